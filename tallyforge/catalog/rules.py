"""Quality scores and business rules over a soiled copy of the profile."""
from pyspark.sql import functions as F

from ..operators import rules
from ..plans.profile import FEATURES, customer_profile, table, with_profile
from ..session import stored
from . import query

_SOILED = """, base AS (
 SELECT CASE WHEN "CustomerID" % 97 = 0 THEN NULL ELSE "CustomerID" END AS "CustomerID",
  CASE WHEN "CustomerID" % 50 = 0 THEN -"Tenure" - 1 ELSE "Tenure" END AS "Tenure",
  CASE WHEN "CustomerID" % 33 = 0 THEN -"CashbackAmount" ELSE "CashbackAmount" END AS "CashbackAmount", "OrderCount",
  CASE WHEN "CustomerID" % 11 = 0 THEN NULL WHEN "CustomerID" % 37 = 0 THEN 'c' || "CustomerID" || '.mail.example' ELSE 'c' || "CustomerID" || '@mail.example' END AS "Email",
  CASE WHEN "CustomerID" % 29 = 0 THEN '12ab' ELSE '+49 ' || (1000000 + "CustomerID") END AS "Phone" FROM cp),
soiled AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE "CustomerID" % 41 = 0)"""


def soiled(spark, sf):
    key = F.col("CustomerID")
    text = key.cast("string")
    # written once: a rule report reads it several times
    base = stored(customer_profile(spark, sf).select("CustomerID", "Tenure", "CashbackAmount", "OrderCount"), "profile").select(
        F.when(key % 97 != 0, key).alias("CustomerID"),
        F.when(key % 50 == 0, -F.col("Tenure") - 1).otherwise(F.col("Tenure")).alias("Tenure"),
        F.when(key % 33 == 0, -F.col("CashbackAmount")).otherwise(F.col("CashbackAmount")).alias("CashbackAmount"),
        "OrderCount",
        F.when(key % 11 == 0, None).when(key % 37 == 0, F.concat(F.lit("c"), text, F.lit(".mail.example")))
        .otherwise(F.concat(F.lit("c"), text, F.lit("@mail.example"))).alias("Email"),
        F.when(key % 29 == 0, F.lit("12ab")).otherwise(F.concat(F.lit("+49 "), (key + 1000000).cast("string"))).alias("Phone"),
    )
    return base.unionAll(base.where(F.col("CustomerID") % 41 == 0))


def _rounded(df, places=6):
    return df.select(*[F.round(n, places).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes])


_CELLS = ["CustomerID", *FEATURES, "Churn", "ChurnPlanted"]


@query("g1_quality", with_profile(f""", q AS (SELECT count(*) AS rows,
  sum({' + '.join(f'("{n}" IS NULL)::INT' for n in _CELLS)}) / (count(*) * 18.0) AS null_ratio,
  (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM cp))) / count(*) AS duplicate_ratio FROM cp)
 SELECT rows, round(null_ratio, 6) AS null_ratio, round(duplicate_ratio, 6) AS duplicate_ratio,
  round(greatest(0, 1 - (null_ratio + duplicate_ratio) / 2), 6) AS quality_score, null_ratio > 0.2 AS null_warning, duplicate_ratio > 0.05 AS duplicate_warning FROM q"""))
def g1(spark, sf):
    return _rounded(rules.quality(customer_profile(spark, sf)))


@query("g1_quality_documents", """WITH q AS (SELECT count(*) AS rows,
  sum((text IS NULL)::INT + (lang IS NULL)::INT + (source IS NULL)::INT + (n_chars IS NULL)::INT) / (count(*) * 4.0) AS null_ratio,
  (count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents))) / count(*) AS duplicate_ratio FROM documents)
 SELECT rows, round(null_ratio, 6) AS null_ratio, round(duplicate_ratio, 6) AS duplicate_ratio,
  round(greatest(0, 1 - (null_ratio + duplicate_ratio) / 2), 6) AS quality_score, null_ratio > 0.2 AS null_warning, duplicate_ratio > 0.05 AS duplicate_warning FROM q""")
def g1_documents(spark, sf):
    return _rounded(rules.quality(table(spark, sf, "documents").drop("doc_id")))


def _rows(name, rule, sql_where, columns):
    cols = ", ".join(f'"{n}"' for n in columns)

    @query(name, with_profile(f"{_SOILED} SELECT {cols} FROM soiled WHERE {sql_where}"))
    def run(spark, sf):
        return rules.breaking_rows(soiled(spark, sf), rule).select(*columns)


_rows("g2_tenure_negative", "Tenure", '"Tenure" < 0', ["CustomerID", "Tenure"])
_rows("g3_cashback_negative_profile", "CashbackAmount", '"CashbackAmount" < 0', ["CustomerID", "CashbackAmount"])
_rows("g4_cashback_without_orders", "OrderCount_for_Cashback", '"CashbackAmount" > 0 AND ("OrderCount" IS NULL OR "OrderCount" <= 0)', ["CustomerID", "CashbackAmount", "OrderCount"])
_rows("g5_email_format", "Email", r"""NOT regexp_matches("Email", '^[^@\s]+@[^@\s]+\.[^@\s]+$')""", ["CustomerID", "Email"])
_rows("g6_phone_format", "Phone", r"""NOT regexp_matches("Phone", '^\+?[0-9\-\s()]{7,}$')""", ["CustomerID", "Phone"])
_rows("g7_null_key", "CustomerID_null", '"CustomerID" IS NULL', ["CustomerID", "Email", "Phone"])


@query("g3_cashback_negative", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def g3(spark, sf):
    df = table(spark, sf, "customer").withColumn("CashbackAmount", F.col("c_acctbal"))
    return rules.breaking_rows(df, "CashbackAmount").select("c_custkey", "c_acctbal")


@query("g8_repeated_keys", """SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)""")
def g8(spark, sf):
    return rules.rows_with_repeated_key(table(spark, sf, "orders"), "o_custkey").select("o_custkey", "o_orderkey")


@query("g9_rule_report", with_profile(_SOILED + r""", broken AS (
 SELECT 'range' AS category, 'Tenure' AS rule, "CustomerID" AS k, true AS fails FROM soiled WHERE "Tenure" < 0
 UNION ALL SELECT 'range', 'CashbackAmount', "CustomerID", true FROM soiled WHERE "CashbackAmount" < 0
 UNION ALL SELECT 'logic', 'OrderCount_for_Cashback', "CustomerID", true FROM soiled WHERE "CashbackAmount" > 0 AND ("OrderCount" IS NULL OR "OrderCount" <= 0)
 UNION ALL SELECT 'format', 'Email', "CustomerID", true FROM soiled WHERE NOT regexp_matches("Email", '^[^@\s]+@[^@\s]+\.[^@\s]+$')
 UNION ALL SELECT 'format', 'Phone', "CustomerID", true FROM soiled WHERE NOT regexp_matches("Phone", '^\+?[0-9\-\s()]{7,}$')
 UNION ALL SELECT 'referential', 'CustomerID_null', "CustomerID", true FROM soiled WHERE "CustomerID" IS NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY k NULLS FIRST) AS rn FROM broken),
keys AS (SELECT "CustomerID" AS k, count(*) AS n FROM soiled GROUP BY 1 HAVING count(*) > 1)
SELECT category, rule, count(*) AS count, coalesce(string_agg(k::VARCHAR, ',' ORDER BY rn) FILTER (WHERE rn <= 5), '') AS examples, fails FROM ranked GROUP BY ALL
UNION ALL SELECT 'referential', 'CustomerID_duplicates', CAST(sum(n) AS BIGINT), (SELECT string_agg(k::VARCHAR, ',' ORDER BY k) FROM (SELECT k FROM keys WHERE k IS NOT NULL ORDER BY k LIMIT 5)), false FROM keys"""))
def g9(spark, sf):
    return rules.business_rules(soiled(spark, sf))
