"""Drift tests between the lower and the upper half of the customers, the latter changed on purpose."""
from pyspark.sql import functions as F

from ..operators import drift
from ..plans.profile import CATEGORICAL, NUMERIC, customer_profile, with_profile
from ..session import stored
from . import query
from .exploring import QUARTILES, _rounded, union

NUMS = NUMERIC

HALVES = """, half AS (SELECT avg("CustomerID") AS h FROM cp),
ref AS (SELECT cp.* FROM cp, half WHERE "CustomerID" < h),
new AS (SELECT cp.* REPLACE ("CashbackAmount" * 1.2 AS "CashbackAmount",
  CASE WHEN "CustomerID" % 10 = 0 THEN 'SMART WATCH' ELSE "PreferredLoginDevice" END AS "PreferredLoginDevice") FROM cp, half WHERE "CustomerID" >= h)"""


def halves(spark, sf):
    """Written once: every test reads both halves."""
    cp = stored(customer_profile(spark, sf), "profile")
    half = cp.agg(F.avg("CustomerID")).scalar()
    key = F.col("CustomerID")
    new = cp.where(key >= half).withColumns({
        "CashbackAmount": F.col("CashbackAmount") * 1.2,
        "PreferredLoginDevice": F.when(key % 10 == 0, F.lit("SMART WATCH")).otherwise(F.col("PreferredLoginDevice")),
    })
    return cp.where(key < half), new


@query("h1_numeric_reference", with_profile(union(
    f"""SELECT '{n}' AS feature, round(avg("{n}"), 5) AS mean, round(stddev_samp("{n}"), 5) AS std, round(min("{n}")::DOUBLE, 5) AS min, round(max("{n}")::DOUBLE, 5) AS max,
    round(quantile_cont("{n}"::DOUBLE, 0.25), 7) AS q1, round(quantile_cont("{n}"::DOUBLE, 0.5), 7) AS median, round(quantile_cont("{n}"::DOUBLE, 0.75), 7) AS q3 FROM cp""" for n in NUMS)))
def h1(spark, sf):
    return _rounded(drift.numeric_reference(stored(customer_profile(spark, sf), "profile").select(*NUMS)), 5, **QUARTILES)


@query("h1_category_reference", with_profile(union(
    f"""SELECT '{n}' AS feature, "{n}" AS value, count(*) AS n, round(count(*) / (SELECT count("{n}") FROM cp), 6) AS frequency FROM cp WHERE "{n}" IS NOT NULL GROUP BY 2""" for n in CATEGORICAL)))
def h1_words(spark, sf):
    return _rounded(drift.category_reference(stored(customer_profile(spark, sf), "profile")))


@query("h1_missing_rates", with_profile(union(
    f"""SELECT '{n}' AS "column", round(count(*) FILTER (WHERE "{n}" IS NULL) / count(*), 6) AS missing_rate FROM cp""" for n in NUMS)))
def h1_missing(spark, sf):
    return _rounded(drift.missing_rates(stored(customer_profile(spark, sf), "profile").select(*NUMS)).drop("type"))


@query("h2_h3_schema_drift", """SELECT * FROM (VALUES ('Tenure', 'missing_column', 'double', NULL), ('Age', 'new_column', NULL, 'int'), ('CityTier', 'type_change', 'bigint', 'string'))
 t("column", finding, reference_type, new_type) WHERE (SELECT count(*) FROM customer) > 0""")
def h2(spark, sf):
    ref, new = halves(spark, sf)
    new = new.drop("Tenure").withColumn("Age", F.lit(1)).withColumn("CityTier", F.col("CityTier").cast("string"))
    found = drift.schema_drift(ref, new)
    return found.where(ref.agg(F.count(F.lit(1)) > 0).scalar())


def _ks(n):
    return f"""SELECT '{n}' AS feature, max(na) AS n_reference, max(nb) AS n_new, round(max(abs(ra / na - rb / nb)), 6) AS statistic FROM (
   SELECT sum(a) OVER (ORDER BY v) AS ra, sum(b) OVER (ORDER BY v) AS rb, CAST(sum(a) OVER () AS BIGINT) AS na, CAST(sum(b) OVER () AS BIGINT) AS nb FROM (
     SELECT v, count(*) FILTER (WHERE s = 0) AS a, count(*) FILTER (WHERE s = 1) AS b FROM (
       SELECT "{n}" AS v, 0 AS s FROM ref UNION ALL SELECT "{n}", 1 FROM new) WHERE v IS NOT NULL GROUP BY v)) HAVING max(na) > 0 AND max(nb) > 0"""


@query("h4_ks_statistic", with_profile(HALVES + union(_ks(n) for n in NUMS)))
def h4(spark, sf):
    ref, new = halves(spark, sf)
    return _rounded(drift.ks_statistics(ref, new, NUMS))


@query("h5_moments", with_profile(HALVES + union(
    f"""SELECT '{n}' AS feature, round(abs((SELECT avg("{n}") FROM new) - (SELECT avg("{n}") FROM ref)), 6) AS mean_diff,
    CASE WHEN (SELECT stddev_samp("{n}") FROM ref) > 0 THEN round((SELECT stddev_samp("{n}") FROM new) / (SELECT stddev_samp("{n}") FROM ref), 6) END AS std_ratio""" for n in NUMS)))
def h5(spark, sf):
    ref, new = halves(spark, sf)
    return _rounded(drift.moments(ref, new, NUMS))


_CATS = ["PreferredLoginDevice", "PreferredPaymentMode", "PreferedOrderCat", "tier", "complained"]
_TWO = HALVES + """, ref2 AS (SELECT *, 'tier ' || "CityTier" AS tier, CASE WHEN "Complain" = 1 THEN 'yes' ELSE 'no' END AS complained FROM ref),
new2 AS (SELECT *, 'tier ' || "CityTier" AS tier, CASE WHEN "Complain" = 1 THEN 'yes' ELSE 'no' END AS complained FROM new),
counts AS (""" + " UNION ALL ".join(
    f"""SELECT '{n}' AS feature, v AS value, count(*) FILTER (WHERE s = 0) AS a, count(*) FILTER (WHERE s = 1) AS b
    FROM (SELECT "{n}" AS v, 0 AS s FROM ref2 UNION ALL SELECT "{n}", 1 FROM new2) WHERE v IS NOT NULL GROUP BY v""" for n in _CATS) + ")"


def _two(spark, sf):
    extra = {"tier": F.concat(F.lit("tier "), F.col("CityTier").cast("string")),
             "complained": F.when(F.col("Complain") == 1, "yes").otherwise("no")}
    ref, new = halves(spark, sf)
    return ref.withColumns(extra), new.withColumns(extra)


@query("h6_chi_square", with_profile(_TWO + """, s AS (SELECT feature, count(*) AS m, sum(a) AS na, sum(b) AS nb FROM counts GROUP BY 1),
e AS (SELECT counts.feature, m, na, nb, a, b, (a + b) * na / (na + nb)::DOUBLE AS ea, (a + b) * nb / (na + nb)::DOUBLE AS eb FROM counts JOIN s ON s.feature = counts.feature),
g AS (SELECT *, CASE WHEN m = 2 THEN abs(a - ea) - least(0.5, abs(a - ea)) ELSE abs(a - ea) END AS ga, CASE WHEN m = 2 THEN abs(b - eb) - least(0.5, abs(b - eb)) ELSE abs(b - eb) END AS gb FROM e)
SELECT feature, any_value(m) AS "values", CAST(any_value(na) AS BIGINT) AS n_reference, CAST(any_value(nb) AS BIGINT) AS n_new,
  count(*) FILTER (WHERE a = 0) AS new_values, CAST(NULL AS VARCHAR) AS skipped, round(sum(ga * ga / ea + gb * gb / eb), 6) AS statistic, any_value(m) - 1 AS dof FROM g GROUP BY feature"""))
def h6(spark, sf):
    ref, new = _two(spark, sf)
    return _rounded(drift.chi_square(ref, new, _CATS))


@query("h7_new_categories", with_profile(_TWO + "SELECT feature, value, b AS n FROM counts WHERE a = 0"))
def h7(spark, sf):
    ref, new = _two(spark, sf)
    return drift.new_categories(ref, new, _CATS)


@query("h8_skip_rules", """SELECT feature, count(DISTINCT v) AS "values", max(length(v)) FILTER (WHERE s = 0) AS longest,
 CASE WHEN count(DISTINCT v) > 50 THEN 'too many values' WHEN max(length(v)) FILTER (WHERE s = 0) > 200 THEN 'value too long' END AS skipped FROM (
 SELECT 'text' AS feature, text AS v, CASE WHEN doc_id < (SELECT avg(doc_id) FROM documents) THEN 0 ELSE 1 END AS s FROM documents
 UNION ALL SELECT 'lang', lang, CASE WHEN doc_id < (SELECT avg(doc_id) FROM documents) THEN 0 ELSE 1 END FROM documents
 UNION ALL SELECT 'banner', repeat(lang, 150), CASE WHEN doc_id < (SELECT avg(doc_id) FROM documents) THEN 0 ELSE 1 END FROM documents) GROUP BY feature""")
def h8(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("banner", F.repeat("lang", 150))
    half = docs.agg(F.avg("doc_id")).scalar()
    counts = drift.category_counts(docs.where(F.col("doc_id") < half), docs.where(F.col("doc_id") >= half), ["text", "lang", "banner"])
    return drift.category_shape(counts).select("feature", "values", F.col("longest").cast("long").alias("longest"), drift.skip_reason(50, 200).alias("skipped"))


@query("h9_severity", """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS checked, count(*) FILTER (WHERE value > 40) AS drifted,
   bool_or(value > 400) AS schema_broken FROM events GROUP BY 1, 2)
 SELECT event_type, checked, drifted, schema_broken, CASE WHEN checked = 0 THEN 'NONE' WHEN schema_broken THEN 'CRITICAL' WHEN drifted / checked > 0.3 THEN 'CRITICAL'
   WHEN drifted / checked > 0.15 THEN 'MODERATE' WHEN drifted > 0 THEN 'LOW' ELSE 'NONE' END AS severity FROM d""")
def h9(spark, sf):
    days = spark.read.parquet(f"{sf}/events.parquet").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(F.col("value") > 40).alias("drifted"), F.bool_or(F.col("value") > 400).alias("schema_broken"))
    return days.select("event_type", "checked", "drifted", "schema_broken",
                       drift.severity(F.col("checked"), F.col("drifted"), F.col("schema_broken")).alias("severity"))


@query("h10_drift_report")
def h10(spark, sf):
    ref, new = halves(spark, sf)
    return drift.detect_drift(ref.select(*NUMERIC, *CATEGORICAL), new.select(*NUMERIC, *CATEGORICAL)).details
