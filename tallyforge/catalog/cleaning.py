"""Cleaning, projection and feature construction."""
from pyspark.sql import functions as F

from ..operators import clean, features
from ..plans.profile import NUMERIC, customer_profile, table, with_profile
from . import query


@query("b1_trim_names", "SELECT c_mktsegment, count(*) AS n, min(c_name) AS first_name FROM customer GROUP BY 1")
def b1(spark, sf):
    df = table(spark, sf, "customer")
    df = clean.trim_names(df.toDF(*[f"  {n} " for n in df.columns]))
    return df.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.min("c_name").alias("first_name"))


@query("b2_drop_repeats", """
SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars
FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents) GROUP BY lang, source""")
def b2(spark, sf):
    df = clean.drop_repeats(table(spark, sf, "documents").drop("doc_id"))
    return df.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("b3_map_values", """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'top' WHEN '2-HIGH' THEN 'top' WHEN '5-LOW' THEN 'rest'
       ELSE o_orderpriority END AS o_orderpriority, count(*) AS n FROM orders GROUP BY 1""")
def b3(spark, sf):
    spellings = {"o_orderpriority": {"1-URGENT": "top", "2-HIGH": "top", "5-LOW": "rest"}}
    return clean.map_values(table(spark, sf, "orders"), spellings).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


def _dirty_customer(spark, sf):
    cents = F.col("c_acctbal").cast("decimal(18,2)").cast("string")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit(" ["), cents, F.lit("] ")).alias("bracketed"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("unknown")).otherwise(F.concat(F.lit("("), cents, F.lit(")"))).alias("mixed"),
        F.concat(cents, F.lit("E0")).alias("scientific"),
        F.col("c_mktsegment").alias("words"),
    )


@query("b4_coerce_numbers", """
SELECT c_custkey, c_acctbal AS bracketed,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS mixed_number,
       c_custkey % 3 = 0 AS mixed_is_text, c_acctbal AS scientific, c_mktsegment AS words FROM customer""")
def b4(spark, sf):
    df = clean.coerce_numbers(_dirty_customer(spark, sf))
    return df.select(
        "c_custkey", "bracketed", F.col("mixed").try_cast("double").alias("mixed_number"),
        (F.col("mixed") == "unknown").alias("mixed_is_text"), "scientific", "words",
    )


@query("b5_coerce_strict", """
SELECT c_custkey, c_acctbal AS bracketed,
       CASE WHEN c_custkey % 3 = 0 THEN 'unknown' ELSE '(' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || ')' END AS mixed,
       c_acctbal AS scientific, c_mktsegment AS words FROM customer""")
def b5(spark, sf):
    return clean.coerce_numbers_strict(_dirty_customer(spark, sf))


@query("b6_numbers_for_drift", """
SELECT c_custkey, ' [' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || '] ' AS bracketed,
       CASE WHEN c_custkey % 3 = 0 THEN 'unknown' ELSE '(' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || ')' END AS mixed,
       c_acctbal AS scientific, c_mktsegment AS words FROM customer""")
def b6(spark, sf):
    return clean.numbers_for_drift(_dirty_customer(spark, sf))


@query("b7_column_roles", """
SELECT * FROM (VALUES ('CustomerID','numeric'),('Tenure','numeric'),('CityTier','numeric'),('PreferredPaymentMode','categorical'),
 ('WarehouseToHome','numeric'),('PreferredLoginDevice','categorical'),('HourSpendOnApp','numeric'),('PreferedOrderCat','categorical'),
 ('NumberOfDeviceRegistered','numeric'),('SatisfactionScore','numeric'),('NumberOfAddress','numeric'),('Complain','numeric'),
 ('CouponUsed','numeric'),('OrderCount','numeric'),('DaySinceLastOrder','numeric'),('CashbackAmount','numeric'),
 ('ChurnPlanted','numeric')) t("column", "role") WHERE (SELECT count(*) FROM customer) > 0""")
def b7(spark, sf):
    cp = customer_profile(spark, sf)
    numeric, categorical = clean.column_roles(cp, skip=["Churn"])
    names = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(r).alias("role")) for r, group in (("numeric", numeric), ("categorical", categorical)) for n in group])
    return cp.agg(F.count(F.lit(1)).alias("rows")).where("rows > 0").select(F.inline(names))


@query("b8_split_target", with_profile('SELECT "Churn", count(*) AS n FROM cp GROUP BY 1'))
def b8(spark, sf):
    _, target = clean.split_target(customer_profile(spark, sf), "Churn")
    return target.groupBy("Churn").agg(F.count(F.lit(1)).alias("n"))


@query("b9_project_features", with_profile(
    'SELECT "CustomerID", "Tenure", CAST(0 AS INTEGER) AS absent_one, "OrderCount", CAST(0 AS INTEGER) AS absent_two FROM cp'))
def b9(spark, sf):
    return clean.project_features(customer_profile(spark, sf), ["Tenure", "absent_one", "OrderCount", "absent_two"], keep=["CustomerID"])


@query("b10_drop_constant", with_profile(
    'SELECT "CustomerID", "Tenure", "CityTier", "HourSpendOnApp", "Complain" FROM cp'))
def b10(spark, sf):
    cp = customer_profile(spark, sf).select("CustomerID", "Tenure", "CityTier", "HourSpendOnApp", "NumberOfDeviceRegistered", "Complain")
    return clean.drop_constant(cp)


@query("b11_code_as_category", with_profile(
    'SELECT CAST("CityTier" AS VARCHAR) AS "CityTier", count(*) AS n, count("Tenure") AS with_tenure FROM cp GROUP BY 1'))
def b11(spark, sf):
    df = clean.as_category(customer_profile(spark, sf), ["CityTier"])
    return df.groupBy("CityTier").agg(F.count(F.lit(1)).alias("n"), F.count("Tenure").alias("with_tenure"))


@query("b12_drop_ids", with_profile(
    'SELECT "Tenure", "CityTier", "OrderCount", count(*) AS n FROM cp GROUP BY ALL'))
def b12(spark, sf):
    df = clean.drop_ids(customer_profile(spark, sf).select("CustomerID", "Tenure", "CityTier", "OrderCount"), ["CustomerID"])
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))


@query("b13_only_numeric", with_profile(
    'SELECT "CustomerID", ' + ", ".join(f'"{n}"' for n in NUMERIC) + ', "Churn", "ChurnPlanted" FROM cp'))
def b13(spark, sf):
    return clean.only_numeric(customer_profile(spark, sf))


_FEATURES_SQL = with_profile("""
SELECT "CustomerID",
  round("CashbackAmount" / CASE WHEN "OrderCount" IS NOT NULL THEN greatest("OrderCount", 1) END, 9) AS avg_cashbk_per_order,
  round("OrderCount" / CASE WHEN "Tenure" IS NOT NULL THEN greatest("Tenure", 1) END, 9) AS order_frequency_mpm,
  round("CouponUsed" / CASE WHEN "OrderCount" IS NOT NULL THEN greatest("OrderCount", 1) END, 9) AS coupon_rate,
  round("HourSpendOnApp" * ln(1 + "NumberOfDeviceRegistered"), 9) AS engagement_score,
  round(ln(1 + CASE WHEN "DaySinceLastOrder" IS NOT NULL THEN greatest("DaySinceLastOrder", 0) END), 9) AS "log_DaySinceLastOrder",
  round(ln(1 + CASE WHEN "WarehouseToHome" IS NOT NULL THEN greatest("WarehouseToHome", 0) END), 9) AS "log_WarehouseToHome",
  round(ln(1 + CASE WHEN "OrderCount" IS NOT NULL THEN greatest("OrderCount", 0) END), 9) AS "log_OrderCount",
  round(ln(1 + CASE WHEN "CashbackAmount" IS NOT NULL THEN greatest("CashbackAmount", 0) END), 9) AS "log_CashbackAmount",
  CASE WHEN "CityTier" = 1 THEN 1 ELSE 0 END AS city_is_tier1,
  CASE WHEN "NumberOfAddress" > 1 THEN 1 ELSE 0 END AS multi_address
FROM cp""")


def rounded(df, names, places=9):
    return df.withColumns({n: F.round(n, places) for n in names})


@query("c1_c6_engineered_features", _FEATURES_SQL)
def c1_c6(spark, sf):
    cp = customer_profile(spark, sf)
    new = [n for n in features.engineer(cp).columns if n not in cp.columns]
    df = features.engineer(cp).select("CustomerID", *new)
    return rounded(df, [n for n, t in df.dtypes if t == "double"])


@query("c7_safe_divide", with_profile("""
SELECT "CustomerID",
  round(CASE WHEN "OrderCount" > 0 THEN "CashbackAmount" / "OrderCount" ELSE "CashbackAmount" END, 9) AS avg_cashbk_per_order,
  round(CASE WHEN "Tenure" > 0 THEN "OrderCount" / "Tenure" ELSE "OrderCount" END, 9) AS order_frequency_mpm,
  round(CASE WHEN "OrderCount" > 0 THEN "CouponUsed" / "OrderCount" ELSE 0 END, 9) AS coupon_rate
FROM cp"""))
def c7(spark, sf):
    col = F.col
    df = customer_profile(spark, sf).select(
        "CustomerID",
        features.safe_divide(col("CashbackAmount"), col("OrderCount"), col("CashbackAmount")).alias("avg_cashbk_per_order"),
        features.safe_divide(col("OrderCount"), col("Tenure"), col("OrderCount")).alias("order_frequency_mpm"),
        features.safe_divide(col("CouponUsed"), col("OrderCount"), F.lit(0)).alias("coupon_rate"),
    )
    return rounded(df, df.columns[1:])


@query("c8_interactions", with_profile("""
SELECT "CustomerID", round("WarehouseToHome" * ("OrderCount" / CASE WHEN "Tenure" IS NOT NULL THEN greatest("Tenure", 1) END), 9) AS growth_x_freq,
       "SatisfactionScore" * (1 - "Complain") AS satis_x_complain FROM cp"""))
def c8(spark, sf):
    cp = customer_profile(spark, sf).withColumn("OrderAmountHikeFromlastYear", F.col("WarehouseToHome"))
    df = features.interactions(features.engineer(cp)).select("CustomerID", "growth_x_freq", "satis_x_complain")
    return rounded(df, ["growth_x_freq"])


@query("c9_repair_numbers", with_profile("""
SELECT "CustomerID", coalesce("Tenure", 0) AS "Tenure", coalesce("HourSpendOnApp", 0) AS "HourSpendOnApp",
       coalesce("OrderCount", 0) AS "OrderCount", CASE WHEN "Complain" = 0 THEN 0 ELSE 1.5 END AS rate FROM cp""".replace("1.5", "CAST(1.5 AS DOUBLE)")))
def c9(spark, sf):
    cp = customer_profile(spark, sf)
    rate = F.when(F.col("Complain") == 0, F.lit(float("inf"))).otherwise(F.lit(1.5))
    return features.repair_numbers(cp.select("CustomerID", "Tenure", "HourSpendOnApp", "OrderCount", rate.alias("rate")))


@query("c7_c9_safe_features", with_profile("""
SELECT "CustomerID",
  round(coalesce(CASE WHEN "Tenure" > 0 THEN "OrderCount" / "Tenure" ELSE "OrderCount" END, 0), 9) AS order_frequency_mpm,
  round(coalesce("HourSpendOnApp" * ln(1 + "NumberOfDeviceRegistered"), 0), 9) AS engagement_score,
  round(coalesce(ln(1 + greatest("CashbackAmount", 0)), 0), 9) AS "log_CashbackAmount",
  "SatisfactionScore" * (1 - "Complain") AS satis_x_complain FROM cp"""))
def c7_c9(spark, sf):
    df = features.engineer_safe(customer_profile(spark, sf)).select(
        "CustomerID", "order_frequency_mpm", "engagement_score", "log_CashbackAmount", "satis_x_complain")
    return rounded(df, ["order_frequency_mpm", "engagement_score", "log_CashbackAmount"])
