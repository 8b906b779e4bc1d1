"""Fitted transforms: each query fits on the whole profile and applies the result."""
from pyspark.sql import functions as F

from ..operators import split, transforms as t
from ..plans.profile import NUMERIC, customer_profile, with_profile
from ..session import stored
from . import query
from .cleaning import rounded

NUMS = NUMERIC


def _cp(spark, sf, *columns):
    """The profile, written once because fitting and applying both read it."""
    df = customer_profile(spark, sf)
    return stored(df.select(*columns) if columns else df, "profile")


def _nums(spark, sf):
    return _cp(spark, sf, "CustomerID", *NUMS)


def _each(template, names=NUMS):
    return ", ".join(template.replace("@", f'"{n}"') for n in names)


@query("d1_median_fill", with_profile(
    f"""SELECT "CustomerID", {_each('coalesce(@::DOUBLE, (SELECT quantile_cont(@, 0.5)::DOUBLE FROM cp)) AS @')} FROM cp"""))
def d1(spark, sf):
    df = _nums(spark, sf)
    return t.MissingFiller(skip=["CustomerID"]).fit(df).transform(df)


@query("d2_mean_fill", with_profile(
    f"""SELECT "CustomerID", {_each('round(coalesce(@::DOUBLE, (SELECT avg(@) FROM cp)), 6) AS @')} FROM cp"""))
def d2(spark, sf):
    df = _nums(spark, sf)
    return rounded(t.MissingFiller(numeric="mean", skip=["CustomerID"]).fit(df).transform(df), NUMS, 6)


_MODE = """, gaps AS (SELECT "CustomerID", CASE WHEN "CustomerID" % 4 = 0 THEN NULL ELSE "PreferredLoginDevice" END AS device,
  "PreferredPaymentMode" AS payment FROM cp)
SELECT "CustomerID", coalesce(device, (SELECT device FROM gaps WHERE device IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS device,
 coalesce(payment, (SELECT payment FROM gaps WHERE payment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS payment FROM gaps"""


def _gaps(spark, sf):
    device = F.when(F.col("CustomerID") % 4 != 0, F.col("PreferredLoginDevice")).alias("device")
    return _cp(spark, sf, "CustomerID", device, F.col("PreferredPaymentMode").alias("payment"))


@query("d3_mode_fill", with_profile(_MODE))
def d3(spark, sf):
    df = _gaps(spark, sf)
    return t.MissingFiller(skip=["CustomerID"]).fit(df).transform(df)


@query("d4_unknown_fill", with_profile("""SELECT "CustomerID",
 CASE WHEN "CustomerID" % 4 = 0 THEN 'Unknown' ELSE "PreferredLoginDevice" END AS device, coalesce("PreferredPaymentMode", 'Unknown') AS payment FROM cp"""))
def d4(spark, sf):
    df = _gaps(spark, sf)
    return t.MissingFiller(categorical="unknown", skip=["CustomerID"]).fit(df).transform(df)


# The cents carry four decimals, so bounds end after seven: eight places cannot meet a rounding tie.
_LIMITS = ", ".join(
    f"""quantile_cont("{n}", 0.25) - 1.5 * (quantile_cont("{n}", 0.75) - quantile_cont("{n}", 0.25)) AS lo{i},
    quantile_cont("{n}", 0.75) + 1.5 * (quantile_cont("{n}", 0.75) - quantile_cont("{n}", 0.25)) AS hi{i}""" for i, n in enumerate(NUMS))
_CLIPPED = ", ".join(
    f"""round(CASE WHEN "{n}" < lo{i} THEN lo{i} WHEN "{n}" > hi{i} THEN hi{i} ELSE "{n}" END, 8) AS "{n}" """ for i, n in enumerate(NUMS))


@query("d5_iqr_clip", with_profile(f', b AS (SELECT {_LIMITS} FROM cp) SELECT "CustomerID", {_CLIPPED} FROM cp, b'))
def d5(spark, sf):
    df = _nums(spark, sf)
    return rounded(t.OutlierLimiter(skip=["CustomerID"]).fit(df).transform(df), NUMS, 8)


@query("d5_iqr_bounds", with_profile(f""", b AS (SELECT {_LIMITS} FROM cp)
{' UNION ALL '.join(f"SELECT '{n}' AS feature, round(lo{i}, 8) AS low, round(hi{i}, 8) AS high FROM b" for i, n in enumerate(NUMS))}"""))
def d5_bounds(spark, sf):
    model = t.OutlierLimiter(skip=["CustomerID"]).fit(_nums(spark, sf))
    values = model.parameters(spark).groupBy(F.col("column").alias("feature"))
    pick = lambda p: F.round(F.max(F.when(F.col("param") == p, F.col("value").cast("double"))), 8).alias(p)
    return values.agg(pick("low"), pick("high"))


@query("d6_zscore_replace", with_profile(f"""SELECT "CustomerID",
 {_each('round(CASE WHEN (SELECT stddev_samp(@) FROM cp) = 0 THEN @::DOUBLE WHEN abs((@ - (SELECT avg(@) FROM cp)) / (SELECT stddev_samp(@) FROM cp)) <= 2.0 THEN @ ELSE (SELECT avg(@) FROM cp) END, 6) AS @')} FROM cp"""))
def d6(spark, sf):
    df = _nums(spark, sf)
    near = t.OutlierLimiter(method="zscore", threshold=2.0, skip=["CustomerID"]).fit(df).transform(df)
    return rounded(near.withColumns({n: F.col(n).cast("double") for n in NUMS}), NUMS, 6)  # a constant column stays as it is


_CODES = """, train AS (SELECT DISTINCT "PreferredLoginDevice" AS v FROM cp WHERE "PreferredLoginDevice" <> 'MACHINERY'),
codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM train)
SELECT "CustomerID", CAST(coalesce(code, @) AS INTEGER) AS "PreferredLoginDevice" FROM cp LEFT JOIN codes ON v = "PreferredLoginDevice" """


def _coded(spark, sf, **options):
    df = _cp(spark, sf, "CustomerID", "PreferredLoginDevice")
    train = df.where(F.col("PreferredLoginDevice") != "MACHINERY")
    return t.CategoryCoder(**options).fit(train).transform(df)


@query("d7_codes_unseen_minus_one", with_profile(_CODES.replace("@", "-1")))
def d7(spark, sf):
    return _coded(spark, sf)


@query("d7_codes_from_table", """
WITH codes AS (SELECT c_name AS v, row_number() OVER (ORDER BY c_name) - 1 AS code FROM (SELECT DISTINCT c_name FROM customer))
SELECT c_custkey, CAST(code AS INTEGER) AS c_name FROM customer JOIN codes ON v = c_name""")
def d7_table(spark, sf):
    df = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name")
    return t.CategoryCoder(columns=["c_name"]).fit(df).transform(df)


@query("d8_codes_unseen_last", with_profile(_CODES.replace("@", "(SELECT count(*) FROM codes)")))
def d8(spark, sf):
    return _coded(spark, sf, unseen="size")


@query("d9_standard_scale", with_profile(f"""SELECT "CustomerID",
 {_each('round((@ - (SELECT avg(@) FROM cp)) / (SELECT CASE stddev_pop(@) WHEN 0 THEN 1 ELSE stddev_pop(@) END FROM cp), 6) AS @')} FROM cp"""))
def d9(spark, sf):
    df = _nums(spark, sf)
    return rounded(t.Scaler(skip=["CustomerID"]).fit(df).transform(df), NUMS, 6)


@query("d10_minmax_scale", with_profile(f"""SELECT "CustomerID",
 {_each('round((@ - (SELECT min(@) FROM cp)) / (SELECT CASE max(@) - min(@) WHEN 0 THEN 1 ELSE max(@) - min(@) END FROM cp), 6) AS @')} FROM cp"""))
def d10(spark, sf):
    df = _nums(spark, sf)
    return rounded(t.Scaler(kind="minmax", skip=["CustomerID"]).fit(df).transform(df), NUMS, 6)


@query("d11_robust_scale", with_profile(f"""SELECT "CustomerID",
 {_each('round((@ - (SELECT quantile_cont(@, 0.5) FROM cp)) / (SELECT coalesce(nullif(quantile_cont(@, 0.75) - quantile_cont(@, 0.25), 0), 1) FROM cp), 6) AS @')} FROM cp"""))
def d11(spark, sf):
    df = _nums(spark, sf)
    return rounded(t.Scaler(kind="robust", skip=["CustomerID"]).fit(df).transform(df), NUMS, 6)


_F = " UNION ALL ".join(f"""
SELECT '{n}' AS feature, round((sum(nc * (mc - mean) * (mc - mean)) / (count(*) - 1)) / nullif(sum(nc * vc) / (sum(nc) - count(*)), 0), 4) AS f_value FROM (
 SELECT count("{n}") AS nc, avg("{n}") AS mc, var_pop("{n}") AS vc, (SELECT avg("{n}") FROM cp) AS mean FROM cp GROUP BY "ChurnPlanted")""" for n in NUMS)


@query("d12_anova_scores", with_profile("SELECT * FROM (" + _F + ")"))
def d12(spark, sf):
    scores = t.anova_scores(customer_profile(spark, sf), NUMS, "ChurnPlanted")
    return spark.createDataFrame([(n, v) for n, v in scores.items()], "feature string, f_value double").select("feature", F.round("f_value", 4).alias("f_value"))


@query("d12_top_features", with_profile("SELECT feature FROM (" + _F + ") ORDER BY f_value DESC NULLS LAST LIMIT 3"))
def d12_top(spark, sf):
    df = _cp(spark, sf, "CustomerID", "ChurnPlanted", *NUMS)
    model = t.FeaturePicker(label="ChurnPlanted", k=3, keep=["CustomerID"]).fit(df)
    return spark.createDataFrame([(n,) for n in model.learned["selected"]], "feature string")


def _bin(n):
    width = f"""nullif(((SELECT max("{n}") FROM cp) - (SELECT min("{n}") FROM cp)) / 10.0::DOUBLE, 0)"""
    return f"""least(coalesce(CAST(floor(("{n}" - (SELECT min("{n}") FROM cp)) / {width}) AS INTEGER), 0), 9)"""


_MI = " UNION ALL ".join(f"""
SELECT '{n}' AS feature, round(sum(k / t * ln(k * t / (kb * ky))), 6) AS information FROM (
 SELECT count(*)::DOUBLE AS k, sum(count(*)) OVER ()::DOUBLE AS t, sum(count(*)) OVER (PARTITION BY b)::DOUBLE AS kb, sum(count(*)) OVER (PARTITION BY y)::DOUBLE AS ky
 FROM (SELECT {_bin(n)} AS b, "ChurnPlanted" AS y FROM cp WHERE "{n}" IS NOT NULL) GROUP BY b, y)""" for n in NUMS)


@query("d13_information_scores", with_profile("SELECT * FROM (" + _MI + ")"))
def d13(spark, sf):
    scores = t.information_scores(_cp(spark, sf, "ChurnPlanted", *NUMS), NUMS, "ChurnPlanted")
    return spark.createDataFrame(list(scores.items()), "feature string, information double").select("feature", F.round("information", 6).alias("information"))


@query("d14_prepared_table")
def d14(spark, sf):
    cp = _cp(spark, sf).drop("Churn")
    train, test = split.stratified_split(cp, "ChurnPlanted", "CustomerID")
    return t.preparation(label="ChurnPlanted").fit(train).transform(test)
