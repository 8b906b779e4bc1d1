"""Explanations of a fixed linear score, and of a fitted model."""
from pyspark.sql import functions as F

from ..operators import explain, models
from ..plans.profile import customer_profile, with_profile
from ..session import stored
from . import query
from .exploring import _rounded, union

# The linear score that is explained.
COEFFICIENTS = {"OrderCount": -0.08, "CouponUsed": -0.03, "DaySinceLastOrder": 0.001, "Complain": 0.2, "CityTier": 0.01}


def _filled(spark, sf):
    cells = [F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in COEFFICIENTS]
    return stored(customer_profile(spark, sf).select("CustomerID", "ChurnPlanted", *cells), "profile")


_VALUES = union(f"""SELECT "CustomerID", '{n}' AS feature, {b} * (coalesce("{n}", 0) - (SELECT avg(coalesce("{n}", 0)) FROM cp)) AS value FROM cp""" for n, b in COEFFICIENTS.items())


@query("k1_numeric_input", with_profile("""SELECT "CustomerID", coalesce("OrderCount"::DOUBLE, (SELECT quantile_cont("OrderCount"::DOUBLE, 0.5) FROM cp)) AS "OrderCount",
 coalesce("HourSpendOnApp", (SELECT quantile_cont("HourSpendOnApp", 0.5) FROM cp)) AS "HourSpendOnApp" FROM cp"""))
def k1(spark, sf):
    cp = stored(customer_profile(spark, sf).select("CustomerID", "OrderCount", "HourSpendOnApp"), "profile")
    text = cp.withColumn("OrderCount", F.concat(F.lit(" ["), F.col("OrderCount").cast("string"), F.lit("] ")))
    return explain.numeric_input(text, cp, ["OrderCount", "HourSpendOnApp"])


@query("k2_linear_shapley", with_profile(f'SELECT "CustomerID", feature, round(value, 6) AS value FROM ({_VALUES})'))
def k2(spark, sf):
    df = _filled(spark, sf)
    return _rounded(explain.linear_shapley(df, COEFFICIENTS, df, "CustomerID"))


@query("k3_sampled_shapley")
def k3(spark, sf):
    df = _filled(spark, sf)
    fitted = models.train(df, "logistic_regression", list(COEFFICIENTS), "ChurnPlanted")
    return explain.sampled_shapley(df, lambda frame: models.predict(fitted, frame), list(COEFFICIENTS), df, "CustomerID", permutations=4)


@query("k4_global_importance", with_profile(f"SELECT feature, round(avg(abs(value)), 6) AS importance FROM ({_VALUES}) GROUP BY 1"))
def k4(spark, sf):
    df = _filled(spark, sf)
    return _rounded(explain.global_importance(explain.linear_shapley(df, COEFFICIENTS, df, "CustomerID")))
