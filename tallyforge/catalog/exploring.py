"""Exploratory aggregates over the derived profile."""
from pyspark.sql import functions as F

from ..operators import explore
from ..plans.profile import CATEGORICAL, FEATURES, NUMERIC, customer_profile, table, with_profile
from ..session import stored
from . import query

ALL = ["CustomerID", *FEATURES, "Churn", "ChurnPlanted"]


# Quartiles of numbers with four decimals end after six: seven places cannot meet a rounding tie.
QUARTILES = {"q1": 7, "median": 7, "q3": 7}


def _rounded(df, places=6, **other):
    return df.select(*[F.round(n, other.get(n, places)).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes])


def union(lines):
    return "SELECT * FROM (" + " UNION ALL ".join(lines) + ")"


@query("f1_dataset_summary", with_profile(f"""SELECT count(*) AS n_rows, 18::BIGINT AS n_cols,
 CAST(sum({' + '.join(f'("{n}" IS NULL)::INT' for n in ALL)}) AS BIGINT) AS missing,
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM cp)) AS duplicates,
 round(count(*) FILTER (WHERE "Churn" = 1) / count("Churn"), 6) AS target_rate FROM cp"""))
def f1(spark, sf):
    return _rounded(explore.dataset_summary(customer_profile(spark, sf), "Churn"))


@query("f1_document_summary", """SELECT count(*) AS n_rows, 4::BIGINT AS n_cols,
 CAST(sum((text IS NULL)::INT + (lang IS NULL)::INT + (source IS NULL)::INT + (n_chars IS NULL)::INT) AS BIGINT) AS missing,
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)) AS duplicates,
 CAST(NULL AS DOUBLE) AS target_rate FROM documents""")
def f1_documents(spark, sf):
    return explore.dataset_summary(table(spark, sf, "documents").drop("doc_id"))


@query("f2_missing_by_column", with_profile(union(
    f"""SELECT '{n}' AS "column", count(*) FILTER (WHERE "{n}" IS NULL) AS missing,
    round(count(*) FILTER (WHERE "{n}" IS NULL) * 100.0 / count(*), 6) AS percent FROM cp""" for n in ALL) + " WHERE missing > 0"))
def f2(spark, sf):
    return _rounded(explore.missing_by_column(customer_profile(spark, sf)).drop("type"))


@query("f3_target_distribution", with_profile(
    'SELECT "Churn" AS label, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM cp), 6) AS percent FROM cp GROUP BY 1'))
def f3(spark, sf):
    return _rounded(explore.target_distribution(customer_profile(spark, sf), "Churn"))


def _hist(n):
    width = f"""nullif((SELECT max("{n}") - min("{n}") FROM cp) / 10.0::DOUBLE, 0)"""
    return f"""SELECT '{n}' AS feature, least(coalesce(CAST(floor(("{n}" - (SELECT min("{n}") FROM cp)) / {width}) AS INTEGER), 0), 9) AS bin, count(*) AS n
    FROM cp WHERE "{n}" IS NOT NULL GROUP BY 2"""


@query("f4_histogram", with_profile(union(_hist(n) for n in NUMERIC)))
def f4(spark, sf):
    cp = stored(customer_profile(spark, sf).select(*NUMERIC), "profile")
    return explore.histogram(cp, bins=10).where("n > 0").select("feature", "bin", "n")


@query("f4_density", with_profile(f""", h AS ({union(_hist(n) for n in NUMERIC)}),
 w AS ({union(f'''SELECT '{n}' AS feature, (max("{n}") - min("{n}")) / 10.0::DOUBLE AS width, count("{n}") AS total FROM cp''' for n in NUMERIC)}),
 g AS (SELECT feature, width, total, CAST(b AS INTEGER) AS bin FROM w, range(10) r(b))
 SELECT g.feature, g.bin, round(1e6 * sum(h.n * exp(-0.5 * pow(g.bin - h.bin, 2))) / (sqrt(2 * pi()) * any_value(total) * nullif(any_value(width), 0)), 4) AS density_ppm
 FROM g JOIN h ON h.feature = g.feature GROUP BY g.feature, g.bin"""))
def f4_density(spark, sf):
    cp = stored(customer_profile(spark, sf).select(*NUMERIC), "profile")
    return explore.histogram(cp, bins=10).select("feature", "bin", F.round(F.col("density") * 1e6, 4).alias("density_ppm"))


def _box(n):
    return f"""SELECT '{n}' AS feature, round(q1, 7) AS q1, round(q2, 7) AS median, round(q3, 7) AS q3,
    round(min(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 5) AS whisker_low,
    round(max(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 5) AS whisker_high,
    count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outliers
    FROM (SELECT CAST("{n}" AS DOUBLE) AS x FROM cp) , (SELECT quantile_cont("{n}"::DOUBLE, 0.25) AS q1, quantile_cont("{n}"::DOUBLE, 0.5) AS q2, quantile_cont("{n}"::DOUBLE, 0.75) AS q3 FROM cp)
    GROUP BY q1, q2, q3"""


@query("f5_box_statistics", with_profile(union(_box(n) for n in NUMERIC)))
def f5(spark, sf):
    return _rounded(explore.box_statistics(stored(customer_profile(spark, sf).select(*NUMERIC), "profile")), 5, **QUARTILES)


def _corr(a, b):
    return f"""SELECT '{a}' AS column_a, '{b}' AS column_b, CASE WHEN stddev_pop(x) > 0 AND stddev_pop(y) > 0 THEN round(corr(x, y), 6) END AS correlation
    FROM (SELECT "{a}"::DOUBLE AS x, "{b}"::DOUBLE AS y FROM cp WHERE "{a}" IS NOT NULL AND "{b}" IS NOT NULL)"""


PAIRS = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[:i]]


@query("f6_correlations", with_profile(union(_corr(a, b) for a, b in PAIRS)))
def f6(spark, sf):
    return _rounded(explore.correlations(customer_profile(spark, sf), NUMERIC))


_TARGET = union(_corr(n, "ChurnPlanted") for n in NUMERIC)


@query("f7_target_correlations", with_profile(
    f"SELECT column_a AS feature, correlation FROM ({_TARGET}) WHERE correlation IS NOT NULL ORDER BY abs(correlation) DESC LIMIT 15"))
def f7(spark, sf):
    return _rounded(explore.target_correlations(customer_profile(spark, sf), "ChurnPlanted", 15, NUMERIC))


_RATES = " UNION ALL ".join(
    f"""SELECT '{n}' AS feature, "{n}" AS value, count(*) AS n, avg("@") * 100 AS rate FROM cp WHERE "{n}" IS NOT NULL GROUP BY 2""" for n in CATEGORICAL)


def rate_sql(target):
    return with_profile(f""", r AS ({_RATES.replace('@', target)}), o AS (SELECT avg("{target}") * 100 AS overall FROM cp)
    SELECT feature, value, n, round(rate, 6) AS rate, round(overall, 6) AS overall, rate > overall AS above FROM r, o""")


@query("f8_rate_by_category", rate_sql("Churn"))
def f8(spark, sf):
    return _rounded(explore.target_rate_by_category(customer_profile(spark, sf), "Churn"))


@query("f8_rate_by_category_planted", rate_sql("ChurnPlanted"))
def f8_planted(spark, sf):
    return _rounded(explore.target_rate_by_category(customer_profile(spark, sf), "ChurnPlanted"))


_WHOLE = ["CityTier", "SatisfactionScore", "NumberOfAddress", "CouponUsed", "OrderCount", "DaySinceLastOrder", "PreferredLoginDevice", "PreferredPaymentMode", "PreferedOrderCat"]


@query("f9_target_by_value", with_profile(union(
    f"""SELECT '{n}' AS feature, CAST("{n}" AS VARCHAR) AS value, CAST(sum("Churn") AS BIGINT) AS churned, count(*) AS total,
    round(sum("Churn") * 100 / count(*), 2) AS percent FROM cp WHERE "{n}" IS NOT NULL GROUP BY 2""" for n in _WHOLE)))
def f9(spark, sf):
    return explore.target_by_value(customer_profile(spark, sf), "Churn", _WHOLE)


@query("f10_collinear_pairs", with_profile(f"SELECT * FROM ({union(_corr(a, b) for a, b in PAIRS)}) WHERE abs(correlation) > 0.8"))
def f10(spark, sf):
    return _rounded(explore.collinear_pairs(customer_profile(spark, sf), 0.8, NUMERIC))


@query("f11_top_three", with_profile(
    f"SELECT column_a AS feature, correlation FROM ({_TARGET}) WHERE correlation IS NOT NULL ORDER BY abs(correlation) DESC LIMIT 3"))
def f11(spark, sf):
    return _rounded(explore.target_correlations(customer_profile(spark, sf), "ChurnPlanted", 3, NUMERIC))


@query("f12_describe_numeric", with_profile(union(
    f"""SELECT '{n}' AS feature, count("{n}") AS count, round(avg("{n}"), 5) AS mean, round(stddev_samp("{n}"), 5) AS std, round(min("{n}")::DOUBLE, 5) AS min,
    round(quantile_cont("{n}"::DOUBLE, 0.25), 7) AS q1, round(quantile_cont("{n}"::DOUBLE, 0.5), 7) AS median, round(quantile_cont("{n}"::DOUBLE, 0.75), 7) AS q3,
    round(max("{n}")::DOUBLE, 5) AS max FROM cp""" for n in NUMERIC)))
def f12(spark, sf):
    return _rounded(explore.describe_numeric(stored(customer_profile(spark, sf).select(*NUMERIC), "profile")), 5, **QUARTILES)


_COUNTS = union(f"""SELECT '{n}' AS feature, "{n}" AS value, count(*) AS n FROM cp WHERE "{n}" IS NOT NULL GROUP BY 2""" for n in CATEGORICAL)


@query("f12_describe_categorical", with_profile(f""", k AS ({_COUNTS})
 SELECT feature, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", (array_agg(value ORDER BY n DESC, value))[1] AS top, max(n) AS freq FROM k GROUP BY feature"""))
def f12_words(spark, sf):
    return explore.describe_categorical(customer_profile(spark, sf))


@query("f13_value_counts", with_profile(_COUNTS))
def f13(spark, sf):
    return explore.value_counts(customer_profile(spark, sf))


@query("f13_distinct_counts", with_profile(union(f"""SELECT '{n}' AS feature, count(DISTINCT "{n}") AS "unique" FROM cp""" for n in CATEGORICAL)))
def f13_distinct(spark, sf):
    return explore.distinct_counts(customer_profile(spark, sf))


@query("f14_target_rate", with_profile('SELECT round(sum("Churn") * 100 / count(*), 2) AS percent FROM cp'))
def f14(spark, sf):
    return explore.target_rate(customer_profile(spark, sf), "Churn")
