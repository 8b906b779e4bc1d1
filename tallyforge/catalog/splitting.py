"""Splits, folds, samples and rebalancing."""
from pyspark.sql import functions as F

from ..operators import rebalance, split
from ..plans.profile import customer_profile, table, with_profile
from ..session import stored
from . import query

def key_order():
    """An order both engines can compute."""
    return F.pmod(F.pmod(F.col("CustomerID"), F.lit(2147483648)) * F.lit(2654435761) + 42, F.lit(4294967296))


ORDER_SQL = '(("CustomerID" % 2147483648) * 2654435761 + 42) % 4294967296'


def _cp(spark, sf):
    return stored(customer_profile(spark, sf).select("CustomerID", "OrderCount", "ChurnPlanted"), "profile")


@query("e1_stratified_split", with_profile(f"""
SELECT "CustomerID", "ChurnPlanted", row_number() OVER (PARTITION BY "ChurnPlanted" ORDER BY {ORDER_SQL})
  <= round(count(*) OVER (PARTITION BY "ChurnPlanted") * 0.2) AS is_test FROM cp"""))
def e1(spark, sf):
    return split.with_side(_cp(spark, sf), "ChurnPlanted", "CustomerID", order=key_order()).drop("OrderCount")


@query("e2_three_way_split", with_profile(f"""
, a AS (SELECT "CustomerID", "ChurnPlanted", {ORDER_SQL} AS h, row_number() OVER (PARTITION BY "ChurnPlanted" ORDER BY {ORDER_SQL})
  <= round(count(*) OVER (PARTITION BY "ChurnPlanted") * 0.3) AS is_test FROM cp),
b AS (SELECT *, row_number() OVER (PARTITION BY "ChurnPlanted" ORDER BY h) <= round(count(*) OVER (PARTITION BY "ChurnPlanted") * 0.15) AS is_val
  FROM a WHERE NOT is_test)
SELECT "CustomerID", 'test' AS part FROM a WHERE is_test UNION ALL SELECT "CustomerID", CASE WHEN is_val THEN 'validation' ELSE 'train' END FROM b"""))
def e2(spark, sf):
    train, validation, test = split.three_way_split(_cp(spark, sf), "ChurnPlanted", "CustomerID", order=key_order())
    parts = [df.select("CustomerID", F.lit(n).alias("part")) for n, df in (("train", train), ("validation", validation), ("test", test))]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("e3_stratified_folds", with_profile(f"""
, r AS (SELECT "ChurnPlanted", row_number() OVER (PARTITION BY "ChurnPlanted" ORDER BY {ORDER_SQL}) AS r, count(*) OVER (PARTITION BY "ChurnPlanted") AS n FROM cp)
SELECT CAST((r > round(n / 5.0)) ::INT + (r > round(n * 2 / 5.0))::INT + (r > round(n * 3 / 5.0))::INT + (r > round(n * 4 / 5.0))::INT AS INTEGER) AS fold,
  "ChurnPlanted", count(*) AS n, CAST(sum(r) AS BIGINT) AS ranks FROM r GROUP BY ALL""".replace(", CAST(sum(r) AS BIGINT) AS ranks", "")))
def e3(spark, sf):
    df = split.with_folds(_cp(spark, sf), "ChurnPlanted", "CustomerID", order=key_order())
    return df.groupBy("fold", "ChurnPlanted").agg(F.count(F.lit(1)).alias("n"))


@query("e7_fraction_sample")
def e7(spark, sf):
    return split.sample_fraction(table(spark, sf, "orders"), 0.3, "o_orderkey")


@query("e8_random_rows", with_profile(f'SELECT "CustomerID", "OrderCount" FROM cp ORDER BY {ORDER_SQL} LIMIT 200'))
def e8(spark, sf):
    return split.sample_rows(_cp(spark, sf), 200, "CustomerID", order=key_order()).select("CustomerID", "OrderCount")


@query("e8_first_rows", with_profile('SELECT "CustomerID", "OrderCount" FROM cp ORDER BY "CustomerID" LIMIT 100'))
def e8_first(spark, sf):
    return split.first_rows(_cp(spark, sf), 100, "CustomerID").select("CustomerID", "OrderCount")


# --------------------------------------------------------------------------- rebalancing

COLUMNS = ["OrderCount", "CouponUsed", "DaySinceLastOrder", "CashbackAmount", "WarehouseToHome"]


def rebalance_input(spark, sf):
    cells = [F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in COLUMNS]
    return stored(customer_profile(spark, sf).select("CustomerID", *cells, "ChurnPlanted"), "profile")


def vectors(spark, sf):
    df = table(spark, sf, "embeddings")
    return df.select(F.col("vec_id").alias("id"), *[F.get("embedding", F.lit(i)).cast("double").alias(f"v{i}") for i in range(64)], (F.col("label") % 2).alias("side"))


_NEAR = """WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e, label % 2 AS side FROM embeddings),
 d AS (SELECT a.id AS a, b.id AS b, a.side AS sa, b.side AS sb, list_sum(list_transform(list_zip(a.e, b.e), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS d2 FROM v a JOIN v b ON a.id <> b.id),
 r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d2, b) AS rn FROM d) """


@query("e4_nearest_neighbours", _NEAR + "SELECT a AS key, b AS neighbour, round(sqrt(d2), 6) AS distance FROM r WHERE rn <= 5")
def e4_near(spark, sf):
    df = vectors(spark, sf)
    # leaves of 40 vectors: the exact search goes through a dozen of them at the smallest scale
    near = rebalance.neighbours(df, [f"v{i}" for i in range(64)], "id", 5, block_rows=40)
    return near.select("key", "neighbour", F.round("distance", 6).alias("distance"))


@query("e4_oversample")
def e4(spark, sf):
    return rebalance.oversample(rebalance_input(spark, sf), COLUMNS, "ChurnPlanted", "CustomerID")


@query("e4_class_sizes", with_profile('SELECT y AS "ChurnPlanted", max(k) AS n FROM (SELECT unnest([0, 1]) AS y), (SELECT count(*) AS k FROM cp GROUP BY "ChurnPlanted") GROUP BY 1'))
def e4_sizes(spark, sf):
    grown = rebalance.oversample(rebalance_input(spark, sf), COLUMNS, "ChurnPlanted", "CustomerID")
    return grown.groupBy("ChurnPlanted").agg(F.count(F.lit(1)).alias("n"))


@query("e5_tomek_links", _NEAR + """, n AS (SELECT a, b, sa, sb FROM r WHERE rn = 1)
 SELECT x.a, x.b FROM n x JOIN n y ON x.a = y.b AND x.b = y.a WHERE x.a < x.b AND x.sa <> x.sb""")
def e5(spark, sf):
    # exact: sixteen leaves of noise in 64 directions hold less than half of the nearest
    return rebalance.tomek_links(vectors(spark, sf), [f"v{i}" for i in range(64)], "side", "id", probes=None)


@query("e6_oversample_then_clean")
def e6(spark, sf):
    return rebalance.oversample_then_clean(rebalance_input(spark, sf), COLUMNS, "ChurnPlanted", "CustomerID")
