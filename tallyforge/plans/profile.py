"""``customer_profile``: one row per customer, derived from the driver tables.

Every block below is a left join against a table grouped by the customer key, so
Catalyst drops the blocks (scan, join and shuffle) whose columns a query does not
use. Line items are reduced to one row per order before they meet the orders.
"""
from __future__ import annotations

from pyspark.sql import functions as F

FEATURES = [
    "Tenure", "PreferredLoginDevice", "CityTier", "WarehouseToHome", "PreferredPaymentMode",
    "HourSpendOnApp", "NumberOfDeviceRegistered", "PreferedOrderCat", "SatisfactionScore",
    "NumberOfAddress", "Complain", "CouponUsed", "OrderCount", "DaySinceLastOrder", "CashbackAmount",
]
NUMERIC = [
    "Tenure", "CityTier", "WarehouseToHome", "HourSpendOnApp", "NumberOfDeviceRegistered",
    "SatisfactionScore", "NumberOfAddress", "Complain", "CouponUsed", "OrderCount",
    "DaySinceLastOrder", "CashbackAmount",
]
CATEGORICAL = ["PreferredLoginDevice", "PreferredPaymentMode", "PreferedOrderCat"]


_SCHEMAS = {}


def table(spark, sf_dir, name):
    """One of the given tables; its schema is read from the footer once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def customer_profile(spark, sf_dir):
    customer, nation, orders, lineitem, part, events = (
        table(spark, sf_dir, n)
        for n in ("customer", "nation", "orders", "lineitem", "part", "events")
    )
    # a one-row subquery: runs once, and enters the plan as a constant
    cut = (
        table(spark, sf_dir, "orders")
        .agg((F.max("o_orderdate") - F.expr("INTERVAL 365 DAYS")).alias("cut"))
        .scalar()
    )
    is_past = F.col("o_orderdate") <= cut

    order_facts = (
        orders.groupBy(F.col("o_custkey").alias("order_cust"))
        .agg(
            F.count_if(is_past).alias("n_past"),
            F.min(F.when(is_past, F.col("o_orderdate"))).alias("first_past"),
            F.max(F.when(is_past, F.col("o_orderdate"))).alias("last_past"),
            F.mode(F.when(is_past, F.col("o_orderpriority")), True).alias("payment"),
            F.max("o_orderdate").alias("last_order"),
        )
    )
    past_orders = orders.where(is_past).select("o_orderkey", "o_custkey")

    amount = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(4,2)")
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("l_quantity").alias("quantity"),
        F.bit_or(F.expr("shiftleft(1, cast(l_suppkey % 10 as int))")).alias("address_bits"),
        F.max(((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.095)).cast("int")).alias("complain"),
        F.count_if(F.col("l_discount") > 0.045).alias("coupons"),
        F.sum(amount).alias("cashback"),
    )
    item_facts = (
        past_orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(F.col("o_custkey").alias("item_cust"))
        .agg(
            (F.sum("quantity") / F.sum("items")).alias("avg_quantity"),
            F.bit_count(F.bit_or("address_bits")).alias("addresses"),
            F.max("complain").alias("complain"),
            F.sum("coupons").alias("coupons"),
            F.sum("cashback").alias("cashback"),
        )
    )
    category = (
        lineitem.join(past_orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("o_custkey").alias("cat_cust"))
        .agg(F.mode("p_type", True).alias("category"))
    )
    app_use = events.groupBy(F.col("user_id").alias("app_cust")).agg(
        (F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count("value")).alias("hours"),
        F.count_distinct("event_type").alias("devices"),
    )

    days = lambda early, late: F.datediff(F.to_date(late), F.to_date(early))
    n_past = F.when(F.col("n_past") > 0, F.col("n_past"))
    planted = F.coalesce((F.col("n_past") <= 5).cast("int"), F.lit(1))
    flip = F.col("c_custkey") % 20 == 0
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(order_facts, F.col("c_custkey") == F.col("order_cust"), "left")
        .join(item_facts, F.col("c_custkey") == F.col("item_cust"), "left")
        .join(category, F.col("c_custkey") == F.col("cat_cust"), "left")
        .join(app_use, F.col("c_custkey") == F.col("app_cust"), "left")
        .select(
            F.col("c_custkey").alias("CustomerID"),
            F.floor(days(F.col("first_past"), cut) / 30).cast("double").alias("Tenure"),
            F.col("c_mktsegment").alias("PreferredLoginDevice"),
            (F.col("n_regionkey") % 3 + 1).cast("long").alias("CityTier"),
            F.col("avg_quantity").alias("WarehouseToHome"),
            F.col("payment").alias("PreferredPaymentMode"),
            F.col("hours").alias("HourSpendOnApp"),
            F.col("devices").alias("NumberOfDeviceRegistered"),
            F.col("category").alias("PreferedOrderCat"),
            (F.col("c_custkey") % 5 + 1).alias("SatisfactionScore"),
            F.col("addresses").cast("long").alias("NumberOfAddress"),
            F.coalesce("complain", F.lit(0)).alias("Complain"),
            F.col("coupons").alias("CouponUsed"),
            n_past.alias("OrderCount"),
            days(F.col("last_past"), cut).cast("long").alias("DaySinceLastOrder"),
            F.coalesce(F.col("cashback").cast("double"), F.col("c_acctbal")).alias("CashbackAmount"),
            F.coalesce((F.col("last_order") <= cut).cast("int"), F.lit(1)).alias("Churn"),
            F.when(flip, 1 - planted).otherwise(planted).alias("ChurnPlanted"),
        )
    )


# The same table written for the SQL engine; prepended to the SQL twins that need it.
PROFILE_SQL = """
cutoff AS (SELECT max(o_orderdate) - INTERVAL 365 DAY AS cut FROM orders),
past AS (SELECT o.* FROM orders o, cutoff WHERE o_orderdate <= cut),
order_facts AS (
  SELECT o_custkey AS k, count(*) AS n, min(o_orderdate) AS first_past, max(o_orderdate) AS last_past
  FROM past GROUP BY o_custkey),
payment AS (
  SELECT k, v FROM (
    SELECT o_custkey AS k, o_orderpriority AS v,
           row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn
    FROM past GROUP BY o_custkey, o_orderpriority) WHERE rn = 1),
items AS (SELECT p.o_custkey AS k, l.* FROM past p JOIN lineitem l ON l.l_orderkey = p.o_orderkey),
item_facts AS (
  SELECT k, sum(l_quantity) / count(*) AS q, count(DISTINCT l_suppkey % 10) AS addresses,
         max(CASE WHEN l_returnflag = 'R' AND l_discount > 0.095 THEN 1 ELSE 0 END) AS complain,
         count(*) FILTER (WHERE l_discount > 0.045) AS coupons,
         sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS cashback
  FROM items GROUP BY k),
category AS (
  SELECT k, v FROM (
    SELECT k, p_type AS v, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, p_type) AS rn
    FROM items JOIN part ON p_partkey = l_partkey GROUP BY k, p_type) WHERE rn = 1),
app_use AS (
  SELECT user_id AS k, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS hours, count(DISTINCT event_type) AS devices
  FROM events GROUP BY user_id),
last_orders AS (SELECT o_custkey AS k, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey),
planted AS (
  SELECT c_custkey AS k, CASE WHEN n IS NULL OR n <= 5 THEN 1 ELSE 0 END AS low
  FROM customer LEFT JOIN order_facts ON k = c_custkey),
cp AS (
  SELECT c_custkey AS "CustomerID",
         CAST(date_diff('day', first_past, cut) // 30 AS DOUBLE) AS "Tenure",
         c_mktsegment AS "PreferredLoginDevice",
         CAST(n_regionkey % 3 + 1 AS BIGINT) AS "CityTier",
         q AS "WarehouseToHome",
         payment.v AS "PreferredPaymentMode",
         hours AS "HourSpendOnApp",
         devices AS "NumberOfDeviceRegistered",
         category.v AS "PreferedOrderCat",
         c_custkey % 5 + 1 AS "SatisfactionScore",
         addresses AS "NumberOfAddress",
         CAST(coalesce(complain, 0) AS INTEGER) AS "Complain",
         coupons AS "CouponUsed",
         n AS "OrderCount",
         date_diff('day', last_past, cut) AS "DaySinceLastOrder",
         coalesce(CAST(cashback AS DOUBLE), c_acctbal) AS "CashbackAmount",
         CASE WHEN last_order > cut THEN 0 ELSE 1 END AS "Churn",
         CASE WHEN c_custkey % 20 = 0 THEN 1 - low ELSE low END AS "ChurnPlanted"
  FROM customer CROSS JOIN cutoff
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN order_facts ON order_facts.k = c_custkey
  LEFT JOIN payment ON payment.k = c_custkey
  LEFT JOIN item_facts ON item_facts.k = c_custkey
  LEFT JOIN category ON category.k = c_custkey
  LEFT JOIN app_use ON app_use.k = c_custkey
  LEFT JOIN last_orders ON last_orders.k = c_custkey
  LEFT JOIN planted ON planted.k = c_custkey)
"""


def with_profile(sql):
    """Prefix ``sql`` (a SELECT, or further CTEs starting with a comma) with the profile."""
    body = sql.strip()
    return f"WITH {PROFILE_SQL.strip()}{body if body.startswith(',') else ' ' + body}"
