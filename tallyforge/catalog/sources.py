"""Sources and sinks."""
from pyspark.sql import functions as F

from ..plans.profile import table
from ..session import scratch_path
from ..sources.io import read_period, read_table, write_by_month, write_table
from . import query

_BY_SEGMENT = """
SELECT c_mktsegment, count(*) AS n, count(DISTINCT c_nationkey) AS nations,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM customer GROUP BY c_mktsegment"""


def _by_segment(df):
    return df.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("c_nationkey").alias("nations"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"),
    )


@query("a1_read_csv", _BY_SEGMENT)
def a1(spark, sf):
    path = write_table(table(spark, sf, "customer"), scratch_path(spark, "customer") + ".csv")
    return _by_segment(read_table(spark, path, table(spark, sf, "customer").schema))


@query("a1_read_csv_inferred", _BY_SEGMENT)
def a1_inferred(spark, sf):
    path = write_table(table(spark, sf, "customer"), scratch_path(spark, "customer") + ".csv")
    return _by_segment(read_table(spark, path))


@query("a2_read_parquet", _BY_SEGMENT)
def a2(spark, sf):
    return _by_segment(read_table(spark, f"{sf}/customer.parquet"))


@query("a4_write_json_read_back", _BY_SEGMENT)
def a4(spark, sf):
    path = write_table(table(spark, sf, "customer"), scratch_path(spark, "customer") + ".json")
    return _by_segment(read_table(spark, path))


@query("a6_period_filter", """
SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1998-07-01'
GROUP BY 1""")
def a6(spark, sf):
    folder = write_by_month(table(spark, sf, "orders"), scratch_path(spark, "orders"), "o_orderdate")
    df = read_period(spark, folder, "1996-03", "1998-Q2")
    return df.groupBy(F.col("period").cast("string").alias("period")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )
