"""Running totals over an ordered column, spread over many tasks.

A plain ``sum over (partition by g order by v)`` sends a whole group to one task. Here the table is range-partitioned by
group and value, so that the ranges follow the data and a large group takes as many as it needs; a window runs inside
each range, and the totals of the ranges, one line per group and range, give the offsets.
"""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import stored


def running_totals(df, by, order, sums, descending=False):
    """Add ``run_<c>`` (inclusive running sum) and ``all_<c>`` (group total) for each ``c`` in ``sums``.

    ``df`` must hold one row per (``by``, ``order``). Null groups are groups; a null order comes first, last if descending.
    """
    # stored, so that rows and totals read the very same ranges
    ranged = stored(df.repartitionByRange(*by, order).withColumn("_range", F.spark_partition_id()), "ranges")
    way = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    group = Window.partitionBy(*by)
    earlier = group.orderBy(way("_range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], F.col("_range").alias("_of"),
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(group).alias(f"all_{c}") for c in sums])
    inner = Window.partitionBy(*by, "_range").orderBy(way(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ranged.select("*", *[F.sum(c).over(inner).alias(f"_i_{c}") for c in sums])
    same = F.col("_range") == F.col("_of")
    for i, b in enumerate(by):
        same &= F.col(b).eqNullSafe(F.col(f"_by{i}"))
    return inside.join(offsets, same).select(
        *df.columns, *[f"all_{c}" for c in sums], *[(F.col(f"_o_{c}") + F.col(f"_i_{c}")).alias(f"run_{c}") for c in sums])
