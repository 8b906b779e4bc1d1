"""Rendezvous hashing of stable record keys over weighted shards.

Each record scores every shard with a hash of (key, shard) and goes to the best one. A new shard can only win
records for itself; all others stay where they are. The expected load of a shard is proportional to its weight.
"""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyforge.session import stored


def _cost(keys, shard, weight):
    """-ln(u) / weight for a uniform hash u of the key and the shard; the least cost wins."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(f"shard-{shard}"), *keys), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.struct((-F.ln(u) / F.lit(float(weight))).alias("cost"), F.lit(shard).alias("shard"))


def shard_of(keys, weights):
    """The shard of a key as a column; ``weights`` has one positive number per shard, at most a few hundred."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one for each shard")
    scores = [_cost(keys, i, w) for i, w in enumerate(weights)]
    return (F.least(*scores) if len(scores) > 1 else scores[0])["shard"]


def assign(docs, weights, key="doc_id", text="text"):
    """Shard, position in the shard, and the shard if one more of weight 1 were added.

    Columns: the key, size (UTF-8 bytes of the text plus 16), text_crc32, law, shard, slot, grown_shard.
    Slots count from 0 in each shard in the order of (key, size, crc), without gaps. A null text counts as empty. A null
    key is a key like any other. Rows with equal keys share a shard, each with its own slot. Other columns are
    ignored, so their names cannot clash. An empty table gives no rows.

    Positions come from ranges: rows are cut into ranges of the sort order, a window numbers the rows of one shard in
    one range, and the counts of earlier ranges are added. The place a row was read from is the last sort key, so
    that many equal rows still spread over ranges.
    """
    keys = [F.col(key).alias("doc_id")]
    rows = docs.select(
        *keys,
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.spark_partition_id().alias("_read"),
    )
    by = [F.col("doc_id")]
    rows = rows.withColumns({"shard": shard_of(by, weights), "grown_shard": shard_of(by, [*weights, 1.0])})
    order = ["doc_id", "size", "text_crc32", "_read"]
    ranged = stored(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "shards")
    counts = ranged.groupBy("shard", "_range").count()
    earlier = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy("shard", "_range").orderBy(*order))
    return ranged.join(offsets, ["shard", "_range"]).select(
        F.col("doc_id").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_before") + number - 1).cast("long").alias("slot"), "grown_shard",
    )
