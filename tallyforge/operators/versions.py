"""Dataset versions, profiles and lineage kept in append-only tables."""
from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import c, melt, missing_cells, numeric_columns, row_digest, string_columns
from ..session import stored
from ..sources.io import exists

VERSION_SCHEMA = (
    "dataset string, version bigint, version_id string, created_at timestamp, fingerprint string, path string, "
    "description string, tags array<string>, rows bigint, columns int"
)
LINEAGE_SCHEMA = "dataset string, version bigint, parent string, transformation string, created_at timestamp"


def fingerprint_table(df):
    """Row count, and two sums over row hashes that do not depend on row order or partitioning."""
    digest = row_digest(df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.xxhash64(digest).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"),
        F.coalesce(F.bit_xor(F.xxhash64(digest, F.lit(1))), F.lit(0)).alias("hash_xor"),
    )


def fingerprint_and_rows(df):
    """Fingerprint and row count of a table, from one scan."""
    r = fingerprint_table(df).first()
    text = "|".join([str(r["rows"]), r["hash_sum"], str(r["hash_xor"]), ",".join(f"{n}:{t}" for n, t in df.dtypes)])
    return hashlib.md5(text.encode()).hexdigest(), r["rows"]


def fingerprint(df):
    """Content fingerprint of a table as a hex string; column names and types are part of it."""
    return fingerprint_and_rows(df)[0]


def metadata(df):
    """One line per column with the size of the table."""
    cells = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("column"), F.lit(t).alias("type")) for i, (n, t) in enumerate(df.dtypes)])
    return df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(len(df.columns)).alias("columns"), F.inline(cells))


def profile(df, max_numeric=None, max_categorical=None):
    """Long table ``(column, statistic, value)`` of nulls, repeats, numbers and frequent values.

    All columns unless a number of numeric or text columns is given.
    """
    names, n = df.columns, F.count(F.lit(1))
    numbers, words = numeric_columns(df)[:max_numeric], string_columns(df)[:max_categorical]
    line = lambda col, stat, value: F.struct(
        F.lit(col).cast("string").alias("column"), F.lit(stat).alias("statistic"), value.cast("string").alias("value")
    )
    share = F.try_divide(F.sum(missing_cells(names)) * 100.0, n * len(names))
    lines = [line(None, "null_percentage", F.round(share, 2)), line(None, "duplicate_rows", n - F.count_distinct(row_digest(names)))]
    lines += [line(k, "nulls", F.count_if(c(k).isNull())) for k in names]
    for k in numbers:
        x = c(k).cast("double")
        for stat, value in (("min", F.min(x)), ("max", F.max(x)), ("mean", F.avg(x)), ("std", F.stddev_samp(x))):
            lines.append(line(k, stat, F.round(value, 2)))
    wide = df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))
    if not words:
        return wide
    counts = melt(df, words, "string").where("value is not null").groupBy("feature", "value").agg(n.alias("n"))
    unique = counts.groupBy("feature").agg(F.count(F.lit(1)).cast("string").alias("value")).select(
        F.col("feature").alias("column"), F.lit("unique").alias("statistic"), "value"
    )
    # the filter on the rank is applied per task before the shuffle
    best = Window.partitionBy("feature").orderBy(F.col("n").desc(), "value")
    top = counts.withColumn("_rank", F.row_number().over(best)).where("_rank <= 3").select(
        F.col("feature").alias("column"), F.concat(F.lit("top_"), F.col("_rank").cast("string")).alias("statistic"),
        F.concat("value", F.lit("="), F.col("n").cast("string")).alias("value"),
    )
    return wide.unionByName(unique).unionByName(top)


# --------------------------------------------------------------------------- reading version tables


def latest_versions(versions):
    """The newest line of each dataset, by a combinable maximum instead of a window."""
    return versions.groupBy("dataset").agg(F.max_by(F.struct(*[n for n in versions.columns if n != "dataset"]), "version").alias("v")).select("dataset", "v.*")


def version_info(versions, dataset, version_id=None):
    mine = versions.where(c("dataset") == dataset)
    return latest_versions(mine) if version_id is None else mine.where(c("version_id") == version_id)


def with_change(versions):
    """Mark versions whose content differs from the version before (the first one counts as changed)."""
    before = versions.select("dataset", (F.col("version") + 1).alias("version"), F.col("fingerprint").alias("_before"))
    return versions.join(before, ["dataset", "version"], "left").select(
        *versions.columns, (~F.col("fingerprint").eqNullSafe(F.col("_before"))).alias("changed")
    )


def compare_versions(versions, pairs):
    """Differences for the version pairs in ``pairs`` (``dataset, v1, v2``); a missing side gives an error text."""
    side = lambda name: versions.select(
        F.col("dataset"), F.col("version_id").alias(name), F.col("fingerprint").alias(f"{name}_fingerprint"),
        F.col("rows").alias(f"{name}_rows"), F.col("columns").alias(f"{name}_columns"), F.lit(True).alias(f"{name}_known"),
    )
    both = pairs.join(side("v1"), ["dataset", "v1"], "left").join(side("v2"), ["dataset", "v2"], "left")
    known = F.col("v1_known").isNotNull() & F.col("v2_known").isNotNull()
    return both.select(
        "dataset", "v1", "v2",
        F.when(known, ~F.col("v1_fingerprint").eqNullSafe(F.col("v2_fingerprint"))).alias("changed"),
        (F.col("v2_rows") - F.col("v1_rows")).alias("rows_diff"), (F.col("v2_columns") - F.col("v1_columns")).alias("columns_diff"),
        F.when(~known, "version not found").alias("error"),
    )


def ancestors(edges, starts=None):
    """All ancestors of each dataset at their smallest depth: ``(dataset, depth, parent, transformation)``.

    ``edges`` holds ``dataset, parent, transformation``. One join per generation, written out before the next, until
    a generation brings no new ancestor; a dataset is not its own ancestor, so cycles end. Of several ways of one
    length the first transformation by name is named.
    """
    edges = stored(edges.select("dataset", "parent", "transformation"), "edges")
    starts = edges.select("dataset").distinct() if starts is None else starts.select("dataset").distinct()
    steps = edges.select(F.col("dataset").alias("_from"), F.col("parent").alias("_to"), F.col("transformation").alias("_how"))
    front = starts.join(edges, "dataset")
    found, depth = None, 0
    while True:
        depth += 1
        fresh = front.where("dataset <> parent").groupBy("dataset", "parent").agg(F.min("transformation").alias("transformation"))
        if found is not None:
            fresh = fresh.join(found.select("dataset", "parent"), ["dataset", "parent"], "left_anti")
        fresh = stored(fresh.select("dataset", F.lit(depth).alias("depth"), "parent", "transformation"), f"generation-{depth}")
        found = fresh if found is None else found.unionAll(fresh)
        if fresh.isEmpty():
            return found
        front = fresh.join(steps, F.col("parent") == F.col("_from")).select("dataset", F.col("_to").alias("parent"), F.col("_how").alias("transformation"))


# --------------------------------------------------------------------------- the store


class VersionStore:
    """Version and lineage tables below one folder."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name, schema):
        path = f"{self.folder}/{name}"
        if exists(self.spark, path):
            return self.spark.read.schema(schema).parquet(path)
        return self.spark.createDataFrame([], schema)

    @property
    def versions(self):
        return self._read("versions", VERSION_SCHEMA)

    @property
    def lineage(self):
        return self._read("lineage", LINEAGE_SCHEMA)

    def create(self, dataset, df, path, description=None, tags=None, now=None):
        """Append a version; returns the latest id unchanged when its content is the same."""
        mark, rows = fingerprint_and_rows(df)
        last = version_info(self.versions, dataset).first()
        if last and last["fingerprint"] == mark:
            return last["version_id"]
        now = now or dt.datetime.now()
        number = (last["version"] if last else 0) + 1
        version_id = f"v{number}_{now:%Y%m%d_%H%M%S}"
        row = (dataset, number, version_id, now, mark, path, description, tags, rows, len(df.columns))
        self.spark.createDataFrame([row], VERSION_SCHEMA).write.mode("append").parquet(f"{self.folder}/versions")
        return version_id

    def add_lineage(self, dataset, parent, transformation=None, now=None):
        """Record the parent of the latest version; nothing happens for an unknown dataset."""
        last = version_info(self.versions, dataset).first()
        if last is None:
            return
        row = (dataset, last["version"], parent, transformation or "unknown", now or dt.datetime.now())
        self.spark.createDataFrame([row], LINEAGE_SCHEMA).write.mode("append").parquet(f"{self.folder}/lineage")

    def lineage_of(self, dataset):
        newest = self.lineage.groupBy("dataset").agg(
            F.max_by(F.struct("parent", "transformation"), F.struct("version", "created_at")).alias("e")
        ).select("dataset", "e.*")
        start = self.spark.createDataFrame([(dataset,)], "dataset string")
        return ancestors(newest, start)
