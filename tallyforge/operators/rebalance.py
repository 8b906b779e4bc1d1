"""Class rebalancing: synthetic minority rows and removal of Tomek links."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import c
from ..plans.neighbours import BLOCK_ROWS, PROBES, merge_equal, nearest
from ..session import stored
from .split import class_sizes, values_at_ranks


def _vectors(df, columns, key):
    return df.select(c(key).cast("long").alias("key"), F.array(*[c(n).cast("double") for n in columns]).alias("vec"))


def neighbours(df, columns, key, k=5, block_rows=BLOCK_ROWS, probes=None):
    """The ``k`` nearest other rows of each row, copies included: ``(key, rank, neighbour, distance)``.

    Ties go to the lower key. The search runs over distinct vectors; of the rows that share a vector only the k + 1 lowest
    keys can be among the answers of others. It is exact unless ``probes`` bounds the leaves that a vector visits.
    """
    rows = _vectors(df, columns, key)
    points = stored(merge_equal(rows, "key", "vec"), "points")
    members = stored(rows.join(points.select("vec", "id"), "vec").select("id", "key"), "members")
    lowest = members.withColumn("_r", F.row_number().over(Window.partitionBy("id").orderBy("key"))).where(F.col("_r") <= k + 1).select(F.col("id").alias("near"), F.col("key").alias("neighbour"))
    reach = nearest(points, k, block_rows, probes).select("id", F.col("neighbour").alias("near"), "distance2").unionByName(
        points.select("id", F.col("id").alias("near"), F.lit(0.0).alias("distance2")))
    found = F.slice(F.array_sort(F.collect_list(F.struct("distance2", "neighbour"))), 1, (k + 1) * (k + 1))
    lists = reach.join(lowest, "near").groupBy("id").agg(found.alias("found"))
    others = F.slice(F.filter("found", lambda f: f["neighbour"] != F.col("key")), 1, k)
    picked = members.join(lists, "id").select("key", F.posexplode(others).alias("rank", "f"))
    return picked.select("key", (F.col("rank") + 1).alias("rank"), F.col("f.neighbour").alias("neighbour"), F.sqrt("f.distance2").alias("distance"))


def _synthesise(rows, columns, key, label, value, wanted, k, seed, block_rows, stride, probes):
    """``wanted`` synthetic rows of one class, each on the line between a row and a near row of its class.

    Their keys are ``-(key * stride + copy)``; ``stride`` is larger than any number of copies, in all classes.
    """
    size = rows.count()
    if not size or wanted <= 0:
        return None
    vectors = _vectors(rows, columns, key)
    points = stored(merge_equal(vectors, "key", "vec"), "points")
    k_eff = min(k, size - 1)
    each, extra = divmod(wanted, size)
    order = F.xxhash64("key", F.lit(seed))
    cut = values_at_ranks(vectors, {"x": (order, [extra - 1])})["x"][1].get(extra - 1)
    copies = F.lit(each) + (F.lit(0) if cut is None else (order <= F.lit(cut)).cast("int"))

    if k_eff > 0:
        near = nearest(points, k_eff, block_rows, probes).join(
            points.select(F.col("id").alias("neighbour"), F.col("vec").alias("nvec"), F.col("copies").alias("ncopies")), "neighbour"
        )
        # at most k lines per vector
        lists = near.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("distance2", "neighbour", "nvec", "ncopies"))).alias("near"))
        points = points.join(lists, "id", "left")
    else:
        points = points.withColumn("near", F.lit(None).cast("array<struct<distance2:double,neighbour:bigint,nvec:array<double>,ncopies:bigint>>"))
    # the copies of a vector come first, then its neighbours, each as often as it occurs
    own = F.array_repeat(F.struct(F.col("vec").alias("v")), F.least(F.col("copies") - 1, F.lit(k_eff)).cast("int"))
    others = F.flatten(F.transform("near", lambda e: F.array_repeat(F.struct(e["nvec"].alias("v")), F.least(e["ncopies"], F.lit(k_eff)).cast("int"))))
    ranked = F.slice(F.concat(own, F.coalesce(others, F.array().cast("array<struct<v:array<double>>>"))), 1, max(k_eff, 1))
    choices = points.select("vec", ranked.alias("choices"))

    born = (
        vectors.withColumn("_copies", copies).where("_copies > 0")
        .join(choices, "vec")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    )
    pick = F.pmod(F.xxhash64("key", "_copy", F.lit(seed + 1)), F.greatest(F.size("choices"), F.lit(1))).cast("int")
    step = F.pmod(F.xxhash64("key", "_copy", F.lit(seed + 2)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    mate = F.coalesce(F.get("choices", pick)["v"], F.col("vec"))
    made = born.select(
        # negative, hence never the key of a given row
        (-(F.col("key") * stride + F.col("_copy"))).alias(key),
        F.col("key").alias("_parent"),
        F.zip_with("vec", mate, lambda a, b: a + step * (b - a)).alias("_v"),
    )
    return made.select(c(key), *[F.get("_v", F.lit(i)).alias(n) for i, n in enumerate(columns)], F.lit(value).alias(label))


def oversample(df, columns, label, key, k=5, seed=42, block_rows=BLOCK_ROWS, probes=PROBES):
    """Add synthetic rows until every class is as large as the largest.

    ``key`` must be a unique, non-negative whole number. The result holds the key, the
    numeric ``columns`` and the label; synthetic rows carry negative keys. The near rows that synthetic rows lean on are
    searched in ``probes`` leaves (None: exactly).
    """
    sizes = class_sizes(df, label)
    most = max(sizes.values(), default=0)
    base = df.select(c(key).cast("long").alias(key), *[c(n).cast("double").alias(n) for n in columns], c(label))
    out = base
    stride = max((most // n for n in sizes.values() if n), default=1) + 2
    top = base.agg(F.max(c(key))).first()[0] or 0
    if (top + 1) * stride >= 1 << 63:
        raise ValueError(f"keys up to {top} leave no room for {stride} synthetic keys each; number the rows first")
    for value, size in sorted(sizes.items(), key=lambda e: str(e[0])):
        if size < most:
            made = _synthesise(base.where(c(label) == F.lit(value)), columns, key, label, value, most - size, k, seed, block_rows, stride, probes)
            if made is not None:
                out = out.unionByName(made.withColumn(label, c(label).cast(dict(base.dtypes)[label])))
    return out


def tomek_links(df, columns, label, key, block_rows=BLOCK_ROWS, probes=PROBES):
    """Pairs of rows of different classes that are each other's nearest row: ``(a, b)`` with a < b.

    Rows with the same vector are nearest to each other; of these only the two with the
    lowest keys can be a mutual pair. A pair that ``probes`` leaves bring together is checked against both sides' nearest
    rows in these leaves; ``probes=None`` searches all leaves that can matter.
    """
    rows = stored(_vectors(df, columns, key).join(df.select(c(key).cast("long").alias("key"), c(label).alias("y")), "key"), "rows")
    points = stored(merge_equal(rows, "key", "vec"), "points")
    # vectors that occur once: the nearest other vector, represented by its lowest key
    single = points.where("copies = 1").select("id")
    ones = nearest(points, 1, block_rows, probes).select(F.col("id").alias("a"), F.col("neighbour").alias("b")).join(
        single.select(F.col("id").alias("a")), "a", "left_semi"
    )
    mutual = ones.alias("p").join(ones.alias("q"), (F.col("p.a") == F.col("q.b")) & (F.col("p.b") == F.col("q.a"))).where("p.a < p.b").select("p.a", "p.b")
    # vectors that occur more often: the lowest and the second lowest key
    twins = rows.join(points.where("copies > 1").select("vec", F.col("id").alias("a")), "vec").where("key <> a")
    copies = twins.groupBy("a").agg(F.min("key").alias("b"))
    pairs = mutual.unionAll(copies)
    known = rows.select("key", "y")
    left, right = known.toDF("a", "ya"), known.toDF("b", "yb")
    return pairs.join(left, "a").join(right, "b").where("ya <> yb").select("a", "b")


def drop_tomek(df, columns, label, key, block_rows=BLOCK_ROWS, probes=PROBES):
    """Remove both rows of every Tomek link."""
    links = tomek_links(df, columns, label, key, block_rows, probes)
    gone = links.select(F.explode(F.array("a", "b")).alias("_gone")).distinct()
    return df.join(gone, c(key).cast("long") == F.col("_gone"), "left_anti")


def oversample_then_clean(df, columns, label, key, k=5, seed=42, block_rows=BLOCK_ROWS, probes=None):
    """Synthetic rows first, then removal of Tomek links. Both search exactly unless ``probes`` bounds the leaves that a vector visits."""
    grown = stored(oversample(df, columns, label, key, k, seed, block_rows, probes), "grown")
    return drop_tomek(grown, columns, label, key, block_rows, probes)


# The names a configuration may use.
SAMPLERS = {"smote": oversample, "smote_tomek": oversample_then_clean}


def sampler(use_smote=True, use_tomek=False):
    """Name of the resampler for the given switches, or None."""
    return None if not use_smote else ("smote_tomek" if use_tomek else "smote")
