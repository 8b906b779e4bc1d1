"""Exploratory aggregates: the tables behind every chart and summary."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..functions.columns import c, melt, missing_cells, numeric_columns, row_digest, string_columns
from ..plans.quantiles import exact_quantiles
from ..session import stored


def _table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def dataset_summary(df, target=None):
    """One line: rows, columns, missing cells, repeated rows, share of positive labels."""
    names = df.columns
    positive = (
        F.count_if(c(target) == 1) / F.nullif(F.count(c(target)), F.lit(0))
        if target in names
        else F.lit(None).cast("double")
    )
    # counting distinct digests keeps whole rows out of the shuffle
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(names)).cast("long").alias("n_cols"),
        F.coalesce(F.sum(missing_cells(names)), F.lit(0)).alias("missing"),
        (F.count(F.lit(1)) - F.count_distinct(row_digest(names))).alias("duplicates"),
        positive.alias("target_rate"),
    )


def missing_by_column(df):
    """Missing count and share of each column that has any, smallest share first."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c(n).isNull()).alias(f"m{i}") for i, n in enumerate(df.columns)]
    )
    cells = F.array(*[
        F.struct(F.lit(n).alias("column"), F.lit(t).alias("type"), F.col(f"m{i}").alias("missing"))
        for i, (n, t) in enumerate(df.dtypes)
    ])
    return (
        counts.select("n", F.inline(cells))
        .where("missing > 0")
        .select("column", "type", "missing", (F.col("missing") * 100.0 / F.col("n")).alias("percent"))
        .orderBy("percent", "column")
    )


def target_distribution(df, target):
    """Rows and share of each class."""
    counts = df.groupBy(c(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("t")).scalar()
    return counts.select("label", "n", (F.col("n") * 100.0 / total).alias("percent"))


def histogram(df, columns=None, bins=20, bandwidth_bins=1.0):
    """Counts and a smoothed density per equal-width bin: ``(feature, bin, low, high, n, density)``.

    The density is a Gaussian kernel over the bin counts, so it costs columns x bins^2 on a
    tiny table and never looks at the rows again.
    """
    columns = list(columns or numeric_columns(df))
    edges = df.agg(
        *[F.min(c(n)).cast("double").alias(f"a{i}") for i, n in enumerate(columns)],
        *[F.max(c(n)).cast("double").alias(f"b{i}") for i, n in enumerate(columns)],
    ).first()
    binned, widths = [], []
    for i, n in enumerate(columns):
        low, high = edges[f"a{i}"], edges[f"b{i}"]
        x = c(n).cast("double")
        if low is None:
            continue
        width = (high - low) / bins
        at = F.floor((x - low) / width).cast("int") if width else F.lit(0)
        binned.append((n, F.when(x.isNotNull(), F.least(at, F.lit(bins - 1)))))
        widths.append((n, low, width))
    spark = df.sparkSession
    shape = _table(spark, widths, "feature string, lowest double, width double")
    counts = (
        melt(df.select(*[x.alias(n) for n, x in binned]), [n for n, _ in binned], "int", value_col="bin")
        .where("bin is not null")
        .groupBy("feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # at most columns x bins lines from here on
    per_feature = counts.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by_bin"), F.sum("n").alias("total")
    )
    grid = per_feature.join(F.broadcast(shape), "feature").withColumn(
        "bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))
    )
    smooth = F.aggregate(
        F.map_entries("by_bin"),
        F.lit(0.0),
        lambda acc, e: acc + e["value"] * F.exp(-0.5 * F.pow((F.col("bin") - e["key"]) / bandwidth_bins, 2)),
    ) / (F.sqrt(F.lit(2 * 3.141592653589793)) * bandwidth_bins)
    return grid.select(
        "feature",
        "bin",
        (F.col("lowest") + F.col("bin") * F.col("width")).alias("low"),
        (F.col("lowest") + (F.col("bin") + 1) * F.col("width")).alias("high"),
        F.coalesce(F.element_at("by_bin", F.col("bin")), F.lit(0)).alias("n"),
        F.when(F.col("width") > 0, smooth / (F.col("total") * F.col("width"))).alias("density"),
    )


def box_statistics(df, columns=None, whisker=1.5):
    """Quartiles, whiskers (furthest values within ``whisker`` x IQR) and outlier count per column."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    columns = [n for n in columns if quartiles[n][0.25] is not None]
    lines = []
    for n in columns:
        q1, q2, q3 = (quartiles[n][p] for p in (0.25, 0.5, 0.75))
        low, high = q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1)
        x = c(n).cast("double")
        inside = F.when((x >= low) & (x <= high), x)
        lines.append(
            F.struct(
                F.lit(n).alias("feature"), F.lit(q1).alias("q1"), F.lit(q2).alias("median"), F.lit(q3).alias("q3"),
                F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high"),
                F.count_if((x < low) | (x > high)).alias("outliers"),
            )
        )
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def correlations(df, columns=None):
    """Pearson correlation of all pairs below the diagonal, each over the rows where both are known.

    One pass over the table: ``(column_a, column_b, correlation)``.
    """
    columns = list(columns or numeric_columns(df))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    return _correlate(df, pairs)


def _cross_products(columns, shifts):
    """Per task the sums of products of every two columns over the rows where both are known, as (i, j, sums) lines."""
    def add_up(batches):
        p = len(columns)
        total = np.zeros((4, p, p))
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(p)]) - shifts
            known = np.column_stack([batch.column(i).is_valid().to_numpy(zero_copy_only=False) for i in range(p)]).astype(float)
            x = np.where(known > 0, x, 0.0)
            total += np.stack([known.T @ known, x.T @ known, x.T @ x, (x * x).T @ known])
        i, j = np.indices((p, p)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *[pa.array(t.reshape(-1)) for t in total]], names=["i", "j", "n", "x", "xy", "xx"])

    return add_up


def _correlate(df, pairs):
    """Correlation of column pairs from one pass: each task adds up its cross products, the shuffle carries their sums.

    Values are taken from the middle of their range, so that a constant column has exactly no variance (a null result).
    """
    columns = list(dict.fromkeys(n for p in pairs for n in p))
    if not columns:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, correlation double")
    # stored, as two passes read it; so are the sums, one line per pair of columns, which meet themselves below
    x = stored(df.select(*[c(n).cast("double").alias(n) for n in columns]), "numbers")
    middle = x.agg(*[F.coalesce((F.min(c(n)) + F.max(c(n))) / 2, F.lit(0.0)) for n in columns]).first()
    task = _cross_products(columns, np.array(list(middle), float))
    sums = x.mapInArrow(task, "i long, j long, n double, x double, xy double, xx double")
    sums = stored(sums.groupBy("i", "j").agg(*[F.sum(k).alias(k) for k in ("n", "x", "xy", "xx")]), "sums")
    wanted = df.sparkSession.createDataFrame([(columns.index(a), columns.index(b), a, b) for a, b in pairs], "i long, j long, column_a string, column_b string")
    other = sums.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("x").alias("y"), F.col("xx").alias("yy"))
    both = wanted.join(sums, ["i", "j"]).join(other, ["i", "j"])
    mean = lambda k: F.try_divide(F.col(k), F.col("n"))
    rest = lambda s, q: mean(q) - mean(s) * mean(s)
    spread = lambda s, q: F.when(rest(s, q) > 1e-13 * mean(q), rest(s, q)).otherwise(0.0)
    return both.select("column_a", "column_b", F.try_divide(mean("xy") - mean("x") * mean("y"), F.sqrt(spread("x", "xx") * spread("y", "yy"))).alias("correlation"))


def target_correlations(df, target, top_n=15, columns=None):
    """The ``top_n`` columns most correlated with the target, by absolute value, sign kept."""
    columns = [n for n in columns or numeric_columns(df) if n != target]
    return (
        _correlate(df, [(n, target) for n in columns])
        .where("correlation is not null")
        .select(F.col("column_a").alias("feature"), "correlation")
        .orderBy(F.abs("correlation").desc(), "feature")
        .limit(top_n)
    )


def collinear_pairs(df, threshold=0.8, columns=None):
    return correlations(df, columns).where(F.abs("correlation") > threshold)


def target_rate_by_category(df, target, max_values=None, max_columns=None, columns=None):
    """Target rate of each value against the overall rate; all columns and values unless limits are given."""
    columns = list(columns or string_columns(df, {target}))
    if not columns:
        return df.limit(0).selectExpr("'' feature", "'' value", "0L n", "0D rate", "0D overall", "false above")
    counts = (
        melt(df, columns, "string", keep=[c(target).cast("double").alias("_y")])
        .groupBy("feature", "value")
        .agg(F.sum("_y").alias("hits"), F.count("_y").alias("known"), F.count(F.lit(1)).alias("n"))
    )
    # reads every column of ``counts`` so that both branches share one shuffle
    per_feature = counts.groupBy("feature").agg(
        F.count("value").alias("values"), F.sum("hits").alias("hits"), F.sum("known").alias("known"), F.sum("n").alias("n")
    )
    position = F.array_position(F.array(*[F.lit(n) for n in columns]), F.col("feature"))
    fits = F.lit(True) if max_values is None else F.col("values") <= max_values
    shortlist = per_feature.where(fits).agg(
        F.slice(F.sort_array(F.collect_list(F.struct(
            position.alias("at"), "feature", (F.col("hits") * 100.0 / F.col("known")).alias("overall")
        ))), 1, max(1, len(columns) if max_columns is None else max_columns)).alias("picked")
    ).select(F.inline("picked"))
    rate = F.col("hits") * 100.0 / F.nullif(F.col("known"), F.lit(0))
    return (
        counts.where("value is not null")
        .join(F.broadcast(shortlist), "feature")
        .select("feature", "value", "n", rate.alias("rate"), "overall", (rate > F.col("overall")).alias("above"))
    )


def target_by_value(df, target, columns=None):
    """For every value of every column: positives, rows and percentage."""
    columns = list(columns or df.columns)
    return (
        melt(df, columns, "string", keep=[c(target).cast("long").alias("_y")])
        .where("value is not null")
        .groupBy("feature", "value")
        .agg(F.sum("_y").alias("churned"), F.count(F.lit(1)).alias("total"))
        .withColumn("percent", F.round(F.col("churned") * 100 / F.col("total"), 2))
    )


def describe_numeric(df, columns=None):
    """count, mean, std, min, quartiles and max per numeric column."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    lines = []
    for n in columns:
        x = c(n).cast("double")
        q = [F.lit(quartiles[n][p]).cast("double") for p in (0.25, 0.5, 0.75)]
        lines.append(F.struct(
            F.lit(n).alias("feature"), F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"), F.max(x).alias("max"),
        ))
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def value_counts(df, columns=None):
    """Rows per value of each categorical column."""
    columns = list(columns or string_columns(df))
    return melt(df, columns, "string").where("value is not null").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def describe_categorical(df, columns=None):
    """count, distinct values, most frequent value (smallest on a tie) and its frequency."""
    best = F.min(F.struct((-F.col("n")).alias("k"), "value"))
    return value_counts(df, columns).groupBy("feature").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best["value"].alias("top"), (-best["k"]).alias("freq")
    )


def distinct_counts(df, columns=None):
    return value_counts(df, columns).groupBy("feature").agg(F.count(F.lit(1)).alias("unique"))


def target_rate(df, target):
    """Positive rows in percent, two decimals."""
    return df.agg(F.round(F.sum(c(target).cast("long")) * 100 / F.count(F.lit(1)), 2).alias("percent"))
