"""Explanation of model scores by Shapley values, as projections and aggregates."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import as_number, c, numeric_columns
from ..plans.quantiles import exact_quantiles
from .clean import coerce_numbers_strict
from .split import sample_rows

BACKGROUND_ROWS = 50


def numeric_input(df, train, columns=None):
    """Numbers only: text is read as numbers where possible, gaps become the train median (or 0)."""
    columns = list(columns or train.columns)
    numeric = set(numeric_columns(train))
    numbers = train.select(*[(c(n).cast("double") if n in numeric else as_number(c(n))).alias(n) for n in columns])
    medians = exact_quantiles(numbers, columns, [0.5])
    ready = coerce_numbers_strict(df, [n for n in columns if n in df.columns and n not in set(numeric_columns(df))])
    now_numeric = set(numeric_columns(ready))
    cells = {}
    for n in columns:
        x = c(n).cast("double") if n in now_numeric else as_number(c(n))
        middle = medians[n][0.5]
        cells[n] = F.coalesce(x, F.lit(0.0 if middle is None else middle)).alias(n)
    return ready.select(*[c(k) for k in ready.columns if k not in cells], *cells.values())


def linear_shapley(df, coefficients, background, key):
    """Exact values of a linear score: ``coefficient x (value - background mean)``, long form."""
    names = list(coefficients)
    means = background.agg(*[F.avg(c(n)).alias(f"m{i}") for i, n in enumerate(names)]).first()
    cells = [
        F.struct(F.lit(n).alias("feature"), (F.lit(float(coefficients[n])) * (c(n) - F.lit(means[i]))).alias("value"))
        for i, n in enumerate(names)
        if means[i] is not None
    ]
    return df.select(c(key), F.inline(F.array(*cells)))


def sampled_shapley(df, score, columns, background, key, permutations=10, seed=42):
    """Shapley values of any model by random feature orders: ``(key, feature, value)``.

    ``score(frame)`` must add a ``score`` column to a frame that holds ``columns``. Every row is
    walked from a background row to itself in ``permutations`` random orders, switching one
    feature at a time; a feature earns the change of the score at its switch. All points are
    scored in one distributed pass, and the differences are sums, so no window is needed.
    """
    columns = list(columns)
    # at most BACKGROUND_ROWS rows, so they may travel with every task
    rows = sample_rows(background.withColumn("_key", F.xxhash64(*[c(n) for n in columns])), BACKGROUND_ROWS, "_key", seed)
    base = [tuple(r) for r in rows.select(*[c(n).cast("double") for n in columns]).limit(BACKGROUND_ROWS).collect()]
    table = F.array(*[F.array(*[F.lit(v) for v in r]) for r in base])

    order = F.array_sort(F.array(*[
        F.struct(F.xxhash64(c(key), F.col("_perm"), F.lit(seed), F.lit(i)).alias("h"), F.lit(i).alias("i")) for i in range(len(columns))
    ]))
    walks = (
        df.select(c(key), *[c(n).cast("double").alias(n) for n in columns])
        .withColumn("_perm", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
        .withColumn("_order", F.transform(order, lambda e: e["i"]))
        .withColumn("_base", F.get(table, F.pmod(F.xxhash64(c(key), F.col("_perm"), F.lit(-seed)), F.lit(len(base))).cast("int")))
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(len(columns)))))
    )
    points = walks.select(
        c(key), "_order", "_step",
        *[
            F.when(F.array_position("_order", F.lit(i)) <= F.col("_step"), c(n)).otherwise(F.get("_base", F.lit(i))).alias(n)
            for i, n in enumerate(columns)
        ],
    )
    scored = score(points)
    names = F.array(*[F.lit(n) for n in columns])
    shares = F.array(
        F.struct(F.get("_order", F.col("_step") - 1).alias("i"), F.col("score").alias("gain")),
        F.struct(F.get("_order", F.col("_step")).alias("i"), (-F.col("score")).alias("gain")),
    )
    return (
        scored.select(c(key), F.inline(shares))
        .where("i is not null")
        .groupBy(c(key), F.get(names, F.col("i")).alias("feature"))
        .agg((F.sum("gain") / permutations).alias("value"))
    )


def global_importance(values):
    """Mean absolute value per feature, largest first."""
    return values.groupBy("feature").agg(F.avg(F.abs("value")).alias("importance")).orderBy(F.col("importance").desc(), "feature")
