"""Splits, folds and samples with exact sizes and no sort of the table.

Rows are ordered by a hash of their key. The hash value at the wanted rank is found by
``values_at_ranks``; a row then knows its side by comparing its own hash with a constant.
Copies of one key always land on the same side.
"""
from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.columns import c
from ..plans.quantiles import values_at_ranks

MAX_CLASSES = 1000


def hash_order(key, seed=42):
    return F.xxhash64(c(key), F.lit(seed))


def half_up(x):
    return math.floor(x + 0.5)


def class_sizes(df, label, max_classes=MAX_CLASSES):
    """Rows of each class; an error above ``max_classes``, since the classes come to the driver."""
    rows = df.groupBy(c(label).alias("y")).count().limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"'{label}' has more than {max_classes} classes")
    return {r["y"]: r["count"] for r in rows}


def _is_class(label, value):
    return c(label).isNull() if value is None else c(label) == F.lit(value)


def thresholds(df, label, order, ranks_of):
    """Hash values at class-wise ranks: ``{class: [value, ...]}``; ``ranks_of(n)`` gives the ranks."""
    sizes = class_sizes(df, label)
    wanted = {y: (F.when(_is_class(label, y), order), ranks_of(n)) for y, n in sizes.items()}
    found = values_at_ranks(df, wanted)
    return {y: [found[y][1].get(r) for r in ranks_of(n)] for y, n in sizes.items()}


def with_side(df, label, key, test_size=0.2, seed=42, order=None, column="is_test"):
    """Mark ``round(n * test_size)`` rows of every class as test rows."""
    if label not in df.columns:
        raise ValueError(f"Target '{label}' not found for splitting")
    order = hash_order(key, seed) if order is None else order
    cut = thresholds(df, label, order, lambda n: [half_up(n * test_size) - 1])
    side = F.lit(False)
    for y, (value,) in cut.items():
        if value is not None:
            side = F.when(_is_class(label, y), order <= F.lit(value)).otherwise(side)
    return df.withColumn(column, F.coalesce(side, F.lit(False)))


def stratified_split(df, label, key, test_size=0.2, seed=42, order=None):
    """``(train, test)`` with the class shares of the whole table."""
    marked = with_side(df, label, key, test_size, seed, order, "_test")
    return marked.where(~c("_test")).drop("_test"), marked.where(c("_test")).drop("_test")


def three_way_split(df, label, key, test_size=0.3, validation_size=0.15, seed=42, order=None):
    """``(train, validation, test)``: the test part first, then validation out of the rest."""
    rest, test = stratified_split(df, label, key, test_size, seed, order)
    train, validation = stratified_split(rest, label, key, validation_size, seed + 1, order)
    return train, validation, test


def with_folds(df, label, key, k=5, seed=42, order=None, column="fold"):
    """Number ``k`` folds so that every fold has the class shares of the table."""
    order = hash_order(key, seed) if order is None else order
    cuts = thresholds(df, label, order, lambda n: [half_up(n * i / k) - 1 for i in range(1, k)])
    fold = F.lit(0)
    for y, values in cuts.items():
        inside = F.lit(0)
        for v in values:
            # no value: the earlier folds are empty, so every row lies beyond this cut
            inside = inside + (F.lit(1) if v is None else (order > F.lit(v)).cast("int"))
        fold = F.when(_is_class(label, y), inside).otherwise(fold)
    return df.withColumn(column, fold.cast("int"))


def sample_fraction(df, fraction, key, seed=42):
    """A repeatable random fraction, chosen row by row from the hash of the key."""
    unit = F.pmod(hash_order(key, seed), F.lit(1 << 31)) / F.lit(float(1 << 31))
    return df.where(unit < F.lit(float(fraction)))


def sample_rows(df, n, key, seed=42, order=None):
    """``n`` random rows, repeatable; keys are taken to be unique."""
    order = hash_order(key, seed) if order is None else order
    cut = values_at_ranks(df, {"cut": (order, lambda size: [min(n, size) - 1])})["cut"][1]
    return df.where(order <= F.lit(list(cut.values())[0])) if cut else df.where(F.lit(False))


def first_rows(df, n, key):
    """The ``n`` rows with the lowest keys."""
    return df.orderBy(c(key)).limit(n)
