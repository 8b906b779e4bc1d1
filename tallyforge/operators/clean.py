"""Cleaning: names, duplicates, value spellings, numbers kept as text, column choice."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import (
    STRICT_NUMBER_PATTERN,
    as_number,
    c,
    nan_to_null,
    numeric_columns,
    string_columns,
)

# Spellings brought together in the customer table.
VALUE_SPELLINGS = {
    "PreferredLoginDevice": {"Phone": "Mobile Phone"},
    "PreferredPaymentMode": {"CC": "Credit Card", "Cash on Delivery": "COD"},
}


def trim_names(df):
    return df.toDF(*[n.strip() for n in df.columns])


def drop_repeats(df):
    """Drop rows equal in all columns; missing equals missing."""
    return nan_to_null(df).dropDuplicates()


def map_values(df, spellings=None):
    """Replace values by ``{column: {old: new}}``; absent columns are skipped."""
    for name, pairs in (spellings or VALUE_SPELLINGS).items():
        if name in df.columns:
            df = df.replace(pairs, subset=[name])
    return df


def _parse_text(df, columns, parsed, partial):
    """Turn text columns whose non-null cells all parse into doubles, in one pass over the table."""
    columns = list(columns)
    if not columns:
        return df
    stats = df.agg(
        *[F.count(c(n)).alias(f"n{i}") for i, n in enumerate(columns)],
        *[F.count(parsed(c(n))).alias(f"p{i}") for i, n in enumerate(columns)],
    ).first()
    new = {}
    for i, n in enumerate(columns):
        cells, numbers = stats[f"n{i}"], stats[f"p{i}"]
        if cells and cells == numbers:
            new[n] = parsed(c(n)).alias(n)
        elif partial and numbers:
            new[n] = F.coalesce(parsed(c(n)).cast("string"), c(n)).alias(n)
    return df.select(*[new.get(n, c(n)) for n in df.columns]) if new else df


def coerce_numbers(df, columns=None):
    """Read numbers out of text cells such as ``" [5E-1] "``.

    A column in which every cell is a number becomes a double; in a mixed column the
    numbers are rewritten in one spelling and the column stays text.
    """
    return _parse_text(df, columns or string_columns(df), as_number, partial=True)


def coerce_numbers_strict(df, columns=None):
    """As ``coerce_numbers``, with the strict spelling, and only for wholly numeric columns."""
    return _parse_text(
        df, columns or string_columns(df), lambda x: as_number(x, STRICT_NUMBER_PATTERN), partial=False
    )


def numbers_for_drift(df):
    """Wholly numeric text columns become doubles before two tables are compared."""

    def plain(col):
        text = F.trim(col)
        return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([Ee][+-]?\d+)?$"), text.try_cast("double"))

    return _parse_text(df, string_columns(df), plain, partial=False)


def clean(df, spellings=None, remove_duplicates=True):
    """The whole cleaning step: names, duplicates, spellings, numbers kept as text."""
    df = trim_names(df)
    df = drop_repeats(df) if remove_duplicates else nan_to_null(df)
    return coerce_numbers(map_values(df, spellings))


def column_roles(df, skip=()):
    """``(numeric, categorical)`` column names, read from the schema alone."""
    return numeric_columns(df, skip), string_columns(df, skip)


def split_target(df, target):
    """``(features, target)`` as two frames; an absent target is an error."""
    if target not in df.columns:
        raise KeyError(f"Target '{target}' not found")
    return df.drop(target), df.select(c(target))


def project_features(df, names, keep=()):
    """Exactly the named features in that order; absent ones are 0."""
    return df.select(
        *[c(n) for n in keep],
        *[c(n) if n in df.columns else F.lit(0).alias(n) for n in names],
    )


def constant_columns(df, columns=None):
    """Columns with at most one distinct non-null value, by one min/max aggregate."""
    columns = list(columns or df.columns)
    row = df.agg(
        *[F.min(c(n)).alias(f"a{i}") for i, n in enumerate(columns)],
        *[F.max(c(n)).alias(f"b{i}") for i, n in enumerate(columns)],
    ).first()
    return [n for i, n in enumerate(columns) if row[f"a{i}"] == row[f"b{i}"]]


def drop_constant(df, columns=None):
    return df.drop(*constant_columns(df, columns))


def as_category(df, columns):
    """Treat numeric codes as categories."""
    return df.withColumns({n: c(n).cast("string") for n in columns if n in df.columns})


def drop_ids(df, columns):
    return df.drop(*columns)


def only_numeric(df):
    return df.select(*[c(n) for n in numeric_columns(df)])
