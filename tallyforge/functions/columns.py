"""Column expressions shared by the operators."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

# The number spellings a string cell may have.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([Ee][+-]?\d+)?$"
STRICT_NUMBER_PATTERN = r"^[+-]?\d*\.?\d+(?:[Ee][+-]?\d+)?$"


def numeric_columns(df, skip=()):
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def string_columns(df, skip=()):
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in skip
    ]


def c(name):
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def unbracket(col):
    """Trim spaces, then brackets and parentheses, at both ends."""
    return F.regexp_replace(F.trim(col), r"^[\[\]()]+|[\[\]()]+$", "")


def as_number(col, pattern=NUMBER_PATTERN):
    """The number a cell spells, or null; never fails under ANSI rules."""
    text = F.trim(unbracket(col))
    return F.when(text.rlike(pattern), text.try_cast("double"))


def nan_to_null(df):
    """One kind of missing value: NaN becomes null in every floating column."""
    floats = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    if not floats:
        return df
    return df.select(
        *[F.when(~F.isnan(c(n)), c(n)).alias(n) if n in floats else c(n) for n in df.columns]
    )


def missing_cells(names):
    """Number of nulls of one row."""
    return reduce(lambda a, b: a + b, [c(n).isNull().cast("long") for n in names], F.lit(0))


def row_digest(names):
    """128 bits of a row that tell nulls, and neighbouring cells, apart."""
    cells = [F.coalesce(F.concat(F.lit("v"), c(n).cast("string")), F.lit("~")) for n in names]
    sized = [F.concat(F.length(x).cast("string"), F.lit(":"), x) for x in cells]
    return F.md5(F.concat(*sized))


def melt(df, names, as_type, keep=(), name_col="feature", value_col="value"):
    """Long form of ``names`` cast to one type; nulls are kept."""
    cells = [F.struct(F.lit(n).alias(name_col), c(n).cast(as_type).alias(value_col)) for n in names]
    return df.select(*keep, F.inline(F.array(*cells)))


def clip(col, low, high):
    """Bound ``col``; a null stays null."""
    return F.when(col < F.lit(low), F.lit(low)).when(col > F.lit(high), F.lit(high)).otherwise(col)


def ratio(num, den):
    """``num / den``, null when the denominator is 0 or missing."""
    return F.try_divide(num.cast("double"), den.cast("double"))
