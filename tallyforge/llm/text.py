"""Column expressions shared by the corpus operators."""
from __future__ import annotations

from pyspark.sql import functions as F

# White space that separates words, as a Java and as an RE2 class.
SPACE = r"[\x20\x09-\x0D]+"


def whole(text):
    """A text, empty when it is null."""
    return F.coalesce(text, F.lit(""))


def words(text, separator=SPACE):
    """The words of a whole text in order; empty for a null or blank text."""
    return F.array_remove(F.split(whole(text), separator), "")


def grams(tokens, k):
    """64-bit hash of every run of ``k`` tokens, at the index of its first token; empty for fewer than ``k``."""
    n = F.size(tokens)
    starts = F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i + 1, k)))
