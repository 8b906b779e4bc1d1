"""Language of whole texts by rank-order profiles.

The letter n-grams of a language's texts, ranked by frequency, are its profile. A text's own most frequent n-grams are
compared to each profile by out-of-place distance: how far each stands from its rank there, or the profile's whole
length when it is absent. The nearest profile wins.
"""
from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEEP = 300  # n-grams in a profile, and of a text
UNKNOWN = "und"
BLANK, BITS = 1, 21  # what stands for all that is no letter; bits of a code point
BLOCK = 1 << 20  # characters of a text that are counted at once
HELD = 1 << 21  # different n-grams that a task holds before it passes them on


_TABLE = []


def _letters():
    """Lower-case code point of each letter, BLANK for all other characters; made once by each task."""
    if _TABLE:
        return _TABLE[0]
    table = np.full(sys.maxunicode + 1, BLANK, np.int64)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    _TABLE.append(table)
    return table


def gram_counts(text):
    """(n-grams of one to three characters, their counts) of a whole text, in ascending order of n-grams.

    Letters are lower-cased, a run of other characters is one blank, and the text begins and ends with one. An n-gram
    has a blank at its ends only and is no blank itself. It is a number: 21 bits for each character.
    """
    s = _letters()[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")]
    s = np.concatenate([[BLANK], s, [BLANK] * 3])
    s = s[np.concatenate([[True], (s[1:] != BLANK) | (s[:-1] != BLANK)])]
    s = np.concatenate([s, [BLANK] * 2])
    parts = []
    for lo in range(0, len(s) - 2, BLOCK):
        hi = min(lo + BLOCK, len(s) - 2)
        a, b, c = s[lo:hi], s[lo + 1 : hi + 1], s[lo + 2 : hi + 2]
        two, three = a << BITS | b, a << 2 * BITS | b << BITS | c
        parts.append(np.unique(np.concatenate([a[a != BLANK], two[(a != BLANK) | (b != BLANK)], three[b != BLANK]]), return_counts=True))
    return _merged(parts)


def _merged(parts):
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(place, np.concatenate([n for _, n in parts]), len(grams)).astype(np.int64)


def _partial_counts(batches):
    """Counts of one task by language."""
    held, size = {}, 0

    def lines():
        for lang, parts in held.items():
            grams, n = _merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            got = gram_counts(text)
            held.setdefault(lang, []).append(got)
            size += len(got[0])
            if size > HELD:
                held = {k: [_merged(v)] for k, v in held.items()}
                size = sum(len(v[0][0]) for v in held.values())
                if size > HELD // 2:
                    yield from lines()
                    held, size = {}, 0
    yield from lines()


class Profiles:
    """Ranked n-grams of each language: ``langs`` in ascending order, ``ranks[gram, lang]`` (-1: absent)."""

    def __init__(self, rows, keep):
        self.keep = keep
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.array(sorted({r[1] for r in rows}), np.int64)
        self.ranks = np.full((len(self.grams), len(self.langs)), -1, np.int32)
        column = {x: i for i, x in enumerate(self.langs)}
        for lang, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, gram), column[lang]] = rank

    def distances(self, text):
        """Out-of-place distance of a text to each language; None for a text without letters."""
        grams, n = gram_counts(text)
        if not len(grams):
            return None
        top = grams[np.argsort(-n, kind="stable")[: self.keep]]
        at = np.minimum(np.searchsorted(self.grams, top), len(self.grams) - 1)
        ranks = np.where((self.grams[at] == top)[:, None], self.ranks[at], -1)
        return np.where(ranks < 0, self.keep, np.abs(ranks - np.arange(len(top))[:, None])).sum(0)

    def judge(self, text):
        """(language, score) of a text."""
        far = self.distances(text) if self.langs else None
        if far is None:
            return UNKNOWN, 0.0
        best = int(far.argmin())
        second = int(np.delete(far, best).min()) if len(far) > 1 else self.keep * self.keep
        total = int(far[best]) + second
        return self.langs[best], second / total if total else 0.5

    def predict(self, docs, text="text", lang_pred="lang_pred", score="score"):
        """``docs`` with the predicted language and a score; columns of these names are replaced, all rows stay.

        The score is the second smallest distance over the sum of the two smallest: 0.5 for a tie (the first language by
        name is taken), 1 for a perfect match. A text that is null or has no letter is ``und`` with score 0.
        """
        profiles, names = self, (lang_pred, score)

        @F.pandas_udf("struct<lang string, score double>")
        def judged(texts: pd.Series) -> pd.DataFrame:
            got = [profiles.judge(t) for t in texts]
            return pd.DataFrame({"lang": [g[0] for g in got], "score": [float(g[1]) for g in got]})

        rows = docs.select(F.struct(*[c for c in docs.columns if c not in names], F.lit(0).alias("_")).alias("_row"), judged(F.col(text)).alias("_got"))
        return rows.select("_row.*", F.col("_got.lang").alias(lang_pred), F.col("_got.score").alias(score)).drop("_")


def fit(docs, lang="lang", text="text", keep=KEEP, most_languages=1000):
    """Profiles of the languages of ``docs``: their ``keep`` most frequent n-grams, the smaller one first among equals.

    Every row with a language counts, repeated rows each. Rows without a language and texts without letters add nothing.
    Without any, every text is ``und``. More than ``most_languages`` languages are an error, so the profiles stay small.
    """
    counts = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counts = counts.mapInArrow(_partial_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < keep).select("lang", "gram", "rank")
    rows = ranked.limit(most_languages * keep + 1).collect()
    if len({r[0] for r in rows}) > most_languages or len(rows) > most_languages * keep:
        raise ValueError(f"more than {most_languages} languages")
    return Profiles([tuple(r) for r in rows], keep)


def held_out(key):
    """Rows that are never learned from: crc32 of the key as text, mod 4, is 2. A null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))
