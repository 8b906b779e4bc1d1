"""Phrase collocations from FM-indexes over word ids, one for each shard of the corpus.

A task numbers the words of its texts, sorts the places of the sequence by the words that follow (as many as a phrase may
have), and keeps the words in front of the sorted places: the Burrows-Wheeler transform, once for the sequence and once
for its reverse. A phrase is an interval of each. Extending an interval to the left reads the transform of the sequence,
to the right that of the reverse, and both ends stay in step.

Local counts are summed across shards twice. First by 32-bit hash of the phrase, for pairs and then for longer phrases all
of whose pairs may be frequent; hashes with enough occurrences become bits of a table of fixed size. A phrase whose bit is
not set is not frequent; the others are enumerated again and summed by their words, which decides.
"""
from __future__ import annotations

import sys
import zlib
from array import array
from contextlib import contextmanager
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyforge.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD = 1 << 20  # words of a shard; it ends with a piece of text. So three numbers below twice that fit into 63 bits (_order)
LINES = 1 << 16  # lines that leave a task at once
BITS = 1 << 27  # bits of the table of hashes: 16 MB, whatever the size of the corpus
# Fixed value: characters that end a piece of text. Words are separated by spaces and tabs.
ENDS = b".,;:!?\n\x0b\x0c\r"
_LINE = bytes.maketrans(ENDS, b"\n" * len(ENDS))


class _Numbers(dict):
    """Numbers of the words of one language; new words go on in ``vocabulary``, which all languages of a shard share."""

    def __init__(self, lang, vocabulary):
        super().__init__()
        self.lang, self.vocabulary = lang, vocabulary

    def __missing__(self, word):
        self.vocabulary.append((self.lang, word))
        n = self[word] = len(self.vocabulary)
        return n


def _order(high, low):
    """Places in the order of (high, low, place). One number holds all three, as sorting numbers is far cheaper than places."""
    bits = [max(1, int(x).bit_length()) for x in (low.max(initial=0), len(low))]
    if int(high.max(initial=0)).bit_length() + sum(bits) > 63:
        return np.lexsort((low, high))
    key = (high.astype(np.int64) << sum(bits)) | (low.astype(np.int64) << bits[1]) | np.arange(len(low))
    key.sort()
    return key & ((1 << bits[1]) - 1)


def sorted_places(s, depth):
    """Places of ``s`` in the order of the next ``depth`` symbols; symbol 0 is the smallest and follows the end."""
    rank, width = s, 1
    while True:
        step = min(width, depth - width)
        after = np.concatenate([rank[step:], np.zeros(min(step, len(rank)), rank.dtype)]) if step else np.zeros(len(rank), rank.dtype)
        order = _order(rank, after)
        if width + step >= depth:
            return order
        first, second = rank[order], after[order]
        new = np.cumsum(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
        rank = np.empty(len(s), np.int64)
        rank[order] = new  # from 1: the end, 0, stays below all
        width += step


def transform(s, depth):
    """The symbol in front of each place, in the order of :func:`sorted_places`; the sequence is read in a circle."""
    return s[sorted_places(s, depth) - 1]


def steps(bwt):
    """Where the place in front of each sorted place is sorted itself: counts of smaller symbols and ranks among equals in one."""
    out = np.empty(len(bwt), np.int32 if len(bwt) < 1 << 31 else np.int64)
    out[_order(bwt, np.zeros(len(bwt), np.int32))] = np.arange(len(bwt))
    return out


def extended(bwt, step, low, n):
    """All extensions by one symbol of the intervals [low, low + n): (interval, symbol, count, new low, offset).

    The new low is in the order that ``bwt`` belongs to; ``offset`` is where the extension lies inside the interval of
    the other order. Symbol 0 never extends a phrase.
    """
    first = (np.cumsum(n) - n).astype(step.dtype)
    owner = np.repeat(np.arange(len(n), dtype=step.dtype), n)
    place = np.arange(len(owner), dtype=step.dtype)
    place -= np.repeat(first - low, n)
    symbol = bwt[place]
    order = _order(owner, symbol).astype(step.dtype)
    by_owner, by_symbol = owner[order], symbol[order]
    start = np.flatnonzero(np.concatenate([[len(order) > 0], (by_owner[1:] != by_owner[:-1]) | (by_symbol[1:] != by_symbol[:-1])])).astype(step.dtype)
    del by_owner, by_symbol
    count = np.diff(start, append=step.dtype.type(len(order)))
    at = order[start]
    kept = symbol[at] > 0
    start, count, at = start[kept], count[kept], at[kept]
    return owner[at], symbol[at], count, step[place[at]], start - first[owner[at]]


def _packed(symbols):
    return zlib.compress(np.ascontiguousarray(symbols.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(blob):
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(blob), np.uint8).reshape(4, -1).T).view("<u4").ravel()


_WORDS = pa.list_(pa.struct([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))


def index(docs, text="text", lang="lang", depth=5, salt="0"):
    """The FM-indexes of ``docs``, a line per shard: shard, vocabulary (language, word and count of symbols 1, 2, ...), hashes (of these words), bwt, reverse.

    Texts are lower-cased in A-Z and split at ``ENDS`` into pieces and these at spaces and tabs into words; every piece
    ends with symbol 0. Null texts are empty, a null language is ``und``, repeated rows count each. A shard ends after
    SHARD words, at a piece's end.
    """
    def build(batches):
        part, number = TaskContext.get().partitionId(), 0
        vocabulary, numbers, s = [], {}, array("I", [0])

        def line():
            symbols = np.array(s, np.int64)
            n = np.bincount(symbols, minlength=len(vocabulary) + 1)[1:]
            words = pa.StructArray.from_arrays([
                pa.array([v[0] for v in vocabulary], pa.string()), pa.array([v[1].decode() for v in vocabulary], pa.string()), pa.array(n, pa.int64())], fields=list(_WORDS.value_type))
            hashes = np.array([_word_hash(salt, a.encode("utf-8", "surrogatepass"), b) for a, b in vocabulary], np.uint64)
            return pa.RecordBatch.from_arrays([
                pa.array([part << 32 | number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), pa.array([hashes.tobytes()], pa.binary()),
                pa.array([_packed(transform(symbols, depth))], pa.binary()), pa.array([_packed(transform(symbols[::-1], depth))], pa.binary())], names=["shard", "vocabulary", "hashes", "bwt", "reverse"])

        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for piece in (t or "").encode("utf-8", "surrogatepass").lower().translate(_LINE).split(b"\n"):
                    words = piece.split()
                    if not words:
                        continue
                    of = numbers.get(name)
                    if of is None:
                        of = numbers[name] = _Numbers(name, vocabulary)
                    s.extend(map(of.__getitem__, words))
                    s.append(0)
                    if len(s) > SHARD:
                        yield line()
                        vocabulary, numbers, s, number = [], {}, array("I", [0]), number + 1
        if len(s) > 1:
            yield line()

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    return rows.mapInArrow(build, "shard long, vocabulary array<struct<lang string, word string, n long>>, hashes binary, bwt binary, reverse binary")


def _word_hash(salt, lang, word):
    """The hash that Spark's xxhash64 gives of three strings; language and word as bytes."""
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang, xxhash.xxh64_intdigest(salt, 42)))


def _folded(h, words):
    """Hash of phrases from the hash of all but their last word and the hash of that word."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words
    return (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


class _Shard:
    """The index of one shard, and the phrases in it."""

    def __init__(self, hashes, bwt, reverse):
        self.bwt, self.reverse = _unpacked(bwt), _unpacked(reverse)
        self.hashes = np.concatenate([np.zeros(1, np.uint64), np.frombuffer(hashes, np.uint64)])

    def phrases(self, depth, wanted):
        """(symbols, count, hash) of the phrases of 2 to ``depth`` words, size by size.

        ``wanted`` tells which hashes go on; a phrase is extended only where both the phrase without its first word and
        that without its last one went on.
        """
        step = steps(self.bwt)
        size = np.bincount(self.bwt, minlength=len(self.hashes)).astype(step.dtype)
        low = (np.cumsum(size) - size)[1:].astype(step.dtype)
        symbols, n, back = np.arange(1, len(self.hashes), dtype=np.uint32)[:, None], size[1:], low
        h = _folded(np.zeros(len(n), np.uint64), self.hashes[1:])
        other = steps(self.reverse) if depth > 2 else None
        for k in range(2, depth + 1):
            end, first, count, new, offset = extended(self.bwt, step, low, n)
            if k == 2:
                symbols, h = np.stack([first, symbols[end, 0]], 1), _folded(h[first - 1], self.hashes[symbols[end, 0]])
                n, low, back = count, new, back[end] + offset
            else:
                start, last, count, back_new, offset = extended(self.reverse, other, back, n)
                # A longer phrase is both the start that goes on and the end that is led up to: its interval is the same.
                led = np.full(len(step), -1, step.dtype)
                led[new] = np.arange(len(new), dtype=step.dtype)
                e = led[low[start] + offset]
                r = np.flatnonzero(e >= 0)
                e = e[r]
                del led
                symbols, h = np.concatenate([symbols[start[r]], last[r, None]], 1), _folded(h[start[r]], self.hashes[last[r]])
                n, low, back = count[r], new[e], back_new[r]
            keep = wanted(h)
            symbols, n, low, back, h = symbols[keep], n[keep], low[keep], back[keep], h[keep]
            yield symbols, n, h
            if not len(n):
                return


def _shards(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Shard(*[batch.column(c)[i].as_py() for c in range(3)])


def _bucket(h):
    return (h >> np.uint64(32)).astype(np.uint32)


@contextmanager
def _few_shards(spark):
    """Jobs inside hand a task two shards at once, not the default number of rows: the line of a shard has megabytes."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def _table(hashed, least):
    """Which hashes have enough occurrences: one bit for all that are equal modulo BITS, broadcast as an array.

    ``hashed``: bucket and n. At most BITS / 64 numbers come to the driver.
    """
    spark = hashed.sparkSession
    often = hashed.groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    slot = F.pmod(F.col("bucket"), F.lit(BITS))
    cells = often.groupBy((slot / 64).cast("int").alias("cell")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(bucket, {BITS}) % 64 as int))")).alias("bits"))
    with _few_shards(spark):
        cells = stored(cells, "cells")
    cells, table = cells.toArrow(), np.zeros(BITS // 64, np.int64)
    table[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return spark.sparkContext.broadcast(table)


def _in_table(table, h):
    slot = _bucket(h).astype(np.int64) % (64 * len(table))
    return (table[slot >> 6] >> (slot & 63)) & 1 == 1


def _everything(h):
    return np.ones(len(h), bool)


def _hashed(shards, depth, pairs=None):
    """Local counts by hash, of pairs, or of the phrases of 3 to ``depth`` words whose pairs are in the table ``pairs``."""
    def enumerate_(batches):
        allowed = pairs.value if pairs else None
        for shard in _shards(batches):
            if allowed is not None:
                # Only pairs are looked up: longer phrases are all of unknown frequency.
                level = iter([lambda h: _in_table(allowed, h)])
                found = islice(shard.phrases(depth, lambda h: next(level, _everything)(h)), 1, None)
            else:
                found = shard.phrases(2, _everything)
            for _, n, h in found:
                for lo in range(0, len(n), LINES):
                    yield pa.RecordBatch.from_arrays([pa.array(_bucket(h[lo : lo + LINES]).view(np.int32)), pa.array(n[lo : lo + LINES], pa.int64())], names=["bucket", "n"])

    return shards.select("hashes", "bwt", "reverse").mapInArrow(enumerate_, "bucket int, n long")


def _exact(shards, depth, pairs, longer):
    """Local counts of the phrases whose hashes are in the tables: key (hashes of the words) and n."""
    def enumerate_(batches):
        allowed = [pairs.value, *[longer.value if longer else None] * (depth - 2)]
        for shard in _shards(batches):
            level = iter(allowed)
            for symbols, n, _ in shard.phrases(depth, lambda h: _in_table(next(level), h)):
                words, size = shard.hashes[symbols].view(np.int64), symbols.shape[1]
                for lo in range(0, len(n), LINES):
                    some = words[lo : lo + LINES]
                    key = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * size, pa.int32()), pa.array(some.ravel(), pa.int64()))
                    yield pa.RecordBatch.from_arrays([key, pa.array(n[lo : lo + LINES], pa.int64())], names=["key", "n"])

    return shards.select("hashes", "bwt", "reverse").mapInArrow(enumerate_, "key array<long>, n long")


def frequent_phrases(docs, text="text", lang="lang", least=100, longest=5):
    """(phrases, words, totals) of each language.

    phrases: key (ids of its words) and f, for phrases of one to ``longest`` words with at least ``least`` occurrences
    inside pieces, overlaps included; words: id, lang, word, f; totals: lang and n, all word occurrences.
    """
    salt = 0
    while True:
        shards = stored(index(docs, text, lang, longest, str(salt)), "fm-index")
        local = shards.select(F.explode("vocabulary").alias("w")).select("w.lang", "w.word", "w.n")
        counts = stored(local.groupBy("lang", "word").agg(F.sum("n").alias("f")), "word-counts")
        hashed = counts.withColumn("id", F.xxhash64(F.lit(str(salt)), "lang", "word"))
        if hashed.groupBy("id").count().where("count > 1").isEmpty():
            break
        salt += 1  # another salt, other hashes: all words differ in theirs
    totals = stored(counts.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    words = stored(hashed.where(F.col("f") >= least), "frequent-words")
    phrases = words.select(F.array("id").alias("key"), "f")
    if longest > 1:
        pairs = _table(_hashed(shards, 2), least)
        longer = _table(_hashed(shards, longest, pairs), least) if longest > 2 else None
        exact = _exact(shards, longest, pairs, longer).groupBy("key").agg(F.sum("n").alias("f"))
        phrases = phrases.unionByName(exact.where(F.col("f") >= least))
    with _few_shards(docs.sparkSession):
        phrases = stored(phrases, "phrases")
    return phrases, words, totals


def scored(phrases, words, totals):
    """Phrases of two words or more that no longer phrase of the same count holds: lang, phrase, a, l, r, n, score.

    Cutting a phrase in two gives floor(1000 * a * n / (l * r)) with the counts l and r of its parts; the lowest score
    counts, of equal ones that with the shortest first part. Arithmetic is exact as long as 1000 * a * n has at most 38 digits.
    """
    size = F.size("key")
    several = phrases.where(size > 1)
    shorter = F.explode(F.array(F.slice("key", 1, size - 1), F.slice("key", 2, size - 1))).alias("key")
    longer = phrases.where(size > 2).select(shorter, "f").groupBy("key").agg(F.max("f").alias("longer"))
    kept = several.join(longer, "key", "left").where(F.coalesce(F.col("longer") < F.col("f"), F.lit(True))).select("key", F.col("f").alias("a"))
    cuts = kept.select("key", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.slice("key", 1, F.col("k")), "right": F.slice("key", F.col("k") + 1, size - F.col("k"))})
    of = lambda side, name: phrases.select(F.col("key").alias(side), F.col("f").alias(name))
    cuts = cuts.join(of("left", "l"), "left").join(of("right", "r"), "right")
    spelled = kept.select("key", F.posexplode("key").alias("at", "id")).join(words.select("id", "lang", "word"), "id")
    spelled = spelled.groupBy("key").agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    spelled = spelled.select("key", "lang", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    lines = cuts.join(spelled, "key").join(totals, "lang").withColumn("thousandfold", F.col("a").cast("decimal(18,0)") * F.lit(1000).cast("decimal(4,0)"))
    lines = lines.withColumns({"_up": (F.col("thousandfold") * big("n")).cast("decimal(38,0)"), "_down": (big("l") * big("r")).cast("decimal(38,0)")})
    lines = lines.withColumn("score", F.expr("_up div _down"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    got = lines.groupBy("key", "lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), lowest)
    return got.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs, text="text", lang="lang", least=100, longest=5, most=2000):
    """The first ``most`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    See :func:`index` for pieces and words, :func:`scored` for the score. Order: score and a descending, phrase ascending
    in UTF-8 bytes; rank is from 1. Other columns are ignored; a table without frequent phrases gives no rows.
    """
    got = scored(*frequent_phrases(docs, text, lang, least, longest))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = got.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
