"""Exact removal of repeated word windows by super-k-mer partitioning.

The minimiser of a window is the least hash among its runs of M words. Consecutive windows with one minimiser travel
together as one packed string to the minimiser's bucket; every window of one content meets there. A bucket is read
in ascending document order, and a window that an earlier document has started marks its words. Windows are
compared as bytes, hashes only route.

Most buckets belong to one document and hold nothing to remove. So (bucket, document) pairs travel first, without
text; only the super-k-mers of buckets that two documents share are then cut out and sent.
"""
from __future__ import annotations

import sys
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, RUN = 13, 5
REMEMBERED = 200_000  # packed strings, and twice as many buckets, a task remembers to combine copies before a shuffle
LAST = (1 << 63) - 1  # place of a null key in the order of documents


def minimisers(sums, lengths, window=WINDOW, run=RUN):
    """Minimiser of the window at each word, from a checksum and a length of each word.

    Runs of long words come first in the order: frequent words are short, and their runs would make hot buckets.
    """
    n = len(sums) - run + 1
    x, size = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    for i in range(run):
        x = x * np.uint64(0x9E3779B97F4A7C15) + sums[i : i + n]
        size += lengths[i : i + n]
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x = (x >> np.uint64(2)) | np.where(size >= 6 * run, np.uint64(0), np.uint64(1 << 62))
    m = n - (window - run)
    least = x[:m].copy()
    for i in range(1, window - run + 1):
        np.minimum(least, x[i : i + m], out=least)
    return least.astype(np.int64)


def _cut(texts):
    """Super-k-mers of some texts: (all words joined, byte position of each word, first word of each text, and per
    super-k-mer its text, minimiser, first word and word after its last window's first word); None without a window."""
    words, first = [], [0]
    for t in texts:
        words += (t or "").encode().split()
        first.append(len(words))
    if len(words) < WINDOW:
        return None
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    key = minimisers(np.fromiter(map(zlib.crc32, words), np.uint64, len(words)), lengths)
    first = np.asarray(first)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(key)]
    valid = np.arange(len(key)) + WINDOW <= first[owner + 1]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]) | (valid[1:] != valid[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(key))
    begin, end = begin[valid[begin]], end[valid[begin]]
    return b" ".join(words), np.concatenate(([0], np.cumsum(lengths + 1))), first, owner[begin], key[begin], begin, end


def _owners(batches):
    """(bucket, ord, known), once per bucket and document. A bucket that two documents of this task share is known from
    then on: its pairs need no counting."""
    first_owner, shared = {}, object()
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            cut = _cut(batch.column(1).slice(lo, 256).to_pylist())
            if cut is None:
                continue
            doc = batch.column(0).slice(lo, 256).to_numpy()[cut[3]]
            pairs = np.unique(np.stack((doc, cut[4])), axis=1)
            known = np.zeros(pairs.shape[1], bool)
            for i, (d, b) in enumerate(zip(*pairs.tolist())):
                old = first_owner.get(b)
                if old is None:
                    if len(first_owner) >= 2 * REMEMBERED:
                        first_owner.clear()
                    first_owner[b] = d
                elif old is shared:
                    known[i] = True
                elif old != d:
                    first_owner[b] = shared  # this pair still travels, so that the first owner is met
            yield pa.RecordBatch.from_arrays([pa.array(pairs[1]), pa.array(pairs[0]), pa.array(known)], names=["bucket", "ord", "known"])


def _shared(batches):
    """The pairs of buckets with two documents, and the known ones, from pairs in the order of (known, bucket, ord).

    Holds pairs of one document and bucket between batches.
    """
    held, open_bucket = None, None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        known, bucket, doc = (rows.column(c).to_numpy() for c in ("known", "bucket", "ord"))
        own = np.flatnonzero(~known)
        keep = known.copy()
        held = None
        if len(own):
            b, d = bucket[own], doc[own]
            start = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
            last = np.append(start[1:], len(b)) - 1
            many = d[start] != d[last]
            many[0] |= open_bucket is not None and b[0] == open_bucket
            keep[own] = np.repeat(many, last - start + 1)
            open_bucket = b[-1] if many[-1] else None
            if not many[-1]:
                held = rows.take(own[start[-1] :])
        rows = rows.filter(pa.array(keep))
        if rows.num_rows:
            yield from rows.select(["ord", "bucket"]).combine_chunks().to_batches()


def _packed(batches):
    """Packed strings of shared super-k-mers. A copy of one that a smaller document of this task has is settled at once."""
    seen = {}
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            ids, hashes, texts, wanted = (batch.column(c).slice(lo, 64).to_pylist() for c in ("ord", "text_hash", "text", "buckets"))
            cut = _cut(texts)
            if cut is None:
                continue
            joined, at, first, who, key, begin, end = cut
            wanted = [set(w) for w in wanted]
            out = {k: [] for k in ("bucket", "packed", "ord", "text_hash", "start", "stop")}
            for i, b, s, e in zip(who.tolist(), key.tolist(), begin.tolist(), (end + WINDOW - 1).tolist()):
                if b not in wanted[i]:
                    continue
                p, d, text_hash, offset = joined[at[s] : at[e] - 1], ids[i], hashes[i], int(first[i])
                s, e = s - offset, e - offset
                old = seen.get(p)
                if old is not None and old < d:
                    if out["packed"] and out["packed"][-1] is None and out["ord"][-1] == d and out["text_hash"][-1] == text_hash and out["start"][-1] <= s <= out["stop"][-1]:
                        out["stop"][-1] = max(e, out["stop"][-1])
                        continue
                    p, b = None, text_hash ^ s
                elif old is None or d < old:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[p] = d
                for k, v in zip(out, (b, p, d, text_hash, s, e)):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=_PACKED)


_PACKED = pa.schema([("bucket", pa.int64()), ("packed", pa.binary()), ("ord", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])
_MARKS = pa.schema([("ord", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])


def _marked(batches):
    """Intervals of words to remove, from rows in the order of (bucket, ord). Holds the distinct windows of one bucket."""
    current, owners, pending = None, {}, None

    def windows(p):
        gaps = [0, *[i + 1 for i, c in enumerate(p) if c == 32], len(p) + 1]
        return [p[a : b - 1] for a, b in zip(gaps, gaps[WINDOW:])]

    def visit(row, out):
        p, doc, text, start = row
        run = None
        for j, w in enumerate(windows(p)):
            if owners.setdefault(w, doc) < doc:
                if run is not None and j <= run[1] - start:
                    run[1] = start + j + WINDOW
                else:
                    run = [start + j, start + j + WINDOW]
                    out.append((doc, text, run))

    for batch in batches:
        out = []
        cols = [batch.column(c).to_pylist() for c in ("bucket", "packed", "ord", "text_hash", "start", "stop")]
        for bucket, p, doc, text, start, stop in zip(*cols):
            if p is None:
                out.append((doc, text, (start, stop)))
                continue
            if bucket != current:
                current, pending = bucket, []
                owners.clear()
            if pending is not None:
                # Until a second document comes, the rows of the first only wait.
                if not pending or pending[0][1] == doc:
                    pending.append((p, doc, text, start))
                    continue
                for row in pending:
                    visit(row, out)
                pending = None
            visit((p, doc, text, start), out)
        if out:
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                pa.array([x[2][0] for x in out], pa.int32()), pa.array([x[2][1] for x in out], pa.int32())], schema=_MARKS)


def _kept(text, marks):
    """(words, removed words, text that stays) of one whole text; ``marks`` are its intervals."""
    words = (text or "").encode().split()
    if marks is None or not len(marks):
        return len(words), 0, b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for m in marks:
        gone[m["start"]] += 1
        gone[m["stop"]] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return len(words), int(len(words) - keep.sum()), b" ".join([w for w, k in zip(words, keep.tolist()) if k])


def _rows(docs, key, text):
    return docs.select(
        F.coalesce(F.col(key), F.lit(LAST)).cast("long").alias("ord"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
        F.col(text).alias("text"), F.col(key).alias("id"))


def marks(rows):
    """Intervals of words to remove from ``rows`` (:func:`_rows`): ord, text_hash, start, stop."""
    pairs = rows.select("ord", "text").mapInArrow(_owners, "bucket long, ord long, known boolean")
    dealt = pairs.repartition(F.when(F.col("known"), F.xxhash64("ord")).otherwise(F.col("bucket")))
    wanted = dealt.sortWithinPartitions("known", "bucket", "ord").mapInArrow(_shared, "ord long, bucket long").groupBy("ord").agg(F.collect_set("bucket").alias("buckets"))
    # All columns of ``rows`` on purpose: the shuffle of texts by ord then serves the join at the end, too.
    packed = rows.join(wanted, "ord").mapInArrow(_packed, "bucket long, packed binary, ord long, text_hash long, start int, stop int")
    return packed.repartition("bucket").sortWithinPartitions("bucket", "ord").mapInArrow(_marked, "ord long, text_hash long, start int, stop int")


def dedup(docs, key="doc_id", text="text"):
    """Each row with the words that stay: key, n_words, n_removed, kept.

    A word goes if a window of 13 words over it also starts in a document with a smaller key. Windows are judged on the
    input. Null and blank texts have no words; texts below 13 words stay whole. Rows with one key are one document's
    texts and never remove each other. Other columns are ignored.
    """
    rows = _rows(docs, key, text)
    found = marks(rows).groupBy("ord").agg(F.collect_list(F.struct("text_hash", "start", "stop")).alias("marks"))

    @F.pandas_udf("struct<n_words long, n_removed long, kept string>")
    def stay(texts: pd.Series, hashes: pd.Series, spans: pd.Series) -> pd.DataFrame:
        got = [_kept(t, None if m is None else [x for x in m if x["text_hash"] == h]) for t, h, m in zip(texts, hashes, spans)]
        return pd.DataFrame({"n_words": [g[0] for g in got], "n_removed": [g[1] for g in got], "kept": [g[2].decode() for g in got]})

    joined = rows.join(found, "ord", "left").select("id", stay("text", "text_hash", "marks").alias("s"))
    return joined.select(F.col("id").alias(key), "s.n_words", "s.n_removed", "s.kept")
