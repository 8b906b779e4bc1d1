"""SimHash near-duplicates with vantage-point trees over Hamming distance.

Distances of unrelated 64-bit fingerprints gather at 32 with a spread of 4, as wide as the search radius, so triangle
bounds on all 64 bits hardly prune. The trees therefore stand on the four 16-bit quarters: fingerprints at most 4 bits
apart are at most 1 bit apart in some quarter. Each quarter has a tree of vantage points; a value goes to the side
its distance to the vantage point names, and values on the boundary go to both, so that every close pair meets in a
leaf. Leaves are the shards. In a leaf, a further vantage point over all 64 bits orders the rows, and only rows whose
distances to it differ by the radius or less are compared.
"""
from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tallyforge.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

RADIUS, QUARTERS, SHINGLE, SEED = 4, 4, 4, 42
LEAF, BLOCK, MOST_LEVELS = 1500, 6000, 16
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint_of(text, size=SHINGLE):
    """64-bit SimHash of one whole text over word shingles, repeats included; 0 without words."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - size + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    ends = (ends[size - 1 :] - 1).tolist() if len(words) >= size else [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], dtype=">u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big", signed=True)


def fingerprint(text):
    """The fingerprint as a long column."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t) for t in texts], dtype="int64")

    return of(text)


def _leaves(levels):
    """For each 16-bit value the leaves it belongs to: (first place in the list by value, list).

    A value is right of a vantage point at distance 8 or more. Right values at exactly 8 also go left, where they
    meet the values at 7: no other pair on different sides can be 1 apart.
    """
    value, node = np.arange(1 << 16, dtype=np.int64), np.ones(1 << 16, dtype=np.int64)
    for _ in range(levels):
        vantage = (node * 40503 + (node >> 3) * 2654435761 + 12345) >> 2 & 0xFFFF
        d = np.bitwise_count((value ^ vantage).astype(np.uint16))
        right, both = d >= 8, d == 8
        value, node = np.concatenate((value, value[both])), np.concatenate((2 * node + right, 2 * node[both]))
    order = np.lexsort((node, value))
    value, node = value[order], node[order]
    return np.searchsorted(value, np.arange((1 << 16) + 1)), node


def _routed(prints, levels):
    """One line per leaf of each fingerprint: leaf (with its quarter), print."""
    def route(batches):
        first, leaf = _leaves(levels)
        for pdf in batches:
            x = pdf["print"].to_numpy(np.int64)
            bits = x.view(np.uint64)
            for q in range(QUARTERS):
                v = ((bits >> np.uint64(16 * q)) & np.uint64(0xFFFF)).astype(np.int64)
                n = first[v + 1] - first[v]
                at = np.repeat(first[v] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                yield pd.DataFrame({"leaf": leaf[at] * QUARTERS + q, "print": np.repeat(x, n)})

    return prints.mapInPandas(route, "leaf long, print long")


def _links_of(rows, columns, radius=RADIUS):
    """A forest of links between two sets of fingerprints: at most one less than their number.

    Both are ordered by distance to a vantage point; chunks of rows meet only the columns in reach of it.
    """
    same = columns is None
    columns = rows if same else columns
    vantage = rows[0]
    dr, dc = np.bitwise_count(rows ^ vantage).astype(np.int16), np.bitwise_count(columns ^ vantage).astype(np.int16)
    order, other = np.argsort(dr, kind="stable"), np.argsort(dc, kind="stable")
    rows, dr, columns, dc = rows[order], dr[order], columns[other], dc[other]
    label = np.arange(len(rows) + len(columns)) if not same else np.arange(len(rows))
    shift = 0 if same else len(rows)
    out = []
    for a in range(0, len(rows), 128):
        b = min(a + 128, len(rows))
        lo, hi = np.searchsorted(dc, dr[a] - radius), np.searchsorted(dc, dr[b - 1] + radius, side="right")
        if same:
            lo = max(lo, a)
        near = np.bitwise_count(rows[a:b, None] ^ columns[None, lo:hi]) <= radius
        if same:
            near[np.arange(b - a), np.arange(a, b) - lo] = False
        for i in np.flatnonzero(near.any(axis=1)):
            own, hits = label[a + i], np.flatnonzero(near[i]) + lo
            for root in np.unique(label[hits + shift]):
                if root != own:
                    j = hits[label[hits + shift] == root][0]
                    out.append((rows[a + i], columns[j]))
                    label[label == root] = own
    return out


def links(prints):
    """Links (u, v) between distinct fingerprints within the radius: a forest of each shard, the same components.

    ``prints`` has distinct longs in ``print``. Shards of over ``BLOCK`` rows are searched as pairs of blocks of at
    most about that size, so no task holds more; every pair of blocks is searched.
    """
    n = prints.count()
    levels = min(MOST_LEVELS, max(0, math.ceil(math.log(max(n, 1) / LEAF) / math.log(1 / 0.6)))) if n > LEAF else 0
    routed = _routed(prints, levels)
    large = routed.groupBy("leaf").count().where(F.col("count") > BLOCK).select("leaf", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    dealt = routed.join(large, "leaf", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    # A row of block i takes part in the pairs (i, 0), ..., (i, blocks - 1), as the lower or the upper block.
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("upper"), "print")

    def search(pdf):
        rows = pdf["print"].to_numpy(np.int64).view(np.uint64)
        upper = pdf["upper"].to_numpy(bool)
        if pdf["i"].iat[0] == pdf["j"].iat[0]:
            found = _links_of(rows, None) if len(rows) > 1 else []
        else:
            found = _links_of(rows[~upper], rows[upper]) if upper.any() and not upper.all() else []
        pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"u": pairs.max(axis=1), "v": pairs.min(axis=1)} if len(pairs) else {"u": pairs[:, 0], "v": pairs[:, 0]})

    return dealt.groupBy("leaf", "i", "j").applyInPandas(search, "u long, v long").distinct()


def components(edges):
    """Root (least member) of every node of ``edges`` (u > v): columns node, root. Alternating large and small stars.

    The edges are a table; each round writes the next one, until a round changes nothing.
    """
    def state(e):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        return r[0], r[1]

    edges = stored(edges, "edges")
    before = state(edges)
    while before[0]:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", "m")).distinct()
        edges = stored(small, "edges")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def groups(docs, key="doc_id", text="text"):
    """Near-duplicate group of every row: key, text_hash, print, root (the group), component_id (its least key).

    Fingerprints link at ``RADIUS`` or fewer differing bits; groups are closed over links. Texts without words (null
    too) share fingerprint 0. Repeated rows each get a row; null keys never name a component unless all its keys are
    null. Other columns are ignored.
    """
    rows = stored(docs.select(F.col(key).alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), fingerprint(F.col(text)).alias("print")), "prints")
    prints = stored(rows.groupBy("print").agg(F.min("doc").alias("least")), "distinct-prints")
    roots = components(links(prints.select("print")))
    rooted = prints.join(roots, prints["print"] == roots["node"], "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    table = rooted.select("print", "root").join(named, "root")
    return rows.join(table, "print").select(F.col("doc").alias(key), "text_hash", "print", "root", "component_id")


def keep_one(docs, key="doc_id", text="text"):
    """One row of each group, with all columns: the least key (a null one last), then the least text hash."""
    rank = F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.col("text_hash").alias("h"))
    keep = groups(docs, key, text).groupBy("root").agg(F.min(rank).alias("r")).select(
        F.col("r.n").alias("_n"), F.coalesce("r.k", F.lit(0)).alias("_k"), F.col("r.h").alias("_h"))
    at = {"_n": F.col(key).isNull(), "_k": F.coalesce(F.col(key), F.lit(0)), "_h": F.xxhash64(F.coalesce(F.col(text), F.lit("")))}
    return docs.withColumns(at).join(keep, ["_n", "_k", "_h"], "left_semi").dropDuplicates(["_n", "_k", "_h"]).select(*docs.columns)
