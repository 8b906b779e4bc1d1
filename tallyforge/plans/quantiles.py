"""Exact order statistics of many columns without sorting or shuffling the rows.

Each pass is one aggregate over all columns. A sketch brackets every wanted rank, an
exact count checks the bracket, and the bracket shrinks until the rows left inside
fit a small bounded buffer. Nothing but sketches, counts and those bounded buffers
leaves the map side, so neither the number of rows nor a hot value matters.
"""
from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..session import stored

BUFFER_ROWS = 100_000
SKETCH_ACCURACY = 10_000
SEARCHES_PER_PASS = 16


def values_at_ranks(df, wanted, buffer_rows=BUFFER_ROWS, accuracy=SKETCH_ACCURACY):
    """Values at 0-based ranks among the non-null values of each column.

    ``wanted`` maps a name to ``(column, ranks)``, or to ``(column, fn)`` where ``fn``
    turns the number of non-null values into ranks. Returns ``{name: (n, {rank: value})}``;
    ranks outside ``0..n-1`` are left out.
    """
    names = list(wanted)
    cols = {name: wanted[name][0] for name in names}
    if not names:
        return {}
    first = df.agg(
        *[F.count(cols[n]).alias(f"n{i}") for i, n in enumerate(names)],
        *[F.min(cols[n]).alias(f"lo{i}") for i, n in enumerate(names)],
        *[F.max(cols[n]).alias(f"hi{i}") for i, n in enumerate(names)],
    ).first()
    found = {n: (first[f"n{i}"], {}) for i, n in enumerate(names)}
    # open searches: (name, rank, low, high, rows below low, rows inside [low, high])
    open_searches = []
    for i, n in enumerate(names):
        size = first[f"n{i}"]
        ranks = wanted[n][1]
        ranks = ranks(size) if callable(ranks) else ranks
        for r in sorted(set(ranks)):
            if 0 <= r < size:
                open_searches.append((n, r, first[f"lo{i}"], first[f"hi{i}"], 0, size))

    while open_searches:
        pending = []
        for s in open_searches:
            if s[2] == s[3]:
                found[s[0]][1][s[1]] = s[2]
            else:
                pending.append(s)
        if not pending:
            break
        small = [s for s in pending if s[5] <= buffer_rows]
        large = [s for s in pending if s[5] > buffer_rows]
        if small:
            _read_small(df, cols, small, found)
        open_searches = []
        for start in range(0, len(large), SEARCHES_PER_PASS):
            open_searches += _narrow(df, cols, large[start : start + SEARCHES_PER_PASS], accuracy)
    return found


def _inside(col, low, high):
    return (col >= F.lit(low)) & (col <= F.lit(high))


def _read_small(df, cols, searches, found):
    """Sort the rows of each bracket, at most ``buffer_rows`` of them, and read the ranks off."""
    brackets = {}
    for name, rank, low, high, below, _ in searches:
        brackets.setdefault((name, low, high, below), []).append(rank)
    # a handful of brackets at a time bounds the memory of one task
    keys = list(brackets)
    for start in range(0, len(keys), 16):
        chunk = keys[start : start + 16]
        exprs = []
        for j, (name, low, high, below) in enumerate(chunk):
            c = cols[name]
            rows = F.sort_array(F.collect_list(F.when(_inside(c, low, high), c)))
            picks = [F.element_at(rows, int(r - below + 1)) for r in brackets[(name, low, high, below)]]
            exprs.append(F.array(*picks).alias(f"v{j}"))
        row = df.agg(*exprs).first()
        for j, key in enumerate(chunk):
            for r, v in zip(brackets[key], row[j]):
                found[key[0]][1][r] = v


def _narrow(df, cols, searches, accuracy):
    """Shrink each bracket with a sketch of its rows, then check it with exact counts."""
    margin = 2.0 / accuracy
    exprs = []
    for j, (name, rank, low, high, below, size) in enumerate(searches):
        c = cols[name]
        at = (rank - below) / max(size - 1, 1)
        probs = [max(0.0, at - margin), min(1.0, at + margin)]
        exprs.append(
            F.percentile_approx(F.when(_inside(c, low, high), c), probs, accuracy).alias(f"e{j}")
        )
    edges = df.agg(*exprs).first()
    exprs = []
    for j, (name, *_rest) in enumerate(searches):
        c, lo, hi = cols[name], F.lit(edges[j][0]), F.lit(edges[j][1])
        exprs += [
            F.count_if(c < lo).alias(f"under{j}"), F.count_if(c <= lo).alias(f"to_lo{j}"),
            F.count_if(c < hi).alias(f"to_hi{j}"), F.count_if(c <= hi).alias(f"upto{j}"),
            F.max(F.when(c < lo, c)).alias(f"before{j}"), F.min(F.when(c > lo, c)).alias(f"next{j}"),
            F.max(F.when(c < hi, c)).alias(f"last{j}"), F.min(F.when(c > hi, c)).alias(f"after{j}"),
        ]
    facts = df.agg(*exprs).first()
    out = []
    for j, (name, rank, low, high, below, size) in enumerate(searches):
        under, to_lo, to_hi, upto = (facts[f"{k}{j}"] for k in ("under", "to_lo", "to_hi", "upto"))
        # the edge values themselves are decided by the counts, so every step drops distinct values
        if rank < under:  # the sketch overshot
            out.append((name, rank, low, facts[f"before{j}"], below, under - below))
        elif rank < to_lo:
            out.append((name, rank, edges[j][0], edges[j][0], under, to_lo - under))
        elif rank >= upto:
            out.append((name, rank, facts[f"after{j}"], high, upto, below + size - upto))
        elif rank >= to_hi:
            out.append((name, rank, edges[j][1], edges[j][1], to_hi, upto - to_hi))
        else:
            out.append((name, rank, facts[f"next{j}"], facts[f"last{j}"], to_lo, to_hi - to_lo))
    return out


def exact_quantiles(df, columns, probs, buffer_rows=BUFFER_ROWS):
    """Linearly interpolated quantiles: ``{column: {prob: value or None}}``."""

    def ranks(n):
        out = []
        for p in probs:
            h = (n - 1) * p
            out += [math.floor(h), math.ceil(h)]
        return out

    wanted = {c: (F.col(f"_{i}"), ranks) for i, c in enumerate(columns)}
    # the passes read the wanted columns alone, not the plan that leads to them
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    found = values_at_ranks(stored(numbers, "numbers") if columns else df, wanted, buffer_rows)
    result = {}
    for c in columns:
        n, at = found[c]
        result[c] = {}
        for p in probs:
            if n == 0:
                result[c][p] = None
                continue
            h = (n - 1) * p
            a, b = at[math.floor(h)], at[math.ceil(h)]
            result[c][p] = a + (b - a) * (h - math.floor(h))
    return result
