"""Canonical length-limited Huffman codes on numpy arrays: lengths, encoding, table-driven decoding."""
from __future__ import annotations

import numpy as np


def code_lengths(counts, limit):
    """Length of each symbol's code, 0 for symbols that never occur: the shortest total with no code over ``limit`` bits.

    Packages of pairs are merged level by level; walking back, the cheapest items of a level say which symbols get
    one bit more. ``limit`` must allow a code for each symbol that occurs.
    """
    counts = np.asarray(counts, np.int64)
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    n = len(used)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need more than {limit} bits")
    if n < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    coins = counts[order]
    level, own = coins, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate((coins, pairs))
        at = np.argsort(merged, kind="stable")
        level = merged[at]
        own.append(at < n)
    take, bits = 2 * n - 2, np.zeros(n, np.int64)
    for symbols in reversed(own):
        plain = int(symbols[:take].sum())
        bits[:plain] += 1
        take = 2 * (take - plain)
    lengths[order] = bits
    return lengths


def canonical_codes(lengths):
    """(symbols in code order, code of each symbol): codes grow with (length, symbol)."""
    lengths = np.asarray(lengths, np.int64)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    codes, code, before = np.zeros(len(lengths), np.int64), 0, 0
    widths, firsts = np.unique(lengths[order], return_index=True)
    for w, a, b in zip(widths, firsts, [*firsts[1:], len(order)]):
        code <<= int(w) - before
        codes[order[a:b]] = code + np.arange(b - a)
        code, before = code + int(b - a), int(w)
    return order, codes


def encode(ids, lengths, codes):
    """(bit string as bytes, bit position of each id). Codes have 24 bits at most."""
    size = lengths[ids]
    end = np.cumsum(size)
    start = end - size
    word = (codes[ids] << (32 - size - (start & 7))).astype(np.uint32)
    out = np.zeros((int(end[-1]) + 7 >> 3) + 4 if len(ids) else 0, np.uint8)
    if len(ids):
        first = start >> 3
        groups = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
        joined = np.bitwise_or.reduceat(word, groups)  # codes that start in one byte
        for k in range(4):
            out[first[groups] + k] |= (joined >> np.uint32(24 - 8 * k)).astype(np.uint8)
        out = out[: int(end[-1]) + 7 >> 3]
    return out.tobytes(), start


class Decoder:
    """A table over the next ``limit`` bits: symbol and length of the code they begin with."""

    def __init__(self, lengths, limit):
        lengths = np.asarray(lengths, np.int64)
        order, _ = canonical_codes(lengths)
        spans = 1 << (limit - lengths[order])
        self.limit = limit
        self.symbols, self.sizes = np.zeros(1 << limit, np.int64), np.ones(1 << limit, np.int64)
        self.symbols[: spans.sum()], self.sizes[: spans.sum()] = np.repeat(order, spans), np.repeat(lengths[order], spans)

    def decode(self, payload, checkpoints, every, n):
        """``n`` ids of a block whose ids 0, every, 2 * every, ... start at the bits ``checkpoints``; all runs step together."""
        raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
        ahead = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
        at = np.array(checkpoints, np.int64)
        last, out = len(ahead) - 1, np.zeros((every, len(at)), np.int64)
        for i in range(min(every, n)):
            window = (ahead[np.minimum(at >> 3, last)] >> (32 - self.limit - (at & 7)).astype(np.uint32)) & np.uint32((1 << self.limit) - 1)
            out[i] = self.symbols[window]
            at += self.sizes[window]
        return out.T.reshape(-1)[:n]
