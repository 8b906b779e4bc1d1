"""Collocations against brute force, and the index against plain counts."""
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyforge.llm import collocations, queries


def plain(rows, least, longest=5, most=2000):
    f, n = {}, Counter()
    for lang, t in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = set()
    for lang, counts in f.items():
        good = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in good.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if (q := p[i:j]) != p and a >= counts[q]}
        lines = []
        for p, a in good.items():
            if p not in gone:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                lines.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(lines)[:most], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


def corpus(seed, n=120):
    r = random.Random(seed)
    words = ["a", "b", "the", "of", "Éa", "éa", "x y", "ß", "C"]
    fixed = ["new york city", "of the", "a b a b a", "one two three four five six seven", "漢 字"]
    out = []
    for _ in range(n):
        bits = [r.choice(fixed) if r.random() < 0.4 else r.choice(words) for _ in range(r.randrange(60))]
        out.append("".join(b + r.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for b in bits))
    return out


@pytest.mark.parametrize("shard,least,longest,most", [(1 << 21, 5, 5, 2000), (40, 20, 5, 7), (300, 3, 3, 2000), (100, 4, 2, 2000)])
def test_collocations(spark, frame, hard, monkeypatch, shard, least, longest, most):
    monkeypatch.setattr(collocations, "SHARD", shard)
    monkeypatch.setattr(collocations, "LINES", 7 if shard == 40 else 1 << 16)
    rows = hard + [(i, t) for i, t in enumerate(corpus(shard) * 2)]
    docs = frame(rows).repartition(5)
    got = collocations.collocations(docs, least=least, longest=longest, most=most)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain([(["en", "de", None][i % 3], t) for i, (_, t) in enumerate(rows)], least, longest, most)
    lines = [tuple(r) for r in got.collect()]
    assert len(want) > 10 and len(lines) == len(set(lines)) and set(lines) == want


def test_intervals_count_every_phrase():
    r = np.random.default_rng(1)
    s = np.concatenate([[0], *[np.append(r.integers(1, 5, r.integers(1, 9)), 0) for _ in range(200)]])
    depth, bwt, reverse = 4, collocations.transform(s, 4), collocations.transform(s[::-1], 4)
    size = np.bincount(s)
    start = np.cumsum(size) - size
    known = {(c,): (start[c], start[c], size[c]) for c in range(1, 5)}
    for k in range(2, depth + 1):
        old = [(p, *v) for p, v in known.items() if len(p) == k - 1]
        low, back, n = (np.array([x[i] for x in old]) for i in (1, 2, 3))
        left = {(int(c), *old[o][0]): (a, back[o] + off, m) for o, c, m, a, off in zip(*collocations.extended(bwt, collocations.steps(bwt), low, n))}
        right = {(*old[o][0], int(c)): (low[o] + off, a, m) for o, c, m, a, off in zip(*collocations.extended(reverse, collocations.steps(reverse), back, n))}
        assert left == right
        known |= left
        text = s.tolist()
        want = Counter(tuple(text[i : i + k]) for i in range(len(text) - k + 1) if 0 not in text[i : i + k])
        assert {p: v[2] for p, v in left.items()} == want


def test_a_full_table_of_hashes_loses_nothing(frame, hard, monkeypatch):
    """With 128 bits for all phrases nearly every bit is set; the exact sums decide."""
    monkeypatch.setattr(collocations, "BITS", 128)
    rows = hard + [(i, t) for i, t in enumerate(corpus(4))]
    got = {tuple(r) for r in collocations.collocations(frame(rows).repartition(3), least=12).collect()}
    assert got == plain([(["en", "de", None][i % 3], t) for i, (_, t) in enumerate(rows)], 12)


def test_word_hashes_are_those_of_spark(spark):
    rows = [("en", "word"), ("und", "漢 字"), ("", ""), ("de", "x" * 100)]
    got = spark.createDataFrame(rows, "a string, b string").selectExpr("a", "b", "xxhash64('7', a, b) h").collect()
    assert all(r.h % (1 << 64) == collocations._word_hash("7", r.a.encode(), r.b.encode()) for r in got)


def test_products_beyond_64_bits(spark):
    a, n, left, right = 7_000_000_000_001, 90_000_000_000_007, 8_000_000_000_003, 7_000_000_000_005
    phrases = spark.createDataFrame([([1], left), ([2], right), ([1, 2], a)], "key array<long>, f long")
    words = spark.createDataFrame([(1, "en", "x"), (2, "en", "y")], "id long, lang string, word string")
    got = collocations.scored(phrases, words, spark.createDataFrame([("en", n)], "lang string, n long")).collect()
    assert [tuple(r) for r in got] == [("en", "x y", a, left, right, n, 1000 * a * n // (left * right))]


def test_empty_table(empty):
    assert collocations.collocations(empty).count() == 0


def test_sql_twin(spark):
    from compare import compare, duck

    name, sf = "op13_collocations", "/root/testdata/sf0.001"
    ok, message = compare(spark, duck(sf), queries.QUERIES[name], queries.ORACLES[name], sf)
    assert ok, message


def test_extensions_stay_in_32_bits():
    """The arrays of a shard take half of what 64 bits take, and hold the same extensions."""
    s = np.random.default_rng(3).integers(0, 5, 400)
    bwt = collocations.transform(s, 3)
    size = np.bincount(bwt, minlength=5).astype(np.int32)
    low = (np.cumsum(size) - size)[1:].astype(np.int32)
    owner, symbol, count, new, offset = collocations.extended(bwt.astype(np.uint32), collocations.steps(bwt), low, size[1:])
    assert all(a.dtype.itemsize == 4 for a in (owner, symbol, count, new, offset))
    pairs = {(int(a), int(b)): int(n) for a, b, n in zip(symbol, owner + 1, count)}
    ring = list(zip(s.tolist(), np.roll(s, -1).tolist()))
    assert pairs == {p: ring.count(p) for p in set(ring) if 0 not in p}
