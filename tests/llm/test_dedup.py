"""Substring dedup and SimHash against brute force."""
import re
from collections import Counter

import numpy as np
import pytest
import xxhash


from tallyforge.llm import queries, simhash, substring_dedup

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def brute_substring(rows):
    first, last = {}, 1 << 63
    for k, t in rows:
        w = words(t)
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            first[key] = min(first.get(key, last), last - 1 if k is None else k)
    out = []
    for k, t in rows:
        w, gone = words(t), set()
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < (last - 1 if k is None else k):
                gone |= set(range(i, i + 13))
        out.append((k, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return Counter(out)


def test_windows_of_earlier_documents_go(docs, hard):
    assert Counter(tuple(r) for r in substring_dedup.dedup(docs).collect()) == brute_substring(hard)


def test_copies_are_combined_before_the_shuffle_without_loss(frame, hard):
    rows = [(1000 - i, hard[0][1] + " " + hard[12][1]) for i in range(60)] + hard
    assert Counter(tuple(r) for r in substring_dedup.dedup(frame(rows).coalesce(2)).collect()) == brute_substring(rows)


def test_one_minimiser_for_one_window():
    text = np.arange(200) % 23
    key = substring_dedup.minimisers(text.astype(np.uint64), np.full(200, 5))
    assert len(key) == 188
    assert (key[:160] == key[23:183]).all()


def brute_groups(rows):
    prints = []
    for _, t in rows:
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(rows)))
    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = Counter()
    for (k, _), p, g in zip(rows, prints, group):
        ids = [rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None]
        out[(k, f"{p:016x}", min(ids) if ids else None)] += 1
    return out, len(set(group))


def test_groups(docs, hard):
    got = simhash.groups(docs).selectExpr("doc_id", "lpad(lower(hex(print)), 16, '0') f", "component_id")
    assert Counter(tuple(r) for r in got.collect()) == brute_groups(hard)[0]


def test_one_document_of_each_group_stays(docs, hard):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == brute_groups(hard)[1]


@pytest.mark.parametrize("n,levels", [(3000, 4), (4000, 9)])
def test_no_link_is_lost_in_the_trees(spark, monkeypatch, n, levels):
    """Random prints, and clusters around some, against all pairs; small blocks make the hot leaves split."""
    r = np.random.default_rng(n)
    x = r.integers(0, 1 << 64, n, dtype=np.uint64)
    for i in range(n // 2):
        for b in r.integers(0, 64, r.integers(0, 6)):
            x[i] = x[i % 37] if b == 0 else x[i] ^ np.uint64(1 << int(b))
    x[: n // 4] = x[0] ^ (np.uint64(1) << r.integers(0, 64, n // 4).astype(np.uint64))
    x = np.unique(x)
    monkeypatch.setattr(simhash, "BLOCK", 200)
    monkeypatch.setattr(simhash, "LEAF", n * 0.6**levels)
    prints = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "print long")
    roots = {a.node: a.root for a in simhash.components(simhash.links(prints)).collect()}
    label = np.arange(len(x))
    for i in range(len(x)):
        near = label[np.bitwise_count(x ^ x[i]) <= 4]
        for g in np.unique(near):
            label[label == g] = label[i]
    got = [roots.get(int(v), int(v)) for v in x.view(np.int64)]
    assert len(set(zip(got, label.tolist()))) == len(set(got)) == len(set(label.tolist()))


def test_empty_tables(empty):
    assert substring_dedup.dedup(empty).count() == 0
    assert simhash.groups(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def test_sql_twin(spark):
    from compare import compare, duck

    name, sf = "op2_substring_dedup", "/root/testdata/sf0.001"
    ok, message = compare(spark, duck(sf), queries.QUERIES[name], queries.ORACLES[name], sf)
    assert ok, message
