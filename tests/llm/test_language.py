"""Language identification against a plain re-statement, and its held-out accuracy."""
import zlib
from collections import Counter

import pytest

from tallyforge.llm import language_id, queries


def plain_grams(text):
    """Counts of n-grams with "_" for a run of other characters."""
    s = "_"
    for c in text or "":
        c = (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else "_"
        s += "" if c == s[-1] == "_" else c
    s = s if s[-1] == "_" else s + "_"
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(s) - n + 1):
            g = s[i : i + n]
            if "_" not in g[1:-1] and g.strip("_"):
                out[g] += 1
    return out


def top(counts, keep):
    code = lambda g: tuple(1 if c == "_" else ord(c) for c in g)
    return sorted(counts, key=lambda g: (-counts[g], len(g), code(g)))[:keep]


def plain(rows, keep):
    """rows: (key, text, lang, learn). Prediction and score of each row."""
    totals = {}
    for _, t, lang, learn in rows:
        if learn and lang is not None:
            totals.setdefault(lang, Counter()).update(plain_grams(t))
    profiles = {k: {g: i for i, g in enumerate(top(v, keep))} for k, v in totals.items() if v}
    out = []
    for key, t, _, _ in rows:
        mine = top(plain_grams(t), keep)
        far = sorted((sum(abs(i - p[g]) if g in p else keep for i, g in enumerate(mine)), k) for k, p in profiles.items())
        if not mine or not far:
            out.append((key, "und", 0.0))
            continue
        second = far[1][0] if len(far) > 1 else keep * keep
        out.append((key, far[0][1], second / (far[0][0] + second) if far[0][0] + second else 0.5))
    return Counter(out)


def held_out(key):
    return key is not None and zlib.crc32(str(key).encode()) % 4 == 2


ODD = [(300, "12 34 --"), (301, "漢字 und İstanbul ǅ ² Ⅷ"), (302, "ÉÉ éé"), (303, "\U0001f600"), (304, "a"), (304, "a"), (305, "x퟿"), (306, "ＭＩＴ ｍｉｔ")]


@pytest.mark.parametrize("keep", [30, 300])
def test_ranks_and_distances(spark, frame, hard, keep):
    rows = hard + ODD
    docs = frame(rows).repartition(4)
    learned = docs.where(~language_id.held_out("doc_id"))
    got = language_id.fit(learned, keep=keep).predict(docs)
    assert [c for c in got.columns if c not in ("lang_pred", "score")] == [c for c in docs.columns if c != "score"]
    langs = ["en", "de", None]
    assert Counter((r.doc_id, r.lang_pred, r.score) for r in got.collect()) == plain([(k, t, langs[i % 3], not held_out(k)) for i, (k, t) in enumerate(rows)], keep)


def test_long_texts_are_counted_in_blocks(monkeypatch):
    text = "Der schnelle, braune Fuchs -- springt! " * 50
    whole = {int(g): int(n) for g, n in zip(*language_id.gram_counts(text))}
    monkeypatch.setattr(language_id, "BLOCK", 7)
    assert {int(g): int(n) for g, n in zip(*language_id.gram_counts(text))} == whole
    assert sorted(whole.values()) == sorted(plain_grams(text).values())


def test_tasks_pass_on_what_they_hold(frame, hard, monkeypatch):
    docs = frame(hard).coalesce(1)
    want = language_id.fit(docs).ranks
    monkeypatch.setattr(language_id, "HELD", 50)
    assert (language_id.fit(docs).ranks == want).all()


def test_empty_tables_and_no_languages(docs, empty):
    assert language_id.fit(docs).predict(empty).count() == 0
    none = language_id.fit(empty).predict(docs)
    assert {tuple(r) for r in none.select("lang_pred", "score").distinct().collect()} == {("und", 0.0)}
    with pytest.raises(ValueError):
        language_id.fit(docs, most_languages=1)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.QUERIES["op11_language_id"](spark, sf).collect()
    assert len(got) == len(truth) and {r.held_out for r in got} == {True, False}
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)
    judged = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in judged) >= 0.99 * len(judged)
