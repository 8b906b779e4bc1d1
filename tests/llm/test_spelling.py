"""Spelling variants against brute force."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyforge.llm import spelling


def plain_words(rows, every=199):
    out = Counter()
    for k, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    return out


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, least_letters=6, least_n=5, ratio=5):
    words = {w: n for w, n in counts.items() if len(w) >= least_letters and n >= least_n}
    form, near_of = {}, {}
    for w, n in words.items():
        near = near_of[w] = [x for x in words if abs(len(x) - len(w)) <= 1 and one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near_of[w]), words[form[w]] if form[w] else None))
    return out


def corpus(seed, stems=40):
    """Texts with words, their misspellings and the misspellings of these, in Zipf-like numbers."""
    r = random.Random(seed)
    letters = "abcdeé×ßÿÀ"
    bag = []
    for i in range(stems):
        w = "".join(r.choice(letters) for _ in range(5 + i % 6))
        for depth in range(4):
            bag += [w if i % 3 else w.upper()] * (5 ** (3 - depth) * (1 + i % 3) + (i % 2))
            at, kind = r.randrange(len(w)), r.randrange(3)
            w = w[:at] + (r.choice(letters) if kind else "") + w[at + (kind != 1) :]
    bag += ["listen", "silent", "enlist", "tinsel"] * 6 + ["aaaaaa", "aaaaaaa", "aaaaaaaa"] * 7 + ["q" * 3000, "q" * 3001] * 5
    r.shuffle(bag)
    return [(i, " ".join(bag[i::30]) + " x1y2") for i in range(30)]


@pytest.mark.parametrize("leaf,letters,sample", [(10_000, 400_000, 100_000), (40, 200, 100_000), (40, 5000, 60)])
def test_words_and_forms(frame, hard, monkeypatch, leaf, letters, sample):
    for name, value in (("LEAF", leaf), ("LETTERS", letters), ("SAMPLE", sample), ("CELLS", 5000 if leaf == 40 else spelling.CELLS)):
        monkeypatch.setattr(spelling, name, value)
    rows = hard + corpus(leaf) + [(None, "Straße straße STRASSE colour"), (3, "Straße")] * 3
    got = spelling.variants(frame(rows).repartition(5))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    lines = [tuple(r) for r in got.collect()]
    assert len(lines) == len(set(lines)) and set(lines) == plain(plain_words(rows))


def test_lost_letters(frame, hard):
    rows = hard + corpus(5)
    got = {r.word: r.n for r in spelling.count_words(frame(rows).repartition(3), least_letters=1, every=7).collect()}
    assert got == {w: n for w, n in plain_words(rows, 7).items() if w}


def test_tasks_pass_on_what_they_hold(frame, hard, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 20)
    got = {r.word: r.n for r in spelling.count_words(frame(hard).coalesce(1)).collect()}
    assert got == {w: n for w, n in plain_words(hard).items() if len(w) >= 6}


def test_boxes_in_reach_hold_every_near_vector():
    """Each leaf that holds a vector one step away is visited, and each row meets a leaf at most once."""
    r = np.random.default_rng(3)
    x = r.integers(0, 3, (600, spelling.CLASSES)).astype(np.int32) * (np.arange(spelling.CLASSES) < 6)
    tree = spelling.Tree(x, 4)
    met = {}
    for leaf, rows in tree.visit(x, spelling.FREE, spelling.FREE):
        for i in rows.tolist():
            assert (i, leaf) not in met
            met[i, leaf] = True
    step = x[:, None] - x[None]
    near = ((step > 0).sum(2) <= 1) & ((step < 0).sum(2) <= 1) & (np.abs(step).max(2) <= 1)
    for leaf, members in enumerate(tree.members):
        for i in np.flatnonzero(near[:, members].any(1)).tolist():
            assert (i, leaf) in met
    own = sorted(i for _, rows in tree.visit(x, spelling.SHUT, spelling.SHUT) for i in rows.tolist())
    assert own == list(range(600))


def test_empty_table(empty):
    assert spelling.variants(empty).count() == 0
