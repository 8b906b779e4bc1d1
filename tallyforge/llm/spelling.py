"""Spelling variants grouped by k-d trees over letter counts.

One edit changes the letter counts of a word little: a replaced letter moves one count up and one down, an inserted one
moves one count up. So the words one edit away lie in the boxes of a k-d tree that such a step can reach. There is a tree
for each length, grown on a bounded sample; each word is sent to its own leaf, and as a query to the leaves in reach among
the words of its length and of one letter more. A task grows a finer tree over the words of its leaf, and what is still in
reach is compared letter by letter.
"""
from __future__ import annotations

import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tallyforge.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
HELD = 400_000  # words whose counts a task holds before it passes them on
SAMPLE = 100_000  # words that the trees of all lengths are grown on
LEAF, SMALL = 10_000, 16  # words aimed at in a leaf, and in a leaf of the finer trees
LETTERS = 400_000  # letters of the words that are searched at once; a fuller leaf is cut into blocks by hash
CELLS = 1 << 22  # letters compared at once
CLASSES = 191  # counted letters: code points modulo this number, all different for a-z and the Latin-1 letters
FREE, SHUT = -1, -2  # a step that is still open, and one that is not allowed


def count_words(docs, key="doc_id", text="text", least_letters=6, every=199):
    """Occurrences of the words of whole texts: word, n.

    Words are the maximal runs of Latin letters with only A-Z lower-cased. Where ``every`` divides the crc32 h of
    ``<key>:<word>``, the run loses its code point h % length (``every=0``: none does). Null texts have no words, a null
    key is empty text, repeated rows count each.
    """
    def counted(batches):
        held = Counter()

        def lines():
            words = [w for w in held if len(w) >= least_letters]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())], names=["word", "n"])

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{k or ''}:".encode())
                mine = Counter(RUNS.findall(t or ""))
                for run, n in mine.items():
                    word = run.lower() if run.isascii() else run.encode("latin-1").lower().decode("latin-1")
                    h = zlib.crc32(word.encode(), start)
                    if every and h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    held[word] += n
                if len(held) > HELD:
                    yield lines()
                    held.clear()
        yield lines()

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _spelled(words, length):
    """Code points of words of one length, a line each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), length)


def _vectors(codes):
    """Letter counts of each word."""
    m, length = codes.shape
    at = np.arange(m)[:, None] * CLASSES + codes % CLASSES
    return np.bincount(at.ravel(), minlength=m * CLASSES).reshape(m, CLASSES).astype(np.int32)


class Tree:
    """A k-d tree over letter counts; a node is (letter, threshold, at most, more), a leaf a number from ``first`` on."""

    def __init__(self, vectors, size, first=0):
        self.vectors, self.size, self.next, self.members = vectors, size, first, []
        self.root = self._grow(np.arange(len(vectors)))
        del self.vectors

    def _grow(self, rows):
        if len(rows) > self.size:
            counts = self.vectors[rows]
            letters = np.flatnonzero(counts.max(0) > counts.min(0))
            if len(letters):
                counts = counts[:, letters]
                # Below the mean there is always a word, and above as well.
                cuts = np.ceil(counts.mean(0) - 1e-9).astype(np.int32) - 1
                below = (counts <= cuts).mean(0)
                best = int(np.abs(below - 0.5).argmin())
                side = counts[:, best] <= cuts[best]
                if side.any() and not side.all():
                    return int(letters[best]), int(cuts[best]), self._grow(rows[side]), self._grow(rows[~side])
        self.members.append(rows)
        self.next += 1
        return self.next - 1

    def visit(self, vectors, up, down):
        """(leaf, rows of ``vectors``) for each leaf in reach of some row.

        ``up`` and ``down`` say whether one count may rise and one may fall: FREE or SHUT.
        """
        n = len(vectors)
        todo = [(self.root, np.arange(n), np.full(n, up), np.full(n, down))]
        while todo:
            node, rows, up, down = todo.pop()
            if not len(rows):
                continue
            if isinstance(node, int):
                yield node, rows
                continue
            letter, cut, low, high = node
            # A step once taken for a letter counts in all later boxes of that letter.
            c = vectors[rows, letter] + (up == letter) - (down == letter)
            left, right = (c <= cut) | ((c == cut + 1) & (down == FREE)), (c > cut) | ((c == cut) & (up == FREE))
            todo.append((low, rows[left], up[left], np.where(c[left] > cut, letter, down[left])))
            todo.append((high, rows[right], np.where(c[right] <= cut, letter, up[right]), down[right]))


class _Block:
    """Words of one length that are searched together."""

    def __init__(self, words):
        self.codes = _spelled(words, len(words[0]))
        self.tree = Tree(_vectors(self.codes), SMALL)

    def search(self, words):
        """(rows of ``words``, rows of the block) of all pairs that differ by one edit. Words have the block's length or one less."""
        length, mine = len(words[0]), self.codes.shape[1]
        codes = _spelled(words, length)
        out = [np.zeros((2, 0), np.int64)]
        for leaf, rows in self.tree.visit(_vectors(codes), FREE, FREE if length == mine else SHUT):
            homes = self.tree.members[leaf]
            step = max(1, CELLS // (len(homes) * mine))
            for lo in range(0, len(rows), step):
                some = rows[lo : lo + step]
                hit = _one_edit(codes[some], self.codes[homes])
                out.append(np.stack([some[hit[0]], homes[hit[1]]]))
        return np.concatenate(out, 1)


def _one_edit(a, b):
    """Pairs of lines of ``a`` and ``b`` that differ by one replaced letter, or by one that ``b`` has more."""
    if a.shape[1] == b.shape[1]:
        return np.nonzero((a[:, None] != b[None]).sum(2) == 1)
    n = a.shape[1]
    head = np.logical_and.accumulate(a[:, None] == b[None, :, :n], 2).sum(2)
    tail = np.logical_and.accumulate((a[:, None] == b[None, :, 1:])[:, :, ::-1], 2).sum(2)
    return np.nonzero(head + tail >= n)


def grow(words):
    """Trees by length of words, grown on about SAMPLE words drawn by hash; leaves are numbered throughout."""
    total = words.count()
    share = min(1.0, SAMPLE / max(total, 1))
    drawn = words.select("word").where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30)))
    by_length, trees, first = {}, {}, 0
    for r in drawn.collect():
        by_length.setdefault(len(r["word"]), []).append(r["word"])
    for length, some in sorted(by_length.items()):
        tree = Tree(_vectors(_spelled(sorted(some), length)), max(SMALL, int(LEAF * share)), first)
        first, trees[length] = tree.next, tree.root
    return trees


def _reached(trees, words, length, up, down):
    """(leaf, rows of ``words``) in the tree of ``length``; a length outside the sample is one leaf, -length."""
    if length not in trees:
        yield -length, np.arange(len(words))
        return
    tree = Tree.__new__(Tree)
    tree.root = trees[length]
    yield from tree.visit(_vectors(_spelled(words, len(words[0]))), up, down)


def _placed(trees, homes):
    """Words with the leaf they stand in (``homes``), or with the leaves they are looked for."""
    def place(batches):
        for batch in batches:
            words, n = np.array(batch.column(0).to_pylist(), object), np.array(batch.column(1).to_pylist(), np.int64)
            sizes = np.array([len(w) for w in words], np.int64)
            out = []
            for length in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == length)
                some = words[rows].tolist()
                if homes:
                    found = _reached(trees, some, length, SHUT, SHUT)
                    out += [(leaf, 0, rows[r]) for leaf, r in found]
                else:
                    out += [(leaf, 1, rows[r]) for leaf, r in _reached(trees, some, length, FREE, FREE)]
                    out += [(leaf, 2, rows[r]) for leaf, r in _reached(trees, some, length + 1, FREE, SHUT)]
            for leaf, kind, r in out:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(r), leaf, np.int64)), pa.array(np.full(len(r), kind, np.int32)),
                    pa.array(words[r].tolist(), pa.string()), pa.array(n[r])], names=["leaf", "kind", "word", "n"])
    return place


def _searched(batches):
    """Pairs (word, near, near_n), from rows in the order of (leaf, block, kind). Holds the words of one block."""
    current, homes, index = None, [], None
    for batch in batches:
        leaf, block, kind, words, n = (batch.column(i).to_pylist() for i in range(5))
        keys = list(zip(leaf, block, kind))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if keys[lo][:2] != current:
                current, homes, index = keys[lo][:2], [], None
            if keys[lo][2] == 0:
                homes += zip(words[lo:hi], n[lo:hi])
                continue
            if not homes:
                continue
            index = index or _Block([w for w, _ in homes])
            a, b = index.search(words[lo:hi])
            pairs = [(words[lo + i], *homes[j]) for i, j in zip(a.tolist(), b.tolist())]
            if keys[lo][2] == 2:
                pairs += [(homes[j][0], words[lo + i], n[lo + i]) for i, j in zip(a.tolist(), b.tolist())]
            if pairs:
                word, near, near_n = zip(*pairs)
                yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(near_n, pa.int64())], names=["word", "near", "near_n"])


def near_pairs(words):
    """All pairs of distinct words one insertion, deletion or replacement apart, in both directions: word, near, near_n."""
    trees = grow(words)
    words = words.select("word", "n")
    homes = words.mapInArrow(_placed(trees, True), "leaf long, kind int, word string, n long")
    fill = homes.groupBy("leaf").agg(F.ceil(F.sum(F.length("word")) / F.lit(LETTERS)).cast("int").alias("blocks"))
    own = homes.join(fill, "leaf").withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    asked = words.mapInArrow(_placed(trees, False), "leaf long, kind int, word string, n long")
    asked = asked.join(fill, "leaf").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = own.unionByName(asked).select("leaf", "block", "kind", "word", "n").repartition(parts, "leaf", "block")
    return dealt.sortWithinPartitions("leaf", "block", "kind").mapInArrow(_searched, "word string, near string, near_n long")


def forms(words, ratio=5):
    """Each of the words (word, n; distinct) with its near words: word, n, n_near, form, form_n.

    The form is the near word of largest n, the smallest in code-point order among equals, if its n is at least ``ratio``
    times the word's.
    """
    lines = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    lines = lines.unionByName(near_pairs(words).withColumn("n", F.lit(None).cast("long")))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("minus"), "near"))).alias("best")
    got = lines.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best)
    taken = -F.col("best.minus") >= F.lit(ratio) * F.col("n")
    return got.select("word", "n", "n_near", F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.minus")).alias("form_n"))


def roots(found):
    """``found`` with root: the last word that the forms lead to, the word itself where it has none.

    Counts grow from form to form, so chains are short; each round doubles the steps and is written to the shared folder.
    """
    now = stored(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return found.join(now, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs, key="doc_id", text="text", least_letters=6, least_n=5, ratio=5, every=199):
    """Words of whole texts with their spelling variants: word, form, root, n, n_near, form_n.

    Words have at least ``least_letters`` code points and ``least_n`` occurrences (see :func:`count_words`). n_near is
    the number of words one edit away; form and root see :func:`forms` and :func:`roots`. Other columns are ignored; a
    table without words gives no rows.
    """
    words = stored(count_words(docs, key, text, least_letters, every).where(F.col("n") >= least_n), "words")
    return roots(stored(forms(words, ratio), "forms")).select("word", "form", "root", "n", "n_near", "form_n")
