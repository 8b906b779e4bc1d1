"""Token files: ids of whole texts, Huffman-coded from the counts of the whole corpus.

A folder holds two Parquet tables. ``codes`` has the code length of each id; canonical codes follow from it. ``blocks``
has independent blocks of whole documents in ascending order: part and block (the order), ids (their number), docs
and counts (document keys and their ids), checkpoints (bit position of every EVERY-th id) and payload (the bits).
"""
from __future__ import annotations

import json
import re
import sys
import zlib
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyforge.llm import huffman
from tallyforge.session import scratch_path, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(huffman)

LIMIT, EVERY, BLOCK = 16, 512, 1 << 19
REMEMBERED = 1_000_000  # pieces whose ids a Python worker keeps
TOGETHER = 1 << 23  # bytes of text that are encoded together
# Fixed value: the pattern of byte-level tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ODD = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
CUT = re.compile(r"(?<=\S) (?=\S)")


class _Pieces:
    """Encodes texts piece by piece; the pieces met first are remembered with their ids.

    The byte-level pattern never joins characters across a single space between two other characters: a token may
    begin with that space but not contain it. Texts are cut there, and the pieces (but the first) keep the space. The new
    pieces of many texts are cut by the pattern at once, and the tokenizer's model merges what is new. A file with another
    pre-tokenizer encodes whole texts. With ``added`` a text that holds an added token's string is encoded by the library's own call,
    which gives that token; else such strings are ordinary text.
    """

    def __init__(self, path, end, width, added=False):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        settings = json.loads(self.tokenizer.to_str())
        before, model, letters = settings["pre_tokenizer"] or {}, settings["model"], _byte_letters()
        self.added = [t["content"] for t in settings["added_tokens"]] if added else []
        whole = {chr(x) for x in letters.values()} <= set(model["vocab"])
        usual = model.get("type") == "BPE" and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        self.plain = whole and usual and not settings["normalizer"] and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        self.pattern, self.width, self.end = regex.compile(PATTERN), width, np.array([end], width).tobytes()
        self.known, self.parts = {}, {}  # ids of pieces behind a space, and of other matches of the pattern
        if self.plain:
            self.letters = np.array([letters[x] for x in range(255)] + [32], "<u2")  # 255 is no byte of a text; it becomes the space between matches
            self.size = np.zeros(max(model["vocab"].values()) + 1, np.int64)  # bytes of each token
            self.size[list(model["vocab"].values())] = list(map(len, model["vocab"]))
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = CharDelimiterSplit(" ")

    def _merged(self, parts):
        """Ids of matches of the pattern, merged by the tokenizer's model in one call."""
        parts = [p.encode() for p in parts]
        text = self.letters[np.frombuffer(b"\xff".join(parts), np.uint8)].tobytes().decode("utf-16-le")
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.width)
        wide, data = ids.itemsize, ids.tobytes()
        stops = (_stops(self.size[ids], map(len, parts), len(parts)) * wide).tolist()
        return [data[lo:hi] for lo, hi in zip([0, *stops], stops)]

    def _ids(self, parts):
        """Ids of each match of the pattern; one with a space before it is a piece, too."""
        got, new = {}, []
        for p in set(parts):
            ids = self.known.get(p[1:]) if p[0] == " " else self.parts.get(p)
            if ids is None:
                new.append(p)
            else:
                got[p] = ids
        for p, ids in zip(new, self._merged(new) if new else []):
            got[p] = ids
            known, name = (self.known, p[1:]) if p[0] == " " else (self.parts, p)
            if len(known) < REMEMBERED:
                known[name] = ids
        return list(map(got.__getitem__, parts))

    def _whole(self, texts):
        """Ids of each text, cut by the pattern alone."""
        parts = [self.pattern.findall(t) for t in texts]
        ids = iter(self._ids([p for some in parts for p in some]))
        return [b"".join(islice(ids, len(some))) for some in parts]

    def _behind_space(self, pieces):
        """Ids of each piece behind its space. What is new is cut by the pattern in one pass."""
        ids = list(map(self.known.get, pieces))
        new = [i for i, x in enumerate(ids) if x is None]
        plain = [i for i in new if pieces[i].isalpha()]  # the pattern leaves letters whole
        others = [i for i in new if not pieces[i].isalpha()]
        parts = self.pattern.findall("".join([" " + pieces[i] for i in others]))
        got = self._ids([" " + pieces[i] for i in plain] + parts)
        for i, x in zip(plain, got):
            ids[i] = x
        # No match goes over the end of a piece: it is followed by a space and another character.
        stops = (_stops(list(map(len, parts)), [len(pieces[i]) + 1 for i in others], len(others)) + len(plain)).tolist()
        for i, lo, hi in zip(others, [len(plain), *stops], stops):
            ids[i] = b"".join(got[lo:hi])
            if len(self.known) < REMEMBERED:
                self.known[pieces[i]] = ids[i]
        return ids

    def with_added(self, column):
        """Which texts of an Arrow column hold the string of an added token: one search of the whole column for each."""
        found = [pc.fill_null(pc.match_substring(column, t), False).to_numpy(zero_copy_only=False) for t in self.added]
        return np.logical_or.reduce(found) if found else np.zeros(len(column), bool)

    def encode(self, texts, with_added=None):
        """Ids of each text with the end id, as bytes. ``with_added`` marks texts for the library's own call."""
        if not self.plain:
            return [np.array(e.ids, self.width).tobytes() + self.end for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        marks = [False] * len(texts) if with_added is None else with_added
        out, even = [None] * len(texts), []
        for i, (t, marked) in enumerate(zip(texts, marks)):
            if marked:
                out[i] = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, self.width).tobytes() + self.end
            elif "  " in t or " \n" in t or "\n " in t or t[:1] == " " or t[-1:] == " " or any(map(t.__contains__, ODD)):
                first, *pieces = CUT.split(t)
                out[i] = b"".join([*self._whole([first]), *self._behind_space(pieces), self.end])
            elif t:
                even.append(i)
            else:
                out[i] = self.end
        # All other texts at once: each different piece is looked up once, and its ids are copied to its places.
        lists = pc.split_pattern(pa.array([texts[i] for i in even], pa.large_string()), " ")
        words, bounds = lists.flatten().dictionary_encode(), lists.offsets.to_numpy()
        pieces, place = words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy().copy()
        firsts = {}
        for i, lo in zip(even, bounds.tolist()):
            place[lo] = len(pieces) + firsts.setdefault(texts[i].partition(" ")[0], len(firsts))
        ids = pa.array(self._behind_space(pieces) + self._whole(firsts), pa.large_binary()).take(pa.array(place))
        _, ends, data = ids.buffers()
        edges = np.frombuffer(ends, np.int64)[bounds].tolist() if even else []
        for i, lo, hi in zip(even, edges, edges[1:]):
            out[i] = data[lo:hi].to_pybytes() + self.end
        return out


def _stops(inner, outer, n):
    """Of two divisions of one sequence, given by sizes, how many inner parts each of the ``n`` outer parts and those before it hold."""
    return np.searchsorted(np.cumsum(inner), np.cumsum(np.fromiter(outer, np.int64, n))) + 1


def _byte_letters():
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


_TOKENS = "doc long, n long, crc long, ids binary"


def tokens(docs, tokenizer, end=0, key="doc_id", text="text", vocabulary=1 << 16, added=False):
    """Per row: doc, n, crc and ids (little-endian, 2 bytes each up to 65,536 ids, else 4), with the end id; null is empty.

    ``tokenizer`` is the path of a byte-level tokenizer file that every executor has. ``added``: the strings of its
    added tokens stand for these tokens, as in the library's encode(text, add_special_tokens=False); else they are text.
    """
    return _coded(docs, tokenizer, end, key, text, vocabulary, added).where("seen IS NULL").select("doc", "n", "crc", "ids")


def _coded(docs, tokenizer, end, key, text, vocabulary, added):
    """The lines of :func:`tokens`, and a last line of each task with the ids it has seen and how many times."""
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary()), ("seen", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])

    # What a broadcast holds is read once by a Python worker, so all tasks of a worker remember pieces together.
    shared = docs.sparkSession.sparkContext.broadcast({})

    def encode(batches):
        kept, total = shared.value, np.zeros(vocabulary, np.int64)
        if not kept:
            kept["pieces"] = _Pieces(tokenizer, end, width, added)
        pieces = kept["pieces"]
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            edges = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // TOGETHER)) + 1).tolist(), batch.num_rows]
            for part in (batch.slice(lo, hi - lo) for lo, hi in zip(edges, edges[1:])):
                ids = pieces.encode([t or "" for t in part.column(1).to_pylist()], pieces.with_added(part.column(1)))
                total += np.bincount(np.frombuffer(b"".join(ids), width), minlength=vocabulary)
                none = pa.nulls(len(ids), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(x) // int(width[2]) for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(ids, pa.binary()), none, none], schema=schema)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"doc": [None], "n": [None], "crc": [None], "ids": [None], "seen": [seen], "times": [total[seen]]}, schema=schema)

    return docs.select(F.col(key).cast("long").alias("doc"), F.col(text)).mapInArrow(encode, f"{_TOKENS}, seen array<long>, times array<long>")


def _counts(coded, vocabulary):
    """Occurrences of each id over all rows: at most ``vocabulary`` numbers. Reads the last lines of the tasks only."""
    lines = coded.select(F.explode(F.arrays_zip("seen", "times")).alias("c"))
    out = np.zeros(vocabulary, np.int64)
    for r in lines.groupBy(F.col("c.seen").alias("id")).agg(F.sum("c.times").alias("count")).collect():
        out[r["id"]] = r["count"]
    return out


_BLOCKS = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("ids", pa.int64()), ("docs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("checkpoints", pa.list_(pa.int64())), ("payload", pa.binary())])


def write(docs, path, tokenizer, end=0, key="doc_id", text="text", vocabulary=1 << 16, limit=LIMIT, block=BLOCK, added=False):
    """Write the token files of ``docs`` to the folder ``path``, in ascending order of the key (nulls first).

    Rows with one key follow each other in a fixed order. A block holds whole documents, ``block`` ids at most unless one
    document has more. An empty table gives empty tables.
    """
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    coded = stored(_coded(docs, tokenizer, end, key, text, vocabulary, added), "tokens")
    lengths = huffman.code_lengths(_counts(coded, vocabulary), limit)
    coded = coded.where("seen IS NULL")
    spark = docs.sparkSession
    spark.createDataFrame(pd.DataFrame({"id": np.flatnonzero(lengths), "length": lengths[lengths > 0]}), "id long, length long").coalesce(1).write.parquet(f"{path}/codes")
    sizes = lengths.astype(np.uint8)

    def pack(batches):
        lengths = sizes.astype(np.int64)
        _, codes = huffman.canonical_codes(lengths)
        part, number = TaskContext.get().partitionId(), 0
        keys, counts, parts, total = [], [], [], 0

        def flush():
            payload, start = huffman.encode(np.frombuffer(b"".join(parts), width).astype(np.int64), lengths, codes)
            return pa.RecordBatch.from_pydict({"part": [part], "block": [number], "ids": [total], "docs": [keys], "counts": [counts], "checkpoints": [start[::EVERY]], "payload": [payload]}, schema=_BLOCKS)

        for batch in batches:
            for d, n, x in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if total and total + n > block:
                    yield flush()
                    keys, counts, parts, total, number = [], [], [], 0, number + 1
                keys.append(d)
                counts.append(n)
                parts.append(x)
                total += n
        if keys:
            yield flush()

    ordered = coded.repartitionByRange("doc", "n", "crc").sortWithinPartitions("doc", "n", "crc").select("doc", "n", "ids")
    ordered.mapInArrow(pack, "part int, block int, ids long, docs array<long>, counts array<long>, checkpoints array<long>, payload binary").write.parquet(f"{path}/blocks")


def _lengths(spark, path, vocabulary):
    out = np.zeros(vocabulary, np.uint8)
    for r in spark.read.parquet(f"{path}/codes").collect():  # at most ``vocabulary`` lines
        out[r["id"]] = r["length"]
    return out


def read(spark, path, each, schema, vocabulary=1 << 16, limit=LIMIT):
    """Decode every block on its own: ``each(docs, counts, ids)`` gives columns by name, one line per document.

    Adds part, block and at (ids before the document in its block).
    """
    sizes = _lengths(spark, path, vocabulary)
    names = [f.split()[0] for f in schema.split(", ")]

    def unpack(batches):
        decoder = huffman.Decoder(sizes, limit)
        for batch in batches:
            for r in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                ids = decoder.decode(r["payload"], r["checkpoints"], EVERY, r["ids"])
                counts = np.array(r["counts"], np.int64)
                got = each(r["docs"], counts, ids)
                k = len(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(k, r["part"], np.int32)), pa.array(np.full(k, r["block"], np.int32)), pa.array(np.cumsum(counts) - counts),
                    *[pa.array(got[c]) for c in names]], names=["part", "block", "at", *names])

    return spark.read.parquet(f"{path}/blocks").mapInArrow(unpack, f"part int, block int, at long, {schema}")


def starts(spark, path):
    """Ids before each block: part, block, before. Sums of parts first, so that no task orders all blocks."""
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "block", "ids")
    inside = F.sum("ids").over(Window.partitionBy("part").orderBy("block")) - F.col("ids")
    parts = blocks.groupBy("part").agg(F.sum("ids").alias("all"))
    parts = parts.select("part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("earlier"))
    return blocks.withColumn("inside", inside).join(parts, "part").select("part", "block", (F.col("earlier") + F.col("inside")).alias("before"))


def digest(spark, path, key="doc_id", **options):
    """Per document of the files: key, start (ids before it), n_tokens, ids_crc32 (of the ids as 32-bit little-endian)."""
    def each(docs, counts, ids):
        wide, ends = ids.astype("<u4"), np.cumsum(counts)
        crc = [zlib.crc32(wide[b - n : b].tobytes()) for b, n in zip(ends.tolist(), counts.tolist())]
        return {"doc": pa.array(docs, pa.int64()), "n_tokens": counts, "ids_crc32": np.array(crc, np.int64)}

    rows = read(spark, path, each, "doc long, n_tokens long, ids_crc32 long", **options)
    return rows.join(starts(spark, path), ["part", "block"]).select(F.col("doc").alias(key), (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def new_folder(spark):
    """A fresh folder for token files in the shared scratch space."""
    return scratch_path(spark, "token-files")
