"""Huffman codes, token files and sharding: round trips and properties."""
import heapq
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import huffman, sharding, token_files

BPE = public_tokenizers.path("byte_bpe_50k.json")


def huffman_cost(counts):
    heap, cost = [c for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


@pytest.mark.parametrize("seed", range(6))
def test_code_lengths_are_best_and_limited(seed):
    r = np.random.default_rng(seed)
    counts = (r.pareto(0.6, 300) * 5).astype(np.int64)
    free = huffman.code_lengths(counts, 40)
    assert (free * counts).sum() == huffman_cost(counts.tolist())
    tight = huffman.code_lengths(counts, 9)
    assert tight.max() <= 9 and ((tight > 0) == (counts > 0)).all()
    assert (0.5 ** tight[tight > 0]).sum() <= 1 + 1e-12
    assert huffman_cost(counts.tolist()) <= (tight * counts).sum()


def test_limited_lengths_against_every_choice():
    """All length vectors of five symbols that satisfy Kraft, at most three bits."""
    import itertools

    counts = np.array([50, 20, 3, 2, 1])
    best = min(int((np.array(c) * counts).sum()) for c in itertools.product((1, 2, 3), repeat=5) if sum(0.5**x for x in c) <= 1)
    assert (huffman.code_lengths(counts, 3) * counts).sum() == best


@pytest.mark.parametrize("n,symbols", [(0, 3), (1, 1), (5, 1), (4000, 2), (5000, 700)])
def test_round_trip(n, symbols):
    r = np.random.default_rng(n)
    ids = (r.random(n) ** 3 * symbols).astype(np.int64)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=symbols + 1), 16)
    payload, start = huffman.encode(ids, lengths, huffman.canonical_codes(lengths)[1])
    assert len(payload) == (int(lengths[ids].sum()) + 7) // 8
    assert (huffman.Decoder(lengths, 16).decode(payload, start[::512], 512, n) == ids).all()


def test_too_many_symbols():
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9), 3)


def expected(rows, added=False):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    if not added:
        t.encode_special_tokens = True
    return [(k, t.encode(x or "", add_special_tokens=False).ids + [0]) for k, x in rows]


@pytest.mark.parametrize("added", [False, True])  # the query's call: the library's defaults, added tokens and all
def test_files_hold_all_ids_in_order(spark, docs, hard, added):
    path = token_files.new_folder(spark)
    token_files.write(docs, path, BPE, vocabulary=50257, block=3000, added=added)
    got = token_files.digest(spark, path, vocabulary=50257).collect()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted(str((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got) == sorted(str((k, len(i), crc(i))) for k, i in expected(hard, added))
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    keys = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert spark.read.parquet(f"{path}/blocks").count() > 3


@pytest.mark.parametrize("text", [" a", "a  b", "a \n b", "\n\n a  b  c", "it 's 'll  ", "a\tb \t c", "\x1c \x85 x", "x " * 50 + "\r\n y", "<|endoftext|> <|endoftext|>", "", "I'll 've\u00a0x \u2003 y\u3000z", "\u00e9\u00e8 \u6f22\u5b57 \U0001f600\u0301 a\u0301b 12\u00bd ~!@#"])
def test_pieces_are_encoded_like_whole_texts(text):
    got = token_files._Pieces(BPE, 0, "<u2").encode([text, text + " " + text])
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [i for _, i in expected([(0, text), (1, text + " " + text)])]


def test_added_tokens_are_encoded_as_by_the_library(spark, frame):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BPE)
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "x<|endoftext|><|endoftext|>  y <|endoftext"), (4, "no token here"), (5, None)]
    want = {k: plain.encode(x or "", add_special_tokens=False).ids + [0] for k, x in rows}
    assert 50256 in want[1]
    got = token_files.tokens(frame(rows), BPE, vocabulary=50257, added=True).collect()
    assert {r.doc: np.frombuffer(r.ids, "<u2").tolist() for r in got} == want


def test_pieces_forget_and_still_encode(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 3)
    texts = ["a b c d e f", "b c d x y z", "a b c d e f"]
    got = token_files._Pieces(BPE, 0, "<u2")
    for _ in range(2):
        assert [np.frombuffer(g, "<u2").tolist() for g in got.encode(texts)] == [i for _, i in expected(list(enumerate(texts)))]


def test_no_documents(spark, empty):
    path = token_files.new_folder(spark)
    token_files.write(empty, path, BPE, vocabulary=50257)
    assert token_files.digest(spark, path, vocabulary=50257).count() == 0
    assert sharding.assign(empty, [1.0] * 3).count() == 0


def test_shards(docs, hard):
    got = sharding.assign(docs, [1.0] * 7).collect()
    assert len(got) == len(hard)
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in hard)
    assert all(r.grown_shard in (r.shard, 7) for r in got) and any(r.grown_shard == 7 for r in got)
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    by_key = {}
    for r in got:
        assert by_key.setdefault(r.doc_id, r.shard) == r.shard


def test_more_shards_move_rows_only_into_the_new_one(spark):
    keys = spark.range(20000).select(F.col("id").alias("k"))
    a, b = ({r.k: r.s for r in keys.select("k", sharding.shard_of([F.col("k")], w).alias("s")).collect()} for w in ([1.0, 2.0, 1.0], [1.0, 2.0, 1.0, 4.0]))
    moved = [k for k in a if a[k] != b[k]]
    assert {b[k] for k in moved} == {3} and abs(len(moved) - 10000) < 400
    assert abs(sum(v == 1 for v in a.values()) - 10000) < 400


def test_equal_rows_spread_over_ranges(spark):
    rows = spark.range(0, 4000, 1, 8).selectExpr("7L doc_id", "'same' text")
    got = sharding.assign(rows, [1.0] * 4)
    assert got.select("shard").distinct().count() == 1
    assert sorted(r.slot for r in got.collect()) == list(range(4000))


def test_weights_must_be_positive():
    with pytest.raises(ValueError):
        sharding.shard_of([F.lit(1)], [1.0, 0.0])


def test_new_pieces_are_merged_together(monkeypatch):
    """The model is called once for the matches behind spaces and once for those at the starts of texts, not once for each piece."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [f"Start{i} word{i}, two{i}.\nThree %%% café{i}\n" for i in range(50)] + ["", "end\n", "\n", "one", "a  b \t c", " x ", "漢 字漢, \U0001f600 it's"]
    for most in (1_000_000, 7):
        monkeypatch.setattr(token_files, "REMEMBERED", most)
        pieces, calls = token_files._Pieces(path, 0, "<u2"), []
        merged = pieces._merged
        monkeypatch.setattr(pieces, "_merged", lambda parts: calls.append(len(parts)) or merged(parts))
        assert pieces.plain and len(pieces.encode(texts[:54])) == 54 and len(calls) <= 2
        for _ in range(2):
            got = [np.frombuffer(x, "<u2").tolist() for x in pieces.encode(texts)]
            assert got == [[*pieces.tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]
        assert len(pieces.known) <= most
