"""The pipeline: every stage on planted documents, and the whole run against brute force on the smallest tables."""
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyforge.llm import queries, sharding, simhash

SF = "/root/testdata/sf0.001"
NAMES = ["toxicity", "simhash near-dedup", "benchmark decontamination", "mixing to target weights", "sharding"]


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of every stage over the smallest tables, written and read again."""
    from tallyforge.session import stored

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        made = stored(stage(spark, docs, SF), "test")
        out.append((docs, made))
        docs = made
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    for before, after in steps[:-1]:
        assert after.columns == before.columns and ids(after) <= ids(before)


def test_toxic_documents_go(spark, steps):
    before, after = steps[0]
    toxic = ids(before) - ids(after)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    insults = re.compile(r"\b(idiot|moron|scum|stupid|pathetic)\b")
    for r in before.collect():
        if r["doc_id"] in toxic:
            assert labels.get(r["doc_id"], 1) == 1 or insults.search(r["text"].lower())
    assert all(not (labels.get(d) == 0 and d in toxic) for d in ids(before))


def test_one_of_each_group_stays(steps):
    before, after = steps[1]
    rows = [(r["doc_id"], simhash.fingerprint_of(r["text"])) for r in before.collect()]
    group = {d: d for d, _ in rows}
    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if bin((x ^ y) & (1 << 64) - 1).count("1") <= 4 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    assert ids(after) == set(group.values())


def test_benchmark_items_go(spark, steps):
    before, after = steps[2]
    items = [r["text"].split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = [" " + " ".join(w) + " " for w in items]
    found = {r["doc_id"] for r in before.collect() if any(w in " " + " ".join(r["text"].split()) + " " for w in whole)}
    assert ids(before) - ids(after) >= found
    windows = {tuple(w[i : i + 8]) for w in items for i in range(len(w) - 7)}
    for r in before.collect():
        if r["doc_id"] in ids(before) - ids(after):
            w = r["text"].split()
            assert any(tuple(w[i : i + 8]) in windows for i in range(len(w) - 7)) or re.search(r"\d", r["text"])


def test_shards_of_what_is_left(spark, steps):
    before, after = steps[4]
    want = before.select("doc_id", sharding.shard_of([F.col("doc_id")], [1.0] * queries.SHARDS).alias("shard"))
    assert {tuple(r) for r in after.select("doc_id", "shard").collect()} == {tuple(r) for r in want.collect()}
    assert ids(after) == ids(before)


def test_stages_take_hard_rows(spark, docs, hard, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() <= len(hard)
        assert stage(spark, empty, SF).count() == 0
