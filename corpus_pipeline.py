"""A corpus from documents to shards: each stage calls one operator, is written, and is read again by the next.

Every stage takes null and repeated keys, null, empty, blank and very long texts, an empty table, and further columns of
any name; what it does with them is said in its own words below. All but the last keep all columns of their input.
"""
from __future__ import annotations

from tallyforge.llm import decontaminate, mixing, sharding, simhash, toxicity
from tallyforge.llm.queries import MIX, SHARDS
from tallyforge.session import stored


def without_toxic(spark, docs, sf_dir):
    """Documents that the toxicity scorer does not reject; it learns from the labels of these documents.

    Every row is judged by its whole text, repeated rows alike; a null or empty text has no terms and is judged by the
    model's constant. Without labels of both classes the share of toxic ones decides.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.fit_documents(docs, labels).score(docs, out="_score")
    return scored.where("predicted = 0").select(*docs.columns)


def without_copies(spark, docs, sf_dir):
    """One document of each SimHash group.

    Repeated rows are one group, and so are all null, empty and blank texts, whose fingerprint is zero.
    """
    return simhash.keep_one(docs)


def without_benchmark(spark, docs, sf_dir):
    """Documents without benchmark items.

    Null and empty texts and items match nothing. Of rows with one key only the texts with an item go; rows without a key
    that have an item take all other rows without a key along.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), by_stretch=True)


def mixed(spark, docs, sf_dir):
    """A sample whose expected tokens meet the target weights; the share that is kept is lowered where they ask for it.

    Null sources and languages are values of their own. Null, empty and blank texts have no tokens: they follow the
    probability of their cell, or the share of the whole sample where the cell has none. Repeated rows go or stay together.
    """
    return mixing.draw(docs, MIX)


def sharded(spark, docs, sf_dir):
    """Shard and slot of every document; repeated rows share a shard and have slots of their own, a null text has no bytes."""
    return sharding.assign(docs, [1.0] * SHARDS)


STAGES = [
    ("toxicity", without_toxic), ("simhash near-dedup", without_copies), ("benchmark decontamination", without_benchmark),
    ("mixing to target weights", mixed), ("sharding", sharded),
]


def run(spark, sf_dir):
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, "corpus")
    return docs


ORACLE_SQL = None
