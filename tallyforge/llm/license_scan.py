"""License scan by diagonal voting.

Runs of words of every text are hashed and joined to the runs of the templates. A hit votes for its diagonal (position
in the text minus position in the template); one vote makes a candidate, each candidate is compared word by word with
its template, and neighbouring diagonals merge.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyforge.llm.text import grams, whole, words

# What separates words, base phrases, and notices of well-known licenses, in lower case.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by 4 0": "cc-by",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "subject to the terms of the mozilla public license v 2 0": "mpl",
}
SHORT, LONG = 2, 4  # words in a run: fewest (base phrases), most
SLACK = 3  # diagonals that merge, and least words of margin kept around a hit


def _edits(n, least):
    """Words out of ``n`` that may differ."""
    return int((1 - least) * n + 1e-9)


def _run(n, least):
    """Words in a run of a notice of ``n`` words: whichever words differ, one such run is left, unless SHORT is more."""
    e = _edits(n, least)
    return max(SHORT, min(LONG, -(-(n - e) // (e + 1))))


def _changes(near, wanted):
    """Fewest words to change, put in or leave out to make ``wanted`` from some stretch of ``near``."""
    def step(state, x):
        old = state["row"]

        def cell(row, j):
            swap = F.get(old, j) + F.when(F.get(wanted, j) == x, 0).otherwise(1)
            return F.concat(row, F.array(F.least(swap, F.get(old, j + 1) + 1, F.element_at(row, -1) + 1)))

        row = F.aggregate(F.sequence(F.lit(0), F.size(wanted) - 1), F.array(F.lit(0)), cell)
        return F.struct(row.alias("row"), F.least(state["best"], F.element_at(row, -1)).alias("best"))

    start = F.struct(F.sequence(F.lit(0), F.size(wanted)).alias("row"), F.size(wanted).alias("best"))
    return F.aggregate(near, start, step, lambda state: state["best"])


def _templates(spark, phrases, notices, least):
    """One line per run of each template; as many as the templates have words, so it is always small."""
    texts = [(t, label, True) for t, label in phrases.items()] + [(t, label, False) for t, label in notices.items()]
    rows = [(i, t.split(), label, base, SHORT if base else _run(len(t.split()), least), 0 if base else max(SLACK, _edits(len(t.split()), least))) for i, (t, label, base) in enumerate(texts)]
    lines = spark.createDataFrame(rows, "template int, wanted array<string>, label string, base boolean, k int, margin int")
    parts = [lines.where(F.col("k") == k).select("*", F.posexplode(grams(F.col("wanted"), k)).alias("at", "gram")) for k in range(SHORT, LONG + 1)]
    return reduce(lambda a, b: a.unionByName(b), parts)


def scan(docs, key="doc_id", text="text", phrases=None, notices=None, least=0.8):
    """Spans of license phrases and notices: key, text_hash, template, label, base, first, score.

    ``first`` is the word the span starts at, from 0. A base span holds the phrase word for word (score 1). A notice
    span differs from its template by words changed, put in or left out; they are at most 1 - ``least`` of the
    template's words, and the score is one minus their share. Of notices that start at most SLACK words apart, those
    with the fewest such words are kept. Equal rows (same key and text) are reported once.

    Phrases need two words or more, notices four or more. Null and empty texts have no spans.
    """
    phrases, notices = PHRASES if phrases is None else phrases, NOTICES if notices is None else notices
    if any(len(p.split()) < SHORT for p in phrases) or any(len(p.split()) < LONG for p in notices):
        raise ValueError(f"phrases need {SHORT} words or more, notices {LONG}")
    tokens = docs.select(F.col(key).alias("doc_id"), F.xxhash64(whole(F.col(text))).alias("text_hash"), words(F.col(text), SEPARATOR).alias("w"))
    # lower() also changes other letters; that can only add hits, and the comparison below uses A-Z alone.
    lowered = tokens.withColumn("v", F.transform("w", lambda x: F.lower(x)))
    sizes = sorted({SHORT, *[_run(len(n.split()), least) for n in notices]})
    runs = lowered.select("doc_id", "text_hash", "w", F.concat(*[F.transform(grams(F.col("v"), k), lambda g, i: F.struct(i.alias("pos"), g.alias("gram"))) for k in sizes]).alias("g"))
    # Outer on purpose: for a plain explode Spark adds a filter on the size of the array, below the projections, which then
    # splits and hashes every text once more for each run. The join drops the line of a text without runs.
    placed = runs.select("doc_id", "text_hash", "w", F.explode_outer("g").alias("g")).select("doc_id", "text_hash", "w", "g.pos", "g.gram")
    hits = placed.join(F.broadcast(_templates(docs.sparkSession, phrases, notices, least)), "gram")
    start = F.col("pos") - F.col("at")
    begin = F.greatest(start - F.col("margin"), F.lit(0))
    votes = hits.select(
        "doc_id", "text_hash", "template", "label", "base", "wanted", start.alias("diagonal"),
        F.transform(F.slice("w", begin + 1, F.size("wanted") + 2 * F.col("margin")), lambda x: F.translate(x, UPPER, LOWER)).alias("near"),
    )
    by = ["doc_id", "text_hash", "template"]
    diagonals = votes.groupBy(*by, "diagonal").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("label", "base", "wanted", "near")])
    changes = F.when(F.col("base"), (F.col("near") != F.col("wanted")).cast("int")).otherwise(_changes(F.col("near"), F.col("wanted")))
    good = diagonals.withColumn("changes", changes).withColumn("score", 1 - F.col("changes") / F.size("wanted")).where(F.when(F.col("base"), F.col("score") == 1).otherwise(F.col("score") >= least - 1e-9))
    order = Window.partitionBy(*by).orderBy("diagonal")
    jump = F.when((F.col("diagonal") - F.lag("diagonal").over(order) <= SLACK) & ~F.col("base"), 0).otherwise(1)
    grouped = good.withColumn("jump", jump).withColumn("island", F.sum("jump").over(order))
    spans = grouped.groupBy(*by, "island").agg(
        F.max_by("diagonal", F.struct("score", "n", -F.col("diagonal"))).alias("diagonal"), F.max("score").alias("score"), F.min("changes").alias("changes"), *[F.first(c).alias(c) for c in ("label", "base")])
    spans = spans.withColumn("first", F.greatest("diagonal", F.lit(0)).cast("long"))
    beside = Window.partitionBy("doc_id", "text_hash", "base").orderBy("first").rangeBetween(-SLACK, SLACK)
    return spans.withColumn("fewest", F.min("changes").over(beside)).where(F.col("changes") == F.col("fewest")).select(*by, "label", "base", "first", "score")


def label_documents(docs, key="doc_id", text="text", **options):
    """One row per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Documents without a span have zero places, null positions, empty labels and score 0. Repeated rows each get one.
    """
    spans = scan(docs, key, text, **options)
    base = F.col("base")
    found = spans.groupBy(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_null"), "text_hash").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"), F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("score").alias("score"))
    rows = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(key), F.lit(0)).alias("_id"), F.col(key).isNull().alias("_null"),
        F.xxhash64(whole(F.col(text))).alias("text_hash"), F.size(words(F.col(text), SEPARATOR)).cast("long").alias("n_words"))
    return rows.join(found, ["_id", "_null", "text_hash"], "left").select(
        F.col("doc_id").alias(key), "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
