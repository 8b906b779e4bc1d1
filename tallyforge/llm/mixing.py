"""Mixing sources to target weights by iterative proportional fitting.

Token counts by cell (source, language, topic) are raked until their margins meet the targets, and no cell gives more tokens
than it has; the ratio of raked to present tokens is the probability to sample the documents of a cell.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.llm.text import whole, words
from tallyforge.session import stored

DIMENSIONS = ("source", "lang", "topic")
TOPICS = 6


def topic_of(text, topics=TOPICS, least_letters=6):
    """Lexical field of a text: its long words fall into ``topics`` fields by hash; the fullest one wins, the first of equals.

    A text without long words is in field 0. A stand-in where the table has no topic column.
    """
    fields = F.transform(F.filter(words(text), lambda w: F.length(w) >= least_letters), lambda w: F.pmod(F.xxhash64(w), F.lit(topics)).cast("int"))

    def count(fields, k):
        return F.struct(F.size(F.filter(fields, lambda x: x == k)).alias("n"), F.lit(-k).alias("k"))

    def fullest(box):
        return -F.greatest(*[count(box["f"], k) for k in range(topics)])["k"]

    return F.transform(F.array(F.struct(fields.alias("f"))), fullest)[0].cast("string")


def _value(column):
    """Null is a value of its own."""
    return F.coalesce(F.col(column).cast("string"), F.lit("\x00null"))


def target_shares(cells, targets):
    """Target share of each value of each dimension, as tables (dimension -> value, target).

    A target is a dict of shares (values it does not name keep their present share; the named ones divide the rest
    in proportion), or an exponent that flattens the present shares (1 keeps them, 0 makes them equal).
    """
    spark, out = cells.sparkSession, {}
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    for d in DIMENSIONS:
        present = cells.groupBy(d).agg((F.sum("tokens") / F.lit(float(max(total, 1)))).alias("share")).where("share > 0")
        want = targets.get(d, 1.0)
        if isinstance(want, dict):
            named = spark.createDataFrame([(k, float(v)) for k, v in want.items()], f"{d} string, wanted double")
            both = present.join(named, d, "left")
            sums = both.agg(F.sum(F.when(F.col("wanted").isNull(), F.col("share"))).alias("free"), F.sum("wanted").alias("all")).first()
            rest = 1.0 - (sums["free"] or 0.0)
            out[d] = stored(both.select(d, F.when(F.col("wanted").isNull(), F.col("share")).otherwise(F.col("wanted") / F.lit(float(sums["all"] or 1.0)) * rest).alias("target")), "target")
        else:
            power = present.withColumn("p", F.pow("share", F.lit(float(want))))
            norm = power.agg(F.sum("p")).first()[0] or 1.0
            out[d] = stored(power.select(d, (F.col("p") / F.lit(norm)).alias("target")), "target")
    return out


def _filled(cells, dimension, wanted):
    """``cells`` with weights scaled so that the margins of one dimension meet ``wanted`` times their targets.

    No weight exceeds the cell's tokens: the cells of a value are scaled by one factor f and trimmed, and f is the one with
    sum(least(tokens, f * weight)) = target. With cells in the order of tokens / weight that sum is the least of lines, one
    for each number of trimmed cells, so f is the greatest of the factors at which they reach the target.
    """
    of = f"PARTITION BY {dimension}"
    before = f"({of} ORDER BY tokens / weight, {', '.join(DIMENSIONS)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    placed = cells.selectExpr("*", f"coalesce(sum(tokens) OVER {before}, 0) AS _full", f"sum(weight) OVER ({of}) - coalesce(sum(weight) OVER {before}, 0D) AS _open")
    factor = f"max(CASE WHEN _open > 0 THEN ({dimension}_target * {float(wanted)!r}D - _full) / _open END) OVER ({of})"
    filled = "least(cast(tokens AS double), _factor * weight) AS weight"
    return placed.selectExpr("*", f"{factor} AS _factor").selectExpr(*[filled if n == "weight" else n for n in cells.columns])


def _gap(cells, wanted):
    """Largest difference of a margin from its target, as a share of all sampled tokens."""
    off = None
    for d in DIMENSIONS:
        sums = cells.groupBy(d, f"{d}_target").agg(F.sum("weight").alias("sum"))
        gap = sums.select(F.abs(F.col("sum") / F.lit(float(wanted)) - F.col(f"{d}_target")).alias("gap"))
        off = gap if off is None else off.unionAll(gap)
    return off.agg(F.max("gap")).first()[0] or 0.0


def _hopeless(gaps, tolerance, left):
    """Whether ``left`` more steps like the last one, each counted twice, would not bring the gap down to ``tolerance``."""
    return len(gaps) > 1 and gaps[-1] * min(1.0, gaps[-1] / gaps[-2]) ** (2 * left) > tolerance


def rake(cells, targets, share=1.0, tolerance=1e-5, most_rounds=60, least_share=0.01):
    """(cells, share): cells (source, lang, topic, tokens) with ``weight``, the tokens to sample; cells without tokens are left out.

    The margins of the weights are ``share`` of all tokens times the targets, to ``tolerance``, and no cell gives more
    tokens than it has. Each round fills the targets of one dimension after the other (:func:`_filled`) and is written to
    the shared folder, so that no plan is longer than a round; margins are compared every fifth round. Where a value has
    fewer tokens than ``share`` asks for, ``share`` is lowered to what it has; where the margins don't come together in
    ``most_rounds``, or would not at twice the pace of the last five (:func:`_hopeless`), it is lowered by a tenth and raking
    starts anew. Below ``least_share`` targets count as contradictory: an error.
    """
    shares = target_shares(cells, targets)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    named = [*DIMENSIONS, "tokens", "weight"]
    cells = cells.where("tokens > 0").withColumn("weight", F.col("tokens").cast("double")).select(*named)
    if not total:
        return stored(cells, "cells"), share
    for d in DIMENSIONS:
        cells = cells.join(shares[d].withColumnRenamed("target", f"{d}_target"), d)
    cells = stored(cells, "cells")
    for d in DIMENSIONS:
        has = cells.where(F.col(f"{d}_target") > 0).groupBy(d, f"{d}_target").agg(F.sum("tokens").alias("has"))
        share = min(share, has.agg(F.min(F.col("has") / F.lit(float(total)) / F.col(f"{d}_target"))).first()[0] or share)
    while share >= least_share:
        now, gaps = cells, []
        for done in range(1, most_rounds + 1):
            for d in DIMENSIONS:
                now = _filled(now, d, share * total)
            now = stored(now, "cells")
            if done % 5:
                continue
            gaps.append(_gap(now, share * total))
            if gaps[-1] <= tolerance:
                return now.select(*named), share
            if _hopeless(gaps, tolerance, (most_rounds - done) // 5):
                break
        share *= 0.9
    raise ValueError("the targets contradict each other in the cells that have tokens")


def calibrate(docs, targets, share=0.8, topic=None, key="doc_id", text="text", source="source", lang="lang", tolerance=1e-5):
    """(rows, cells, share): per document its cell, and per cell tokens, weight, ratio and probability.

    ``share`` of all tokens is expected in the sample, or the part of it that the targets leave possible, which is
    returned. Tokens are words; texts that are null or blank have none, and a cell without tokens has the probability
    ``share``. Null sources and languages are values of their own. ``topic`` names a column; without it :func:`topic_of`
    is used. Repeated rows count each.
    """
    of_topic = _value(topic) if topic else topic_of(F.col(text))
    small = docs.select(F.col(key).alias("doc"), F.xxhash64(whole(F.col(text))).alias("text_hash"), F.size(words(F.col(text))).cast("long").alias("n_tokens"),
                        _value(source).alias("source"), _value(lang).alias("lang"), of_topic.alias("topic"))
    rows = stored(small, "mixing")
    cells = stored(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    raked, share = rake(cells, targets, share, tolerance)
    rated = cells.join(raked.select(*DIMENSIONS, "weight"), list(DIMENSIONS), "left")
    probability = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight") / F.col("tokens"))).otherwise(F.lit(float(share)))
    rated = rated.withColumn("probability", probability).withColumn("ratio", F.col("probability") / F.lit(float(share)))
    return rows, stored(rated, "cells"), share


def drawn(key, text_hash, probability, seed=0):
    """Whether a document is in the sample: its own hash against the probability, the same in every run."""
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, text_hash), 11) / F.lit(float(1 << 53))
    return u < probability


def sample(docs, targets, share=0.8, topic=None, key="doc_id", text="text", source="source", lang="lang", seed=0):
    """Each document's key, cell, n_tokens, ratio, probability and sampled."""
    rows, cells, _ = calibrate(docs, targets, share, topic, key, text, source, lang)
    return rows.join(cells.select(*DIMENSIONS, "ratio", "probability"), list(DIMENSIONS)).select(
        F.col("doc").alias(key), *[F.when(F.col(d) != "\x00null", F.col(d)).alias(d) for d in DIMENSIONS], "n_tokens", "ratio", "probability",
        drawn(F.col("doc"), F.col("text_hash"), F.col("probability"), seed).alias("sampled"))


def draw(docs, targets, share=0.8, topic=None, key="doc_id", text="text", source="source", lang="lang", seed=0):
    """The sampled documents with all their columns."""
    _, cells, _ = calibrate(docs, targets, share, topic, key, text, source, lang)
    of_topic = _value(topic) if topic else topic_of(F.col(text))
    cells = cells.select(*[F.col(d).alias(f"_{d}") for d in DIMENSIONS], F.col("probability").alias("_probability"))
    placed = docs.withColumns({"_source": _value(source), "_lang": _value(lang), "_topic": of_topic})
    hit = drawn(F.col(key), F.xxhash64(whole(F.col(text))), F.col("_probability"), seed)
    return placed.join(cells, ["_source", "_lang", "_topic"]).where(hit).select(*docs.columns)
