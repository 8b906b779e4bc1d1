"""Quality rules learned as an ordered decision list.

Sequential covering: a rule is a conjunction of thresholds, grown condition by condition on two thirds of the
labelled rows and pruned on the rest; the rows it covers leave, and the next rule starts. The list is emitted as one
Spark conditional expression over per-document statistics.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import functions as F

from tallyforge.llm.text import SPACE, grams, whole, words
from tallyforge.session import stored

SYMBOLS = "#*$%&|<>"  # fixed values of the base rules
WINDOW = 8
FEATURES = ("n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "stop_share")


def _repeat_words(tokens, k=WINDOW):
    """Words inside runs of ``k`` words that occur twice or more in the document, the first occurrence included.

    Runs are compared by 64-bit hash inside one document. Documents without any repeated run stop after a hash set;
    the others sort their runs, keep those with an equal neighbour, and add up the covered words from start to start.
    """
    g = grams(tokens, k)

    def covered(hashes):
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def of_pairs(box):
            p = box["p"]
            last = F.size(p) - 1
            again = F.filter(p, lambda x, j: ((j > 0) & (F.get(p, j - 1)["h"] == x["h"])) | ((j < last) & (F.get(p, j + 1)["h"] == x["h"])))
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        def total(box):
            s = box["s"]
            return F.aggregate(F.transform(s, lambda x, j: F.least(F.lit(k), F.coalesce(F.get(s, j + 1) - x, F.lit(k)))), F.lit(0), lambda a, x: a + x)

        starts = F.transform(F.array(F.struct(pairs.alias("p"))), of_pairs)
        return F.transform(F.transform(starts, lambda s: F.struct(s.alias("s"))), total)[0]

    def one(box):
        h = box["g"]
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))

    return F.transform(F.array(F.struct(g.alias("g"))), one)[0]


def statistics(docs, key="doc_id", text="text"):
    """Counts of each document: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and shares for learning.

    A null or empty text has zero of everything. Repeated rows are counted each on their own; other columns are ignored.
    """
    body = docs.select(F.col(key), whole(F.col(text)).alias("_t"))
    rows = body.select(key, "_t", words(F.col("_t")).alias("_w"), F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    n = rows.select(
        key,
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("_t", SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").alias("_lines"),
        _repeat_words(F.col("_w")).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("_w")).alias("_distinct"),
        F.regexp_count("_t", F.lit("[A-Z]")).alias("_upper"),
        F.regexp_count("_t", F.lit("[.!?]")).alias("_stops"),
    )
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1)).cast("double")
    return n.select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("word_length"), share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "_lines").alias("dup_line_share"), share("n_repeat_words", "n_words").alias("repeat_share"),
        share("_distinct", "n_words").alias("distinct_share"), share("_upper", "word_chars").alias("upper_share"),
        share("_stops", "n_words").alias("stop_share"),
    )


def base_failed():
    """The fixed rules: fewer than 20 words, or over 30 % of the words in repeated runs."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self):
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold

    def __str__(self):
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


class DecisionList:
    """Ordered rules; a document is rejected by the first one that holds."""

    def __init__(self, rules):
        self.rules = rules

    def rule_index(self):
        """0, 1, ... of the first rule that holds; null if none does. One ordered conditional expression."""
        out = None
        for i, rule in enumerate(self.rules):
            held = F.lit(True)
            for c in rule:
                held = held & c.column()
            out = F.when(held, F.lit(i)) if out is None else out.when(held, F.lit(i))
        return F.lit(None).cast("int") if out is None else out

    def __str__(self):
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules) + "\nelse keep"


def _gain(p, n, p0, n0):
    """FOIL information gain of narrowing (p0, n0) down to (p, n)."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p and p0 else 0.0


def _cuts(frame, features, cuts):
    """Thresholds of each feature: quantiles of all rows and of each class, the ends of both, and the tails of the good rows."""
    inner = [(i + 1) / (cuts + 1) for i in range(cuts)]
    wanted = {"all": (F.lit(True), inner), "bad": (F.col("y") == 1, [0.0, *inner, 1.0]), "good": (F.col("y") == 0, [0.0, 0.001, 0.01, *inner, 0.99, 0.999, 1.0])}
    got = frame.agg(*[F.percentile_approx(F.when(rows, F.col(f)), at, 10000).alias(f"{name} {f}") for f in features for name, (rows, at) in wanted.items()]).first()
    # The first value below all good rows: "at most this" then means "less than the least good row".
    below = {f: [math.nextafter(got[f"good {f}"][0], -math.inf)] if got[f"good {f}"] else [] for f in features}
    return {f: sorted({*below[f], *[x for name in wanted for x in got[f"{name} {f}"] or []]}) for f in features}


def learn(labelled, label="bad", features=FEATURES, cuts=24, max_rules=None, max_conditions=4, least_precision=0.9, least_cover=5):
    """Learn a DecisionList from rows with ``features`` and a 0/1 ``label`` (1: reject).

    Rows with a null label or feature are left out. One class only, or no rows, gives an empty list (keep all).
    Thresholds are taken anew from the rows left in each round: ``cuts`` quantiles of all, bad and good rows, their ends
    and tails. So a step collects at most features x (3 cuts + 10) counts, whatever the number of rows. A rule needs
    ``least_precision`` and ``least_cover`` rows on the pruning part; if it fails, rules that start with another
    feature or direction are tried. The list ends when none is left, or at ``max_rules``.
    """
    rows = labelled.dropna(subset=[label, *features]).select(F.col(label).cast("int").alias("y"), *[F.col(f).cast("double").alias(f) for f in features])
    fold = F.pmod(F.xxhash64("y", *features), F.lit(3))
    left, rules = stored(rows.select("y", *features, (fold == 0).alias("prune")), "rules"), []

    def tally(frame, cut):
        """Counts by feature, bin (how many cuts lie below the value) and class; bounded by features x cuts."""
        def bin_of(f):
            return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cut[f]]), lambda c: F.col(f) > c))

        bins = F.array(*[bin_of(f) for f in features])
        got = frame.select("y", F.posexplode(bins).alias("f", "b")).groupBy("f", "b").agg(F.sum("y").alias("p"), F.count("*").alias("n"))
        return {(r["f"], r["b"]): (r["p"], r["n"] - r["p"]) for r in got.collect()}

    def holds(conditions):
        out = F.lit(True)
        for c in conditions:
            out = out & c.column()
        return out

    def best_condition(counts, cut, tried=()):
        p0 = sum(v[0] for k, v in counts.items() if k[0] == 0)
        n0 = sum(v[1] for k, v in counts.items() if k[0] == 0)
        best = (0.0, None)
        if p0 and n0:
            for i, f in enumerate(features):
                p = n = 0
                for b in range(len(cut[f])):
                    p, n = p + counts.get((i, b), (0, 0))[0], n + counts.get((i, b), (0, 0))[1]
                    for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                        if (f, above) not in tried and (g := _gain(pp, nn, p0, n0)) > best[0]:
                            best = (g, Condition(f, above, cut[f][b]))
        return best[1]

    def pruned(grown):
        """The shortest head of the rule with the best share of bad rows among those it was not grown on; None if it fails."""
        heads = [holds(grown[: i + 1]) for i in range(len(grown))]
        got = left.where("prune").agg(*[F.sum(F.when(h, F.col("y")).otherwise(0)).alias(f"p{i}") for i, h in enumerate(heads)], *[F.sum(h.cast("int")).alias(f"m{i}") for i, h in enumerate(heads)]).first()
        value = [((got[f"p{i}"] or 0) / got[f"m{i}"] if got[f"m{i}"] else 0.0, got[f"m{i}"] or 0) for i in range(len(grown))]
        fit = [i for i, v in enumerate(value) if v[0] >= least_precision and v[1] >= least_cover]
        return grown[: max(fit, key=lambda i: (round(value[i][0], 3), -i)) + 1] if fit else None

    while max_rules is None or len(rules) < max_rules:
        grow = left.where(~F.col("prune"))
        cut = _cuts(grow, features, cuts)
        if not all(cut.values()):
            break
        first, tried, rule = tally(grow, cut), set(), None
        while rule is None and (start := best_condition(first, cut, tried)):
            grown, frame = [start], grow.where(start.column())
            while len(grown) < max_conditions and (more := best_condition(tally(frame, cut), cut)):
                grown.append(more)
                frame = frame.where(more.column())
            rule = pruned(grown)
            tried.add((start.feature, start.above))
        if rule is None:
            break
        rules.append(rule)
        left = left.where(~holds(rule))
    return DecisionList(rules)


def judge(docs, labels, key="doc_id", text="text", **options):
    """Statistics and verdict of every document: base rules first, then the learned list.

    ``labels`` has the key and ``quality`` (0: bad). Returns the statistics, base_failed, rule (index of the learned
    rule that holds, else null) and kept. Repeated documents each get a row.
    """
    stats = stored(statistics(docs, key, text), "statistics")
    truth = labels.select(F.col(key), (1 - F.col("quality")).alias("bad")).dropna().groupBy(key).agg(F.max("bad").alias("bad"))
    rules = learn(stats.where(~base_failed()).join(truth, key), **options)
    return stats.withColumn("base_failed", base_failed()).withColumn("rule", rules.rule_index()).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
