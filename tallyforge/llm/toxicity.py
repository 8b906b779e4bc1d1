"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text and their heads of four and five characters, hashed into buckets. The buckets that tell the classes
apart, and all frequent ones, become the inputs; the machine learns a weight for each and a vector for each whose products score pairs,
so that two terms can mean together what neither means alone.
"""
from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyforge.llm.text import words
from tallyforge.session import stored

BUCKETS = 1 << 20  # so the inputs are bounded, too
HEADS = (4, 5)
EDGES = ".,;:!?\"'()[]{}*#$%&|<>"


def terms(text):
    """Distinct buckets of a whole text as strings; a null or blank text has none.

    Words are lower-cased and freed of punctuation at their ends once per distinct word.
    """
    bare = F.array_distinct(F.transform(F.array_distinct(words(F.lower(text))), lambda w: F.btrim(w, F.lit(EDGES))))
    bucket = lambda kind, x: F.pmod(F.xxhash64(F.lit(kind), x), F.lit(BUCKETS)).cast("int")

    def heads(b, k):
        return F.transform(F.filter(b, lambda w: F.length(w) > k), lambda w: bucket(k, F.left(w, F.lit(k))))

    def of(box):
        b = box["b"]
        return F.array_distinct(F.concat(F.transform(b, lambda w: bucket(0, w)), *[heads(b, k) for k in HEADS]))

    return F.transform(F.array(F.struct(bare.alias("b"))), of)[0].cast("array<string>")


class Toxicity:
    """A fitted scorer: the chosen buckets, and the machine."""

    def __init__(self, chosen, model, constant=None):
        self.chosen, self.model, self.constant = chosen, model, constant

    def score(self, docs, text="text", out="score", threshold=0.7):
        """``docs`` with the score (0 to 1) and predicted (1 from the threshold on). Every row of any text gets both.

        Columns of these names are replaced; all other columns, repeated rows and nulls stay as they are.
        """
        if self.model is None:
            scored = docs.withColumn(out, F.lit(float(self.constant)))
        else:
            kept = [c for c in docs.columns if c != out and c != "predicted"]
            rows = docs.select(F.struct(*kept).alias("_row"), terms(F.col(text)).alias("_terms"))
            scored = self.model.transform(rows).select("_row.*", vector_to_array("_p")[1].alias(out))
        return scored.withColumn("predicted", (F.col(out) >= threshold).cast("int"))


def fit(labelled, label="toxic", text="text", least_g=25.0, often=0.2, factors=4, rounds=80, seed=7):
    """Learn from rows with a text and a 0/1 label; null labels are left out.

    Inputs are the buckets whose likelihood ratio statistic with the class is at least ``least_g`` (chance alone gives
    that to one bucket in a million), and those that at least the share ``often`` of the rows have, whatever they tell on
    their own: such a term may matter in a pair alone. They are counted over all rows, equal texts once. With one class only, without such buckets, or without rows, every text gets the share of label 1 (0
    without rows).
    """
    once = labelled.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label"), text).dropDuplicates()
    rows = stored(once.select("label", terms(F.col(text)).alias("_terms")), "terms")
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("p")).first()
    n, p = total["n"], total["p"]
    if not n or p in (0, n):
        return Toxicity([], None, p / n if n else 0.0)
    counts = rows.select("label", F.explode("_terms").alias("term")).groupBy("term").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    share = (F.col("a") + F.col("b")) / n

    def part(seen, wanted):
        """seen * ln(seen / wanted), 0 for nothing seen."""
        return F.when(seen > 0, seen * F.log(seen / wanted)).otherwise(0.0)

    with_it = part(F.col("a"), share * p) + part(F.col("b"), share * (n - p))
    without = part(p - F.col("a"), (1 - share) * p) + part(n - p - F.col("b"), (1 - share) * (n - p))
    good = (2 * (with_it + without) >= least_g) | (share >= often)
    chosen = sorted(r["term"] for r in counts.where(good).select("term").collect())  # at most BUCKETS
    if not chosen:
        return Toxicity([], None, p / n)
    vector = CountVectorizerModel.from_vocabulary(chosen, inputCol="_terms", outputCol="_x", binary=True)
    # Classes weigh the same in training: the rarer one is repeated by whole copies.
    copies = max(1, min(20, round((n - p) / p)))
    again = F.when(F.col("label") == 1, F.lit(copies)).otherwise(F.lit(1))
    train = stored(vector.transform(rows).select("label", "_x", F.explode(F.array_repeat(F.lit(0), again)).alias("_copy")).drop("_copy"), "training")
    machine = FMClassifier(featuresCol="_x", labelCol="label", probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_pred",
                           factorSize=factors, maxIter=rounds, stepSize=0.05, regParam=1e-4, initStd=0.01, seed=seed, solver="adamW")
    return Toxicity(chosen, PipelineModel(stages=[vector, machine.fit(train)]))


def held_out(key):
    """Rows whose labels are never learned: crc32 of the key as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_documents(docs, labels, key="doc_id", text="text", label="toxic", most_rows=20_000, **options):
    """Fit on the labelled documents that are not held out. A key with several labels counts as its largest.

    Learns from at most ``most_rows`` labelled keys, those with the least hashes. So the labels that meet the documents
    can be broadcast, and no text is shuffled to be looked up.
    """
    truth = labels.select(F.col(key), F.col(label)).dropna().groupBy(key).agg(F.max(label).alias(label)).where(~held_out(key))
    some = truth.orderBy(F.xxhash64(key), key).limit(most_rows)
    return fit(docs.select(key, text).join(F.broadcast(some), key), label, text, **options)
