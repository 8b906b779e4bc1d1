"""Evaluation of binary scores. Input: ``label`` and ``prediction`` (0/1) and, where used, ``score``.

``by`` names the columns that identify a model, so that many models are evaluated at once.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import c, ratio
from ..plans.running import running_totals

METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]


def _outcomes():
    y, p = c("label").cast("int"), c("prediction").cast("int")
    return [
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"),
    ]


def _rate(num, den):
    return F.coalesce(ratio(num, den), F.lit(0.0))


def classification_metrics(scored, by=()):
    """accuracy, precision, recall and F1 of class 1; a division by zero gives 0."""
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    return scored.groupBy(*by).agg(*_outcomes()).select(
        *by,
        (tp + fp + fn + tn).alias("n"),
        _rate(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _rate(tp, tp + fp).alias("precision"),
        _rate(tp, tp + fn).alias("recall"),
        _rate(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def _ladder(scored, by):
    """Positives and negatives at or above every distinct score, highest score first."""
    steps = scored.where("score is not null").groupBy(*by, "score").agg(
        F.count_if(c("label") == 1).alias("pos"), F.count_if(c("label") == 0).alias("neg")
    )
    return running_totals(steps, list(by), "score", ["pos", "neg"], descending=True)


def roc_auc(scored, by=()):
    """Area under the ROC curve; tied scores count half. Null when a class is absent."""
    won = F.col("neg") * (F.col("run_pos") - F.col("pos") + F.col("pos") / 2.0)
    return _ladder(scored, by).groupBy(*by).agg(
        F.try_divide(F.sum(won), F.max("all_pos").cast("double") * F.max("all_neg")).alias("roc_auc")
    )


def roc_points(scored, by=()):
    """``(threshold, fpr, tpr)`` per distinct score, plus the start (0, 0) without a threshold."""
    ladder = _ladder(scored, by)
    points = ladder.select(
        *by, F.col("score").alias("threshold"),
        ratio(F.col("run_neg"), F.col("all_neg")).alias("fpr"), ratio(F.col("run_pos"), F.col("all_pos")).alias("tpr"),
    )
    start = scored.groupBy(*by).agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def precision_recall_points(scored, by=()):
    """``(threshold, precision, recall)`` per distinct score."""
    return _ladder(scored, by).select(
        *by, F.col("score").alias("threshold"),
        ratio(F.col("run_pos"), F.col("run_pos") + F.col("run_neg")).alias("precision"),
        ratio(F.col("run_pos"), F.col("all_pos")).alias("recall"),
    )


def average_precision(scored, by=()):
    gain = F.try_divide(F.col("pos").cast("double"), F.col("all_pos"))
    at = ratio(F.col("run_pos"), F.col("run_pos") + F.col("run_neg"))
    return _ladder(scored, by).groupBy(*by).agg(F.sum(gain * at).alias("average_precision"))


def evaluate(scored, by=()):
    """All metrics in one line per model; ``roc_auc`` only when there is a ``score``."""
    table = classification_metrics(scored, by)
    if "score" not in scored.columns:
        return table
    auc = roc_auc(scored, by)
    if not by:
        # one line on each side
        return table.withColumn("roc_auc", auc.scalar())
    return table.join(auc, list(by), "left")


def confusion(scored, by=()):
    """``(label, prediction, n, percent)`` with all four cells; percent within the true label."""
    cells = F.array(
        F.struct(F.lit(1).alias("label"), F.lit(1).alias("prediction"), F.col("tp").alias("n"), (F.col("tp") + F.col("fn")).alias("of")),
        F.struct(F.lit(1).alias("label"), F.lit(0).alias("prediction"), F.col("fn").alias("n"), (F.col("tp") + F.col("fn")).alias("of")),
        F.struct(F.lit(0).alias("label"), F.lit(1).alias("prediction"), F.col("fp").alias("n"), (F.col("fp") + F.col("tn")).alias("of")),
        F.struct(F.lit(0).alias("label"), F.lit(0).alias("prediction"), F.col("tn").alias("n"), (F.col("fp") + F.col("tn")).alias("of")),
    )
    return (
        scored.groupBy(*by).agg(*_outcomes()).select(*by, F.inline(cells))
        .select(*by, "label", "prediction", "n", (_rate(F.col("n"), F.col("of")) * 100).alias("percent"))
    )


def class_report(scored, by=()):
    """precision, recall, F1 and support of both classes, their plain and their weighted mean."""
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))

    def line(name, hit, wrong, missed):
        return F.struct(
            F.lit(name).alias("class"), _rate(hit, hit + wrong).alias("precision"), _rate(hit, hit + missed).alias("recall"),
            _rate(2 * hit, 2 * hit + wrong + missed).alias("f1"), (hit + missed).alias("support"),
        )

    zero, one = line("0", tn, fn, fp), line("1", tp, fp, fn)
    outcome = scored.groupBy(*by).agg(*_outcomes()).withColumns({"_zero": zero, "_one": one})
    total = F.col("_zero.support") + F.col("_one.support")

    def mean(name, weight):
        w0, w1 = (F.lit(0.5), F.lit(0.5)) if weight is None else (ratio(F.col("_zero.support"), total), ratio(F.col("_one.support"), total))
        parts = [(F.col(f"_zero.{m}") * w0 + F.col(f"_one.{m}") * w1).alias(m) for m in ("precision", "recall", "f1")]
        return F.struct(F.lit(name).alias("class"), *parts, total.alias("support"))

    lines = F.array(F.col("_zero"), F.col("_one"), mean("macro", None), mean("weighted", "support"))
    return outcome.select(*by, F.inline(lines))


def comparison(metrics, wanted=METRICS):
    """Long form ``(model, metric, score)`` of the metrics that are present."""
    present = [m for m in wanted if m in metrics.columns]
    cells = F.array(*[F.struct(F.lit(m.upper()).alias("metric"), c(m).cast("double").alias("score")) for m in present])
    return metrics.select("model", F.inline(cells)).where("score is not null")


def ranking(metrics, metric="f1"):
    return metrics.orderBy(c(metric).desc_nulls_last(), "model")


def best_model(metrics, metric="f1", order="position"):
    """Line with the highest metric; a missing metric counts 0 and the first wins a tie."""
    score = F.coalesce(c(metric), F.lit(0.0)) if metric in metrics.columns else F.lit(0.0)
    best = F.max_by(F.struct(*metrics.columns), F.struct(score, -c(order)))
    return metrics.agg(best.alias("b")).select("b.*")


def overfit_gap(train, validation, by=("model",), limit=0.10):
    """Accuracy on train minus accuracy on validation, flagged above ``limit``."""
    a = classification_metrics(train, by).select(*by, F.col("accuracy").alias("train_accuracy"))
    b = classification_metrics(validation, by).select(*by, F.col("accuracy").alias("validation_accuracy"))
    gap = F.col("train_accuracy") - F.col("validation_accuracy")
    return a.join(b, list(by)).select("*", gap.alias("gap"), (gap > limit).alias("overfit"))


def report_table(metrics):
    """The table of a training report: one line per model, numbers as text with four decimals."""
    shown = [m for m in METRICS if m in metrics.columns]
    return metrics.select("model", *[F.coalesce(F.format_number(c(m), 4), F.lit("-")).alias(m) for m in shown])
