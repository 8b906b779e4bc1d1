"""Grid and randomised search with stratified folds."""
from __future__ import annotations

import itertools
import logging
import random
from multiprocessing.pool import ThreadPool

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from ..functions.columns import c
from ..session import stored
from .models import GRIDS, NamedClassifier, train
from .rebalance import SAMPLERS
from .split import with_folds

log = logging.getLogger(__name__)

# Search settings.
SEARCH = {"method": "randomized", "folds": 5, "n_iter": 20, "scoring": "f1", "seed": 42, "parallelism": 4}
_BY_LABEL = {"f1": "fMeasureByLabel", "precision": "precisionByLabel", "recall": "recallByLabel"}


def evaluator(metric):
    """The Spark evaluator of a metric of class 1."""
    if metric == "roc_auc":
        return BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC", numBins=0)
    if metric == "accuracy":
        return MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    return MulticlassClassificationEvaluator(labelCol="label", metricName=_BY_LABEL[metric], metricLabel=1.0)


def combinations(grid):
    """All settings of a grid, in order."""
    names = list(grid)
    return [dict(zip(names, values)) for values in itertools.product(*grid.values())]


def draws(grid, n_iter, seed=42):
    """At most ``n_iter`` different settings drawn without replacement; repeatable."""
    every = combinations(grid)
    n = min(n_iter, max(1, len(every)))
    return [every[i] for i in random.Random(seed).sample(range(len(every)), n)]


def optimise(df, name, columns, label, key, grid=None, sampler=None, **search):
    """``(best model, best params, scores)``: cross-validated search, best settings fitted on all rows.

    ``scores`` is ``[(params, mean score)]``. Without a grid the model is trained plainly.
    """
    s = {**SEARCH, **search}
    grid = GRIDS.get(name, {}) if grid is None else grid
    if not grid:
        log.warning("no grid for %s: plain training", name)
        return train(df, name, columns, label, seed=s["seed"]), {}, []
    settings = combinations(grid) if s["method"] == "grid" else draws(grid, s["n_iter"], s["seed"])
    plain = NamedClassifier(name=name, columns=list(columns), label=label, key=key, seed=s["seed"])
    measure = evaluator(s["scoring"])
    folded = stored(with_folds(df.withColumn("label", c(label).cast("double")), label, key, s["folds"], s["seed"], column="_fold"), "folds")
    totals = [0.0] * len(settings)
    for fold in range(s["folds"]):
        rows, held = folded.where(c("_fold") != fold), folded.where(c("_fold") == fold)
        if sampler:  # does not depend on the settings: once for each fold
            rows = stored(SAMPLERS[sampler](rows, list(columns), label, key, seed=s["seed"]), "resampled")

        def score(params, rows=rows, held=held):
            fitted = plain.copy({plain.settings: plain.with_params(params)}).fit(rows)
            return measure.evaluate(fitted.transform(held))

        with ThreadPool(s["parallelism"]) as pool:
            totals = [a + b for a, b in zip(totals, pool.map(score, settings))]
    scores = [(p, t / s["folds"]) for p, t in zip(settings, totals)]
    best = max(range(len(scores)), key=lambda i: scores[i][1])
    return train(df, name, columns, label, settings[best], sampler, key, s["seed"]), settings[best], scores
