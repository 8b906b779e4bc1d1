"""Binary classifiers by name, each one estimator: optional rebalancing, assembly, fit."""
from __future__ import annotations

import logging
import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from ..functions.columns import c
from .metrics import evaluate
from .rebalance import SAMPLERS

log = logging.getLogger(__name__)
# the helpers of the Fourier map travel to the executors with the task: the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Model names, in the order they are trained, and their search grids.
GRIDS = {
    "logistic_regression": {"C": [0.001, 0.01, 0.1, 1, 10], "max_iter": [1000]},
    "svm": {"C": [0.1, 1, 10], "kernel": ["rbf", "linear"], "gamma": ["scale", "auto"]},
    "decision_tree": {"max_depth": [6, 10, 16, None], "min_samples_leaf": [1, 2, 4]},
    "random_forest": {"n_estimators": [50, 100, 200], "max_depth": [10, 20, None], "min_samples_leaf": [1, 2]},
    "xgboost": {"n_estimators": [100, 300, 500], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.05, 0.1]},
    "adaboost": {"n_estimators": [50, 100], "learning_rate": [0.01, 0.1, 1.0]},
}
# Settings used when a name is trained without any.
DEFAULTS = {
    "logistic_regression": {"C": 1.0, "max_iter": 1000},
    "svm": {"C": 1.0, "kernel": "rbf", "gamma": "scale", "max_iter": 100},
    "decision_tree": {"max_depth": None, "min_samples_leaf": 1},
    "random_forest": {"n_estimators": 100, "max_depth": None, "min_samples_leaf": 1},
    "xgboost": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3},
    "adaboost": {"n_estimators": 50, "learning_rate": 1.0},
}
DEEPEST = 30
FOURIER_FEATURES = 200


# --------------------------------------------------------------------------- kernel approximation


def _fourier(v, weights, shift, scale):
    """Features of a batch of lists; one working array, which is the answer's own buffer."""
    inputs, outputs = weights.shape
    out = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), inputs) @ weights
    out += shift
    np.cos(out, out=out)
    out *= scale
    return pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, outputs, dtype=np.int32)), pa.array(out.ravel()))


class FourierFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Random Fourier features of a Gaussian kernel (Rahimi and Recht 2007)."""

    settings = Param(Params._dummy(), "settings", "gamma, inputs, outputs, seed, columns")

    def __init__(self, **settings):
        super().__init__()
        if settings:
            self._set(settings=settings)

    def _transform(self, df):
        s = self.getOrDefault(self.settings)
        rng = np.random.default_rng(s["seed"])
        weights = rng.normal(0.0, math.sqrt(2 * s["gamma"]), (s["inputs"], s["outputs"]))
        shift = rng.uniform(0, 2 * math.pi, s["outputs"])
        scale = math.sqrt(2 / s["outputs"])

        @F.arrow_udf("array<double>")
        def project(v: pa.Array) -> pa.Array:
            return _fourier(v, weights, shift, scale)

        return df.withColumn(s["output"], array_to_vector(project(vector_to_array(c(s["input"])))))


# --------------------------------------------------------------------------- boosting of stumps


def _stump_side(stump, features):
    """-1 or +1 as a column expression."""
    if stump["feature"] is None:
        return F.lit(1.0 if stump["left"] == 1.0 else -1.0)
    value = F.get(features, F.lit(stump["feature"]))
    left, right = (1.0 if stump[s] == 1.0 else -1.0 for s in ("left", "right"))
    return F.when(value <= F.lit(stump["threshold"]), F.lit(left)).otherwise(F.lit(right))


class BoostedStumpsModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Weighted vote of stumps; pure column arithmetic."""

    stumps = Param(Params._dummy(), "stumps", "learned stumps with their weights")
    size = Param(Params._dummy(), "size", "number of features")

    def _learn(self, stumps, size):
        self._set(stumps=stumps, size=size)
        return self

    @property
    def featureImportances(self):
        out = np.zeros(self.getOrDefault(self.size))
        for s in self.getOrDefault(self.stumps):
            if s["feature"] is not None:
                out[s["feature"]] += s["weight"]
        return out / out.sum() if out.sum() else out

    def _transform(self, df):
        stumps = self.getOrDefault(self.stumps)
        total = sum(s["weight"] for s in stumps) or 1.0
        x = vector_to_array(c("features"))
        vote = F.lit(0.0)
        for s in stumps:
            vote = vote + F.lit(s["weight"]) * _stump_side(s, x)
        share = vote / F.lit(total)
        p = 1 / (1 + F.exp(-share))
        return df.withColumns({
            "probability": array_to_vector(F.array(1 - p, p)),
            "rawPrediction": array_to_vector(F.array(-share, share)),
            "prediction": (share > 0).cast("double"),
        })


class BoostedStumps(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """AdaBoost (SAMME) over depth-1 trees.

    The weight of a row is recomputed from all stumps so far in one projection, so the plan
    does not grow from round to round and nothing has to be checkpointed.
    """

    settings = Param(Params._dummy(), "settings", "n_estimators, learning_rate, seed")

    def __init__(self, n_estimators=50, learning_rate=1.0, seed=42):
        super().__init__()
        self._set(settings={"n_estimators": n_estimators, "learning_rate": learning_rate, "seed": seed})

    def _fit(self, df):
        s = self.getOrDefault(self.settings)
        x, y = vector_to_array(c("features")), F.when(c("label") == 1, 1.0).otherwise(-1.0)
        stumps, exponent = [], F.lit(0.0)
        for _ in range(s["n_estimators"]):
            weighted = df.withColumn("_weight", F.exp(exponent))
            tree = DecisionTreeClassifier(maxDepth=1, weightCol="_weight", seed=s["seed"], maxBins=64).fit(weighted)
            stump = _read_stump(tree)
            wrong = (_stump_side(stump, x) != y).cast("double")
            row = weighted.agg(F.sum(wrong * F.col("_weight")).alias("e"), F.sum("_weight").alias("w")).first()
            error = row["e"] / row["w"]
            if error <= 0:
                stumps.append({**stump, "weight": 1.0})
                break
            if error >= 0.5:
                break
            weight = s["learning_rate"] * math.log((1 - error) / error)
            stumps.append({**stump, "weight": weight})
            exponent = exponent + F.lit(weight) * wrong
        if not stumps:
            raise ValueError("no stump is better than chance")
        return BoostedStumpsModel()._learn(stumps, tree.numFeatures)


def _read_stump(tree):
    root = tree._call_java("rootNode")
    if tree.depth == 0:
        return {"feature": None, "threshold": None, "left": root.prediction(), "right": root.prediction()}
    split = root.split()
    return {
        "feature": split.featureIndex(), "threshold": split.threshold(),
        "left": root.leftChild().prediction(), "right": root.rightChild().prediction(),
    }


# --------------------------------------------------------------------------- one estimator per name


def _fit_named(name, p, df, n, seed):
    """Fitted stages for a frame with ``features`` and ``label``."""
    if name == "logistic_regression":
        # C weighs the summed loss, regParam weighs against the mean loss
        return [LogisticRegression(maxIter=int(p["max_iter"]), regParam=1.0 / (p["C"] * n), elasticNetParam=0.0, standardization=False).fit(df)]
    if name == "svm":
        return _fit_svm(p, df, n, seed)
    depth = min(DEEPEST, p.get("max_depth") or DEEPEST)
    if name == "decision_tree":
        return [DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=int(p["min_samples_leaf"]), maxBins=64, seed=seed).fit(df)]
    if name == "random_forest":
        return [RandomForestClassifier(numTrees=int(p["n_estimators"]), maxDepth=depth, minInstancesPerNode=int(p["min_samples_leaf"]), maxBins=64, seed=seed).fit(df)]
    if name == "xgboost":
        return [GBTClassifier(maxIter=int(p["n_estimators"]), maxDepth=depth, stepSize=p["learning_rate"], maxBins=64, seed=seed).fit(df)]
    if name == "adaboost":
        return [BoostedStumps(int(p["n_estimators"]), float(p["learning_rate"]), seed).fit(df)]
    raise ValueError(f"Unknown model: {name}")


def _fit_svm(p, df, n, seed):
    stages, column = [], "features"
    if p["kernel"] == "rbf":
        size = len(df.select(c("features")).first()[0])
        gamma = p["gamma"]
        if gamma == "auto":
            gamma = 1.0 / size
        elif gamma == "scale":
            spread = df.select(F.explode(vector_to_array(c("features"))).alias("x")).agg(F.var_pop("x")).first()[0]
            gamma = 1.0 / (size * spread) if spread else 1.0
        stages.append(FourierFeatures(gamma=float(gamma), inputs=size, outputs=FOURIER_FEATURES, seed=seed, input="features", output="kernel_features"))
        df, column = stages[-1].transform(df), "kernel_features"
    margin = LinearSVC(featuresCol=column, maxIter=int(p.get("max_iter", 100)), regParam=1.0 / (p["C"] * n), standardization=False, rawPredictionCol="margin").fit(df)
    # the margin becomes a probability through a logistic curve (Platt 1999)
    curve = LogisticRegression(featuresCol="margin", predictionCol="curve_prediction", rawPredictionCol="rawPrediction", maxIter=100).fit(margin.transform(df))
    return [*stages, margin, curve]


class NamedClassifier(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """A classifier by name. Rebalancing, if any, touches only the rows it is fitted on.

    ``settings``: name, columns, label, params, sampler (``smote``, ``smote_tomek`` or None), key, seed.
    """

    settings = Param(Params._dummy(), "settings", "what to fit, and on which columns")

    def __init__(self, **settings):
        super().__init__()
        if settings:
            self._set(settings={"params": {}, "sampler": None, "key": None, "seed": 42, **settings})

    def with_params(self, params):
        return {**self.getOrDefault(self.settings), "params": params}

    def _fit(self, df):
        s = self.getOrDefault(self.settings)
        if s["name"] not in DEFAULTS:
            raise ValueError(f"Unknown model: {s['name']}")
        foreign = set(s["params"]) - set(DEFAULTS[s["name"]]) - set(GRIDS[s["name"]])
        if foreign:
            raise ValueError(f"unknown settings of {s['name']}: {sorted(foreign)}")
        if s["sampler"]:
            df = SAMPLERS[s["sampler"]](df, s["columns"], s["label"], s["key"], seed=s["seed"])
        assembler = VectorAssembler(inputCols=s["columns"], outputCol="features", handleInvalid="error")
        ready = assembler.transform(df.withColumn("label", c(s["label"]).cast("double"))).select("features", "label").persist()
        try:
            fitted = _fit_named(s["name"], {**DEFAULTS[s["name"]], **s["params"]}, ready, max(1, ready.count()), s["seed"])
        finally:
            ready.unpersist()
        return PipelineModel([assembler, *fitted])


def train(df, name, columns, label, params=None, sampler=None, key=None, seed=42):
    """Fit one model with fixed settings."""
    return NamedClassifier(name=name, columns=list(columns), label=label, params=params or {}, sampler=sampler, key=key, seed=seed).fit(df)


def predict(model, df):
    """Add ``prediction`` (0/1) and ``score`` (probability of class 1)."""
    names = df.columns
    out = model.transform(df)
    return out.select(
        *[c(n) for n in names if n not in ("prediction", "score")],
        c("prediction").cast("int").alias("prediction"), F.get(vector_to_array(c("probability")), F.lit(1)).alias("score"),
    )


def scored(model, df, label):
    """``(label, prediction, score)`` for the evaluation functions."""
    return predict(model, df).select(c(label).cast("int").alias("label"), "prediction", "score")


def evaluate_model(model, df, label):
    """All metrics of a model on a table, as a dictionary."""
    return {k: v for k, v in evaluate(scored(model, df, label)).first().asDict().items() if k != "n"}


def train_all(train_df, test_df, columns, label, names=None, params=None, optimise=None, sampler=None, key=None, seed=42, strict=False):
    """``(models, metrics table rows)``; a model that fails is logged and left out, or with ``strict`` an error.

    ``optimise(df, name)`` may replace plain training; it returns ``(model, params)``.
    """
    names = list(DEFAULTS if names is None else names)
    if not names:
        raise ValueError("no models to train")
    models, metrics = {}, {}
    train_df, test_df = train_df.persist(), test_df.persist()
    try:
        for name in names:
            try:
                if optimise:
                    models[name], _ = optimise(train_df, name)
                else:
                    models[name] = train(train_df, name, columns, label, (params or {}).get(name), sampler, key, seed)
                metrics[name] = evaluate_model(models[name], test_df, label)
            except Exception as e:  # noqa: BLE001
                if strict:
                    raise RuntimeError(f"training {name} failed: {e}") from e
                log.error("training %s failed: %s", name, e)
                models.pop(name, None)
    finally:
        train_df.unpersist()
        test_df.unpersist()
    return models, metrics


def metrics_table(spark, metrics):
    """``(position, model, accuracy, precision, recall, f1, roc_auc)``."""
    rows = [(i, n, *[v.get(k) for k in ("accuracy", "precision", "recall", "f1", "roc_auc")]) for i, (n, v) in enumerate(metrics.items())]
    return spark.createDataFrame(rows, "position int, model string, accuracy double, precision double, recall double, f1 double, roc_auc double")


def feature_importance(spark, model, columns, top_n=20, only=None):
    """``(feature, importance)`` of the ``top_n`` features, or None for a model without importances."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if not hasattr(last, "featureImportances"):
        return None
    values = last.featureImportances
    values = values.toArray() if hasattr(values, "toArray") else values
    rows = sorted(((n, float(v)) for n, v in zip(columns, values) if only is None or n in only), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows[:top_n], "feature string, importance double")


def save_model(model, path):
    model.write().overwrite().save(path)
    return path


def load_model(path):
    return PipelineModel.load(path)
