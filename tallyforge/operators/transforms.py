"""Fitted transforms as ``pyspark.ml`` stages.

Fitting reads the table a fixed, small number of times for all columns together; the
learned values are stored on the model and enter the plan as constants.
"""
from __future__ import annotations

import math

from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import c, clip, melt, nan_to_null, numeric_columns, string_columns
from ..plans.quantiles import exact_quantiles
from ..session import scratch_path, stored
from .clean import constant_columns
from .features import engineer
from .split import MAX_CLASSES


class _Options(Params):
    """Options as one JSON-friendly dictionary, so that stages save and load by themselves."""

    options = Param(Params._dummy(), "options", "options of the stage")

    def option(self, name):
        return self.getOrDefault(self.options)[name]


class _Stage(Estimator, _Options, DefaultParamsReadable, DefaultParamsWritable):
    DEFAULTS: dict = {}
    MODEL = None

    def __init__(self, **options):
        super().__init__()
        unknown = set(options) - set(self.DEFAULTS)
        if unknown:
            raise ValueError(f"unknown options: {sorted(unknown)}")
        self._set(options={**self.DEFAULTS, **options})

    def _fit(self, df):
        return self.MODEL()._learn(self.getOrDefault(self.options), self._learn(nan_to_null(df)))

    def _learn(self, df):
        raise NotImplementedError

    def _numeric(self, df):
        return list(self.option("columns") or numeric_columns(df, set(self.option("skip"))))


class _Learned(Model, _Options, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "learned values")

    def __init__(self):
        super().__init__()

    def _learn(self, options, state):
        self._set(options=options, state=state)
        return self

    @property
    def learned(self):
        return self.getOrDefault(self.state)

    def parameters(self, spark):
        """The learned values as a table ``(column, param, value)``."""
        rows = []
        for column, values in self.learned.items():
            values = values if isinstance(values, dict) else {"value": values}
            rows += [(column, p, None if v is None else str(v)) for p, v in values.items()]
        return spark.createDataFrame(rows, "column string, param string, value string")


# --------------------------------------------------------------------------- missing values


def top_values(df, columns):
    """Most frequent non-null value per column, the smallest on a tie."""
    if not columns:
        return {}
    counts = (
        melt(df, columns, "string").where("value is not null").groupBy("feature", "value").count()
    )
    # a min over (-count, value) combines on the map side; no sort by column is needed
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("count")).alias("n"), "value")).alias("best"))
    found = {r["feature"]: r["best"]["value"] for r in best.collect()}  # one line per column
    return {n: found.get(n) for n in columns}


class MissingFillerModel(_Learned):
    def _transform(self, df):
        df, new = nan_to_null(df), {}
        for n, value in self.learned.items():
            if n in df.columns:
                col = c(n).cast("double") if isinstance(value, float) else c(n)
                new[n] = col if value is None else F.coalesce(col, F.lit(value))
        return df.withColumns(new) if new else df


class MissingFiller(_Stage):
    """Numbers by ``median`` or ``mean``, categories by ``mode`` or ``unknown``."""

    DEFAULTS = {"numeric": "median", "categorical": "mode", "columns": None, "skip": []}
    MODEL = MissingFillerModel

    def _learn(self, df):
        names = self.option("columns")
        numeric = [n for n in numeric_columns(df, self.option("skip")) if not names or n in names]
        words = [n for n in string_columns(df, self.option("skip")) if not names or n in names]
        learned = {}
        if self.option("numeric") == "mean":
            row = df.agg(*[F.avg(c(n)).alias(f"m{i}") for i, n in enumerate(numeric)]).first() if numeric else []
            learned.update({n: row[i] for i, n in enumerate(numeric)})
        else:
            medians = exact_quantiles(df, numeric, [0.5])
            learned.update({n: medians[n][0.5] for n in numeric})
        if self.option("categorical") == "unknown":
            learned.update({n: "Unknown" for n in words})
        else:
            learned.update(top_values(df, words))
        return learned


# --------------------------------------------------------------------------- features


class FeatureBuilder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The domain features as a stage."""

    def _transform(self, df):
        return engineer(df)


# --------------------------------------------------------------------------- outliers


class OutlierLimiterModel(_Learned):
    def _transform(self, df):
        df = nan_to_null(df)
        if self.option("method") == "zscore":
            return _replace_far(df, self._present(df), self.option("threshold"))
        new = {
            n: clip(c(n).cast("double"), b["low"], b["high"])
            for n, b in self.learned.items()
            if n in df.columns and b["low"] is not None
        }
        return df.withColumns(new) if new else df

    def _present(self, df):
        return [n for n in self.learned if n in df.columns]


def _replace_far(df, columns, threshold):
    """Values further than ``threshold`` deviations from the mean of this frame become the mean."""
    if not columns:
        return df
    row = df.agg(
        *[F.avg(c(n)).alias(f"m{i}") for i, n in enumerate(columns)],
        *[F.stddev_samp(c(n)).alias(f"s{i}") for i, n in enumerate(columns)],
        *[F.min(c(n)).alias(f"lo{i}") for i, n in enumerate(columns)],
        *[F.max(c(n)).alias(f"hi{i}") for i, n in enumerate(columns)],
    ).first()
    new = {}
    for i, n in enumerate(columns):
        mean, std = row[f"m{i}"], row[f"s{i}"]
        # merged partial deviations of equal values may be a little above 0: the range tells a constant column
        if mean is None or std is not None and row[f"lo{i}"] == row[f"hi{i}"]:
            continue
        x = c(n).cast("double")
        near = F.abs((x - mean) / std) <= threshold if std is not None else F.lit(False)
        new[n] = F.when(near, x).otherwise(F.lit(mean))
    return df.withColumns(new) if new else df


class OutlierLimiter(_Stage):
    """``iqr``: clip to train quartiles -/+ threshold x IQR; ``zscore``: far values become the mean."""

    DEFAULTS = {"method": "iqr", "threshold": 1.5, "columns": None, "skip": []}
    MODEL = OutlierLimiterModel

    def _learn(self, df):
        columns = self._numeric(df)
        if self.option("method") == "zscore":
            return {n: {} for n in columns}
        k = self.option("threshold")
        learned = {}
        for n, q in exact_quantiles(df, columns, [0.25, 0.75]).items():
            if q[0.25] is None:
                learned[n] = {"low": None, "high": None}
            else:
                spread = q[0.75] - q[0.25]
                learned[n] = {"low": q[0.25] - k * spread, "high": q[0.75] + k * spread}
                if not all(map(math.isfinite, learned[n].values())):  # infinite quartiles bound nothing
                    learned[n] = {"low": None, "high": None}
        return learned


# --------------------------------------------------------------------------- categories

def ranked_labels(labels):
    """``feature`` and ``label`` (distinct lines) with the code of each label: its rank within the feature, from 0.

    The sort is spread over ranges; each range numbers its own lines, and the sizes of the ranges (a few rows) shift them
    to ranks over all features, from which the first rank of the feature is taken.
    """
    numbered = stored(labels.orderBy("feature", "label").withColumn("_id", F.monotonically_increasing_id()), "labels")
    numbered = numbered.select("feature", "label", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    ranks = numbered.join(shifts, "_part").select("feature", "label", (F.col("_shift") + F.col("_at")).alias("_rank"))
    return ranks.join(ranks.groupBy("feature").agg(F.min("_rank").alias("_first")), "feature").select("feature", "label", (F.col("_rank") - F.col("_first")).alias("code"))


def _label_text(col, missing):
    """A cell as text; a missing one is a label of its own unless ``missing`` is None."""
    text = col.cast("string")
    return text if missing is None else F.coalesce(text, F.lit(missing))


class _CodesWriter(DefaultParamsWriter):
    """Saves the code table inside the model's folder."""

    def saveImpl(self, path):
        super().saveImpl(path)
        self.instance.codes(SparkSession.active()).write.parquet(f"{path}/codes")


class _CodesReader(DefaultParamsReader):
    def load(self, path):
        model = super().load(path)
        return model._learn(model.getOrDefault(model.options), {n: {**v, "table": f"{path}/codes"} for n, v in model.learned.items()})


class CategoryCoderModel(_Learned):
    """The codes are a table whatever their number: written when fitted, copied into the folder of a saved model."""

    def write(self):
        return _CodesWriter(self)

    @classmethod
    def read(cls):
        return _CodesReader(cls)

    def codes(self, spark):
        """``(feature, label, code)`` of all columns."""
        for known in self.learned.values():
            return spark.read.parquet(known["table"])
        return spark.createDataFrame([], "feature string, label string, code bigint")

    def _transform(self, df):
        codes = self.codes(df.sparkSession)
        for n, known in self.learned.items():
            if n not in df.columns:
                continue
            unseen = -1 if self.option("unseen") == "minus_one" else known["size"]
            # left to the optimiser: broadcast when the codes are few, else sort-merge
            own = codes.where(F.col("feature") == n).select(F.col("label").alias("_label"), F.col("code").alias("_code"))
            df = df.join(own, _label_text(c(n), self.option("missing")) == F.col("_label"), "left").select(
                *[F.coalesce("_code", F.lit(unseen)).cast("int").alias(n) if k == n else c(k) for k in df.columns]
            )
        return df


class CategoryCoder(_Stage):
    """Codes by sorted order from 0; unseen values become -1, or the number of known values."""

    DEFAULTS = {"unseen": "minus_one", "missing": "nan", "columns": None, "skip": []}
    MODEL = CategoryCoderModel

    def _learn(self, df):
        columns = list(self.option("columns") or string_columns(df, set(self.option("skip"))))
        if not columns:
            return {}
        as_text = df.select(*[_label_text(c(n), self.option("missing")).alias(n) for n in columns])
        labels = melt(as_text, columns, "string").where("value is not null").distinct().select("feature", F.col("value").alias("label"))
        path = scratch_path(df.sparkSession, "codes")
        ranked_labels(labels).write.parquet(path)
        sizes = {r["feature"]: r["n"] for r in df.sparkSession.read.parquet(path).groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
        return {n: {"size": sizes.get(n, 0), "table": path} for n in columns}


def dense_codes(df, columns=None):
    """Codes of the values present in this very frame; a missing value is -1."""
    return CategoryCoder(columns=columns, missing=None).fit(df).transform(df)


# --------------------------------------------------------------------------- scaling


class ScalerModel(_Learned):
    def _transform(self, df):
        new = {
            n: (c(n).cast("double") - F.lit(s["center"])) / F.lit(s["scale"])
            for n, s in self.learned.items()
            if n in df.columns and s["center"] is not None
        }
        return df.withColumns(new) if new else df


class Scaler(_Stage):
    """``standard`` (population deviation), ``minmax`` or ``robust`` (median and quartile range)."""

    DEFAULTS = {"kind": "standard", "columns": None, "skip": []}
    MODEL = ScalerModel

    def _learn(self, df):
        columns = self._numeric(df)
        if not columns:
            return {}
        kind = self.option("kind")
        if kind == "robust":
            found = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
            pairs = {n: (q[0.5], None if q[0.5] is None else q[0.75] - q[0.25]) for n, q in found.items()}
        else:
            low, spread = (F.min, lambda x: F.max(x) - F.min(x)) if kind == "minmax" else (F.avg, F.stddev_pop)
            row = df.agg(
                *[low(c(n).cast("double")).alias(f"a{i}") for i, n in enumerate(columns)],
                *[spread(c(n).cast("double")).alias(f"b{i}") for i, n in enumerate(columns)],
                *[F.min(c(n).cast("double")).alias(f"lo{i}") for i, n in enumerate(columns)],
                *[F.max(c(n).cast("double")).alias(f"hi{i}") for i, n in enumerate(columns)],
            ).first()
            # merged partial means and deviations of equal values may be a little off: the range tells a constant column
            pairs = {n: (row[f"lo{i}"], 0.0) if row[f"lo{i}"] == row[f"hi{i}"] else (row[f"a{i}"], row[f"b{i}"]) for i, n in enumerate(columns)}
        return {n: {"center": a, "scale": b or 1.0} for n, (a, b) in pairs.items()}


# --------------------------------------------------------------------------- selection


def _class_facts(df, columns, label):
    """Per class and feature: count, mean, variance and range; one pass, one line per class."""
    rows = (
        df.groupBy(c(label).alias("_class"))
        .agg(
            *[F.count(c(n)).alias(f"n{i}") for i, n in enumerate(columns)],
            *[F.avg(c(n).cast("double")).alias(f"m{i}") for i, n in enumerate(columns)],
            *[F.var_pop(c(n).cast("double")).alias(f"v{i}") for i, n in enumerate(columns)],
            *[F.min(c(n)).alias(f"lo{i}") for i, n in enumerate(columns)],
            *[F.max(c(n)).alias(f"hi{i}") for i, n in enumerate(columns)],
        )
        .limit(MAX_CLASSES + 1)
        .collect()
    )
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"'{label}' has more than {MAX_CLASSES} classes")
    return rows


def _constant(rows, i):
    edges = {r[k] for r in rows for k in (f"lo{i}", f"hi{i}") if r[f"n{i}"]}
    return len(edges) <= 1


def anova_scores(df, columns, label):
    """F statistic of each feature between the classes: ``{feature: F or None}``, one pass."""
    return _anova(_class_facts(df, columns, label), columns)


def _anova(rows, columns):
    rows = [r for r in rows if r["_class"] is not None]
    scores = {}
    for i, n in enumerate(columns):
        groups = [(r[f"n{i}"], r[f"m{i}"], r[f"v{i}"]) for r in rows if r[f"n{i}"]]
        total = sum(g[0] for g in groups)
        if len(groups) < 2 or total <= len(groups):
            scores[n] = None
            continue
        mean = sum(g[0] * g[1] for g in groups) / total
        between = sum(g[0] * (g[1] - mean) ** 2 for g in groups) / (len(groups) - 1)
        within = sum(g[0] * g[2] for g in groups) / (total - len(groups))
        scores[n] = between / within if within else (float("inf") if between else None)
    return scores


def information_scores(df, columns, label, bins=10):
    """Mutual information (nats) between each feature, cut into equal-width bins, and the label."""
    edges = df.agg(
        *[F.min(c(n).cast("double")).alias(f"a{i}") for i, n in enumerate(columns)],
        *[F.max(c(n).cast("double")).alias(f"b{i}") for i, n in enumerate(columns)],
    ).first()
    binned = []
    for i, n in enumerate(columns):
        low, high = edges[f"a{i}"], edges[f"b{i}"]
        x = c(n).cast("double")
        if low is None or low == high:
            cell = F.when(x.isNotNull(), F.lit(0))
        else:
            at = F.floor((x - low) / ((high - low) / bins)).cast("int")
            cell = F.when(at.isNotNull(), F.least(at, F.lit(bins - 1)))
        binned.append(cell.alias(n))
    cells = (
        melt(df.select(*binned, c(label).alias("_label")), columns, "int", keep=["_label"])
        .where("value is not null and _label is not null")
        .groupBy("feature", "value", "_label")
        .count()
        .limit(len(columns) * bins * MAX_CLASSES + 1)
        .collect()  # columns x bins x classes lines
    )
    if len({r["_label"] for r in cells}) > MAX_CLASSES:
        raise ValueError(f"'{label}' has more than {MAX_CLASSES} classes")
    scores = {}
    for n in columns:
        mine = [(r["value"], r["_label"], r["count"]) for r in cells if r["feature"] == n]
        total = sum(k for *_, k in mine)
        by_bin, by_label = {}, {}
        for b, y, k in mine:
            by_bin[b] = by_bin.get(b, 0) + k
            by_label[y] = by_label.get(y, 0) + k
        scores[n] = sum(k / total * math.log(k * total / (by_bin[b] * by_label[y])) for b, y, k in mine)
    return scores


class FeaturePickerModel(_Learned):
    def _transform(self, df):
        keep = [n for n in [*self.option("keep"), self.option("label")] if n in df.columns]
        return df.select(
            *[c(n) for n in keep],
            *[c(n) if n in df.columns else F.lit(0).alias(n) for n in self.learned["selected"] if n not in keep],
        )


class FeaturePicker(_Stage):
    """Drop constant features, then keep the ``k`` best by ``anova`` or ``information`` in table order."""

    DEFAULTS = {"label": "Churn", "k": 15, "method": "anova", "keep": []}
    MODEL = FeaturePickerModel

    def _learn(self, df):
        label = self.option("label")
        outside = {label, *self.option("keep")}
        features = [n for n in df.columns if n not in outside]
        if label in df.columns:
            rows = _class_facts(df, features, label)
            constant = {n for i, n in enumerate(features) if _constant(rows, i)}
            scores = {n: v for n, v in _anova(rows, features).items() if n not in constant}
        else:
            constant, scores = set(constant_columns(df, features)), None
        features = [n for n in features if n not in constant]
        k = self.option("k")
        if k is None or k >= len(features) or not self.option("method") or scores is None:
            return {"selected": features, "constant": sorted(constant)}
        if self.option("method") != "anova":
            scores = information_scores(df, features, label)
        # ties go to the later column, and an undefined score ranks last
        order = sorted(
            range(len(features)),
            key=lambda i: (scores[features[i]] is not None, scores[features[i]] or 0.0, i),
        )
        chosen = {features[i] for i in order[-k:]}
        return {"selected": [n for n in features if n in chosen], "constant": sorted(constant)}


# --------------------------------------------------------------------------- the chain

# a struct column of this name passes through the chain untouched
SOURCE = "_source"

# Default settings of the preparation chain.
PREPARATION = {
    "numeric_fill": "median",
    "categorical_fill": "mode",
    "create_features": True,
    "outlier_method": "iqr",
    "outlier_threshold": 1.5,
    "scaler": "standard",
    "feature_selection": "anova",
    "n_top_features": 15,
}


def preparation(label="Churn", id_cols=("CustomerID",), **settings):
    """fill -> features -> outliers -> codes -> scale -> select, as one ``Pipeline``.

    The scaler covers the numbers present before the categories become codes, so it runs first.
    """
    s = {**PREPARATION, **settings}
    skip = [label, *id_cols]
    stages = [MissingFiller(numeric=s["numeric_fill"], categorical=s["categorical_fill"], skip=skip)]
    if s["create_features"]:
        stages.append(FeatureBuilder())
    stages += [
        OutlierLimiter(method=s["outlier_method"], threshold=s["outlier_threshold"], skip=skip),
        Scaler(kind=s["scaler"], skip=skip),
        CategoryCoder(skip=skip),
        FeaturePicker(label=label, k=s["n_top_features"], method=s["feature_selection"], keep=[*id_cols, SOURCE]),
    ]
    return Pipeline(stages=stages)
