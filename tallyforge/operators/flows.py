"""Whole flows over one folder: explore, prepare, train, chart tables, score."""
from __future__ import annotations

import logging
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..functions.columns import c, numeric_columns, string_columns
from ..sources.io import exists, latest_pair, read_table, write_table
from . import clean as cleaning
from . import drift, explain, explore, metrics, models, monitor, rules, split, transforms, tuning, versions

log = logging.getLogger(__name__)

# Default settings of the flows.
SETTINGS = {
    "target": "Churn",
    "key": "CustomerID",
    "test_size": 0.2,
    "seed": 42,
    "preparation": {},
    "remove_duplicates": True,
    "fail_on_violation": False,
    "persist_rules": True,
    "models": {},
    "sampler": "smote_tomek",
    "search": {},
    "scoring": "f1",
    "minimum": {"f1": 0.70, "accuracy": 0.75},
    "drift_max": 0.10,
    "drift_threshold": 0.05,
    "drift_sample": 1.0,
    "drift_max_rows": None,
    "abort_on_critical": True,
    "explain_rows": 100,
    "quick_model": "xgboost",
}


class DriftError(RuntimeError):
    """Scoring was stopped by critical drift."""


class Flows:
    """Flows that share one folder: cleaned and split tables, fitted stages, logs, chart tables."""

    def __init__(self, spark, folder, **settings):
        unknown = set(settings) - set(SETTINGS)
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        self.spark, self.folder = spark, folder.rstrip("/")
        self.s = {**SETTINGS, **settings}
        self.monitor = monitor.MonitorStore(spark, f"{self.folder}/monitoring")
        self.versions = versions.VersionStore(spark, f"{self.folder}/versions")

    def _at(self, *parts):
        return "/".join([self.folder, *parts])

    def _write(self, df, *parts):
        """Write and read back: later steps start from the stored table."""
        path = write_table(df, self._at(*parts))
        return path, read_table(self.spark, path)

    # ------------------------------------------------------------------ explore

    def eda(self, raw_path, run_id="eda"):
        """Write the tables behind the exploratory charts of the raw, uncleaned data."""
        df, y = read_table(self.spark, raw_path), self.s["target"]
        numbers = [n for n in numeric_columns(df) if n != y]
        tables = {"summary": explore.dataset_summary(df, y), "missing": explore.missing_by_column(df)}
        if y in df.columns:
            tables["target"] = explore.target_distribution(df, y)
            tables["target_correlations"] = explore.target_correlations(df, y, 15, numbers)
            tables["rate_by_category"] = explore.target_rate_by_category(df, y)
            tables["target_by_value"] = explore.target_by_value(df, y)
        if numbers:
            tables["histogram"] = explore.histogram(df, numbers)
            tables["box"] = explore.box_statistics(df, numbers)
            tables["correlations"] = explore.correlations(df, numeric_columns(df))
            tables["describe"] = explore.describe_numeric(df, numbers)
        if string_columns(df):
            tables["value_counts"] = explore.value_counts(df)
        for name, frame in tables.items():
            self._write(frame, "runs", run_id, f"{name}.parquet")
        summary = tables["summary"].first().asDict()
        top = read_table(self.spark, self._at("runs", run_id, "target_correlations.parquet")) if y in df.columns else None
        summary["top_correlated"] = [r["feature"] for r in top.orderBy(F.desc(F.abs("correlation")), "feature").limit(3).collect()] if top else []
        return summary

    # ------------------------------------------------------------------ prepare

    def preprocess(self, raw_path):
        """Clean, check, split, fit on train, apply to both; returns the paths."""
        s, y = self.s, self.s["target"]
        name = raw_path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
        raw = read_table(self.spark, raw_path)
        self.versions.create("raw_data", raw, raw_path)
        cleaned_path, cleaned = self._write(cleaning.clean(raw, remove_duplicates=s["remove_duplicates"]), "processed", f"{name}_cleaned.parquet")
        report = rules.business_rules(cleaned, s["key"])
        rules.enforce(report, s["fail_on_violation"], self._at("processed", f"{name}_rules.json") if s["persist_rules"] else None)
        self.versions.create("cleaned_data", cleaned, cleaned_path)
        self.versions.add_lineage("cleaned_data", "raw_data", "cleaning")
        train, test = split.stratified_split(cleaned, y, s["key"], s["test_size"], s["seed"])
        # the split is stored once: every stage of the chain reads it
        _, train = self._write(train, "processed", f"{name}_train_rows.parquet")
        chain = transforms.preparation(label=y, id_cols=(s["key"],), **s["preparation"]).fit(train)
        chain.write().overwrite().save(self._at("registry", "preparation"))
        paths = {}
        for part, frame in (("train", train), ("test", test)):
            path, ready = self._write(chain.transform(frame), "train_test", f"{name}_{part}.parquet")
            self.versions.create(f"{part}_data", ready, path)
            self.versions.add_lineage(f"{part}_data", "cleaned_data", "feature_engineering")
            paths[part] = path
        self._write(rules.quality(cleaned), "processed", f"{name}_quality.parquet")
        self.spark.createDataFrame([(cleaned_path,)], "path string").write.mode("overwrite").json(self._at("registry", "reference"))
        return {**paths, "cleaned": cleaned_path}

    # ------------------------------------------------------------------ train

    def _parts(self):
        train_path, test_path = latest_pair(self.spark, self._at("train_test"))
        train, test = read_table(self.spark, train_path), read_table(self.spark, test_path)
        columns = [n for n in numeric_columns(train) if n not in (self.s["target"], self.s["key"])]
        return train, test, columns

    def train(self, name=None, optimise=False, run_id="train"):
        """Train one model, or all; register and log the best one and check its health."""
        s, y, key = self.s, self.s["target"], self.s["key"]
        train, test, columns = self._parts()
        search = None
        if optimise:
            def search(frame, model):
                model_, params, _ = tuning.optimise(frame, model, columns, y, key, sampler=s["sampler"], scoring=s["scoring"], **s["search"])
                return model_, params
        fitted, values = models.train_all(
            train, test, columns, y, [name] if name else None, s["models"], search, s["sampler"], key, s["seed"]
        )
        if not values:
            raise RuntimeError("no model could be trained")
        best = metrics.best_model(models.metrics_table(self.spark, values), s["scoring"]).first()["model"]
        baseline = monitor.first_logged(self.monitor.history(best))
        self.monitor.register_model(best, fitted[best], values[best], run_id)
        table = models.metrics_table(self.spark, {best: values[best]}).withColumnRenamed("model", "model_name")
        self.monitor.check_health(table, baseline, s["minimum"], s["drift_max"])
        # logged last: the first line of the log is what later trainings are compared with
        self.monitor.log_performance(best, values[best], n_samples=test.count())
        self.monitor.log_values(run_id, "metrics", values[best])
        self.chart_tables(fitted, values, best, run_id)
        return best, values

    def chart_tables(self, fitted, values, best, run_id):
        """Write the tables behind the evaluation charts."""
        train, test, columns = self._parts()
        y, key = self.s["target"], self.s["key"]
        both = models.scored(fitted[best], test, y)
        tables = {
            "metrics": models.metrics_table(self.spark, values),
            "comparison": metrics.comparison(models.metrics_table(self.spark, values)),
            "confusion": metrics.confusion(both), "roc": metrics.roc_points(both),
            "precision_recall": metrics.precision_recall_points(both), "class_report": metrics.class_report(both),
        }
        importance = models.feature_importance(self.spark, fitted[best], columns)
        if importance is not None:
            tables["importance"] = importance
        sample = split.first_rows(test, self.s["explain_rows"], key)
        shares = explain.sampled_shapley(sample, lambda f: models.predict(fitted[best], f), columns, train, key)
        tables["explanations"] = shares
        for name, frame in tables.items():
            self._write(frame, "runs", run_id, f"{name}.parquet")

    def visualize(self, name=None, run_id="visualize"):
        """Chart tables of one model trained without a search."""
        train, test, columns = self._parts()
        name = name or self.s["quick_model"]
        fitted, values = models.train_all(train, test, columns, self.s["target"], [name], self.s["models"], None, self.s["sampler"], self.s["key"], self.s["seed"])
        if not values:
            raise RuntimeError(f"{name} could not be trained")
        self.chart_tables(fitted, values, name, run_id)
        return values

    # ------------------------------------------------------------------ score

    def drift_gate(self, df, model_name="prediction"):
        """Compare with the cleaned training data; raises ``DriftError`` on critical drift if so set."""
        s = self.s
        marker = self._at("registry", "reference")
        if not exists(self.spark, marker):
            raise FileNotFoundError("no cleaned training data to compare with")
        reference = read_table(self.spark, self.spark.read.json(marker).first()["path"])
        report = drift.detect_drift(
            cleaning.numbers_for_drift(reference), cleaning.numbers_for_drift(df), s["drift_threshold"],
            s["drift_sample"], s["drift_max_rows"], s["key"], ignore=(s["target"], s["key"]),
        )
        if report.severity != "NONE":
            message = f"Drift severity={report.severity}; drifted_features={report.drifted}"
            self.monitor.create_alert(model_name, "data_drift", message, report.severity)
        if report.severity == "CRITICAL" and s["abort_on_critical"]:
            raise DriftError(message)
        return report

    def predict(self, input_path, output_path, model_path=None, run_id=None):
        """Score new data and write the cleaned rows with ``prediction``; None when the gate closes."""
        run_id = run_id or f"predict_{uuid.uuid4().hex}"
        if model_path is None:
            newest = monitor.newest_model(self.monitor.registry).first()
            if newest is None:
                raise FileNotFoundError("no model in the registry")
            model_path = newest["path"]
        _, df = self._write(cleaning.clean(read_table(self.spark, input_path), remove_duplicates=self.s["remove_duplicates"]), "processed", f"{run_id}_input.parquet")
        if not rules.passed(rules.business_rules(df, self.s["key"])):
            log.warning("business rules are violated")
        try:
            self.drift_gate(df)
        except DriftError as e:
            log.error("scoring stopped: %s", e)
            return None
        chain = PipelineModel.load(self._at("registry", "preparation"))
        return write_table(score(df, chain, models.load_model(model_path)), output_path)

    # ------------------------------------------------------------------ by name

    def run(self, mode, raw_path=None, name=None, optimise=False, input_path=None, output_path=None):
        """Run a flow by name inside a run record that ends FINISHED or FAILED."""
        flows = {
            "eda": lambda run: self.eda(raw_path, run),
            "preprocess": lambda run: self.preprocess(raw_path),
            "train": lambda run: self.train(name, optimise, run),
            "visualize": lambda run: self.visualize(name, run),
            "predict": lambda run: self.predict(input_path, output_path or self._at("predictions", "predicted.csv"), None, run),
            "full": lambda run: self._full(raw_path, name, optimise, run),
        }
        if mode not in flows:
            raise ValueError(f"Unknown mode: {mode}")
        run_id = self.monitor.start_run()
        run_id_mode = f"{run_id}_{mode}"
        try:
            result = flows[mode](run_id_mode)
        except Exception:
            self.monitor.end_run(run_id, "FAILED")
            raise
        self.monitor.end_run(run_id)
        return result

    def _full(self, raw_path, name, optimise, run_id):
        summary = self.eda(raw_path, run_id)
        self.preprocess(raw_path)
        best, values = self.train(name, optimise, run_id)
        return {"summary": summary, "best": best, "metrics": values}


def score(df, chain, model):
    """Rows of ``df`` plus ``prediction``, in one plan: the source row rides along, so nothing is joined back."""
    source = transforms.SOURCE
    ready = chain.transform(df.withColumn(source, F.struct(*[c(n) for n in df.columns])))
    words = string_columns(ready)
    if words:
        # last resort: codes of the values of this input
        ready = transforms.dense_codes(ready, words)
    return models.predict(model, ready).select(f"{source}.*", "prediction")
