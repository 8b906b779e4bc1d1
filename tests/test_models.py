"""Metrics, models, search, explanations, logs and whole flows."""
import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tallyforge.operators import explain, flows, metrics, models, monitor, tuning, versions

COLUMNS = ["Tenure", "CityTier", "WarehouseToHome", "CouponUsed", "OrderCount", "DaySinceLastOrder"]


# ------------------------------------------------------------------ metrics


def _scored(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int, score double")


def test_no_positive_prediction_gives_zero(spark):
    r = metrics.classification_metrics(_scored(spark, [(1, 0, 0.1), (0, 0, 0.2)])).first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (0.5, 0.0, 0.0, 0.0)


def test_auc_by_pairs_and_monotone(spark):
    r = np.random.default_rng(2)
    y, s = r.integers(0, 2, 300), r.integers(0, 40, 300) / 40
    df = _scored(spark, [(int(a), 0, float(b)) for a, b in zip(y, s)])
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert metrics.roc_auc(df).first()[0] == pytest.approx(want)
    assert metrics.roc_auc(df.withColumn("score", F.exp(3 * F.col("score")))).first()[0] == pytest.approx(want)


def test_no_scores_no_auc(spark):
    df = _scored(spark, [(1, 1, 0.9), (0, 0, 0.2)])
    assert "roc_auc" not in metrics.evaluate(df.drop("score")).columns
    assert metrics.evaluate(df).first()["roc_auc"] == 1.0
    assert metrics.roc_auc(df.where("label = 1")).first()[0] is None


def test_confusion_is_filled(spark):
    rows = metrics.confusion(_scored(spark, [(1, 1, 0.9)])).collect()
    assert sum(r["n"] for r in rows) == 1 and len(rows) == 4


# ------------------------------------------------------------------ models


@pytest.mark.parametrize("name", ["logistic_regression", "svm", "decision_tree", "random_forest", "xgboost", "adaboost"])
def test_each_model_learns_saves_and_loads(spark, raw, tmp_path, name):
    params = {"xgboost": {"n_estimators": 3, "max_depth": 3}, "random_forest": {"n_estimators": 5}, "adaboost": {"n_estimators": 3},
              "svm": {"kernel": "rbf", "max_iter": 10}}.get(name)
    scaled = raw.withColumns({n: F.col(n) / 20.0 for n in COLUMNS})
    model = models.train(scaled, name, COLUMNS, "Churn", params)
    found = models.evaluate_model(model, scaled, "Churn")
    assert found["roc_auc"] > 0.6 and all(0 <= v <= 1 for v in found.values())
    again = models.load_model(models.save_model(model, str(tmp_path / name)))
    a, b = (models.predict(m, scaled).orderBy("CustomerID").select("prediction", "score").collect() for m in (model, again))
    assert a == b
    importance = models.feature_importance(spark, model, COLUMNS)
    assert (importance is None) == (name in ("logistic_regression", "svm"))
    if importance is not None and name != "adaboost":
        assert importance.first()["feature"] == "OrderCount"


def test_unknown_model(raw):
    with pytest.raises(ValueError, match="Unknown model"):
        models.train(raw, "oracle", COLUMNS, "Churn")


def test_boosting_by_hand(spark):
    # one feature, classes 0 0 1 1 0: the first stump cuts between 2 and 3 and misses the last row
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0), (3.0, 1.0), (4.0, 1.0), (5.0, 0.0)], "x double, label double")
    ready = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    stumps = models.BoostedStumps(n_estimators=1).fit(ready).getOrDefault("stumps")
    assert stumps[0]["weight"] == pytest.approx(math.log(0.8 / 0.2)) and 2 < stumps[0]["threshold"] < 3
    out = models.BoostedStumps(n_estimators=3).fit(ready).transform(ready)
    assert [r["prediction"] for r in out.orderBy("x").collect()][:4] == [0.0, 0.0, 1.0, 1.0]


def test_boosting_stops_at_a_perfect_stump(spark):
    df = spark.createDataFrame([(float(i), float(i > 5)) for i in range(10)], "x double, label double")
    ready = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    assert [s["weight"] for s in models.BoostedStumps(n_estimators=9).fit(ready).getOrDefault("stumps")] == [1.0]


def test_failed_models_are_left_out(raw):
    fitted, found = models.train_all(raw, raw, COLUMNS, "Churn", ["decision_tree", "oracle"])
    assert list(fitted) == list(found) == ["decision_tree"]
    with pytest.raises(ValueError):
        models.train_all(raw, raw, COLUMNS, "Churn", [])


@pytest.mark.parametrize("step", ["_fit_named", "evaluate_model"])
def test_a_failed_model_fails_the_query(spark, monkeypatch, step):
    """A model that can't be trained or evaluated is no shorter table; its name and the reason are told."""
    from tallyforge.catalog import modelling

    columns = ", ".join(f"{n} double" for n in modelling.COLUMNS)
    rows = spark.createDataFrame([(i, i % 2, *[float((i + j) % 5) for j in range(8)]) for i in range(40)], f"{modelling.KEY} bigint, {modelling.LABEL} int, {columns}")
    monkeypatch.setattr(modelling, "parts", lambda *_: (rows, rows))
    plain, calls = getattr(models, step), []

    def first_fails(*args):
        calls.append(1)
        if len(calls) == 1:
            raise ArithmeticError("no convergence")
        return plain(*args)

    monkeypatch.setattr(models, step, first_fails)
    with pytest.raises(RuntimeError, match="logistic_regression failed: no convergence"):
        modelling.i10(spark, None)


@pytest.mark.parametrize("values", [{"a": {"f1": 0.5}, "b": {"f1": 0.5}, "c": {}}, {"a": {}, "b": {"f1": 0.0}}])
def test_best_model_first_wins(spark, values):
    assert metrics.best_model(models.metrics_table(spark, values)).first()["model"] == "a"


def test_rebalanced_fit_scores_plain_rows(raw):
    model = models.train(raw, "decision_tree", COLUMNS, "Churn", {"max_depth": 3}, sampler="smote_tomek", key="CustomerID")
    assert models.predict(model, raw).count() == 100


def test_draws_are_distinct_and_repeatable():
    grid = {"a": [1, 2, 3], "b": [1, 2]}
    assert len(tuning.draws(grid, 20)) == 6
    some = tuning.draws(grid, 4)
    assert some == tuning.draws(grid, 4) and len({tuple(d.items()) for d in some}) == 4


def test_search_returns_model_and_params(raw):
    grid = {"max_depth": [1, 4]}
    model, params, scores = tuning.optimise(raw, "decision_tree", COLUMNS, "Churn", "CustomerID", grid, method="grid", folds=2)
    assert params in [{"max_depth": 1}, {"max_depth": 4}] and len(scores) == 2
    assert max(s for _, s in scores) == dict((str(p), s) for p, s in scores)[str(params)]
    assert models.predict(model, raw).count() == 100
    assert tuning.optimise(raw, "decision_tree", COLUMNS, "Churn", "CustomerID", {})[1] == {}


# ------------------------------------------------------------------ explanations


def test_sampled_values_of_a_linear_score(spark, raw):
    weights = {"Tenure": 0.5, "CityTier": -2.0, "CouponUsed": 1.0}
    cols = list(weights)
    df = raw.select("CustomerID", *[F.col(n).cast("double").alias(n) for n in cols])
    linear = lambda f: f.withColumn("score", sum(F.lit(w) * F.col(n) for n, w in weights.items()))
    one = df.limit(1).select(*cols)
    got = explain.sampled_shapley(df, linear, cols, one, "CustomerID", permutations=3).toPandas()
    # with a single background row a linear score is explained without sampling error
    base = one.first()
    truth = df.toPandas().set_index("CustomerID")
    for r in got.itertuples():
        assert r.value == pytest.approx(weights[r.feature] * (truth.loc[r.CustomerID, r.feature] - base[r.feature]))


def test_sampled_values_add_up(spark, raw):
    df = raw.select("CustomerID", "Churn", *[F.col(n).cast("double").alias(n) for n in COLUMNS])
    model = models.train(df, "decision_tree", COLUMNS, "Churn", {"max_depth": 4})
    one = df.limit(1)
    score = lambda f: models.predict(model, f)
    got = explain.sampled_shapley(df, score, COLUMNS, one, "CustomerID", permutations=2).groupBy("CustomerID").agg(F.sum("value").alias("total"))
    base = score(one).first()["score"]
    both = score(df).join(got, "CustomerID").withColumn("gap", F.abs(F.col("score") - base - F.col("total")))
    assert both.agg(F.max("gap")).first()[0] < 1e-9


# ------------------------------------------------------------------ logs


def test_alert_id_of_a_known_alert(spark):
    row = [(dt.datetime(2025, 12, 11), "prediction", "data_drift", "CRITICAL", "Drift severity=CRITICAL; drifted_features=0")]
    df = spark.createDataFrame(row, "timestamp timestamp, model_name string, alert_type string, severity string, message string")
    assert monitor.with_alert_id(df).first()["alert_id"] == "0f8f1bd210143bbeb2cba124bd117474"


def test_monitor_store(spark, raw, tmp_path):
    store = monitor.MonitorStore(spark, str(tmp_path))
    at = dt.datetime(2025, 1, 1)
    model = models.train(raw, "decision_tree", COLUMNS, "Churn", {"max_depth": 2})
    store.register_model("tree", model, {"f1": 0.5}, now=at)
    path = store.register_model("tree", model, {"f1": 0.4, "roc_auc": None}, now=at + dt.timedelta(days=1))
    assert [r["version"] for r in store.registry.orderBy("version").collect()] == [1, 2]
    assert monitor.newest_model(store.registry).first()["path"] == path
    assert monitor.best_models(store.registry).first()["version"] == 1
    assert monitor.newest_model(store.registry.limit(0)).first() is None

    run = store.start_run("r1", at)
    assert monitor.run_states(store.runs).first()["status"] == "RUNNING"
    store.log_values(run, "metrics", {"f1": 0.1, "acc": 1}, at)
    store.log_values(run, "metrics", {"f1": 0.2}, at + dt.timedelta(seconds=1))
    store.end_run(run, now=at + dt.timedelta(seconds=90))
    state = monitor.run_states(store.runs).first()
    assert (state["status"], state["duration_seconds"]) == ("FINISHED", 90.0)
    assert store.run_info(run) == {"metrics": {"f1": "0.2", "acc": "1"}}

    store.log_performance("tree", {"f1": 0.9}, now=at)
    assert monitor.performance_drift(store.history("tree")).first()["message"] == "fewer than two values"
    store.log_performance("tree", {"f1": 0.8}, now=at + dt.timedelta(days=1))
    found = monitor.performance_drift(store.history("tree")).first()
    assert found["drift_detected"] and found["drift"] == pytest.approx(0.1)
    assert monitor.performance_drift(store.history("tree"), "recall").first()["message"] == "a value is missing"

    assert store.create_alert("tree", "drift", "m") and not store.create_alert("tree", "drift", "m")
    assert store.create_alert("tree", "drift", "other") and store.alerts.count() == 2


def test_health_reports_the_worst_level(spark, tmp_path):
    store = monitor.MonitorStore(spark, str(tmp_path))
    schema = "model_name string, f1 double, accuracy double, roc_auc double"
    now = spark.createDataFrame([("a", 0.60, 0.74, 0.80), ("b", 0.90, 0.90, 0.90)], schema)
    base = spark.createDataFrame([("a", 0.80, 0.86, 0.80), ("b", 0.90, 0.90, 0.90)], schema)
    status, findings = store.check_health(now, base)
    assert {r["model_name"]: (r["status"], r["issues"]) for r in status.collect()} == {"a": ("CRITICAL", 4), "b": ("HEALTHY", 0)}
    assert store.alerts.count() == 2
    assert {r["level"] for r in findings.where("kind = 'minimum'").collect()} == {"WARNING"}


def test_fingerprint_sees_content_only(spark, raw):
    a = versions.fingerprint(raw)
    assert a == versions.fingerprint(raw.repartition(7).orderBy(F.col("Tenure").desc()))
    assert a != versions.fingerprint(raw.withColumn("Tenure", F.when(F.col("CustomerID") == 5, 0).otherwise(F.col("Tenure"))))
    assert a != versions.fingerprint(raw.unionAll(raw)) and a != versions.fingerprint(raw.withColumnRenamed("Tenure", "T"))


def test_version_store(spark, raw, tmp_path):
    store = versions.VersionStore(spark, str(tmp_path))
    first = store.create("raw", raw, "p", tags=["x"])
    assert store.create("raw", raw.repartition(3), "p") == first
    second = store.create("raw", raw.limit(50), "p")
    assert second != first and store.versions.count() == 2
    info = versions.version_info(store.versions, "raw").first()
    assert (info["version"], info["rows"], info["columns"]) == (2, 50, len(raw.columns))
    assert versions.version_info(store.versions, "none").first() is None
    pair = spark.createDataFrame([("raw", first, second), ("raw", first, "zz")], "dataset string, v1 string, v2 string")
    got = {r["v2"]: (r["changed"], r["rows_diff"], r["error"]) for r in versions.compare_versions(store.versions, pair).collect()}
    assert got == {second: (True, -50, None), "zz": (None, None, "version not found")}
    store.create("clean", raw, "p")
    store.add_lineage("clean", "raw", "cleaning")
    store.add_lineage("raw", "clean", "loop")
    store.add_lineage("unknown", "raw")
    assert [(r["parent"], r["transformation"]) for r in store.lineage_of("clean").collect()] == [("raw", "cleaning")]


# ------------------------------------------------------------------ flows


def test_whole_flow(spark, raw_missing, tmp_path):
    path = str(tmp_path / "customers.parquet")
    raw_missing.write.parquet(path)
    work = flows.Flows(spark, str(tmp_path / "work"), models={"decision_tree": {"max_depth": 4}}, sampler="smote", explain_rows=5)
    summary = work.run("eda", raw_path=path)
    assert summary["n_rows"] == 100 and summary["top_correlated"][0] == "OrderCount"
    paths = work.run("preprocess", raw_path=path)
    assert spark.read.parquet(paths["train"]).count() == 80
    best, values = work.run("train", name="decision_tree")
    assert best == "decision_tree" and 0 <= values[best]["f1"] <= 1
    assert [r["parent"] for r in work.versions.lineage_of("train_data").orderBy("depth").collect()] == ["cleaned_data", "raw_data"]

    out = work.run("predict", input_path=path)
    result = spark.read.csv(out, header=True)
    assert result.columns[-1] == "prediction" and result.count() == 100 and "Tenure" in result.columns

    broken = str(tmp_path / "broken.parquet")
    raw_missing.drop("Tenure").write.parquet(broken)
    assert work.run("predict", input_path=broken, output_path=str(tmp_path / "none.csv")) is None
    assert work.monitor.alerts.where("severity = 'CRITICAL'").count() == 1
    with pytest.raises(ValueError, match="Unknown mode"):
        work.run("dance")
    with pytest.raises(FileNotFoundError):
        work.run("preprocess", raw_path=str(tmp_path / "absent.parquet"))
    assert {r["status"] for r in monitor.run_states(work.monitor.runs).collect()} == {"FINISHED", "FAILED"}


def test_rows_are_rebalanced_once_for_each_fold(raw, monkeypatch):
    from tallyforge.operators import rebalance

    calls = []

    def counted(df, *args, **kwargs):
        calls.append(1)
        return rebalance.oversample(df, *args, **kwargs)

    monkeypatch.setitem(rebalance.SAMPLERS, "smote", counted)
    _, best, scores = tuning.optimise(raw, "decision_tree", COLUMNS, "Churn", "CustomerID", {"max_depth": [2, 3], "min_samples_leaf": [1, 4]}, "smote", method="grid", folds=3)
    assert len(scores) == 4 and best in [p for p, _ in scores]
    assert len(calls) == 3 + 1  # the folds, and the fit on all rows


def test_unknown_settings_are_refused(raw):
    with pytest.raises(ValueError, match="unknown settings"):
        models.train(raw, "decision_tree", COLUMNS, "Churn", {"min_samples_split": 2})


def test_fourier_map_needs_one_working_array():
    """A batch costs its answer and little more, and travels without the package."""
    import tracemalloc

    import pyarrow as pa
    from pyspark import cloudpickle

    r = np.random.default_rng(1)
    x, weights, shift = r.normal(size=(10_000, 8)), r.normal(size=(8, 200)), r.uniform(0, 6, 200)
    batch = pa.array(x.tolist(), pa.list_(pa.float64()))
    tracemalloc.start()
    got = models._fourier(batch, weights, shift, 0.1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.2 * 8 * 10_000 * 200
    assert np.allclose(np.array(got[:50].to_pylist()), 0.1 * np.cos(x[:50] @ weights + shift), atol=1e-14)
    assert len(models._fourier(batch[:0], weights, shift, 0.1)) == 0
    assert b"operators.models\x94\x8c\x08_fourier" not in cloudpickle.dumps(models._fourier)
