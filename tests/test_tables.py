"""Sources, cleaning, features, fitted transforms, rules, drift."""
import math
import shutil

import numpy as np
import pandas as pd

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tallyforge.operators import clean, drift, explore, features, monitor, rebalance, rules, transforms as t, versions
from tallyforge.sources import io


# ------------------------------------------------------------------ sources


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "a bigint, b bigint")
    for name in ("x.csv", "x.parquet", "x.json"):
        path = io.write_table(df, str(tmp_path / name))
        assert sorted(tuple(r) for r in io.read_table(spark, path, df.schema).select("a", "b").collect()) == [(1, 4), (2, 5), (3, 6)]


def test_bad_paths(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported"):
        io.read_table(spark, str(tmp_path / "x.xlsx"))
    with pytest.raises(FileNotFoundError):
        io.read_table(spark, str(tmp_path / "none.csv"))


def test_latest_pair(spark, tmp_path):
    for n in ("a_1_train", "a_1_test", "a_2_train", "a_2_test", "b_train", "b_test"):
        spark.range(1).write.parquet(str(tmp_path / f"{n}.parquet"))
    assert [p.rsplit("/", 1)[1] for p in io.latest_pair(spark, str(tmp_path))] == ["b_train.parquet", "b_test.parquet"]
    assert [p.rsplit("/", 1)[1] for p in io.latest_pair(spark, str(tmp_path), "raw/a_2.csv")] == ["a_2_train.parquet", "a_2_test.parquet"]
    with pytest.raises(FileNotFoundError):
        io.latest_pair(spark, str(tmp_path), "c.csv")
    with pytest.raises(FileNotFoundError):
        io.latest_pair(spark, str(tmp_path / "none"))


def test_periods_in_names(spark):
    names = ["d_2024_01.csv", "d_2024-03.csv", "d_202405.csv", "d_2024_Q3.csv", "d.csv", "d_2024_13.csv"]
    table = spark.createDataFrame([(n,) for n in names], "n string").select(io.period_of(F.col("n")).alias("p"))
    assert [r["p"] and (r["p"]["first"] - 2024 * 12, r["p"]["last"] - 2024 * 12) for r in table.collect()] == [(1, 1), (3, 3), (5, 5), (7, 9), None, None]
    assert io.names_in_period(spark, names, "2024-02", "2024-Q2") == ["d.csv", "d_2024-03.csv", "d_202405.csv", "d_2024_13.csv"]
    assert io.names_in_period(spark, names, "2024-Q3") == ["d.csv", "d_2024_13.csv", "d_2024_Q3.csv"]
    assert io.names_in_period(spark, names, None, "2024-Q1") == ["d.csv", "d_2024-03.csv", "d_2024_01.csv", "d_2024_13.csv"]


def test_other_files_in_a_folder_are_left(spark, tmp_path):
    for month in ("2024-01", "2024-02"):
        io.write_table(spark.range(3), str(tmp_path / f"t_{month}.parquet"))
    (tmp_path / "notes.txt").write_text("x")
    assert io.read_period(spark, str(tmp_path), "2024-02").count() == 3
    assert io.read_period(spark, str(tmp_path)).count() == 6


# ------------------------------------------------------------------ cleaning


def test_clean(spark):
    rows = [(1, "Phone", "CC", "[5E-1]", float("nan")), (1, "Phone", "CC", "[5E-1]", None), (2, "Computer", "Cash on Delivery", " (2) ", 1.0)]
    df = spark.createDataFrame(rows, "CustomerID int, PreferredLoginDevice string, PreferredPaymentMode string, n string, x double")
    out = clean.clean(df.withColumnRenamed("n", " n "))
    assert out.columns[3] == "n" and dict(out.dtypes)["n"] == "double"
    assert sorted(map(tuple, out.collect())) == [(1, "Mobile Phone", "Credit Card", 0.5, None), (2, "Computer", "COD", 2.0, 1.0)]
    assert clean.clean(df, remove_duplicates=False).count() == 3


def test_mixed_text_stays_text(spark):
    df = spark.createDataFrame([("[1.5]",), ("x",), ("nan",), (None,)], "v string")
    assert [r[0] for r in clean.coerce_numbers(df).collect()] == ["1.5", "x", "nan", None]
    assert [r[0] for r in clean.coerce_numbers_strict(df).collect()] == ["[1.5]", "x", "nan", None]


def test_projection_and_constants(spark):
    df = spark.createDataFrame([(1, 2.0, None, "a"), (1, None, None, "b")], "a int, b double, c string, d string")
    assert set(clean.constant_columns(df)) == {"a", "b", "c"}
    assert [tuple(r) for r in clean.project_features(df, ["d", "zz"]).collect()] == [("a", 0), ("b", 0)]
    with pytest.raises(KeyError):
        clean.split_target(df, "Churn")


def test_feature_edges(spark):
    df = spark.createDataFrame([(0, 10.0, None, -5.0), (None, 10.0, 2.0, 1.0)], "OrderCount int, CashbackAmount double, Tenure double, WarehouseToHome double")
    a, b = features.engineer(df).collect()
    assert a["avg_cashbk_per_order"] == 10.0 and b["avg_cashbk_per_order"] is None
    assert a["order_frequency_mpm"] is None and a["log_WarehouseToHome"] == 0.0
    safe = features.engineer_safe(df).collect()
    assert safe[0]["avg_cashbk_per_order"] == 10.0 and safe[1]["order_frequency_mpm"] == 0.0


# ------------------------------------------------------------------ fitted transforms


def test_chain_equals_itself_after_reload(spark, raw_missing, tmp_path):
    chain = t.preparation(n_top_features=8).fit(raw_missing)
    once = chain.transform(raw_missing).toPandas()
    chain.write().overwrite().save(str(tmp_path / "chain"))
    again = PipelineModel.load(str(tmp_path / "chain")).transform(raw_missing).toPandas()
    pd.testing.assert_frame_equal(once, again)
    assert list(once.columns[:2]) == ["CustomerID", "Churn"] and len(once.columns) == 10
    assert not once.isna().any().any()


def test_scaled_like_population_deviation(spark, raw, raw_pandas):
    out = t.Scaler(columns=["Tenure"]).fit(raw).transform(raw).toPandas()["Tenure"].to_numpy()
    x = raw_pandas["Tenure"].to_numpy()
    np.testing.assert_allclose(np.sort(out), np.sort((x - x.mean()) / x.std()), atol=1e-12)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    for kind in ("standard", "minmax", "robust"):
        assert [r[0] for r in t.Scaler(kind=kind).fit(df).transform(df).collect()] == [0.0, 0.0]


def test_constant_column_over_partitions(spark):
    """Partial deviations of equal values merge to a little more than 0, and partial means to a little less than the value."""
    cells = F.when(F.col("id") % 10 == 0, F.lit(0.1)).alias("x")
    df = spark.range(0, 11 * 10 * 8, 1, 8).select(cells)
    assert df.agg(F.stddev_samp("x")).first()[0] > 0
    out = t.OutlierLimiter(method="zscore", threshold=2.0).fit(df).transform(df)
    assert {r["x"] for r in out.distinct().collect()} == {0.1, None}
    assert {r["x"] for r in t.Scaler().fit(df).transform(df).distinct().collect()} == {0.0, None}


def test_unseen_and_missing_categories(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "v string")
    new = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    model = t.CategoryCoder().fit(train)
    assert sorted(r[0] for r in model.transform(new).collect()) == [-1, 0, 2]
    last = t.CategoryCoder(unseen="size").fit(train)
    assert sorted(r[0] for r in last.transform(new).collect()) == [0, 2, 3]
    assert sorted(r[0] for r in t.dense_codes(new, ["v"]).collect()) == [-1, 0, 1]


def test_ranked_labels_over_ranges(spark):
    words = [f"w{i:04d}" for i in range(500)]
    rows = [("a", w) for w in words] + [("b", w) for w in words[::3]] + [("c", "x")]
    got = {(r["feature"], r["label"]): r["code"] for r in t.ranked_labels(spark.createDataFrame(rows, "feature string, label string").repartition(8)).collect()}
    assert got == {("a", w): i for i, w in enumerate(words)} | {("b", w): i for i, w in enumerate(words[::3])} | {("c", "x"): 0}


def test_saved_codes_need_no_scratch_folder(spark, tmp_path):
    """A chain with 150 labels transforms after the folder it was fitted in is gone; its model folder holds the codes."""
    from pyspark.ml import Pipeline, PipelineModel

    train = spark.createDataFrame([(f"v{i:03d}", f"s{i % 3}") for i in range(150)], "v string, s string")
    fitted = Pipeline(stages=[t.CategoryCoder()]).fit(train)
    fitted.write().overwrite().save(str(tmp_path / "model"))
    shutil.move(fitted.stages[0].learned["v"]["table"], tmp_path / "gone")
    new = spark.createDataFrame([("v149", "s2"), ("v007", "s0"), ("none", "s9")], "v string, s string")
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert [tuple(r) for r in loaded.transform(new).collect()] == [(149, 2), (7, 0), (-1, -1)]
    loaded.write().overwrite().save(str(tmp_path / "copy"))
    assert PipelineModel.load(str(tmp_path / "copy")).transform(new).count() == 3


def test_outliers_use_train_bounds(spark):
    train = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    new = spark.createDataFrame([(1e6,), (-1e6,), (None,)], "x double")
    model = t.OutlierLimiter().fit(train)
    assert [r[0] for r in model.transform(new).collect()] == [150.0, -50.0, None]
    z = t.OutlierLimiter(method="zscore", threshold=1.0).fit(train)
    assert [r[0] for r in z.transform(spark.createDataFrame([(0.0,), (0.0,), (9.0,)], "x double")).collect()] == [0.0, 0.0, 3.0]


def test_most_frequent_value_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "v string")
    assert t.top_values(df, ["v"]) == {"v": "a"}


def test_selection_keeps_table_order_and_drops_constants(raw):
    model = t.FeaturePicker(k=3, keep=["CustomerID"]).fit(raw.select("CustomerID", "Tenure", "OrderCount", "CityTier", "CouponUsed", F.lit(1).alias("one"), "Churn"))
    assert "OrderCount" in model.learned["selected"] and model.learned["constant"] == ["one"]
    assert model.learned["selected"] == [n for n in ["Tenure", "OrderCount", "CityTier", "CouponUsed"] if n in model.learned["selected"]]


def test_anova_by_hand(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, 0), (4.0, 1), (5.0, 1), (6.0, 1)], "x double, y int")
    assert t.anova_scores(df, ["x"], "y")["x"] == pytest.approx(13.5)


# ------------------------------------------------------------------ rules


def test_empty_table_scores_one(spark):
    q = rules.quality(spark.createDataFrame([], "a int, b string")).first()
    assert (q["rows"], q["null_ratio"], q["duplicate_ratio"], q["quality_score"]) == (0, 0.0, 0.0, 1.0)


def test_every_rule_and_the_gate(spark, tmp_path):
    rows = [
        (1, -1.0, 5.0, 1, "a@b.co", "+1 234 5678"), (2, 3.0, -5.0, 1, "bad", "12"), (3, None, 5.0, 0, None, None),
        (None, 1.0, 1.0, 1, "a b@c.d", "0123456"), (3, 1.0, 1.0, None, "x@y.z", "(030) 123-45"),
    ]
    df = spark.createDataFrame(rows, "CustomerID int, Tenure double, CashbackAmount double, OrderCount int, Email string, Phone string")
    report = rules.business_rules(df)
    got = {r["rule"]: (r["count"], r["examples"], r["fails"]) for r in report.collect()}
    assert got == {
        "Tenure": (1, "1", True), "CashbackAmount": (1, "2", True), "OrderCount_for_Cashback": (2, "3,3", True),
        "Email": (2, "2", True), "Phone": (1, "2", True), "CustomerID_null": (1, "", True), "CustomerID_duplicates": (2, "3", False),
    }
    assert rules.enforce(report, path=str(tmp_path / "r.json")) is False
    assert io.read_table(spark, str(tmp_path / "r.json")).count() == 7
    with pytest.raises(ValueError):
        rules.enforce(report, fail_on_violation=True)
    fine = spark.createDataFrame([(1, 2.0), (1, 3.0)], "CustomerID int, Tenure double")
    assert rules.enforce(rules.business_rules(fine), fail_on_violation=True)


# ------------------------------------------------------------------ drift


def test_missing_column_is_critical(spark):
    ref = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "A bigint, B bigint")
    report = drift.detect_drift(ref, ref.select("A"))
    assert report.severity == "CRITICAL" and report.has_drift
    assert ("B", "missing_column") in {(r["feature"], r["statistic"]) for r in report.details.collect()}


def test_shift_is_found(spark):
    r = np.random.default_rng(0)
    a = spark.createDataFrame(pd.DataFrame({"x": r.normal(0, 1, 1000)}))
    b = spark.createDataFrame(pd.DataFrame({"x": r.normal(1, 1, 1000)}))
    report = drift.detect_drift(a, b, threshold=0.01)
    assert report.drifted == 1 and report.severity == "CRITICAL"
    same = drift.detect_drift(a, a)
    assert same.drifted == 0 and same.severity == "NONE" and not same.has_drift


def test_new_category_is_drift(spark):
    a = spark.createDataFrame([("a",)] * 80 + [("b",)] * 20, "v string")
    b = spark.createDataFrame([("a",)] * 50 + [("b",)] * 30 + [("c",)] * 20, "v string")
    values = {r["statistic"]: r["value"] for r in drift.detect_drift(a, b).details.collect() if r["section"] == "categorical"}
    # 2 x 3 table by hand: 80/50, 20/30, 0/20
    assert values["chi_square"] == pytest.approx(30 * 30 / 130 + 10 * 10 / 50 + 20, abs=1e-9)
    assert values["p_value"] == pytest.approx(math.exp(-values["chi_square"] / 2)) and values["new_values"] == 1


def test_yates_for_two_values(spark):
    a = spark.createDataFrame([("a",)] * 10 + [("b",)] * 20, "v string")
    b = spark.createDataFrame([("a",)] * 20 + [("b",)] * 10, "v string")
    assert drift.chi_square(a, b).first()["statistic"] == pytest.approx(4 * 4.5**2 / 15)


def test_empty_side_is_tolerated(spark):
    a, b = spark.createDataFrame([], "x double"), spark.createDataFrame([(1.0,), (2.0,)], "x double")
    report = drift.detect_drift(a, b)
    assert report.checked == 0 and report.severity == "NONE"


@pytest.mark.parametrize("checked,drifted,broken,level", [
    (0, 0, True, "NONE"), (10, 0, True, "CRITICAL"), (10, 4, False, "CRITICAL"), (10, 3, False, "MODERATE"),
    (10, 2, False, "MODERATE"), (20, 3, False, "LOW"), (10, 0, False, "NONE"),
])
def test_severity_steps(spark, checked, drifted, broken, level):
    assert spark.range(1).select(drift.severity(F.lit(checked), F.lit(drifted), F.lit(broken))).first()[0] == level


def test_sampled_drift_uses_fewer_rows(spark):
    df = spark.range(1000).select("id", F.col("id").cast("double").alias("x"))
    for options in ({"max_rows": 100, "key": "id"}, {"max_rows": 100}, {"sample_frac": 0.3}, {"sample_frac": 0.3, "max_rows": 50, "key": "id"}):
        report = drift.detect_drift(df, df.repartition(7, "x"), **options)
        assert report.severity == "NONE" and report.checked == 2
        assert {r["value"] for r in report.details.where("statistic = 'ks'").collect()} == {0.0}
    late = df.where("id >= 500")
    assert drift.detect_drift(df, late, max_rows=100).severity == "CRITICAL"


def test_many_new_categories_are_drift(spark):
    old = spark.range(600).selectExpr("concat('old', id % 60) v")
    new = spark.range(600).selectExpr("concat('new', id % 60) v")
    assert drift.detect_drift(old, new).severity == "CRITICAL"
    assert drift.detect_drift(old, new, max_values=50).severity == "CRITICAL"
    assert drift.detect_drift(old, old).severity == "NONE"


def test_lineage_has_every_ancestor_once(spark):
    chain = [(f"d{i}", f"d{i + 1}", "step") for i in range(12)] + [("d12", "d0", "loop")]
    diamond = [("a", "b", "x"), ("a", "c", "x"), ("b", "d", "y"), ("c", "d", "x"), ("d", "e", "x")]
    edges = spark.createDataFrame(chain + diamond, "dataset string, parent string, transformation string")
    got = {(r["dataset"], r["parent"]): (r["depth"], r["transformation"]) for r in versions.ancestors(edges).where("dataset in ('a', 'd0')").collect()}
    assert len([k for k in got if k[0] == "d0"]) == 12 and got["d0", "d12"][0] == 12
    assert {k[1]: v for k, v in got.items() if k[0] == "a"} == {"b": (1, "x"), "c": (1, "x"), "d": (2, "x"), "e": (3, "x")}


def test_nothing_to_check_passes(spark):
    report = rules.business_rules(spark.createDataFrame([(1,)], "other int"))
    assert report.count() == 0 and rules.passed(report)


def test_equal_times_keep_the_last_value(spark):
    log = spark.createDataFrame([("r", "m", "old", 1, 1), ("r", "m", "new", 1, 2)], "run_id string, name string, value string, at int, seq long")
    assert monitor.latest_values(log).first()["value"] == "new"


def test_neighbours_hold_copies(spark):
    rows = [(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 1.0, 0.0), (4, 0.0, 2.0)]
    got = rebalance.neighbours(spark.createDataFrame(rows, "k long, x double, y double"), ["x", "y"], "k", 2)
    found = {(r["key"], r["rank"]): (r["neighbour"], r["distance"]) for r in got.collect()}
    assert found == {(1, 1): (2, 0.0), (1, 2): (3, 1.0), (2, 1): (1, 0.0), (2, 2): (3, 1.0), (3, 1): (1, 1.0), (3, 2): (2, 1.0), (4, 1): (1, 2.0), (4, 2): (2, 2.0)}


def test_synthetic_keys_are_unique(spark):
    rows = spark.range(180).selectExpr("id", "cast(id % 13 as double) x", "cast(id % 7 as double) y", "case when id < 100 then 'a' when id < 150 then 'b' else 'c' end label")
    out = rebalance.oversample(rows, ["x", "y"], "label", "id", k=3)
    assert out.count() == 300 and out.select("id").distinct().count() == 300
    with pytest.raises(ValueError, match="number the rows"):
        rebalance.oversample(rows.withColumn("id", F.col("id") + (1 << 62)), ["x", "y"], "label", "id", k=3)


# ------------------------------------------------------------------ exploration


def test_summary_counts_null_rows_as_equal(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "a", 1), (1, None, 0)], "x int, s string, Churn int")
    r = explore.dataset_summary(df, "Churn").first()
    assert (r["n_rows"], r["n_cols"], r["missing"], r["duplicates"], r["target_rate"]) == (3, 3, 3, 1, 2 / 3)


def test_rate_by_category_skips_wide_columns(spark):
    df = spark.createDataFrame([(str(i), str(i % 2), i % 2) for i in range(20)], "wide string, narrow string, Churn int")
    got = {(r["feature"], r["value"]): (r["rate"], r["overall"], r["above"]) for r in explore.target_rate_by_category(df, "Churn", max_values=8).collect()}
    assert got == {("narrow", "0"): (0.0, 50.0, False), ("narrow", "1"): (100.0, 50.0, True)}


def test_histogram_top_edge_and_constant(spark):
    df = spark.createDataFrame([(0.0, 5), (5.0, 5), (10.0, 5)], "x double, same int")
    rows = {(r["feature"], r["bin"]): r["n"] for r in explore.histogram(df, bins=2).collect()}
    assert rows == {("x", 0): 1, ("x", 1): 2, ("same", 0): 3, ("same", 1): 0}


def test_fitters_take_nan_and_infinity(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    assert t.MissingFiller().fit(df).learned["x"] == 2.0
    assert sorted(r["x"] for r in t.MissingFiller().fit(df).transform(df).collect()) == [1.0, 2.0, 3.0]
    wild = spark.createDataFrame([(float("inf"),), (1.0,), (2.0,), (float("inf"),)], "x double")
    assert sorted(r["x"] for r in t.OutlierLimiter().fit(wild).transform(wild).collect()) == [1.0, 2.0, math.inf, math.inf]


def test_correlations_take_gaps_and_constants(spark):
    r = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": r.normal(1e6, 1, 300), "b": r.random(300), "same": 0.1})
    pdf["c"] = pdf["a"] * 3 + r.random(300)
    df = spark.createDataFrame(pdf).select(*[F.when(F.rand(i) > 0.2, F.col(n)).alias(n) for i, n in enumerate(pdf.columns)]).repartition(3)
    got = {(x["column_a"], x["column_b"]): x["correlation"] for x in explore.correlations(df).collect()}
    known = df.toPandas().corr()
    for (a, b), value in got.items():
        if "same" in (a, b):
            assert value is None
        else:
            assert value == pytest.approx(known.loc[a, b], abs=1e-9)
