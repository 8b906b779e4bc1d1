"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyforge.catalog import load_all  # noqa: E402
from tallyforge.session import local_session  # noqa: E402

HEADLINE = [
    "f1_dataset_summary", "f5_box_statistics", "f6_correlations", "f8_rate_by_category", "f9_target_by_value",
    "g1_quality", "g9_rule_report", "b2_drop_repeats", "c1_c6_engineered_features", "d1_median_fill", "d5_iqr_clip",
    "d9_standard_scale", "d12_top_features", "d14_prepared_table", "e1_stratified_split", "e3_stratified_folds",
    "e4_oversample", "e5_tomek_links", "h4_ks_statistic", "h6_chi_square", "h10_drift_report", "i3_decision_tree",
    "i10_train_all", "j1_j2_evaluate", "j3_roc_points", "k2_linear_shapley", "l3_profile", "l14_new_alerts", "m1_score_table",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("OFF")
    queries, _ = load_all()
    queries["f14_target_rate"](spark, sf_dir).collect()  # starts the JVM's compilers
    times = {}
    for name in HEADLINE:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


main()
