"""Every registered query against its SQL twin on the smallest tables."""
import pytest
from compare import compare, duck

from tallyforge.catalog import load_all

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    ok, message = compare(spark, con, QUERIES[name], ORACLES[name], SF)
    assert ok, message


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["f6_correlations", "g9_rule_report", "h4_ks_statistic", "j2_roc_auc", "l4_changed_versions", "c1_c6_engineered_features"])
def test_plan_shape(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan


def test_unused_blocks_of_the_profile_are_dropped(spark):
    from tallyforge.plans.profile import customer_profile

    plan = customer_profile(spark, SF).select("CustomerID", "Tenure")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "event_type" not in plan and "p_type" not in plan


def test_tasks_need_no_package_on_the_executors(tmp_path):
    """Run from another folder with a bare session: the workers cannot import the package."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[4]').config('spark.sql.shuffle.partitions', '4').config('spark.ui.enabled', 'false').getOrCreate()\n"
        f"print('rows', e.queries()['e5_tomek_links'](s, {SF!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows " in run.stdout, run.stderr[-2000:]
