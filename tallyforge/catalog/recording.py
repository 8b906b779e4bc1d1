"""Versions, lineage, registry, runs, performance, alerts and health, over logs derived from the tables."""
from pyspark.sql import functions as F

from ..operators import monitor, versions
from ..plans.profile import customer_profile, table, with_profile
from . import query
from .exploring import _rounded


@query("l1_fingerprint")
def l1(spark, sf):
    return versions.fingerprint_table(table(spark, sf, "lineitem"))


@query("l2_metadata", """SELECT (SELECT count(*) FROM customer) AS rows, CAST(5 AS INTEGER) AS columns, CAST(position AS INTEGER) AS position, "column", type
 FROM (VALUES (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'), (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string')) t(position, "column", type)""")
def l2(spark, sf):
    return versions.metadata(table(spark, sf, "customer"))


_PROFILED = ["OrderCount", "CouponUsed", "Complain", "PreferredPaymentMode", "PreferedOrderCat"]
_NUM, _CAT = _PROFILED[:3], _PROFILED[3:]


@query("l3_profile", with_profile(f""", t AS (SELECT {', '.join(f'"{n}"' for n in _PROFILED)} FROM cp),
 k AS ({' UNION ALL '.join(f'''SELECT '{n}' AS f, "{n}" AS v, count(*) AS n FROM t WHERE "{n}" IS NOT NULL GROUP BY 2''' for n in _CAT)}),
 r AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY n DESC, v) AS rn FROM k)
 SELECT NULL AS "column", 'duplicate_rows' AS statistic, CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS VARCHAR) AS value FROM t
 UNION ALL SELECT NULL, 'null_percentage', CAST(round(({' + '.join(f'count(*) FILTER (WHERE "{n}" IS NULL)' for n in _PROFILED)}) * 100.0 / (count(*) * 5), 2)::DOUBLE AS VARCHAR) FROM t
 UNION ALL {' UNION ALL '.join(f"""SELECT '{n}', 'nulls', CAST(count(*) FILTER (WHERE "{n}" IS NULL) AS VARCHAR) FROM t""" for n in _PROFILED)}
 UNION ALL {' UNION ALL '.join(f"""SELECT '{n}', '{s}', CAST(round({f}("{n}"::DOUBLE), 2) AS VARCHAR) FROM t""" for n in _NUM for s, f in (('min', 'min'), ('max', 'max'), ('mean', 'avg'), ('std', 'stddev_samp')))}
 UNION ALL SELECT f, 'unique', CAST(count(*) AS VARCHAR) FROM k GROUP BY f
 UNION ALL SELECT f, 'top_' || rn, v || '=' || n FROM r WHERE rn <= 3"""))
def l3(spark, sf):
    return versions.profile(customer_profile(spark, sf).select(*_PROFILED))


# every day of an event type is one version: its content mark is the number of users seen
VERSIONS_SQL = """WITH d AS (SELECT event_type AS dataset, CAST(ts AS DATE) AS day, count(*) AS rows, count(DISTINCT user_id) % 3 AS mark FROM events GROUP BY 1, 2),
 v AS (SELECT dataset, row_number() OVER (PARTITION BY dataset ORDER BY day) AS version, 'v' || row_number() OVER (PARTITION BY dataset ORDER BY day) AS version_id,
  CAST(mark AS VARCHAR) AS fingerprint, rows, CAST(6 + mark AS INTEGER) AS columns FROM d) """


def version_log(spark, sf):
    days = table(spark, sf, "events").groupBy(F.col("event_type").alias("model_name"), F.to_date("ts").cast("timestamp").alias("registered_at")).agg(
        F.count(F.lit(1)).alias("rows"), (F.count_distinct("user_id") % 3).alias("mark"))
    return monitor.number_versions(days).select(
        F.col("model_name").alias("dataset"), "version", F.concat(F.lit("v"), F.col("version").cast("string")).alias("version_id"),
        F.col("mark").cast("string").alias("fingerprint"), "rows", (F.col("mark") + 6).cast("int").alias("columns"))


@query("l4_changed_versions", VERSIONS_SQL + "SELECT dataset, version, fingerprint, fingerprint IS DISTINCT FROM lag(fingerprint) OVER (PARTITION BY dataset ORDER BY version) AS changed FROM v")
def l4(spark, sf):
    return versions.with_change(version_log(spark, sf)).select("dataset", "version", "fingerprint", "changed")


@query("l5_latest_versions", VERSIONS_SQL + "SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY version DESC) = 1")
def l5(spark, sf):
    return versions.latest_versions(version_log(spark, sf))


@query("l5_version_by_id", VERSIONS_SQL + "SELECT * FROM v WHERE dataset = 'click' AND version_id = 'v7'")
def l5_by_id(spark, sf):
    return versions.version_info(version_log(spark, sf), "click", "v7")


_EDGES = """e AS (SELECT c_name AS dataset, n_name AS parent, 'by nation' AS transformation FROM customer JOIN nation ON n_nationkey = c_nationkey
 UNION ALL SELECT n_name, r_name, 'by region' FROM nation JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT r_name, 'WORLD', 'total' FROM region
 UNION ALL SELECT 'WORLD', 'ASIA', 'loop')"""


@query("l6_lineage", f"""WITH RECURSIVE {_EDGES}, w(dataset, depth, parent, transformation, seen) AS (
  SELECT dataset, 1, parent, transformation, [dataset, parent] FROM e WHERE dataset <> parent
  UNION ALL SELECT w.dataset, w.depth + 1, e.parent, e.transformation, list_append(w.seen, e.parent) FROM w JOIN e ON e.dataset = w.parent
  WHERE NOT list_contains(w.seen, e.parent)), b AS (SELECT *, min(depth) OVER (PARTITION BY dataset, parent) AS least FROM w)
SELECT dataset, depth, parent, min(transformation) AS transformation FROM b WHERE depth = least GROUP BY ALL""")
def l6(spark, sf):
    customer, nation, region = (table(spark, sf, n) for n in ("customer", "nation", "region"))
    edge = lambda df, a, b, t: df.select(F.col(a).alias("dataset"), F.col(b).alias("parent"), F.lit(t).alias("transformation"))
    edges = (
        edge(customer.join(nation, F.col("n_nationkey") == F.col("c_nationkey")), "c_name", "n_name", "by nation")
        .unionAll(edge(nation.join(region, F.col("r_regionkey") == F.col("n_regionkey")), "n_name", "r_name", "by region"))
        .unionAll(edge(region.withColumn("w", F.lit("WORLD")), "r_name", "w", "total"))
        .unionAll(spark.createDataFrame([("WORLD", "ASIA", "loop")], "dataset string, parent string, transformation string"))
    )
    return versions.ancestors(edges)


@query("l7_compare_versions", VERSIONS_SQL + """, p AS (SELECT dataset, version_id AS v1, 'v' || (version + 1) AS v2 FROM v)
 SELECT p.dataset, v1, v2, CASE WHEN b.version_id IS NOT NULL THEN a.fingerprint IS DISTINCT FROM b.fingerprint END AS changed, b.rows - a.rows AS rows_diff,
 b.columns - a.columns AS columns_diff, CASE WHEN b.version_id IS NULL THEN 'version not found' END AS error
 FROM p JOIN v a ON a.dataset = p.dataset AND a.version_id = v1 LEFT JOIN v b ON b.dataset = p.dataset AND b.version_id = v2""")
def l7(spark, sf):
    log = version_log(spark, sf)
    pairs = log.select("dataset", F.col("version_id").alias("v1"), F.concat(F.lit("v"), (F.col("version") + 1).cast("string")).alias("v2"))
    return versions.compare_versions(log, pairs)


# one registration per event type and day; every seventh registration has no f1
REGISTRY_SQL = """WITH d AS (SELECT event_type AS model_name, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS registered_at, avg((value > 1)::INT) AS accuracy,
   CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 500 AS f1 FROM events GROUP BY 1, 2),
 r AS (SELECT model_name, row_number() OVER (PARTITION BY model_name ORDER BY registered_at) AS version, strftime(registered_at, '%Y-%m-%d') AS day, accuracy,
   CASE WHEN day(registered_at) % 7 <> 0 THEN f1 END AS f1 FROM d) """


def registry(spark, sf):
    days = daily(spark, sf)
    entry = F.when(F.day("registered_at") % 7 != 0, F.create_map(F.lit("accuracy"), F.col("accuracy"), F.lit("f1"), F.col("f1"))).otherwise(
        F.create_map(F.lit("accuracy"), F.col("accuracy")))
    return monitor.number_versions(days).select("model_name", "version", "registered_at", entry.alias("metrics"))


def daily(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("model_name"), F.to_date("ts").cast("timestamp").alias("registered_at")).agg(
        F.avg((F.col("value") > 1).cast("int")).alias("accuracy"),
        (F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1)) / 500).alias("f1"))


def _flat(df):
    return _rounded(df.select("model_name", "version", F.date_format("registered_at", "yyyy-MM-dd").alias("day"),
                              F.element_at("metrics", F.lit("accuracy")).alias("accuracy"), F.element_at("metrics", F.lit("f1")).alias("f1")))


_FLAT = "model_name, version, day, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1"


@query("l8_registered_versions", REGISTRY_SQL + f"SELECT {_FLAT} FROM r")
def l8(spark, sf):
    return _flat(registry(spark, sf))


@query("l9_latest_models", REGISTRY_SQL + f"SELECT {_FLAT} FROM r QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY version DESC) = 1")
def l9(spark, sf):
    return _flat(monitor.latest_models(registry(spark, sf)))


@query("l9_model_version", REGISTRY_SQL + f"SELECT {_FLAT} FROM r WHERE model_name = 'purchase' AND version = 3")
def l9_version(spark, sf):
    return _flat(monitor.model_version(registry(spark, sf), "purchase", 3))


@query("l10_best_models", REGISTRY_SQL + f"SELECT {_FLAT} FROM r QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY coalesce(f1, 0) DESC, version) = 1")
def l10(spark, sf):
    return _flat(monitor.best_models(registry(spark, sf)))


@query("l11_newest_model", REGISTRY_SQL + f"SELECT {_FLAT} FROM r ORDER BY day DESC, model_name DESC, version DESC LIMIT 1")
def l11(spark, sf):
    return _flat(monitor.newest_model(registry(spark, sf)))


# a user's day is one run: it starts with the first event and ends with the last one, unless there is only one
_RUNS = """WITH u AS (SELECT user_id || '@' || strftime(ts, '%Y-%m-%d') AS run_id, min(ts) AS s, CASE WHEN count(*) > 1 THEN max(ts) END AS e,
 CASE WHEN bool_or(event_type = 'error') THEN 'FAILED' ELSE 'FINISHED' END AS st FROM events GROUP BY 1) """


@query("l12_run_states", _RUNS + """SELECT run_id, CASE WHEN e IS NULL THEN 'RUNNING' ELSE st END AS status, round((epoch_us(e) - epoch_us(s)) / 1e6, 6) AS duration_seconds FROM u""")
def l12(spark, sf):
    run_id = F.concat(F.col("user_id").cast("string"), F.lit("@"), F.date_format("ts", "yyyy-MM-dd"))
    days = table(spark, sf, "events").groupBy(run_id.alias("run_id")).agg(
        F.min("ts").alias("s"), F.max("ts").alias("e"), F.count(F.lit(1)).alias("n"), F.bool_or(F.col("event_type") == "error").alias("bad"))
    start = days.select("run_id", F.lit("start").alias("event"), F.col("s").alias("at"), F.lit("RUNNING").alias("status"))
    end = days.where("n > 1").select("run_id", F.lit("end").alias("event"), F.col("e").alias("at"), F.when(F.col("bad"), "FAILED").otherwise("FINISHED").alias("status"))
    return _rounded(monitor.run_states(start.unionAll(end)).select("run_id", "status", "duration_seconds"))


@query("l12_latest_values", """SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS name, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def l12_values(spark, sf):
    log = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("name"), "value", F.struct("ts", "event_id").alias("at"))
    return monitor.latest_values(log)


_ENDS = """, f AS (SELECT model_name, count(*) AS n, arg_min(struct_pack(x := @), day).x AS a, arg_max(struct_pack(x := @), day).x AS b FROM r GROUP BY 1)
SELECT model_name, n, CASE WHEN n >= 2 AND a IS NOT NULL AND b IS NOT NULL THEN round(a, 6) END AS baseline, CASE WHEN n >= 2 AND a IS NOT NULL AND b IS NOT NULL THEN round(b, 6) END AS current,
 CASE WHEN n >= 2 THEN round(abs(b - a), 6) END AS drift, coalesce(n >= 2 AND abs(b - a) > 0.005, false) AS drift_detected,
 CASE WHEN n < 2 THEN 'fewer than two values' WHEN a IS NULL OR b IS NULL THEN 'a value is missing' ELSE
  'moved by ' || printf('%.4f', round(abs(b - a), 4)) || CASE WHEN abs(b - a) > 0.005 THEN ', too far' ELSE '' END END AS message FROM f"""


def _history(spark, sf):
    f1 = F.when(F.day("registered_at") % 7 != 0, F.col("f1"))
    return daily(spark, sf).select("model_name", F.col("registered_at").alias("timestamp"), "accuracy", f1.alias("f1"))


@query("l13_performance_drift_f1", REGISTRY_SQL + _ENDS.replace("@", "f1"))
def l13(spark, sf):
    return _rounded(monitor.performance_drift(_history(spark, sf), "f1", 0.005))


@query("l13_performance_drift_accuracy", REGISTRY_SQL + _ENDS.replace("@", "accuracy"))
def l13_accuracy(spark, sf):
    return _rounded(monitor.performance_drift(_history(spark, sf), "accuracy", 0.005))


_ALERTS = """WITH a AS (SELECT ts, event_type AS model_name, 'drift' AS alert_type, CASE WHEN value > 60 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, 'user ' || user_id AS message FROM events WHERE value > 20),
 old AS (SELECT DISTINCT md5(event_type || '|drift|WARNING|user ' || user_id) AS alert_id FROM events WHERE value <= 20 AND user_id > 75) """


@query("l14_new_alerts", _ALERTS + """SELECT md5(model_name || '|' || alert_type || '|' || severity || '|' || message) AS alert_id, model_name, alert_type, severity, message, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen
 FROM a WHERE md5(model_name || '|' || alert_type || '|' || severity || '|' || message) NOT IN (SELECT alert_id FROM old) GROUP BY 1, 2, 3, 4, 5""")
def l14(spark, sf):
    events = table(spark, sf, "events")
    user = F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("message")
    seen = events.where("value > 20").select(F.col("ts").alias("timestamp"), F.col("event_type").alias("model_name"), F.lit("drift").alias("alert_type"),
                                             F.when(F.col("value") > 60, "CRITICAL").otherwise("WARNING").alias("severity"), user)
    old = events.where("value <= 20 and user_id > 75").select(F.col("event_type").alias("model_name"), F.lit("drift").alias("alert_type"), F.lit("WARNING").alias("severity"), user).distinct()
    fresh = monitor.new_alerts(seen, monitor.with_alert_id(old))
    return fresh.select("alert_id", "model_name", "alert_type", "severity", "message", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


# the month's mean is the baseline, every user is a model
_HEALTH = """WITH m AS (SELECT user_id, avg((value > 20)::INT) AS f1, avg((value > 10)::INT) AS accuracy, avg((value > 30)::INT) AS roc_auc FROM events GROUP BY 1),
 b AS (SELECT user_id, avg((value > 20)::INT) AS f1, avg((value > 10)::INT) AS accuracy, avg((value > 30)::INT) AS roc_auc FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1),
 f AS (SELECT user_id, 'f1' AS metric, 'minimum' AS kind, f1 AS value, 'WARNING' AS level FROM m WHERE f1 < 0.7 UNION ALL SELECT user_id, 'accuracy', 'minimum', accuracy, 'WARNING' FROM m WHERE accuracy < 0.75
 UNION ALL SELECT user_id, 'f1', 'drift', abs(m.f1 - b.f1), CASE WHEN abs(m.f1 - b.f1) > 0.15 THEN 'CRITICAL' ELSE 'WARNING' END FROM m JOIN b USING (user_id) WHERE abs(m.f1 - b.f1) > 0.1
 UNION ALL SELECT user_id, 'accuracy', 'drift', abs(m.accuracy - b.accuracy), CASE WHEN abs(m.accuracy - b.accuracy) > 0.15 THEN 'CRITICAL' ELSE 'WARNING' END FROM m JOIN b USING (user_id) WHERE abs(m.accuracy - b.accuracy) > 0.1
 UNION ALL SELECT user_id, 'roc_auc', 'drift', abs(m.roc_auc - b.roc_auc), CASE WHEN abs(m.roc_auc - b.roc_auc) > 0.15 THEN 'CRITICAL' ELSE 'WARNING' END FROM m JOIN b USING (user_id) WHERE abs(m.roc_auc - b.roc_auc) > 0.1) """


def _health(spark, sf):
    rates = lambda df: df.groupBy(F.col("user_id").cast("string").alias("model_name")).agg(
        F.avg((F.col("value") > 20).cast("int")).alias("f1"), F.avg((F.col("value") > 10).cast("int")).alias("accuracy"), F.avg((F.col("value") > 30).cast("int")).alias("roc_auc"))
    events = table(spark, sf, "events")
    current, baseline = rates(events), rates(events.where("ts < timestamp_ntz'2024-01-10'"))
    return current, monitor.health_findings(current, baseline)


@query("l15_health_findings", _HEALTH + "SELECT CAST(user_id AS VARCHAR) AS model_name, metric, kind, round(value, 6) AS value, level FROM f")
def l15(spark, sf):
    return _rounded(_health(spark, sf)[1].drop("message"))


@query("l15_health_status", _HEALTH + """SELECT CAST(m.user_id AS VARCHAR) AS model_name, CASE WHEN bool_or(level = 'CRITICAL') THEN 'CRITICAL' WHEN count(level) > 0 THEN 'WARNING' ELSE 'HEALTHY' END AS status,
 count(level) AS issues FROM m LEFT JOIN f ON f.user_id = m.user_id GROUP BY 1""")
def l15_status(spark, sf):
    return monitor.health_status(*_health(spark, sf))
