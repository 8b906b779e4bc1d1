"""Model registry, run log, performance log, alerts and health as append-only tables."""
from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import functions as F

from ..functions.columns import c
from ..plans.running import running_totals
from ..sources.io import exists

REGISTRY_SCHEMA = "model_name string, version bigint, registered_at timestamp, path string, metrics map<string,double>, run_id string"
RUN_SCHEMA = "run_id string, event string, at timestamp, status string"
PARAM_SCHEMA = "run_id string, kind string, name string, value string, at timestamp, seq bigint"
PERFORMANCE_SCHEMA = (
    "timestamp timestamp, model_name string, model_version string, accuracy double, precision double, "
    "recall double, f1 double, roc_auc double, n_samples bigint, notes string"
)
ALERT_SCHEMA = "timestamp timestamp, model_name string, alert_type string, severity string, message string, alert_id string"

# Health limits.
MINIMUM = {"f1": 0.70, "accuracy": 0.75}
DRIFT_METRICS = ["f1", "accuracy", "roc_auc"]
DRIFT_MAX = 0.10
DRIFT_CRITICAL = 0.15


# --------------------------------------------------------------------------- registry


def number_versions(registrations):
    """Version number of each registration of a model in time order (one registration per instant).

    ``registrations``: ``model_name, registered_at, ...``. The count runs over time ranges, so
    a model with very many registrations is not numbered by one task.
    """
    instants = registrations.select("model_name", F.unix_micros(F.col("registered_at").cast("timestamp")).alias("_at")).distinct().withColumn("_one", F.lit(1))
    numbered = running_totals(instants, ["model_name"], "_at", ["_one"])
    return (
        registrations.withColumn("_at", F.unix_micros(F.col("registered_at").cast("timestamp")))
        .join(numbered.select("model_name", "_at", F.col("run__one").alias("version")), ["model_name", "_at"])
        .drop("_at")
    )


def _newest(table, by, order):
    rest = [n for n in table.columns if n not in by]
    return table.groupBy(*by).agg(F.max_by(F.struct(*rest), order).alias("v")).select(*by, "v.*")


def latest_models(registry):
    return _newest(registry, ["model_name"], "version")


def model_version(registry, model_name, version):
    return registry.where((c("model_name") == model_name) & (c("version") == version))


def best_models(registry, metric="f1"):
    """Per name the version with the highest metric; a missing one counts 0, the first wins a tie."""
    score = F.coalesce(F.element_at("metrics", F.lit(metric)), F.lit(0.0))
    return _newest(registry, ["model_name"], F.struct(score, -F.col("version")))


def newest_model(registry):
    """The most recently registered model of all names."""
    line = F.max_by(F.struct(*registry.columns), F.struct("registered_at", "model_name", "version"))
    return registry.agg(line.alias("v")).where("v is not null").select("v.*")


# --------------------------------------------------------------------------- runs


def run_states(run_log):
    """Current state of each run: RUNNING until its end event, duration in seconds after it."""
    start = F.min(F.when(c("event") == "start", c("at")))
    end = F.max(F.when(c("event") == "end", c("at")))
    status = F.max_by("status", F.when(c("event") == "end", c("at")))
    return run_log.groupBy("run_id").agg(start.alias("start_time"), end.alias("end_time"), status.alias("_s")).select(
        "run_id", "start_time", "end_time",
        F.when(F.col("end_time").isNull(), "RUNNING").otherwise(F.col("_s")).alias("status"),
        ((F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / 1e6).alias("duration_seconds"),
    )


def _logged(values):
    """Order of logged values: by time, then by the sequence of logging if it is known, then by value."""
    return F.struct("at", *[n for n in ("seq", "value") if n in values.columns])


def latest_values(values):
    """Last value logged per run and name."""
    return values.groupBy("run_id", "name").agg(F.max_by("value", _logged(values)).alias("value"))


# --------------------------------------------------------------------------- performance


def first_logged(history):
    """The first line of each model in a performance log: what later values are compared with."""
    rest = [n for n in history.columns if n not in ("model_name", "timestamp")]
    return history.groupBy("model_name").agg(F.min_by(F.struct(*rest), F.struct("timestamp", *rest)).alias("v")).select("model_name", "v.*")


def performance_drift(history, metric="f1", threshold=0.05):
    """First against last value per model: ``(model_name, n, baseline, current, drift, drift_detected, message)``."""
    ends = history.groupBy("model_name").agg(
        F.count(F.lit(1)).alias("n"), F.min_by(F.struct(c(metric).alias("x")), "timestamp").alias("a"), F.max_by(F.struct(c(metric).alias("x")), "timestamp").alias("b")
    )
    few, known = F.col("n") < 2, F.col("a.x").isNotNull() & F.col("b.x").isNotNull()
    gap = F.abs(F.col("b.x") - F.col("a.x"))
    usable = ~few & known
    return ends.select(
        "model_name", "n", F.when(usable, F.col("a.x")).alias("baseline"), F.when(usable, F.col("b.x")).alias("current"),
        F.when(usable, gap).alias("drift"), F.coalesce(usable & (gap > threshold), F.lit(False)).alias("drift_detected"),
        F.when(few, "fewer than two values").when(~known, "a value is missing")
        .otherwise(F.concat(F.lit("moved by "), F.format_number(gap, 4), F.when(gap > threshold, ", too far").otherwise(""))).alias("message"),
    )


# --------------------------------------------------------------------------- alerts


def with_alert_id(alerts):
    """Stable id of an alert's content; the time is not part of it."""
    return alerts.withColumn("alert_id", F.md5(F.concat_ws("|", "model_name", "alert_type", "severity", "message")))


def new_alerts(alerts, stored=None):
    """The first copy of each alert that is not stored yet."""
    alerts = with_alert_id(alerts)
    rest = [n for n in alerts.columns if n != "alert_id"]
    first = alerts.groupBy("alert_id").agg(F.min_by(F.struct(*rest), "timestamp").alias("v")).select("v.*", "alert_id")
    return first if stored is None else first.join(stored.select("alert_id"), "alert_id", "left_anti").select(*first.columns)


# --------------------------------------------------------------------------- health


def health_findings(current, baseline=None, minimum=None, drift_max=DRIFT_MAX):
    """One line per problem: ``(model_name, metric, kind, value, level, message)``.

    ``current`` and ``baseline`` hold one line per model with metric columns; absent metrics are skipped.
    """
    minimum = MINIMUM if minimum is None else minimum
    cells = [
        F.struct(
            F.lit(m).alias("metric"), F.lit("minimum").alias("kind"), c(m).cast("double").alias("value"), F.lit("WARNING").alias("level"),
            F.concat(F.lit(f"{m.upper()} below minimum: "), F.format_number(c(m), 3), F.lit(f" < {low}")).alias("message"),
            (c(m) < low).alias("bad"),
        )
        for m, low in minimum.items()
        if m in current.columns
    ]
    joined = current
    if baseline is not None:
        shared = [m for m in DRIFT_METRICS if m in current.columns and m in baseline.columns]
        joined = current.join(baseline.select("model_name", *[c(m).alias(f"_base_{m}") for m in shared]), "model_name", "left")
        for m in shared:
            gap = F.abs(c(m) - c(f"_base_{m}"))
            cells.append(F.struct(
                F.lit(m).alias("metric"), F.lit("drift").alias("kind"), gap.alias("value"),
                F.when(gap > DRIFT_CRITICAL, "CRITICAL").otherwise("WARNING").alias("level"),
                F.concat(F.lit(f"Drift {m.upper()}: "), F.format_number(gap, 3)).alias("message"), (gap > drift_max).alias("bad"),
            ))
    return joined.select("model_name", F.inline(F.filter(F.array(*cells), lambda x: F.coalesce(x["bad"], F.lit(False))))).drop("bad")


def health_status(current, findings):
    """The worst level per model, HEALTHY without a finding."""
    worst = findings.groupBy("model_name").agg(F.max(F.when(c("level") == "CRITICAL", 2).otherwise(1)).alias("_w"), F.count(F.lit(1)).alias("_n"))
    return current.select("model_name").join(worst, "model_name", "left").select(
        "model_name", F.when(F.col("_w") == 2, "CRITICAL").when(F.col("_w") == 1, "WARNING").otherwise("HEALTHY").alias("status"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("issues"),
    )


def health_alerts(findings, at):
    """Drift findings as alert lines."""
    return findings.where("kind = 'drift'").select(
        F.lit(at).cast("timestamp").alias("timestamp"), "model_name", F.lit("drift").alias("alert_type"), F.col("level").alias("severity"), "message"
    )


# --------------------------------------------------------------------------- the store


class MonitorStore:
    """Registry, runs, performance and alert tables below one folder."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name, schema):
        path = f"{self.folder}/{name}"
        if exists(self.spark, path):
            return self.spark.read.schema(schema).parquet(path)
        return self.spark.createDataFrame([], schema)

    def _append(self, name, rows, schema):
        self.spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{self.folder}/{name}")

    registry = property(lambda self: self._read("registry", REGISTRY_SCHEMA))
    runs = property(lambda self: self._read("runs", RUN_SCHEMA))
    values = property(lambda self: self._read("run_values", PARAM_SCHEMA))
    performance = property(lambda self: self._read("performance", PERFORMANCE_SCHEMA))
    alerts = property(lambda self: self._read("alerts", ALERT_SCHEMA))

    def register_model(self, model_name, model, metrics, run_id=None, now=None):
        """Save the model next to the registry and append it with the next version; returns its path."""
        now = now or dt.datetime.now()
        version = self.registry.where(c("model_name") == model_name).count() + 1
        path = f"{self.folder}/models/{model_name}_v{version}_{now:%Y%m%d_%H%M%S}"
        model.write().overwrite().save(path)
        metrics = {k: float(v) for k, v in metrics.items() if v is not None}
        self._append("registry", [(model_name, version, now, path, metrics, run_id)], REGISTRY_SCHEMA)
        return path

    def start_run(self, run_name=None, now=None):
        now = now or dt.datetime.now()
        run_id = run_name or f"{now:%Y%m%d_%H%M%S}"
        self._append("runs", [(run_id, "start", now, "RUNNING")], RUN_SCHEMA)
        return run_id

    def end_run(self, run_id, status="FINISHED", now=None):
        self._append("runs", [(run_id, "end", now or dt.datetime.now(), status)], RUN_SCHEMA)

    def log_values(self, run_id, kind, values, now=None):
        now = now or dt.datetime.now()
        self._append("run_values", [(run_id, kind, k, str(v), now, time.time_ns()) for k, v in values.items()], PARAM_SCHEMA)

    def run_info(self, run_id):
        """``{kind: {name: value}}`` with the last value of every name."""
        mine = self.values.where(c("run_id") == run_id)
        info = {}
        for r in mine.groupBy("kind", "name").agg(F.max_by("value", _logged(mine)).alias("value")).collect():
            info.setdefault(r["kind"], {})[r["name"]] = r["value"]
        return info

    def log_performance(self, model_name, metrics, model_version=None, n_samples=None, notes=None, now=None):
        known = [metrics.get(m) for m in ("accuracy", "precision", "recall", "f1", "roc_auc")]
        row = (now or dt.datetime.now(), model_name, model_version or "unknown", *known, n_samples, notes)
        self._append("performance", [row], PERFORMANCE_SCHEMA)

    def history(self, model_name=None):
        return self.performance if model_name is None else self.performance.where(c("model_name") == model_name)

    def create_alert(self, model_name, alert_type, message, severity="WARNING", now=None):
        """True when the alert is new and was stored."""
        row = (now or dt.datetime.now(), model_name, alert_type, severity, message)
        one = self.spark.createDataFrame([row], "timestamp timestamp, model_name string, alert_type string, severity string, message string")
        return self.store_alerts(one) > 0

    def store_alerts(self, alerts):
        fresh = new_alerts(alerts, self.alerts).persist()
        n = fresh.count()
        if n:
            fresh.write.mode("append").parquet(f"{self.folder}/alerts")
        fresh.unpersist()
        return n

    def check_health(self, current, baseline=None, minimum=None, drift_max=DRIFT_MAX, now=None):
        """``(status table, findings table)``; drift findings are stored as alerts."""
        findings = health_findings(current, baseline, minimum, drift_max)
        self.store_alerts(health_alerts(findings, now or dt.datetime.now()))
        return health_status(current, findings), findings
