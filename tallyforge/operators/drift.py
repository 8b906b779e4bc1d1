"""Drift between a reference table and a new one: schema, numbers, categories."""
from __future__ import annotations

from collections import namedtuple

from pyspark.sql import functions as F

from ..functions.columns import c, melt, numeric_columns, row_digest, string_columns
from ..functions.stats import chi_square_p, ks_two_sample_p
from ..plans.quantiles import exact_quantiles
from ..plans.running import running_totals
from .split import sample_fraction, sample_rows

# The severity steps.
CRITICAL_RATIO = 0.3
MODERATE_RATIO = 0.15

DriftReport = namedtuple("DriftReport", "details checked drifted severity has_drift")


# --------------------------------------------------------------------------- reference side


def numeric_reference(df, columns=None):
    """mean, sample std, min, max and quartiles per numeric column."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    lines = []
    for n in columns:
        x = c(n).cast("double")
        q = [F.lit(quartiles[n][p]).cast("double") for p in (0.25, 0.5, 0.75)]
        lines.append(F.struct(
            F.lit(n).alias("feature"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
            F.max(x).alias("max"), q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"),
        ))
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def category_reference(df, columns=None):
    """Relative frequency of each value per categorical column."""
    columns = list(columns or string_columns(df))
    totals = df.agg(F.map_from_arrays(F.array(*[F.lit(n) for n in columns]), F.array(*[F.count(c(n)) for n in columns])).alias("t")).scalar()
    counts = melt(df, columns, "string").where("value is not null").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("feature", "value", "n", (F.col("n") / F.element_at(totals, F.col("feature"))).alias("frequency"))


def missing_rates(df):
    rates = F.array(*[
        F.struct(F.lit(n).alias("column"), F.lit(t).alias("type"), F.avg(c(n).isNull().cast("double")).alias("missing_rate"))
        for n, t in df.dtypes
    ])
    return df.agg(rates.alias("r")).select(F.inline("r"))


# --------------------------------------------------------------------------- schema


def schema_findings(reference, new, ignore=()):
    """``[(column, finding, reference type, new type)]`` from the two schemas alone."""
    old = {n: t for n, t in reference.dtypes if n not in ignore}
    now = {n: t for n, t in new.dtypes if n not in ignore}
    found = [(n, "missing_column", t, None) for n, t in old.items() if n not in now]
    found += [(n, "new_column", None, t) for n, t in now.items() if n not in old]
    found += [(n, "type_change", t, now[n]) for n, t in old.items() if n in now and now[n] != t]
    return found


def schema_drift(reference, new, ignore=()):
    return reference.sparkSession.createDataFrame(
        schema_findings(reference, new, ignore),
        "column string, finding string, reference_type string, new_type string",
    )


# --------------------------------------------------------------------------- numbers


def _both(reference, new, columns, as_type):
    """Long form of both tables with a 0/1 mark for the side."""
    a = melt(reference, columns, as_type).select("feature", "value", F.lit(1).alias("a"), F.lit(0).alias("b"))
    b = melt(new, columns, as_type).select("feature", "value", F.lit(0).alias("a"), F.lit(1).alias("b"))
    return a.unionAll(b).where("value is not null")


def ks_statistics(reference, new, columns=None):
    """Two-sample Kolmogorov-Smirnov distance per feature: ``(feature, n_reference, n_new, statistic)``.

    Equal values are combined before the shuffle; the distribution functions are running
    totals spread over value ranges.
    """
    columns = [n for n in columns or numeric_columns(reference) if n in new.columns and n in numeric_columns(new)]
    counts = _both(reference, new, columns, "double").groupBy("feature", "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    steps = running_totals(counts, ["feature"], "value", ["a", "b"])
    gap = F.abs(F.try_divide(F.col("run_a"), F.col("all_a")) - F.try_divide(F.col("run_b"), F.col("all_b")))
    return (
        steps.groupBy("feature")
        .agg(F.max("all_a").alias("n_reference"), F.max("all_b").alias("n_new"), F.max(gap).alias("statistic"))
        .where("n_reference > 0 and n_new > 0")
    )


def moments(reference, new, columns):
    """Mean difference and deviation ratio per feature (null ratio when the reference does not vary)."""
    facts = lambda df: df.agg(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.avg(c(n).cast("double")).alias("m"), F.stddev_samp(c(n).cast("double")).alias("s"))
        for n in columns
    ]).alias("r")).select(F.inline("r"))
    a = facts(reference).toDF("feature", "m1", "s1")
    b = facts(new).toDF("feature", "m2", "s2")
    # one line per column on both sides
    return a.join(F.broadcast(b), "feature").select(
        "feature", F.abs(F.col("m2") - F.col("m1")).alias("mean_diff"),
        F.when(F.col("s1") > 0, F.col("s2") / F.col("s1")).alias("std_ratio"),
    )


# --------------------------------------------------------------------------- categories


def category_counts(reference, new, columns=None):
    """``(feature, value, a, b)``: rows per value on both sides."""
    columns = [n for n in columns or string_columns(reference) if n in new.columns and n in string_columns(new)]
    return _both(reference, new, columns, "string").groupBy("feature", "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def category_shape(counts):
    """Per feature: distinct values, longest reference value, totals, new values."""
    return counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("values"),
        F.max(F.when(F.col("a") > 0, F.length("value"))).alias("longest"),
        F.sum("a").alias("all_a"),
        F.sum("b").alias("all_b"),
        F.count_if(F.col("a") == 0).alias("new_values"),
    )


def skip_reason(max_values=None, max_length=None):
    """Why a column gets no chi-square test, for the limits that are given; null otherwise."""
    many = F.lit(False) if max_values is None else F.col("values") > max_values
    long = F.lit(False) if max_length is None else F.col("longest") > max_length
    return F.when(many, F.lit("too many values")).when(long, F.lit("value too long"))


def new_categories(reference, new, columns=None):
    """Values the reference does not hold."""
    return category_counts(reference, new, columns).where("a = 0").select("feature", "value", F.col("b").alias("n"))


def chi_square(reference, new, columns=None, max_values=None, max_length=None):
    """Chi-square of the 2 x m table per feature, corrected for continuity when m = 2.

    ``(feature, values, n_reference, n_new, new_values, skipped, statistic, dof)``. Columns beyond a limit that is
    given have no statistic; their new values count all the same.
    """
    counts = category_counts(reference, new, columns)
    shape = category_shape(counts).withColumn("skipped", skip_reason(max_values, max_length))
    joined = counts.join(F.broadcast(shape), "feature")  # one line per column
    total = F.col("all_a") + F.col("all_b")

    def cell(seen, side):
        expected = (F.col("a") + F.col("b")) * F.col(side) / total
        gap = F.abs(F.col(seen) - expected)
        gap = F.when(F.col("values") == 2, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return F.try_divide(gap * gap, expected)

    testable = F.col("skipped").isNull() & (F.col("all_a") > 0) & (F.col("all_b") > 0)
    return joined.groupBy("feature").agg(
        F.max("values").alias("values"), F.max("all_a").alias("n_reference"), F.max("all_b").alias("n_new"),
        F.max("new_values").alias("new_values"), F.max("skipped").alias("skipped"),
        F.sum(F.when(testable, cell("a", "all_a") + cell("b", "all_b"))).alias("statistic"),
        F.max(F.when(testable, F.col("values") - 1)).alias("dof"),
    )


# --------------------------------------------------------------------------- report


def severity(checked, drifted, schema_broken):
    """The level as a column expression. With nothing to check, the schema is not looked at."""
    ratio = F.try_divide(drifted.cast("double"), checked.cast("double"))
    return (
        F.when(checked == 0, "NONE").when(schema_broken, "CRITICAL").when(ratio > CRITICAL_RATIO, "CRITICAL")
        .when(ratio > MODERATE_RATIO, "MODERATE").when(ratio > 0, "LOW").otherwise("NONE")
    )


def _thinned(df, fraction, max_rows, key):
    """A repeatable sample by the hash of the key, or of the whole row: the same rows of equal tables."""
    if (fraction is None or fraction >= 1.0) and max_rows is None:
        return df
    by = key or "_digest"
    out = df if key else df.withColumn("_digest", row_digest(df.columns))
    if fraction is not None and fraction < 1.0:
        out = sample_fraction(out, fraction, by)
    if max_rows is not None:
        out = sample_rows(out, max_rows, by)
    return out.select(*df.columns)


def detect_drift(reference, new, threshold=0.05, sample_frac=1.0, max_rows=None, key=None, ignore=(), max_values=None, max_length=None, ks_method="asymptotic"):
    """All tests at once. ``details`` is a long table ``(section, feature, statistic, value, note, drifted)``.

    Only one line per column comes to the driver, where the p-values are computed. ``sample_frac`` and ``max_rows`` thin
    both tables by one rule, so that a table never drifts from itself. ``max_values`` and ``max_length`` leave
    columns without a chi-square test; new values are drift in every column. ``ks_method`` holds for every size.
    """
    reference, new = (_thinned(t, sample_frac, max_rows, key) for t in (reference, new))
    spark = reference.sparkSession
    ref, now = reference.drop(*ignore), new.drop(*ignore)
    lines, checked, drifted = [], 0, 0

    found = schema_findings(ref, now)
    for n, finding, old, cur in found:
        lines.append(("schema", n, finding, None, f"{old} -> {cur}", finding != "type_change"))
    broken = any(f[1] in ("missing_column", "type_change") for f in found)
    names_differ = any(f[1] in ("missing_column", "new_column") for f in found)

    numeric = [n for n in numeric_columns(ref) if n in numeric_columns(now)]
    if numeric:
        spread = {r["feature"]: r for r in moments(ref, now, numeric).collect()}
        for r in ks_statistics(ref, now, numeric).collect():
            n = r["feature"]
            p = ks_two_sample_p(r["statistic"], r["n_reference"], r["n_new"], ks_method)
            bad = p < threshold
            checked, drifted = checked + 1, drifted + bad
            for stat, value in (("ks", r["statistic"]), ("p_value", p), ("mean_diff", spread[n]["mean_diff"]), ("std_ratio", spread[n]["std_ratio"])):
                lines.append(("numeric", n, stat, value, None, bad))

    words = [n for n in string_columns(ref) if n in string_columns(now)]
    if words:
        for r in chi_square(ref, now, words, max_values, max_length).collect():
            checked += 1
            if r["skipped"]:
                lines.append(("categorical", r["feature"], "skipped", float(r["values"]), r["skipped"], r["new_values"] > 0))
            p = None if r["statistic"] is None else chi_square_p(r["statistic"], r["dof"])
            bad = (p is not None and p < threshold) or r["new_values"] > 0
            drifted += bad
            for stat, value in (("chi_square", r["statistic"]), ("p_value", p), ("new_values", float(r["new_values"]))):
                lines.append(("categorical", r["feature"], stat, value, None, bad))

    level = spark.range(1).select(severity(F.lit(checked), F.lit(drifted), F.lit(broken))).first()[0]
    lines.append(("summary", None, "checked", float(checked), None, False))
    lines.append(("summary", None, "drifted", float(drifted), level, drifted > 0))
    details = spark.createDataFrame(
        lines, "section string, feature string, statistic string, value double, note string, drifted boolean"
    )
    return DriftReport(details, checked, drifted, level, names_differ or drifted > 0)
