"""Quality scores and business rules, reported as a long table."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ..functions.columns import c, missing_cells, row_digest
from ..sources.io import write_table

# Accepted spellings and warning levels.
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
PHONE = r"^\+?[0-9\-\s()]{7,}$"
NULL_RATIO_WARNING = 0.2
DUPLICATE_RATIO_WARNING = 0.05


@dataclass(frozen=True)
class Rule:
    category: str
    name: str
    needs: tuple
    broken: Column
    fails: bool = True


def row_rules():
    """Rules a single row can break."""
    cashback, orders = c("CashbackAmount"), c("OrderCount")
    return [
        Rule("range", "Tenure", ("Tenure",), c("Tenure") < 0),
        Rule("range", "CashbackAmount", ("CashbackAmount",), cashback < 0),
        Rule("logic", "OrderCount_for_Cashback", ("CashbackAmount", "OrderCount"), (cashback > 0) & (orders.isNull() | (orders <= 0))),
        Rule("format", "Email", ("Email",), ~c("Email").cast("string").rlike(EMAIL)),
        Rule("format", "Phone", ("Phone",), ~c("Phone").cast("string").rlike(PHONE)),
        Rule("referential", "CustomerID_null", ("CustomerID",), c("CustomerID").isNull()),
    ]


def applicable(df, rules=None):
    return [r for r in rules or row_rules() if set(r.needs) <= set(df.columns)]


def breaking_rows(df, rule_name, rules=None):
    """The rows that break one rule; none when its columns are absent."""
    for r in applicable(df, rules):
        if r.name == rule_name:
            return df.where(r.broken)
    return df.limit(0)


def repeated_keys(df, key="CustomerID"):
    """Keys held by several rows, with the number of rows; null counts as one key."""
    return df.groupBy(c(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def rows_with_repeated_key(df, key="CustomerID"):
    """All copies of the rows whose key occurs more than once."""
    keys = repeated_keys(df, key).select(F.col("key").alias("_key"))
    return df.join(keys, c(key).eqNullSafe(F.col("_key")), "left_semi")


def business_rules(df, key="CustomerID", n_examples=5, rules=None):
    """``(category, rule, count, examples, fails)``, one line per broken rule.

    Every row rule is evaluated in the same pass. Examples are the lowest keys; each task
    keeps ``n_examples`` of them per rule before anything is shuffled.
    """
    rules = applicable(df, rules)
    id_col = c(key).cast("string") if key in df.columns else F.lit(None).cast("string")
    order = c(key) if key in df.columns else F.lit(0)
    out = None
    if rules:
        checks = F.filter(
            F.array(*[
                F.struct(
                    F.lit(r.category).alias("category"), F.lit(r.name).alias("rule"), F.lit(r.fails).alias("fails"),
                    F.coalesce(r.broken, F.lit(False)).alias("broken"),
                )
                for r in rules
            ]),
            lambda x: x["broken"],
        )
        broken = df.select(order.alias("_order"), id_col.alias("_id"), F.inline(checks))
        counts = broken.groupBy("category", "rule", "fails").agg(F.count(F.lit(1)).alias("count"))
        # the filter on row_number is pushed below the shuffle as a group limit
        lowest = Window.partitionBy("rule").orderBy("_order")
        examples = (
            broken.withColumn("_rank", F.row_number().over(lowest))
            .where(F.col("_rank") <= n_examples)
            .groupBy("rule")
            .agg(F.array_sort(F.collect_list(F.struct("_rank", "_id"))).alias("_found"))
            .select(F.col("rule").alias("_rule"), F.transform("_found", lambda x: x["_id"]).alias("examples"))
        )
        # one line per rule
        out = counts.join(F.broadcast(examples), F.col("rule") == F.col("_rule"), "left").select(
            "category", "rule", "count", F.concat_ws(",", "examples").alias("examples"), "fails"
        )
    if key in df.columns:
        repeats = repeated_keys(df, key)
        total = repeats.agg(F.sum("n").alias("count"))
        lowest_keys = repeats.where("key is not null").orderBy("key").limit(n_examples)
        cited = lowest_keys.agg(F.array_join(F.transform(F.array_sort(F.collect_list("key")), lambda x: x.cast("string")), ",").alias("e")).scalar()
        line = total.where("count > 0").select(
            F.lit("referential").alias("category"), F.lit(f"{key}_duplicates").alias("rule"), "count",
            cited.alias("examples"), F.lit(False).alias("fails"),
        )
        out = line if out is None else out.unionByName(line)
    if out is None:  # nothing to check: no broken rule
        out = df.sparkSession.createDataFrame([], "category string, rule string, count bigint, examples string, fails boolean")
    return out


def passed(report):
    """True when no failing rule is broken. Reads at most one line per rule."""
    return report.where("fails").limit(1).count() == 0


def enforce(report, fail_on_violation=False, path=None):
    """Store the report when ``path`` is given, and stop on a broken rule when asked to."""
    if path:
        write_table(report, path)
    ok = passed(report)
    if fail_on_violation and not ok:
        raise ValueError("business rules are violated")
    return ok


def quality(df):
    """``(rows, null_ratio, duplicate_ratio, quality_score)`` in one line."""
    n, cells = F.count(F.lit(1)), len(df.columns)
    facts = df.agg(
        n.alias("rows"),
        F.coalesce(F.sum(missing_cells(df.columns)), F.lit(0)).alias("missing"),
        (n - F.count_distinct(row_digest(df.columns))).alias("repeats"),
    )
    share = lambda x, of: F.coalesce(F.try_divide(x.cast("double"), of.cast("double")), F.lit(0.0))
    ratios = facts.select(
        "rows",
        share(F.col("missing"), F.col("rows") * cells).alias("null_ratio"),
        share(F.col("repeats"), F.col("rows")).alias("duplicate_ratio"),
    )
    return ratios.select(
        "*",
        F.greatest(F.lit(0.0), 1 - (F.col("null_ratio") + F.col("duplicate_ratio")) / 2).alias("quality_score"),
        (F.col("null_ratio") > NULL_RATIO_WARNING).alias("null_warning"),
        (F.col("duplicate_ratio") > DUPLICATE_RATIO_WARNING).alias("duplicate_warning"),
    )
