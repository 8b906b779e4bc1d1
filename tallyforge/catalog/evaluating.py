"""Evaluation of three fixed scores on the profile; scores are hundredths, so ties are common."""
from pyspark.sql import functions as F

from ..operators import metrics, split
from ..plans.profile import customer_profile, with_profile
from ..session import stored
from . import query
from .exploring import _rounded
from .splitting import ORDER_SQL, key_order

SCORED = """, wide AS (SELECT "CustomerID", "ChurnPlanted" AS label, coalesce(100 - 8 * "OrderCount", 100) AS a,
  coalesce(90 - 3 * "CouponUsed", 90) AS b, coalesce("DaySinceLastOrder" // 8, 100) AS d FROM cp),
long AS (SELECT 'orders' AS model, "CustomerID", label, a AS points FROM wide UNION ALL SELECT 'coupons', "CustomerID", label, b FROM wide
  UNION ALL SELECT 'recency', "CustomerID", label, d FROM wide),
scored AS (SELECT model, "CustomerID", label, points / 100.0::DOUBLE AS score, CASE WHEN points >= 50 THEN 1 ELSE 0 END AS prediction FROM long),
outcome AS (SELECT model, count(*) AS n, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn FROM scored GROUP BY model),
metrics AS (SELECT model, n, (tp + tn) / n AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM outcome),
ladder AS (SELECT model, score, p, q, sum(p) OVER w AS rp, sum(q) OVER w AS rq, sum(p) OVER (PARTITION BY model) AS ap, sum(q) OVER (PARTITION BY model) AS aq
  FROM (SELECT model, score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS q FROM scored GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
auc AS (SELECT model, sum(q * (rp - p + p / 2.0)) / (any_value(ap)::DOUBLE * any_value(aq)) AS roc_auc FROM ladder GROUP BY 1)
"""


def scored(spark, sf):
    col = F.col
    wide = customer_profile(spark, sf).select(
        "CustomerID", col("ChurnPlanted").alias("label"),
        F.inline(F.array(
            F.struct(F.lit("orders").alias("model"), F.coalesce(100 - 8 * col("OrderCount"), F.lit(100)).alias("points")),
            F.struct(F.lit("coupons").alias("model"), F.coalesce(90 - 3 * col("CouponUsed"), F.lit(90)).alias("points")),
            F.struct(F.lit("recency").alias("model"), F.coalesce(F.floor(col("DaySinceLastOrder") / 8), F.lit(100)).alias("points")),
        )),
    )
    return wide.select("model", "CustomerID", "label", (col("points") / 100.0).alias("score"), (col("points") >= 50).cast("int").alias("prediction"))


BY = ["model"]


@query("j1_metrics", with_profile(SCORED + "SELECT model, n, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM metrics"))
def j1(spark, sf):
    return _rounded(metrics.classification_metrics(scored(spark, sf), BY))


@query("j1_j2_evaluate", with_profile(SCORED + "SELECT model, n, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(roc_auc, 6) AS roc_auc FROM metrics JOIN auc USING (model)"))
def j1_j2(spark, sf):
    return _rounded(metrics.evaluate(scored(spark, sf), BY))


@query("j2_roc_auc", with_profile(SCORED + "SELECT model, round(roc_auc, 6) AS roc_auc FROM auc"))
def j2(spark, sf):
    return _rounded(metrics.roc_auc(scored(spark, sf), BY))


@query("j2_roc_auc_documents", """WITH s AS (SELECT n_chars AS score, quality FROM documents JOIN labels USING (doc_id)),
 l AS (SELECT score, count(*) FILTER (WHERE quality = 1) AS p, count(*) FILTER (WHERE quality = 0) AS q FROM s GROUP BY 1),
 r AS (SELECT *, sum(p) OVER (ORDER BY score DESC) AS rp FROM l) SELECT round(sum(q * (rp - p + p / 2.0)) / (sum(p)::DOUBLE * sum(q)), 6) AS roc_auc FROM r""")
def j2_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    return _rounded(metrics.roc_auc(docs.select(F.col("n_chars").alias("score"), F.col("quality").alias("label"))))


@query("j3_roc_points", with_profile(SCORED + """SELECT model, score AS threshold, round(rq / aq, 6) AS fpr, round(rp / ap, 6) AS tpr FROM ladder
 UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM scored"""))
def j3(spark, sf):
    return _rounded(metrics.roc_points(scored(spark, sf), BY))


_CONF = """SELECT model, CAST(label AS INTEGER) AS label, CAST(prediction AS INTEGER) AS prediction, n, round(coalesce(n * 100 / nullif(t, 0), 0), 6) AS percent FROM (
 SELECT model, 1 AS label, 1 AS prediction, tp AS n, tp + fn AS t FROM outcome UNION ALL SELECT model, 1, 0, fn, tp + fn FROM outcome
 UNION ALL SELECT model, 0, 1, fp, fp + tn FROM outcome UNION ALL SELECT model, 0, 0, tn, fp + tn FROM outcome)"""


@query("j4_j6_confusion", with_profile(SCORED + _CONF))
def j4(spark, sf):
    return _rounded(metrics.confusion(scored(spark, sf), BY))


@query("j5_class_report", with_profile(SCORED + """, c AS (
 SELECT model, '1' AS class, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f, tp + fn AS support FROM outcome
 UNION ALL SELECT model, '0', coalesce(tn / nullif(tn + fn, 0), 0), coalesce(tn / nullif(tn + fp, 0), 0), coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0), tn + fp FROM outcome)
 SELECT model, class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM c
 UNION ALL SELECT model, 'macro', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM c GROUP BY model
 UNION ALL SELECT model, 'weighted', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM c GROUP BY model"""))
def j5(spark, sf):
    return _rounded(metrics.class_report(scored(spark, sf), BY))


@query("j7_comparison", with_profile(SCORED + """SELECT * FROM (SELECT model, 'ACCURACY' AS metric, round(accuracy, 6) AS score FROM metrics UNION ALL SELECT model, 'PRECISION', round(precision, 6) FROM metrics
 UNION ALL SELECT model, 'RECALL', round(recall, 6) FROM metrics UNION ALL SELECT model, 'F1', round(f1, 6) FROM metrics UNION ALL SELECT model, 'ROC_AUC', round(roc_auc, 6) FROM auc)"""))
def j7(spark, sf):
    return _rounded(metrics.comparison(metrics.evaluate(scored(spark, sf), BY)))


@query("j7_ranking", with_profile(SCORED + "SELECT model, round(f1, 6) AS f1 FROM metrics ORDER BY f1 DESC"))
def j7_ranking(spark, sf):
    return _rounded(metrics.ranking(metrics.classification_metrics(scored(spark, sf), BY)).select("model", "f1"))


@query("j8_precision_recall_points", with_profile(SCORED + "SELECT model, score AS threshold, round(rp / (rp + rq), 6) AS precision, round(rp / ap, 6) AS recall FROM ladder"))
def j8(spark, sf):
    return _rounded(metrics.precision_recall_points(scored(spark, sf), BY))


@query("j8_average_precision", with_profile(SCORED + "SELECT model, round(sum(p / ap * (rp / (rp + rq))), 6) AS average_precision FROM ladder GROUP BY 1"))
def j8_ap(spark, sf):
    return _rounded(metrics.average_precision(scored(spark, sf), BY))


@query("j9_overfit_gap", with_profile(SCORED + f""", side AS (SELECT "CustomerID", row_number() OVER (PARTITION BY "ChurnPlanted" ORDER BY {ORDER_SQL})
  <= round(count(*) OVER (PARTITION BY "ChurnPlanted") * 0.2) AS is_test FROM cp),
 m AS (SELECT model, is_test, avg((label = prediction)::INT) AS accuracy FROM scored JOIN side USING ("CustomerID") GROUP BY 1, 2)
 SELECT a.model, round(a.accuracy, 6) AS train_accuracy, round(b.accuracy, 6) AS validation_accuracy, round(a.accuracy - b.accuracy, 6) AS gap, a.accuracy - b.accuracy > 0.1 AS overfit
 FROM m a JOIN m b ON a.model = b.model AND NOT a.is_test AND b.is_test"""))
def j9(spark, sf):
    keys = stored(customer_profile(spark, sf).select("CustomerID", "ChurnPlanted"), "keys")
    side = split.with_side(keys, "ChurnPlanted", "CustomerID", order=key_order()).select("CustomerID", "is_test")
    both = scored(spark, sf).join(side, "CustomerID")
    return _rounded(metrics.overfit_gap(both.where("not is_test"), both.where("is_test")))


@query("j10_report_table", with_profile(SCORED + """SELECT model, printf('%.4f', round(accuracy, 4)) AS accuracy, printf('%.4f', round(precision, 4)) AS precision,
 printf('%.4f', round(recall, 4)) AS recall, printf('%.4f', round(f1, 4)) AS f1, printf('%.4f', round(roc_auc, 4)) AS roc_auc FROM metrics JOIN auc USING (model)"""))
def j10(spark, sf):
    return metrics.report_table(metrics.evaluate(scored(spark, sf), BY))


@query("i11_best_model", with_profile(SCORED + """SELECT model, round(f1, 6) AS f1 FROM metrics ORDER BY coalesce(f1, 0) DESC, model LIMIT 1"""))
def i11(spark, sf):
    table = metrics.classification_metrics(scored(spark, sf), BY)
    position = F.array_position(F.array(F.lit("coupons"), F.lit("orders"), F.lit("recency")), F.col("model"))
    return _rounded(metrics.best_model(table.withColumn("position", position)).select("model", "f1"))
