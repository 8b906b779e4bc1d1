"""Batch scoring of new rows."""

from ..operators import flows, models, split, transforms
from ..plans.profile import customer_profile, with_profile
from ..session import stored
from . import query

LABEL, KEY = "ChurnPlanted", "CustomerID"


@query("m1_score_table")
def m1(spark, sf):
    cp = stored(customer_profile(spark, sf).drop("Churn"), "profile")
    train, new = split.stratified_split(cp, LABEL, KEY)
    chain = transforms.preparation(label=LABEL).fit(train)
    ready = chain.transform(train)
    columns = [n for n, t in ready.dtypes if n not in (KEY, LABEL) and t in ("double", "int", "bigint")]
    model = models.train(ready, "decision_tree", columns, LABEL, {"max_depth": 6})
    return flows.score(new, chain, model)


@query("m3_dense_codes", with_profile("""
, k AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT "PreferedOrderCat" AS v FROM cp WHERE "PreferedOrderCat" IS NOT NULL)),
d AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT "PreferredLoginDevice" AS v FROM cp))
SELECT "CustomerID", CAST(coalesce(k.code, -1) AS INTEGER) AS "PreferedOrderCat", CAST(d.code AS INTEGER) AS "PreferredLoginDevice"
FROM cp LEFT JOIN k ON k.v = "PreferedOrderCat" LEFT JOIN d ON d.v = "PreferredLoginDevice" """))
def m3(spark, sf):
    df = stored(customer_profile(spark, sf).select("CustomerID", "PreferedOrderCat", "PreferredLoginDevice"), "profile")
    return transforms.dense_codes(df, ["PreferedOrderCat", "PreferredLoginDevice"])
