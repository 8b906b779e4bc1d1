"""URL filter, toxicity and mixing: exact parts by brute force, learned parts by held-out rows."""
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import mixing, queries, toxicity, url_filter

URLS = [
    None, "", "no scheme/at/all", "http://", "HTTP://Sub.Example.NET/en/1?x=1#y", "https://example.net/en", "https://example.net/en/", "https://notexample.com/de/1",
    "https://a.b.example.com/de/1", "https://example.com/DE/1", "x://y://z/a", "http://h?q/en/", "http://h#f", "ftp://org/fr/9", "https://fr.org/fr/", "https://fr.org/frx",
    "http://ÄX.net/a b\nc?d", "https://net", "https://net/",
]


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = []
    for rule in queries.URL_RULES:
        owner, _, tail = rule.partition("/")
        if (host == owner or host.endswith("." + owner)) and path.startswith("/" + tail):
            fits.append(rule)
    return host, path, max(fits, key=len) if fits else None


def test_rules_decide(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[4]), (4, URLS[4])], "page_id long, url string").withColumn("rule", F.lit("x")).withColumn("host", F.lit(1))
    got = url_filter.judge(pages, queries.URL_RULES, url_filter.UrlModel(None, 0.9, None)).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule = brute_rule(URLS[4 if r.page_id is None else r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (queries.URL_RULES[rule] if rule else "block")
    assert url_filter.judge(pages.limit(0), {}, url_filter.UrlModel(None, 0.0, None)).count() == 0
    with pytest.raises(ValueError):
        url_filter.rule_for(F.lit(""), F.lit(""), {f"h{i}/": "block" for i in range(1001)})


def test_trees_learn_shape_and_suffix(spark):
    rows = spark.range(3000).selectExpr("id", "id % 3 = 0 as bad", "id % 7 as s").selectExpr(
        "id", "concat('https://h', id, if(bad, '.spam', '.good'), s, '.org/', if(bad, concat('a/b/c?x=', id, '&y=', id * 7919), 'page')) url", "cast(bad as int) blocked")
    train, test = rows.where("id % 5 < 4"), rows.where("id % 5 = 4")
    model = url_filter.fit(train, trees=8)
    got = url_filter.judge(test.withColumnRenamed("id", "page_id"), {}, model).join(test.withColumnRenamed("id", "page_id"), "page_id")
    assert got.where("(verdict = 'block') <> (blocked = 1)").count() < 10
    unknown = spark.createDataFrame([(1, "https://new.example.xyz/"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_filter.judge(unknown, {}, model).collect()} <= {"allow", "block"}


def test_labels_without_signal_give_no_blocks(spark):
    """A share drawn from a row's own label would let the trees read it."""
    rows = spark.range(2000).selectExpr("concat('https://h', id % 40, '.example.org/', id) url", "cast(pmod(xxhash64(id), 5) = 0 as int) blocked")
    got = url_filter.judge(rows.selectExpr("1 page_id", "url"), {}, url_filter.fit(rows, trees=8))
    assert got.where("verdict = 'block'").count() < 100


def test_one_class_of_urls(spark):
    rows = spark.createDataFrame([("http://a.b/", 1), ("http://c.d/", 1)], "url string, blocked int")
    assert url_filter.fit(rows).trees is None and url_filter.fit(rows).base == 1.0
    assert url_filter.fit(rows.limit(0)).base == 0.0


def pair_rows(n=3000, seed=3):
    """Toxic exactly if an insult and a group are named together."""
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b = r.random() < 0.5, r.random() < 0.5
        words = [f"word{j}" for j in r.integers(0, 60, 12)] + ["insultus"] * a + ["gruppen"] * b
        r.shuffle(words)
        rows.append((i, " ".join(words) + ".", int(a and b)))
    return rows


def test_pairs_of_terms_are_learned(spark):
    docs = spark.createDataFrame(pair_rows(), "doc_id long, text string, toxic int")
    scorer = toxicity.fit_documents(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), rounds=200)
    got = scorer.score(docs).where(toxicity.held_out("doc_id")).collect()
    right = sum(r.predicted == r.toxic for r in got)
    assert len(got) > 900 and right > 0.97 * len(got)


def test_a_pair_without_marginals_is_learned(spark):
    """Toxic if just one of two terms is there: each alone tells nothing."""
    rows = [(i, t, int(("insultus" in t) != ("gruppen" in t))) for i, t, _ in pair_rows(4000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scorer = toxicity.fit_documents(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), rounds=200)
    got = scorer.score(docs).where(toxicity.held_out("doc_id")).collect()
    assert sum(r.predicted == r.toxic for r in got) > 0.95 * len(got)


def test_held_out_labels_are_not_learned(spark, hard):
    docs = spark.createDataFrame(pair_rows(600, 5), "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic"))
    one, two = (toxicity.fit_documents(docs.select("doc_id", "text"), t, rounds=15) for t in (docs.select("doc_id", "toxic"), labels))
    assert one.chosen == two.chosen
    ids = [(i, zlib.crc32(str(i).encode()) % 3 == 1) for i in range(-5, 200)]
    got = spark.createDataFrame(ids, "k long, want boolean").withColumn("got", toxicity.held_out("k"))
    assert got.where("want <> got").count() == 0


def test_every_row_gets_a_score(spark, docs, hard, empty):
    train = spark.createDataFrame([(i, ("bad scum " if i % 2 else "fine day ") + f"t{i}", i % 2) for i in range(300)] + [(1000, None, 1), (1001, "", None)], "doc_id long, text string, toxic int")
    scorer = toxicity.fit(train.select("text", "toxic"), rounds=20)
    got = scorer.score(docs)
    assert set(got.columns) == set(docs.columns)  # score and predicted were there already
    rows = got.collect()
    assert len(rows) == len(hard) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert scorer.score(empty).count() == 0
    for t in (train.limit(0), train.where("toxic = 1")):
        assert toxicity.fit(t.select("text", "toxic")).score(docs).count() == len(hard)


def brute_rake(cells, targets, rounds=200):
    w = cells / cells.sum()
    for _ in range(rounds):
        for d, t in enumerate(targets):
            axes = tuple(a for a in range(3) if a != d)
            s = w.sum(axis=axes, keepdims=True)
            w = w * np.divide(t.reshape([-1 if a == d else 1 for a in range(3)]), s, out=np.ones_like(s), where=s > 0)
    return w


def test_margins_meet_their_targets(spark):
    r = np.random.default_rng(0)
    cells = r.integers(0, 500, (5, 3, 4))
    cells[2, 1, :2] = 0
    table = spark.createDataFrame([(f"s{i}", f"l{j}", f"t{k}", int(cells[i, j, k])) for i in range(5) for j in range(3) for k in range(4)], "source string, lang string, topic string, tokens long")
    want = [np.full(5, 0.2), np.array([0.5, 0.3, 0.2]), np.array([0.4, 0.3, 0.2, 0.1])]
    targets = {"source": 0.0, "lang": {"l0": 5, "l1": 3, "l2": 2}, "topic": {f"t{k}": v for k, v in enumerate(want[2])}}
    rows, share = mixing.rake(table, targets, share=0.1, tolerance=1e-8, least_share=0.1)
    best = brute_rake(cells.astype(float), want)
    assert share == 0.1
    for row in rows.collect():
        assert row.weight / (0.1 * cells.sum()) == pytest.approx(best[int(row.source[1]), int(row.lang[1]), int(row.topic[1])], abs=1e-6)


@pytest.mark.parametrize("share", [0.3])
def test_margins_of_the_sample_meet_their_targets(spark, share):
    """No cell gives more tokens than it has, and yet the margins hold; the share is lowered where it has to be."""
    r = np.random.default_rng(7)
    cells = [(f"s{i}", f"l{j}", f"t{k}", int(r.integers(1, 400) * (10 if i == 0 else 1))) for i in range(6) for j in range(3) for k in range(3)]
    table = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    targets = {"source": 0.6, "lang": {"l0": 0.5, "l1": 0.3, "l2": 0.2}, "topic": 0.5}
    rows, got = mixing.rake(table, targets, share=share, tolerance=1e-4, least_share=0.2)
    lines, total = rows.collect(), sum(c[3] for c in cells)
    assert 0.2 < got <= share and len(lines) == len(cells)
    assert all(0 <= x.weight <= x.tokens * (1 + 1e-9) for x in lines)
    for d, shares in mixing.target_shares(table, targets).items():
        for x in shares.collect():
            assert sum(y.weight for y in lines if y[d] == x[d]) / (got * total) == pytest.approx(x.target, abs=1e-4)


def test_contradictory_targets_are_an_error(spark):
    table = spark.createDataFrame([("a", "x", "t", 100), ("b", "y", "t", 100)], "source string, lang string, topic string, tokens long")
    with pytest.raises(ValueError):
        mixing.rake(table, {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}}, least_share=0.55, most_rounds=5)


def test_raking_plans_do_not_grow(spark, monkeypatch):
    """A round is written before the next; a share that the margins can't have is given up long before all rounds are done."""
    plans, made = [], mixing.stored

    def spied(df, label="stage"):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString().count("Window ["))
        return made(df, label)

    monkeypatch.setattr(mixing, "stored", spied)
    table = spark.createDataFrame([("a", "x", "t", 100), ("b", "y", "t", 100)], "source string, lang string, topic string, tokens long")
    with pytest.raises(ValueError):
        mixing.rake(table, {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}}, least_share=0.55)
    assert max(plans) <= 9 and sum(p > 0 for p in plans) == 10
    assert not mixing._hopeless([0.5], 1e-5, 3) and not mixing._hopeless([1e-2, 1e-3], 1e-5, 2) and mixing._hopeless([1e-2, 9e-3], 1e-5, 3)


def test_sample(docs, hard, empty):
    options = dict(targets={"source": 0.5, "lang": {"en": 0.5}}, share=0.6)
    got = mixing.sample(docs, **options).collect()
    assert len(got) == len(hard)
    share = mixing.calibrate(docs, **options)[2]
    assert 0 < share <= 0.6 and sum(r.n_tokens * r.probability for r in got) == pytest.approx(share * sum(r.n_tokens for r in got), rel=1e-4)
    assert all(0 <= r.probability <= 1 for r in got)
    kept = mixing.draw(docs, **options)
    assert kept.columns == docs.columns and kept.count() == sum(r.sampled for r in got)
    named = mixing.sample(docs, topic="topic", **options)
    assert {r.topic for r in named.collect()} == {"x"}
    assert mixing.sample(empty, **options).count() == 0 and mixing.draw(empty, **options).count() == 0
    assert all(r.sampled for r in mixing.sample(docs, {}, share=1.0).collect())


def test_topic_is_the_fullest_field(spark):
    import collections

    texts = ["", "tiny ones", "alphabet zeppelin bananas cabbages elephant giraffes alphabet"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    field = {r.w: r.f for r in rows.select(F.explode(F.split("t", " ")).alias("w")).select("w", F.pmod(F.xxhash64("w"), F.lit(6)).alias("f")).collect()}
    for r in rows.select("t", mixing.topic_of(F.col("t")).alias("x")).collect():
        n = collections.Counter(field[w] for w in r.t.split() if len(w) >= 6)
        assert int(r.x) == min(range(6), key=lambda k: (-n[k], k))


def test_the_bound_on_labelled_rows(spark):
    docs = spark.createDataFrame(pair_rows(900, 8), "doc_id long, text string, toxic int")
    scorer = toxicity.fit_documents(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), most_rows=300, rounds=30)
    assert scorer.score(docs).count() == 900
