"""The plan primitives against brute force, with hot values and tiny buffers."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyforge.operators import rebalance, split
from tallyforge.catalog import load_all
from tallyforge.plans import neighbours
from tallyforge.plans.quantiles import exact_quantiles, values_at_ranks
from tallyforge.plans.running import running_totals


@pytest.fixture(scope="module")
def numbers(spark):
    r = np.random.default_rng(1)
    n = 6000
    pdf = pd.DataFrame({"k": np.arange(n), "smooth": r.normal(size=n), "few": r.integers(0, 4, n).astype(float)})
    pdf["hot"] = np.where(np.arange(n) % 3 == 0, 7.0, r.normal(7, 3, n))
    pdf["gaps"] = np.where(r.random(n) < 0.6, np.nan, r.exponential(size=n))
    df = spark.createDataFrame(pdf).withColumn("gaps", F.when(~F.isnan("gaps"), F.col("gaps"))).withColumn("empty", F.lit(None).cast("double"))
    return pdf, df.repartition(7).persist()


@pytest.mark.parametrize("buffer_rows", [20, 500, 100_000])
def test_quantiles_are_exact_for_any_buffer(numbers, buffer_rows):
    pdf, df = numbers
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_quantiles(df, ["smooth", "few", "hot", "gaps", "empty"], probs, buffer_rows=buffer_rows)
    for n in ("smooth", "few", "hot", "gaps"):
        for p in probs:
            assert found[n][p] == pytest.approx(pdf[n].quantile(p), abs=1e-12)
    assert found["empty"] == {p: None for p in probs}


def test_ranks_at_the_border_of_two_hot_values(spark):
    df = spark.range(4000).select((F.col("id") >= 3000).cast("double").alias("x"))
    _, found = values_at_ranks(df, {"x": (F.col("x"), [0, 2998, 2999, 3000, 3001, 3999])}, buffer_rows=5)["x"]
    assert found == {0: 0.0, 2998: 0.0, 2999: 0.0, 3000: 1.0, 3001: 1.0, 3999: 1.0}


def test_ranks_with_a_coarse_sketch(numbers):
    pdf, df = numbers
    ordered = np.sort(pdf["smooth"].to_numpy())
    ranks = [0, 1, 17, 2999, 5998, 5999, 6000]
    n, found = values_at_ranks(df, {"x": (F.col("smooth"), ranks)}, buffer_rows=10, accuracy=50)["x"]
    assert n == 6000 and found == {r: ordered[r] for r in ranks if r < 6000}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [["g"], []])
def test_running_totals_equal_a_plain_window(spark, numbers, descending, by):
    _, df = numbers
    steps = df.withColumn("g", F.col("k") % 3).groupBy(*by, "hot").agg(F.count(F.lit(1)).alias("a"), F.sum("few").alias("b"))
    got = running_totals(steps, by, "hot", ["a", "b"], descending)
    order = F.col("hot").desc() if descending else F.col("hot")
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    want = steps.select(*by, "hot", F.sum("a").over(w).alias("wa"), F.sum("b").over(w).alias("wb"))
    both = got.join(want, [*by, "hot"])
    assert both.count() == steps.count()
    assert both.where("run_a <> wa or abs(run_b - wb) > 1e-6").count() == 0


def test_running_totals_of_many_groups_and_a_hot_one(spark):
    """10,000 small groups, a null one, and one with a third of all lines, whose ranges are several."""
    small = spark.range(30_000).select((F.col("id") % 10_000).cast("string").alias("g"), F.col("id").cast("double").alias("v"), F.lit(1).alias("a"))
    hot = spark.range(15_000).select(F.lit("hot").alias("g"), (F.col("id") * 0.5).alias("v"), F.lit(2).alias("a"))
    none = spark.range(7).select(F.lit(None).cast("string").alias("g"), F.col("id").cast("double").alias("v"), F.lit(3).alias("a"))
    got = running_totals(small.unionAll(hot).unionAll(none), ["g"], "v", ["a"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "ResolvedHint" not in plan and "strategy=broadcast" not in plan
    checks = got.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("run_a").alias("top"), F.max("all_a").alias("all"), F.count_distinct("run_a").alias("different")).collect()
    assert len(checks) == 10_002
    for r in checks:
        n, each = (15_000, 2) if r["g"] == "hot" else (7, 3) if r["g"] is None else (3, 1)
        assert (r["n"], r["top"], r["all"], r["different"]) == (n, n * each, n * each, n)


def _brute(x, keys, k):
    out = []
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    for i in range(len(x)):
        order = sorted((d2[i, j], keys[j]) for j in range(len(x)) if j != i)
        out += [(keys[i], nb, d) for d, nb in order[:k]]
    return sorted(out)


@pytest.mark.parametrize("shape", ["round", "lattice", "binary"])
def test_neighbours_over_many_blocks(spark, shape, monkeypatch):
    monkeypatch.setattr(neighbours, "VISITORS", 40)
    r = np.random.default_rng(5)
    x = {"round": r.normal(size=(400, 3)), "lattice": r.integers(0, 9, (400, 3)).astype(float), "binary": r.integers(0, 2, (400, 10)).astype(float)}[shape]
    x = np.unique(x, axis=0)
    keys = r.permutation(len(x)).tolist()
    df = spark.createDataFrame([(k, v.tolist()) for k, v in zip(keys, x)], "id bigint, vec array<double>")
    got = sorted((r_["id"], r_["neighbour"], r_["distance2"]) for r_ in neighbours.nearest(df, 4, block_rows=25).collect())
    want = _brute(x, keys, 4)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]


def test_probes_visit_a_constant_number_of_leaves(spark, monkeypatch):
    """Lines of visits per vector do not grow with the table, leaves keep their size, and few neighbours are missed."""
    seen = {}
    plain = neighbours.stored
    def keep(df, label):
        seen[label] = plain(df, label)
        return seen[label]

    monkeypatch.setattr(neighbours, "stored", keep)
    monkeypatch.setattr(neighbours, "SAMPLE", 1000)
    for n in (1500, 6000):
        r = np.random.default_rng(n)
        x = r.normal(size=(n, 8)) * [5, 3, 2, 1, 0.3, 0.2, 0.1, 0.1] + r.integers(0, 3, (n, 1)) * 4
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vec array<double>").repartition(4)
        got = {(r_["id"], r_["neighbour"]) for r_ in neighbours.nearest(df, 5, block_rows=60, probes=12).collect()}
        want = {(a, b) for a, b, _ in _brute(x, list(range(n)), 5)}
        assert len(got & want) >= 0.9 * len(want)
        assert seen["visits"].count() == 12 * n
        assert seen["blocks"].groupBy("block").count().agg(F.max("count")).first()[0] <= 120
        exact = {(r_["id"], r_["neighbour"]) for r_ in neighbours.nearest(df, 5, block_rows=60).collect()} if n == 1500 else want
        assert exact == want


def test_exact_search_in_noise_has_few_lines(spark, monkeypatch):
    """Where every vector reaches every leaf, the leaves grow instead of the lines of visits."""
    seen = {}
    plain = neighbours.stored
    def keep(df, label):
        seen[label] = plain(df, label)
        return seen[label]

    monkeypatch.setattr(neighbours, "stored", keep)
    n = 900
    x = np.random.default_rng(2).normal(size=(n, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vec array<double>").repartition(4)
    got = sorted((r["id"], r["neighbour"]) for r in neighbours.nearest(df, 2, block_rows=4).collect())
    assert got == [(a, b) for a, b, _ in sorted(_brute(x, list(range(n)), 2), key=lambda r: (r[0], r[1]))]
    assert seen["visits"].count() <= 64 * n

def test_probes_out_of_reach_are_not_visited(spark, monkeypatch):
    """Of the leaves that are open to a vector only those are searched that its nearest so far lets in; the answer is that of all."""
    seen, plain, search = {}, neighbours.stored, neighbours._visited

    def keep(df, label):
        seen[label] = plain(df, label)
        return seen[label]

    def lines(guests, blocked, rooms, *rest):
        seen["lines"] = guests.count()
        return search(guests, blocked, rooms, *rest)

    monkeypatch.setattr(neighbours, "stored", keep)
    monkeypatch.setattr(neighbours, "_visited", lines)
    n = 4000
    x = np.random.default_rng(6).normal(size=(n, 2))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vec array<double>").repartition(4)
    got = sorted((r["id"], r["neighbour"], r["distance2"]) for r in neighbours.nearest(df, 2, block_rows=80, probes=12).collect())
    assert [r[:2] for r in got] == [r[:2] for r in sorted(_brute(x, list(range(n)), 2))]
    assert seen["visits"].count() == 12 * n
    assert seen["lines"] < 3 * n


def test_leaves_are_cut_where_vectors_spread():
    """A direction a thousand times as wide as the others is cut until the leaves are as narrow in it."""
    x = np.random.default_rng(7).normal(size=(4000, 3)) * [1000, 1, 1]
    tree = neighbours._Tree(np.eye(3))
    tree.grow(x, 20)
    at = tree.leaf(x)
    widths = [np.ptp(x[at == n], axis=0) for n in np.unique(at)]
    assert np.median([w[0] for w in widths]) < 20  # 4,000 vectors cut in turn by the three directions: over 500


def test_probed_leaves_have_the_smallest_bounds():
    r = np.random.default_rng(9)
    x = r.normal(size=(600, 3))
    tree = neighbours._Tree(np.eye(3))
    tree.grow(x, 20)
    at = tree.leaf(x)
    leaves, bounds = tree.probed(x[:50], 10_000)
    want = sorted(n for n in range(tree.size) if n not in tree.splits)
    low = {n: np.full(3, -np.inf) for n in range(tree.size)}
    high = {n: np.full(3, np.inf) for n in range(tree.size)}
    for node in sorted(tree.splits):
        way, edges, first = tree.splits[node]
        ends = [low[node][way], *edges, high[node][way]]
        for i in range(len(edges) + 1):
            low[first + i], high[first + i] = low[node].copy(), high[node].copy()
            low[first + i][way], high[first + i][way] = max(low[node][way], ends[i]), min(high[node][way], ends[i + 1])
    for i in range(600):
        assert (low[at[i]] < x[i]).all() and (x[i] <= high[at[i]]).all()
    for i in range(50):
        there = np.isfinite(bounds[i])
        assert sorted(leaves[i, there].tolist()) == want
        for n, b in zip(leaves[i, there].tolist(), bounds[i, there].tolist()):
            gap = np.maximum(np.maximum(low[n] - x[i], x[i] - high[n]), 0)
            assert b == pytest.approx((gap**2).sum(), abs=1e-9)


@pytest.mark.parametrize("k", [1, 3])
def test_products_far_from_zero_lose_no_neighbour(k):
    """Differences far below the rounding of the products, ties, and vectors without a distance."""
    r = np.random.default_rng(4)
    x = np.concatenate([r.integers(0, 3, (60, 4)) * 1e-3, r.normal(size=(60, 4)) * 1e-6, r.normal(size=(5, 4)) * 1e6]) + 1e5
    ids = r.permutation(len(x) + 2)
    x = np.concatenate([x, [[np.inf, 0, 0, 0], [np.nan, 0, 0, 0]]])
    at, near, d2 = neighbours._k_best(x, ids, x, ids, k)
    want = _brute(x[:-2], ids[:-2].tolist(), k)
    assert sorted(zip(ids[at].tolist(), near.tolist(), d2.tolist())) == want


def test_oversampling_balances_and_stays_between_parents(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(220, 2))
    x[:70] = [1.5, 2.5]  # a third of the rows are copies
    pdf = pd.DataFrame({"k": np.arange(220), "a": x[:, 0], "b": x[:, 1], "y": (np.arange(220) % 4 == 0).astype("int32")})
    df = spark.createDataFrame(pdf)
    out = rebalance.oversample(df, ["a", "b"], "y", "k", block_rows=20).toPandas()
    assert (out["y"].value_counts() == 165).all()
    assert out["k"].is_unique and (out["k"] < 0).sum() == 110
    minority = pdf[pdf["y"] == 1][["a", "b"]].to_numpy()
    for row in out[out["k"] < 0][["a", "b"]].to_numpy():
        gap = minority - row
        far = np.linalg.norm(gap, axis=1)
        detour = far[:, None] + far[None, :] - np.linalg.norm(minority[:, None] - minority[None, :], axis=2)
        assert detour.min() < 1e-9
    again = rebalance.oversample(df.repartition(5), ["a", "b"], "y", "k", block_rows=20).toPandas()
    pd.testing.assert_frame_equal(out.sort_values("k").reset_index(drop=True), again.sort_values("k").reset_index(drop=True))


def test_tomek_links_by_brute_force(spark):
    r = np.random.default_rng(8)
    x = r.integers(0, 12, (200, 2)).astype(float)
    x[:60] = [3.0, 4.0]
    y = r.integers(0, 2, 200)
    nearest = {}
    for i in range(200):
        d2 = ((x - x[i]) ** 2).sum(axis=1)
        nearest[i] = min((d2[j], j) for j in range(200) if j != i)[1]
    want = sorted((a, b) for a, b in nearest.items() if a < b and nearest[b] == a and y[a] != y[b])
    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(200), "a": x[:, 0], "b": x[:, 1], "y": y}))
    links = rebalance.tomek_links(df, ["a", "b"], "y", "k", block_rows=15)
    assert sorted((r_["a"], r_["b"]) for r_ in links.collect()) == want
    rest = rebalance.drop_tomek(df, ["a", "b"], "y", "k", block_rows=15)
    assert rest.count() == 200 - 2 * len(want)


def test_tomek_query_finds_all_links_over_many_leaves(spark, monkeypatch):
    plain, sf = rebalance.nearest, "/root/testdata/sf0.01"
    monkeypatch.setattr(rebalance, "nearest", lambda points, k, block_rows, probes: plain(points, k, 4, probes))
    rows = sorted((r["vec_id"], r["label"] % 2, r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect())
    side, best = {k: y for k, y, _ in rows}, {a: b for a, b, _ in _brute(np.array([v for *_, v in rows]), [k for k, *_ in rows], 1)}
    want = sorted((a, b) for a, b in best.items() if a < b and best[b] == a and side[a] != side[b])
    assert want and sorted((r["a"], r["b"]) for r in load_all()[0]["e5_tomek_links"](spark, sf).collect()) == want


def test_oversampling_then_cleaning_is_exact(spark, monkeypatch):
    """Noise that reaches far more than sixteen leaves gives the rows of a search that compares all pairs, synthetic and given."""
    x = np.random.default_rng(12).normal(size=(900, 8))
    names = [f"v{i}" for i in range(8)]
    df = spark.createDataFrame([(i, int(i % 4 == 0), *v.tolist()) for i, v in enumerate(x)], f"k bigint, y int, {', '.join(f'{n} double' for n in names)}")

    def rows():
        return sorted(tuple(r) for r in rebalance.oversample_then_clean(df, names, "y", "k", block_rows=4).collect())

    def all_pairs(points, k, *_):
        known = points.select("id", "vec").collect()
        found = _brute(np.array([r["vec"] for r in known]), [r["id"] for r in known], k)
        return spark.createDataFrame([(a, b, float(d)) for a, b, d in found], "id bigint, neighbour bigint, distance2 double")

    got = rows()
    monkeypatch.setattr(rebalance, "nearest", all_pairs)
    want = rows()
    assert len(want) < 1350 and any(r[0] < 0 for r in want)  # links were found among 675 rows of each class
    assert got == want


def test_split_sizes_are_exact_and_repeatable(spark, raw):
    train, test = split.stratified_split(raw, "Churn", "CustomerID")
    whole = {r["Churn"]: r["count"] for r in raw.groupBy("Churn").count().collect()}
    for r in test.groupBy("Churn").count().collect():
        assert r["count"] == split.half_up(whole[r["Churn"]] * 0.2)
    assert train.count() + test.count() == 100
    other = split.stratified_split(raw.repartition(9), "Churn", "CustomerID")[1]
    assert {r[0] for r in test.select("CustomerID").collect()} == {r[0] for r in other.select("CustomerID").collect()}
    with pytest.raises(ValueError):
        split.stratified_split(raw.drop("Churn"), "Churn", "CustomerID")


def test_folds_hold_every_class(raw):
    counts = split.with_folds(raw, "Churn", "CustomerID", 5).groupBy("fold", "Churn").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in counts if r["Churn"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_samples(raw):
    assert split.sample_rows(raw, 17, "CustomerID").count() == 17
    assert split.sample_rows(raw, 500, "CustomerID").count() == 100
    assert 20 <= split.sample_fraction(raw, 0.5, "CustomerID").count() <= 80
