"""k nearest neighbours as a partitioned join over a tree of projections.

Equal vectors are merged first, so copies cost nothing. The distinct vectors are turned onto the principal directions of a
bounded sample, and a tree cuts them by quantiles, one direction after the other, into leaves of a fixed size; only the
number of leaves grows with the data. The slabs that lead to a leaf bound the distance to all its vectors from below.
With ``probes`` the leaves with the smallest bounds are open to a vector: a constant number, whatever the size of the table,
and an approximate answer. Without it, every leaf is. A vector looks in its own leaf first and then visits the open leaves
that its k-th distance so far reaches; the others have nothing nearer.
For that the leaves grow with the table, up to a size that a task holds, so that a vector which reaches all of them (noise in
many dimensions) has few lines to be sent; only beyond that size do its lines grow, and the pairs are n x n in any case.
Distances come from one matrix product, whose rounding error is bounded; pairs within it are measured again by their
differences. No pair leaves a task unless it is among the k best of its leaf.
"""
from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import stored

# the helpers below travel to the executors with the task: the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 2_000  # vectors aimed at in a leaf
PROBES = 16  # leaves that a vector visits unless the caller asks for the exact answer
VISITORS = 5_000  # vectors that visit a leaf in one task, or as many as the leaf holds
EXACT_LEAVES = 16  # leaves aimed at in an exact search, while they hold no more than
EXACT_ROWS = 20_000
CELLS = 1_000_000  # numbers in one working array of a task
PAIRS = 1 << 17  # distances in one working array: it stays in the cache of a core
FAN_OUT = 4
SAMPLE = 20_000  # vectors the directions and the top of the tree are fitted on
LEAST = 20  # sampled vectors in a leaf of the top
DIRECTIONS = 32  # directions the tree may use


def merge_equal(df, key, vector):
    """One line per distinct vector: smallest key and number of rows."""
    return df.groupBy(F.col(vector).alias("vec")).agg(F.min(key).alias("id"), F.count(F.lit(1)).alias("copies"))


def _matrix(vectors):
    """The lines of an Arrow column of lists, which are equally long."""
    parts = vectors.chunks if isinstance(vectors, pa.ChunkedArray) else [vectors]
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in parts if len(c)]
    return np.concatenate(flat).reshape(len(vectors), -1) if flat else np.empty((0, 0))


def _lists(values, ends):
    """An Arrow column of lists: ``values`` cut at ``ends``."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values))


class _Tree:
    """node -> (direction, edges, first child); nodes without an entry are leaves. ``axes`` has orthonormal columns.

    A node is cut in the direction of its widest spread, else bounds in the wide directions would let every vector in.
    """

    def __init__(self, axes, spread=None):
        self.axes, self.splits, self.size = axes, {}, 1
        self.spread = {0: np.ones(axes.shape[1]) if spread is None else spread}

    def turned(self, vectors):
        return _matrix(vectors) @ self.axes

    def direction(self, node):
        return int(self.spread[node].argmax())

    def pass_over(self, node):
        """The node can't be cut in its direction: take the next one, if there is one."""
        self.spread[node] = self.spread[node].copy()
        self.spread[node][self.direction(node)] = -1.0
        return self.spread[node].max() >= 0

    def split(self, node, edges):
        children = range(self.size, self.size + len(edges) + 1)
        way, narrower = self.direction(node), self.spread[node].copy()
        narrower[way] /= FAN_OUT
        self.splits[node] = (way, np.asarray(edges, dtype=float), self.size)
        self.spread.update(dict.fromkeys(children, narrower))
        self.size += len(children)
        return children

    def grow(self, x, leaf):
        """Split until no leaf has over ``leaf`` of the vectors ``x``."""
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if len(rows) > 1:
                self.spread[node] = x[rows].std(axis=0)
            if len(rows) > leaf:
                v = x[rows, self.direction(node)]
                edges = np.unique(np.quantile(v, np.arange(1, FAN_OUT) / FAN_OUT))
                edges = edges[edges < v.max()]
                if len(edges):
                    at = np.searchsorted(edges, v, side="left")
                    todo += [(child, rows[at == i]) for i, child in enumerate(self.split(node, edges))]

    def table(self):
        """The splits as arrays over the nodes: is inner, direction, first child, ends of the children's slabs (inf where there is none)."""
        inner, way, first = np.zeros(self.size, bool), np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        ends = np.full((self.size, FAN_OUT + 1), np.inf)
        ends[:, 0] = -np.inf
        for node, (direction, edges, child) in self.splits.items():
            inner[node], way[node], first[node] = True, direction, child
            ends[node, 1 : len(edges) + 1] = edges
        return inner, way, first, ends

    def leaf(self, x):
        """The leaf of each line of ``x``."""
        inner, way, first, ends = self.table()
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x) if inner[0] else 0)
        while len(rows):
            node = at[rows]
            at[rows] = first[node] + (x[rows, way[node], None] > ends[node, 1:]).sum(1)
            rows = rows[inner[at[rows]]]
        return at

    def probed(self, x, probes):
        """(leaves, bounds), each lines of ``x`` by at most ``probes``: the leaves of smallest bound; where the bound is infinite there is none.

        Level by level the bound of a child is the squared distance to its slabs, and only ``probes`` inner nodes of the
        smallest bounds go on.
        """
        inner, way, first, ends = self.table()
        rows = np.arange(len(x))[:, None]
        nodes, bounds, gaps = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1)), np.zeros((len(x), 1, self.axes.shape[1]))
        if not inner[0]:
            return nodes, bounds
        x = np.where(np.isfinite(x), x, 0.0)
        leaves, done = nodes[:, :0], bounds[:, :0]
        while np.isfinite(bounds).any():
            turn, slab = way[nodes], ends[nodes]
            v, old = x[rows, turn, None], np.take_along_axis(gaps, turn[..., None], 2)
            gap = np.maximum(old, np.maximum(slab[..., :-1] - v, v - slab[..., 1:]))
            bound = (bounds[..., None] - old**2 + gap**2).reshape(len(x), -1)
            child = np.minimum(first[nodes][..., None] + np.arange(FAN_OUT), self.size - 1).reshape(len(x), -1)
            on = inner[child]
            leaves, done = np.hstack([leaves, child]), np.hstack([done, np.where(on, np.inf, bound)])
            best = _least(done, probes)
            leaves, done = leaves[rows, best], done[rows, best]
            bound = np.where(on, bound, np.inf)
            best = _least(bound, probes)
            bounds, parent = bound[rows, best], best // FAN_OUT
            open_ = np.isfinite(bounds)
            nodes, gap = np.where(open_, child[rows, best], 0), np.where(open_, gap.reshape(len(x), -1)[rows, best], 0.0)
            gaps = gaps[rows, parent]
            np.put_along_axis(gaps, turn[rows, parent][..., None], gap[..., None], 2)
        return leaves, done

    def reached(self, x, reach):
        """(lines of ``x``, leaves): for each line all leaves with a bound up to ``reach``, its squared distance."""
        done_rows, done_leaves = [], []
        rows, nodes, gaps = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros((len(x), self.axes.shape[1]))
        while len(rows):
            inner = np.array([n in self.splits for n in nodes.tolist()], bool)
            done_rows.append(rows[~inner])
            done_leaves.append(nodes[~inner])
            parts = []
            for node in np.unique(nodes[inner]).tolist():
                direction, edges, first = self.splits[node]
                mine = np.flatnonzero(nodes == node)
                v = x[rows[mine], direction]
                ends = np.concatenate([[-np.inf], edges, [np.inf]])
                for i in range(len(edges) + 1):
                    g = gaps[mine].copy()
                    g[:, direction] = np.maximum(g[:, direction], np.maximum(np.maximum(ends[i] - v, v - ends[i + 1]), 0.0))
                    parts.append((rows[mine], np.full(len(mine), first + i), g))
            if not parts:
                break
            rows, nodes, gaps = (np.concatenate([p[i] for p in parts]) for i in range(3))
            keep = (gaps**2).sum(1) <= _slack(reach[rows])
            rows, nodes, gaps = rows[keep], nodes[keep], gaps[keep]
        return np.concatenate(done_rows), np.concatenate(done_leaves)


def _slack(reach):
    return reach * (1 + 1e-9) + 1e-12  # so that rounding never hides a tie


def _least(bounds, n):
    """Places of the ``n`` smallest of each line."""
    if bounds.shape[1] <= n:
        return np.broadcast_to(np.arange(bounds.shape[1]), bounds.shape)
    return np.argpartition(bounds, n - 1, axis=1)[:, :n]


def _fit_tree(points, n, block_rows):
    """The tree over ``points``: its top from a bounded sample, and further levels where leaves still hold too many vectors."""
    share = min(1.0, SAMPLE / n)
    drawn = points.select("vec").where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < math.ceil(share * (1 << 30))).limit(2 * SAMPLE)
    sample = np.array([r["vec"] for r in drawn.collect()], dtype=float)
    if not len(sample):
        sample = np.array([points.first()["vec"]], dtype=float)
    spread = np.cov(sample.T).reshape(sample.shape[1], -1) if len(sample) > 1 else np.eye(sample.shape[1])
    tree = _Tree(np.linalg.eigh(spread)[1][:, ::-1][:, :DIRECTIONS])
    tree.grow(sample @ tree.axes, max(LEAST if share < 1 else 1, int(block_rows * share)))
    probs = [i / FAN_OUT for i in range(1, FAN_OUT)]
    whole = set()
    while True:
        def place(batches, tree=tree):
            ways = np.array([tree.direction(a) for a in range(tree.size)])
            for batch in batches:
                if batch.num_rows:
                    x = tree.turned(batch.column(0))
                    leaf = tree.leaf(x)
                    yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(x[np.arange(len(x)), ways[leaf]])], names=["leaf", "v"])

        placed = points.select("vec").mapInArrow(place, "leaf bigint, v double")
        full = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("v", probs, 1000).alias("e"), F.min("v").alias("low"), F.max("v").alias("high"))
        split = False
        for r in full.where(F.col("n") > 2 * block_rows).collect():  # one line per leaf to split
            edges = sorted({e for e in r["e"] if e < r["high"]}) or ([r["low"]] if r["low"] < r["high"] else [])
            if r["leaf"] not in whole and edges:
                tree.split(r["leaf"], edges)
                split = True
            elif r["leaf"] not in whole:  # equal in this direction
                if tree.pass_over(r["leaf"]):
                    split = True
                else:
                    whole.add(r["leaf"])
        if not split:
            return tree


def _k_best(x, ids, p, pids, k, reach=None):
    """``(row of x, id, squared distance)`` of the k nearest of ``p`` for each row of ``x``, itself excluded.

    With ``reach``, a squared distance for each row, those beyond it need not be found.
    """
    rows, found, dist = [], [], []
    sound = np.isfinite(p).all(axis=1)
    p, pids = p[sound], pids[sound]
    guests = np.flatnonzero(np.isfinite(x).all(axis=1))
    if not len(p):
        guests = guests[:0]
    else:
        middle = p.mean(axis=0)
        q = p - middle
        q2 = (q**2).sum(axis=1)
        # one product gives the squared distances but for those of the guests from the middle
        q = np.concatenate([-2 * q, q2[:, None]], axis=1).T
        at_own = np.argsort(pids)
        top = min(k, len(p)) - 1
    step = max(1, PAIRS // max(1, len(p)))
    for start in range(0, len(guests), step):
        mine = guests[start : start + step]
        y = np.concatenate([x[mine] - middle, np.ones((len(mine), 1))], axis=1)
        y2 = (y[:, :-1] ** 2).sum(axis=1)
        near = y @ q
        # no product is further from the squared distance than this
        slack = 4 * (x.shape[1] + 4) * np.finfo(float).eps * (np.sqrt(y2) + math.sqrt(q2.max())) ** 2
        own = at_own[np.minimum(np.searchsorted(pids, ids[mine], sorter=at_own), len(pids) - 1)]
        met = np.flatnonzero(pids[own] == ids[mine])
        near[met, own[met]] = np.inf
        last, many = np.full(len(mine), np.inf) if reach is None else reach[mine] - y2, np.arange(len(mine))
        if reach is not None:
            many = np.flatnonzero(np.count_nonzero(near <= (last + 2 * slack)[:, None], axis=1) > 4 * k)
        if len(many):
            some = near if len(many) == len(mine) else near[many]
            last[many] = np.minimum(last[many], some.min(axis=1) if top == 0 else np.partition(some, top, axis=1)[:, top])
        r, at = np.nonzero(near <= (last + 2 * slack)[:, None])
        # only the candidates are measured and sorted; ties in distance go to the smaller id
        d2 = ((x[mine[r]] - p[at]) ** 2).sum(axis=1)
        good = np.isfinite(near[r, at]) & np.isfinite(d2)
        r, at, d2 = r[good], at[good], d2[good]
        order = np.lexsort((pids[at], d2, r))
        r, at, d2 = r[order], at[order], d2[order]
        keep = np.arange(len(r)) - np.searchsorted(r, r) < k
        rows.append(mine[r[keep]])
        found.append(pids[at[keep]])
        dist.append(d2[keep])
    if not rows:
        return np.array([], np.int64), np.array([], np.int64), np.array([], float)
    return np.concatenate(rows), np.concatenate(found), np.concatenate(dist)


_RESULT = "id bigint, neighbour bigint, distance2 double"
_SETTLED = "id bigint, vec array<double>, block bigint, neighbours array<bigint>, distances2 array<double>"


def _rooms(lines, visitors):
    """block, rooms: a leaf that many vectors visit is searched by several tasks."""
    return lines.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / visitors).cast("int").alias("rooms"))


def _visited(guests, blocked, rooms, search, schema):
    """``search(guests, vectors)`` for each leaf; ``guests`` has a line for each leaf that a vector visits."""
    guests = guests.toDF(*guests.columns).join(rooms, "block").withColumn("room", F.pmod(F.xxhash64("id"), F.col("rooms")).cast("int")).drop("rooms")
    hosts = blocked.join(rooms, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("rooms") - 1)).alias("room"), "id", "vec")
    return guests.groupBy("block", "room").cogroup(hosts.groupBy("block", "room")).applyInArrow(search, schema)


def _k_of_all(found, k):
    best = Window.partitionBy("id").orderBy("distance2", "neighbour")
    return found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k).drop("_r")


def nearest(points, k, block_rows=BLOCK_ROWS, probes=None):
    """The ``k`` nearest other vectors of each line of ``merge_equal``: ``(id, neighbour, distance2)``.

    Ties in distance go to the smaller id. ``probes=None`` is exact; a number of probes bounds the leaves that are open to
    a vector and may miss neighbours in leaves beyond. A tree of no more leaves than probes gives the exact answer.
    """
    spark = points.sparkSession
    points = stored(points.select("id", "vec"), "vectors")
    n = points.count()
    if not n:
        return spark.createDataFrame([], _RESULT)
    if probes is None:
        block_rows = max(block_rows, min(EXACT_ROWS, n // EXACT_LEAVES))
    visitors = max(VISITORS, block_rows)
    tree = _fit_tree(points, n, block_rows)

    def settle(batches):
        for batch in batches:
            if batch.num_rows:
                leaf = tree.leaf(tree.turned(batch.column(1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["id", "vec", "block"])

    blocked = stored(points.mapInArrow(settle, "id bigint, vec array<double>, block bigint"), "blocks")

    def at_home(guests, hosts):
        ids = guests.column("id").to_numpy()
        r, near, d2 = _k_best(_matrix(guests.column("vec")), ids, _matrix(hosts.column("vec")), hosts.column("id").to_numpy(), k)
        ends = np.searchsorted(r, np.arange(len(ids)), side="right")
        return pa.table({"id": guests["id"], "vec": guests["vec"], "block": guests["block"], "neighbours": _lists(near, ends), "distances2": _lists(d2, ends)})

    home = stored(_visited(blocked, blocked, _rooms(blocked, visitors), at_home, _SETTLED), "near")
    own = home.select("id", F.explode(F.arrays_zip("neighbours", "distances2")).alias("f")).select("id", F.col("f.neighbours").alias("neighbour"), F.col("f.distances2").alias("distance2"))
    if not tree.splits:
        return own
    # the working arrays of a task are bounded whatever the number of leaves
    wide = tree.axes.shape[1] * FAN_OUT * (len(tree.splits) if probes is None else probes)
    step = max(1, min(2000, 4 * CELLS // wide))

    def go(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                x, size = tree.turned(part.column(1)), part.column(4).value_lengths().to_numpy()
                reach = np.full(len(x), np.inf)
                reach[size == k] = part.column(4).flatten().to_numpy()[np.cumsum(size)[size == k] - 1]
                if probes is None:
                    rows, leaves = tree.reached(x, reach)
                    order = np.argsort(rows, kind="stable")
                    rows, leaves = rows[order], leaves[order]
                    needed = np.ones(len(rows), bool)
                else:
                    leaves, bounds = tree.probed(x, probes)
                    rows = np.nonzero(np.isfinite(bounds))[0]
                    needed = (bounds <= _slack(reach)[:, None])[np.isfinite(bounds)]
                    leaves = leaves[np.isfinite(bounds)]
                needed &= leaves != part.column(2).to_numpy()[rows]
                ends = np.searchsorted(rows, np.arange(len(x)), side="right")
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(reach), _lists(leaves, ends), _lists(needed, ends)], names=["id", "vec", "reach", "leaves", "needed"])

    guests = stored(home.mapInArrow(go, "id bigint, vec array<double>, reach double, leaves array<bigint>, needed array<boolean>"), "guests")
    # a line for each leaf that is open to a vector, and whether its reach leads there
    visits = stored(guests.select(F.explode(F.arrays_zip(F.col("leaves").alias("block"), "needed")).alias("v")).select("v.block", "v.needed"), "visits")
    lines = guests.select("id", "vec", "reach", F.explode(F.arrays_zip(F.col("leaves").alias("block"), "needed")).alias("v")).where("v.needed").select("id", "vec", "reach", "v.block")

    def visit(guests, hosts):
        ids = guests.column("id").to_numpy()
        r, near, d2 = _k_best(_matrix(guests.column("vec")), ids, _matrix(hosts.column("vec")), hosts.column("id").to_numpy(), k, guests.column("reach").to_numpy())
        return pa.table({"id": ids[r], "neighbour": near, "distance2": d2})

    found = _visited(lines, blocked, _rooms(visits.where("needed"), visitors), visit, _RESULT)
    return _k_of_all(own.unionAll(found), k)
