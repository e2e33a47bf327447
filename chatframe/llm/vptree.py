"""Nearest neighbours by inner product with vantage-point trees.

A vector ``x`` becomes ``(x, sqrt(M^2 - |x|^2))`` and a query ``(q, 0)`` of any
length, ``M`` the largest length, so largest inner products are smallest
distances and the triangle inequality holds.

1. Equal vectors are one index row with their ``k + 1`` smallest ids, picked
   in salted steps; a vector that a third of the rows share is no hot key.
2. A vantage-point tree over at most ``SAMPLE`` rows (by hash) routes *all*
   rows to its leaves; leaves are dealt by hash to shards of about
   ``SHARD_ROWS`` rows.
3. Every shard's vantage-point tree is built once and stored as rows: nodes,
   then vectors in tree order.  A search sorts them in front of the shard's
   queries and streams these past the tree in batches, so a task holds one tree
   and one batch, and only queries are shuffled per visit (the trees once per
   ``QUERY_BLOCK`` queries).  A query searches its home leaf first; its ``k``-th
   distance there bounds the other leaves it visits, by the triangle inequality
   along each leaf's path.
4. Pruning, of leaves and inside trees, is relaxed by ``factor``: a branch goes
   if its lower bound times ``factor`` exceeds the ``k``-th distance.  Factor 1
   is exact search, larger factors look at less.

Distances choose candidates, with all rows that tie at the ``k``-th one up to
rounding; scores are inner products of the original vectors,
summed in order in double precision, and decide ranks (ties: smaller id).

Defined cases: null or empty vectors, zero vectors and vectors with null or
non-finite components take no part, nor do null ids; shorter vectors are
compared as if filled up with zeros; vectors of any length are one row; repeated
rows of one id and vector count once, and no query returns its own id; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatframe.llm.kernels import held
from chatframe.llm.spark_util import past_each_group, stored

K = 20
FACTOR = 1.0
SAMPLE = 4096
SHARD_ROWS = 8192
LEAF = 256
QUERY_BLOCK = 1 << 16   # queries that share one shipment of the trees
QUERY_BATCH = 2048
SALTS = 64
EPS = 1e-9
TIE = 1e-7       # rounding of distances: rows this close to the k-th compete by exact score
PIECE = 1 << 21  # components multiplied at a time


# -------------------------------------------------------------------- trees ---
@dataclass
class Node:
    """A vantage point, its median distance and the two sides; or a leaf."""
    rows: np.ndarray | None = None
    point: np.ndarray | None = None
    radius: float = 0.0
    near: Node | None = None
    far: Node | None = None


def _dist(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    d = (q * q).sum(axis=-1)[:, None] + (x * x).sum(axis=-1)[None, :] - 2 * (q @ x.T)
    return np.sqrt(np.maximum(d, 0))


def build(x: np.ndarray, rows: np.ndarray, leaf: int, seed: int = 0) -> Node:
    """Tree over ``x[rows]``; rows that equal the median distance go near."""
    if len(rows) <= leaf:
        return Node(rows=rows)
    rng = np.random.default_rng(seed + len(rows))
    # of a few points, the one whose distances to others spread most
    tries, probe = rng.choice(rows, min(8, len(rows))), x[rng.choice(rows, min(64, len(rows)))]
    point = x[tries[int(_dist(x[tries], probe).std(axis=1).argmax())]]
    d = _dist(point[None], x[rows])[0]
    radius = float(np.median(d))
    near = d <= radius
    if near.all():
        near = d < radius
        if not near.any():
            return Node(rows=rows)  # all rows are equally far
        radius = float(d[near].max())
    return Node(None, point, radius, build(x, rows[near], leaf, seed + 1), build(x, rows[~near], leaf, seed + 2))


class Found:
    """The ``k`` nearest rows of each query so far."""

    def __init__(self, n: int, k: int):
        self.dist = np.full((n, k), np.inf)
        self.row = np.full((n, k), -1, np.int64)

    def limit(self, q: np.ndarray) -> np.ndarray:
        return self.dist[q, -1]

    def add(self, q: np.ndarray, d: np.ndarray, rows: np.ndarray) -> None:
        better = (d < self.limit(q)[:, None]).any(axis=1)
        q, d = q[better], d[better]
        if not len(q):
            return
        k = self.dist.shape[1]
        both = np.concatenate([self.dist[q], d], axis=1)
        row = np.concatenate([self.row[q], np.broadcast_to(rows, d.shape)], axis=1)
        pick = np.argpartition(both, k - 1, axis=1)[:, :k] if both.shape[1] > k else np.argsort(both, axis=1)
        both, row = np.take_along_axis(both, pick, 1), np.take_along_axis(row, pick, 1)
        order = np.argsort(both, axis=1)
        self.dist[q], self.row[q] = np.take_along_axis(both, order, 1), np.take_along_axis(row, order, 1)


class Ties:
    """Of all rows within ``limit`` of their query the ``k`` best by (exact
    score, smaller key).  ``raw`` and ``q``: vectors as given."""

    def __init__(self, limit: np.ndarray, k: int, raw: np.ndarray, q: np.ndarray, keys: np.ndarray):
        self.bound, self.k, self.raw, self.q, self.keys = limit + TIE, k, raw, q, keys
        self.kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0))
        self.new: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def limit(self, q: np.ndarray) -> np.ndarray:
        return self.bound[q]

    def add(self, q: np.ndarray, d: np.ndarray, rows: np.ndarray) -> None:
        i, j = np.nonzero(d <= self.bound[q][:, None])
        self.pairs(q[i], rows[j], d[i, j])

    def pairs(self, q: np.ndarray, rows: np.ndarray, d: np.ndarray) -> None:
        step = max(1, PIECE // self.raw.shape[1])
        for s in range(0, len(q), step):
            at, row = q[s:s + step], rows[s:s + step]
            self.new.append((at, row, exact_scores(self.q[at], self.raw[row]), d[s:s + step]))
            self.waiting += len(at)
            if self.waiting > PIECE + 4 * len(self.bound) * self.k:
                self.best()

    def best(self) -> tuple[np.ndarray, ...]:
        """Query, row, score and distance of what is kept."""
        q, row, score, d = (np.concatenate(c) for c in zip(self.kept, *self.new, strict=True))
        order = np.lexsort((row, self.keys[row], -score, q))
        q, row, score, d = q[order], row[order], score[order], d[order]
        once = np.ones(len(q), bool)
        once[1:] = (q[1:] != q[:-1]) | (row[1:] != row[:-1])
        q, row, score, d = q[once], row[once], score[once], d[once]
        first = np.arange(len(q)) - np.searchsorted(q, q) < self.k
        self.kept, self.new, self.waiting = (q[first], row[first], score[first], d[first]), [], 0
        return self.kept


def flattened(tree: Node) -> tuple[np.ndarray, list[tuple]]:
    """Order of the rows and (up, near side, lo, hi, point, radius) of the nodes,
    parents first; a leaf's rows are ``lo:hi`` of that order."""
    order, nodes = [np.empty(0, np.int64)], []
    n, stack = 0, [(tree, -1, True)]
    while stack:
        node, up, near = stack.pop()
        me = len(nodes)
        if node.rows is None:
            nodes.append((up, near, 0, 0, node.point, node.radius))
            stack += [(node.near, me, True), (node.far, me, False)]
        else:
            nodes.append((up, near, n, n + len(node.rows), None, 0.0))
            order.append(node.rows)
            n += len(node.rows)
    return np.concatenate(order), nodes


def rebuilt(nodes: list[tuple]) -> Node:
    """The tree whose rows are in the order that ``flattened`` gave."""
    made = [Node(np.arange(lo, hi)) if point is None else Node(None, point, radius) for _, _, lo, hi, point, radius in nodes]
    for node, (up, near, *_) in zip(made, nodes, strict=True):
        if up >= 0:
            setattr(made[up], "near" if near else "far", node)
    return made[0]


def search(tree: Node, x: np.ndarray, q: np.ndarray, active: np.ndarray, found: Found, factor: float) -> None:
    """Search ``q[active]``, nearer sides first, with relaxed pruning."""
    if not len(active):
        return
    if tree.rows is not None:
        if len(tree.rows):
            found.add(active, _dist(q[active], x[tree.rows]), tree.rows)
        return
    gap = _dist(q[active], tree.point[None])[:, 0] - tree.radius
    first = gap <= 0
    search(tree.near, x, q, active[first], found, factor)
    search(tree.far, x, q, active[~first], found, factor)
    left = np.abs(gap) * factor <= found.limit(active) + EPS
    search(tree.far, x, q, active[first & left], found, factor)
    search(tree.near, x, q, active[~first & left], found, factor)


def leaves(tree: Node) -> list[list[tuple[np.ndarray, float, bool]]]:
    """For each leaf its path: (point, radius, whether the near side)."""
    if tree.rows is not None:
        return [[]]
    return ([[(tree.point, tree.radius, True), *p] for p in leaves(tree.near)]
            + [[(tree.point, tree.radius, False), *p] for p in leaves(tree.far)])


def lower_bounds(paths: list, q: np.ndarray) -> np.ndarray:
    """Least possible distance of each query to each leaf's rows."""
    out = np.zeros((len(q), len(paths)))
    seen: dict[int, np.ndarray] = {}
    for i, path in enumerate(paths):
        for point, radius, near in path:
            gap = seen.get(id(point))
            if gap is None:
                gap = seen[id(point)] = _dist(q, point[None])[:, 0] - radius
            out[:, i] = np.maximum(out[:, i], gap if near else -gap)
    return out


def home_leaf(tree: Node, x: np.ndarray) -> np.ndarray:
    """Leaf number (in the order of ``leaves``) of every row of ``x``."""
    if tree.rows is not None:
        return np.zeros(len(x), np.int64)
    near = _dist(x, tree.point[None])[:, 0] <= tree.radius
    out = np.empty(len(x), np.int64)
    out[near] = home_leaf(tree.near, x[near])
    out[~near] = home_leaf(tree.far, x[~near]) + len(leaves(tree.near))
    return out


# -------------------------------------------------------------------- Spark ---
def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and e (array of double) of the rows that take part."""
    e = F.col(vec_col).cast("array<double>")
    bad = F.exists("e", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), e.alias("e"))
            .where(F.col("id").isNotNull() & F.col("e").isNotNull() & ~bad)
            .where(F.exists("e", lambda v: v != 0)).dropDuplicates(["id", "e"]))


def _first_ids(rows: DataFrame, n: int) -> DataFrame:
    """Each vector with its ``n`` smallest ids, without one task for all of its rows."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    part = salted.withColumn("r", F.row_number().over(Window.partitionBy("e", "salt").orderBy("id"))).where(F.col("r") <= n)
    top = part.withColumn("r", F.row_number().over(Window.partitionBy("e").orderBy("id"))).where(F.col("r") <= n)
    return top.groupBy("e").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("key", F.col("ids")[0])


def _matrix(col, dim: int) -> np.ndarray:
    out = np.zeros((len(col), dim))
    for i, v in enumerate(col):
        out[i, :len(v)] = v
    return out


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(top * top - (x * x).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _flat(q: np.ndarray) -> np.ndarray:
    q = q / np.sqrt((q * q).sum(axis=1))[:, None]
    return np.concatenate([q, np.zeros((len(q), 1))], axis=1)


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, components added from first to last."""
    return np.add.accumulate(q * x, axis=1)[:, -1]


TREE = "shard long, kind int, at long, up long, near boolean, lo long, hi long, r double, e array<double>, ids array<long>"


def stored_trees(shards: DataFrame, dim: int, top: float) -> DataFrame:
    """The vantage-point tree of every shard (e, ids, shard) as rows."""
    def grow(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        x = _lift(_matrix(df["e"], dim), top) / top
        order, nodes = flattened(build(x, np.arange(len(x)), LEAF))
        up, near, lo, hi, point, r = zip(*nodes, strict=True)
        head = pd.DataFrame({"shard": key[0], "kind": 0, "at": np.arange(len(nodes)), "up": up, "near": near, "lo": lo, "hi": hi,
                             "r": r, "e": list(point), "ids": None})
        body = pd.DataFrame({"shard": key[0], "kind": 1, "at": np.arange(len(x)), "up": 0, "near": False, "lo": 0, "hi": 0, "r": 0.0,
                             "e": df["e"].to_numpy()[order], "ids": df["ids"].to_numpy()[order]})
        return pd.concat([head, body], ignore_index=True)

    return stored(shards.groupBy("shard").applyInPandas(grow, TREE), "trees")


def _searched(trees: DataFrame, visits: DataFrame, dim: int, top: float, k: int, factor: float, blocks: int) -> DataFrame:
    """Per visit (shard, q, e, lim: a distance known to suffice, or null) the
    ``k`` best index rows of that shard: q, score, ids, dist."""
    blank = {c: F.lit(None).cast(t) for c, t in (x.strip().split(" ") for x in TREE.split(","))}
    block = F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("long")
    asked = visits.select("shard", F.lit(2).alias("kind"), F.col("q").alias("at"), *[blank[c].alias(c) for c in ("up", "near", "lo", "hi")],
                          F.col("lim").alias("r"), "e", blank["ids"].alias("ids"), block.alias("blk"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    both = trees.select("*", every.alias("blk")).unionByName(asked)

    def grown(t: pa.Table):
        kind = t.column("kind").to_numpy()
        node, row = t.filter(pa.array(kind == 0)), t.filter(pa.array(kind == 1))
        cols = [node.column(c).to_pylist() for c in ("up", "near", "lo", "hi", "e", "r")]
        nodes = [(u, n, lo, hi, None if p is None else np.array(p), r) for u, n, lo, hi, p, r in zip(*cols, strict=True)]
        raw, ids = _matrix(row.column("e").to_pylist(), dim), row.column("ids").to_pylist()
        return rebuilt(nodes), raw, _lift(raw, top) / top, ids, np.array([i[0] for i in ids])

    def ask(held_tree, part: pa.RecordBatch):
        tree, raw, x, ids, first = held_tree
        q = _matrix(part.column("e").to_pylist(), dim)
        y, every_q = _flat(q), np.arange(len(q))
        found = Found(len(y), k)
        lim = part.column("r").to_numpy(zero_copy_only=False)
        found.dist[:, -1] = np.where(np.isnan(lim), np.inf, lim) + EPS
        search(tree, x, y, every_q, found, factor)
        ties = Ties(found.limit(every_q), k, raw, q, first)
        i, j = np.nonzero(found.row >= 0)
        ties.pairs(i, found.row[i, j], found.dist[i, j])
        search(tree, x, y, every_q, ties, factor)
        i, r, score, dist = ties.best()
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.column("at").to_numpy()[i]), pa.array(score), pa.array([ids[n] for n in r.tolist()], pa.list_(pa.int64())),
             pa.array(dist)], ["q", "score", "ids", "dist"])

    def run(batches):
        held("vptree")
        yield from past_each_group(batches, grown, ask, QUERY_BATCH)

    return (both.repartition("shard", "blk").sortWithinPartitions("shard", "blk", "kind", "at")
            .mapInArrow(run, "q long, score double, ids array<long>, dist double"))


def nearest(vectors: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int = K,
            factor: float = FACTOR) -> DataFrame:
    """The ``k`` nearest other rows of every row for which ``is_query`` (over
    ``id_col`` as ``id``) holds: query_id, rank, id, score."""
    rows = stored(usable(vectors, id_col, vec_col), "vectors")
    index = stored(_first_ids(rows, k + 1), "index")
    size = F.sqrt(F.aggregate("e", F.lit(0.0), lambda a, v: a + v * v))
    n, top, dim = index.agg(F.count("*"), F.max(size), F.max(F.size("e"))).first()
    out = "query_id long, rank int, id long, score double"
    if not n:
        return rows.sparkSession.createDataFrame([], out)
    top = float(top) * (1 + 1e-12)
    sample = index.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("e").toPandas()
    lifted = _lift(_matrix(sample["e"], dim), top) / top
    want = max(1, -(-n // SHARD_ROWS))
    route = build(lifted, np.arange(len(lifted)), max(16, -(-len(lifted) // want)))
    paths = leaves(route)

    def to_leaf(batches):
        for b in batches:
            x = _lift(_matrix(b["e"], dim), top) / top
            yield b.assign(leaf=home_leaf(route, x).astype(np.int64))

    placed = stored(index.mapInPandas(to_leaf, "e array<double>, ids array<long>, key long, leaf long"), "placed")
    count = {r[0]: r[1] for r in placed.groupBy("leaf").count().collect()}  # one row for each leaf of the sample's tree
    subs = np.array([-(-count.get(i, 0) // SHARD_ROWS) for i in range(len(paths))])
    base = np.concatenate([[0], np.cumsum(subs)[:-1]])
    lists = lambda v: F.array(*[F.lit(int(i)) for i in v])
    leaf = F.col("leaf").cast("int") + 1
    shards = placed.select("e", "ids", (F.element_at(lists(base), leaf) + F.pmod(
        F.xxhash64("key"), F.greatest(F.lit(1), F.element_at(lists(subs), leaf)))).cast("long").alias("shard"))

    asked = rows.where(is_query).select("id", "e")
    named = stored(asked.join(index.select("e", F.col("key").alias("q")), "e").select("id", "q", "e"), "queries")
    queries = named.groupBy("q").agg(F.first("e").alias("e"), F.lit(None).cast("double").alias("lim"))
    queries = stored(queries, "asked")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    trees = stored_trees(shards, dim, top)

    def visits(home: bool):
        def run(batches):
            for b in batches:
                y = _flat(_matrix(b.column("e").to_pylist(), dim))
                lim = b.column("lim").to_numpy(zero_copy_only=False)
                low = lower_bounds(paths, y)
                mine = np.zeros(low.shape, bool)
                mine[np.arange(len(y)), low.argmin(axis=1)] = True
                near = low * factor <= np.where(np.isnan(lim), np.inf, lim)[:, None] + TIE
                i, at = np.nonzero(mine if home else near & ~mine)
                n = subs[at]
                shard = np.repeat(base[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                rows = b.take(pa.array(np.repeat(i, n)))
                yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int64)), *rows.columns], ["shard", *rows.schema.names])
        return run

    kind = "shard long, q long, e array<double>, lim double"
    want_k = k + 1
    one = stored(_searched(trees, queries.mapInArrow(visits(True), kind), dim, top, want_k, factor, blocks), "round1")
    limit = (one.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("dist")))
             .where(F.col("r") == want_k).select("q", F.col("dist").alias("lim")))
    again = queries.drop("lim").join(limit, "q", "left").select("q", "e", "lim")
    two = _searched(trees, again.mapInArrow(visits(False), kind), dim, top, want_k, factor, blocks)
    hits = one.unionByName(two).select("q", "score", F.explode("ids").alias("id"))
    best = (hits.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id")))
            .where(F.col("r") <= want_k))
    own = named.select(F.col("id").alias("query_id"), "q").distinct()
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (own.join(best.select("q", "id", "score"), "q").where(F.col("id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))
