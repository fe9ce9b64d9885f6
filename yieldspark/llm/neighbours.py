"""Approximate nearest neighbours: vantage-point trees per shard, triangle pruning relaxed by a factor.

Points. Rows with one vector are one point, with its ``k + 1`` smallest ids: no
query can need more of them, so a vector that a third of all rows share costs
no more than any other. Vectors that are NULL, zero or hold a NULL or
non-finite component, and rows without an id, take no part.

Dealing. A vantage-point tree over a bounded sample (``SAMPLE`` points, at
most ``MAX_CELLS`` cells) deals all points out to cells; the sample shapes the
cells only. A cell of more than ``SHARD_POINTS`` points is split into shards
by hash. Each shard builds a vantage-point tree over all of its points.

Search. A query first descends to its leaf in its own shard and searches that
shard, which gives k neighbours and their greatest distance r. By the triangle
inequality a point on the other side of a vantage point's sphere is at least
as far as the query is from the sphere; sides, leaves and cells with
``bound * factor > r`` are left out. With factor 1 nothing nearer can be left
out and the result is exact; a greater factor looks at less. The second round
takes each query to the shards that its ball can touch, and the best of both
rounds, by distance and id, are the result.

Distances that are reported, and the order of neighbours, come from the
components' differences in double precision; products are used only to choose
candidates, with a margin for their rounding.

Growth. Shards hold ``SHARD_POINTS`` points at most at every size; queries are
streamed past a shard in blocks and are never gathered. The work is the number
of queries times the points that the bounds leave.

Defined cases: vectors of different lengths are not compared; rows equal in id
and vector are one row; a query's own row (its id and vector) is left out, and
nothing else; fewer than k candidates give fewer rows; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

K, FACTOR = 10, 1.25
SAMPLE, MAX_CELLS, SHARD_POINTS, LEAF = 8192, 256, 20_000, 256
QUERY_BLOCK = 512
_ROUND = 1e-12  # of the sum of two squared norms: more than what their product can lose


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def points_of(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """h1, h2, ids, v: each different vector with its ``k + 1`` smallest ids."""
    d = vectors.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    d = keyed(d.where(F.col("id").isNotNull() & usable(F.col("v"))))
    d = d.groupBy("h1", "h2", "id").agg(F.first("v").alias("v"))
    # The limit is taken before the shuffle as well.
    first = Window.partitionBy("h1", "h2").orderBy("id")
    d = d.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    return d.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("v").alias("v"))


def keyed(d: DataFrame) -> DataFrame:
    """``d`` plus 128 bits that stand for its vector."""
    return d.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), "v"))


# ------------------------------------------------------------------ trees
def _dist(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - v) ** 2).sum(axis=-1))


def _grow(x: np.ndarray, idx: np.ndarray, depth: int, least: int, leaves: list[np.ndarray], seed: np.random.Generator):
    """(vantage point, radius, near, far), or a leaf's number. Both sides are halves as near as ties allow."""
    if depth and len(idx) > least:
        tried = []
        for c in seed.choice(len(idx), min(4, len(idx)), replace=False):  # the point with the widest spread of distances
            d = _dist(x[idx], x[idx[c]])
            tried.append((float(d.std()), int(idx[c]), d))
        _, c, d = max(tried, key=lambda t: t[:2])
        mu = float(np.median(d))
        near = d <= mu
        if not near.all():
            return (x[c].copy(), mu, _grow(x, idx[near], depth - 1, least, leaves, seed),
                    _grow(x, idx[~near], depth - 1, least, leaves, seed))
    leaves.append(idx)
    return len(leaves) - 1


def build(x: np.ndarray, least: int = LEAF, depth: int = 64) -> tuple[object, list[np.ndarray]]:
    """A vantage-point tree over the rows of ``x`` and the rows of its leaves."""
    leaves: list[np.ndarray] = []
    return _grow(x, np.arange(len(x)), depth, least, leaves, np.random.default_rng(0)), leaves


def home(tree, q: np.ndarray) -> np.ndarray:
    """The leaf in which each row of ``q`` belongs."""
    out = np.zeros(len(q), dtype=np.int64)
    todo = [(tree, np.arange(len(q)))]
    while todo:
        node, idx = todo.pop()
        if not isinstance(node, tuple):
            out[idx] = node
        elif len(idx):
            near = _dist(q[idx], node[0]) <= node[1]
            todo += [(node[2], idx[near]), (node[3], idx[~near])]
    return out


def touched(tree, q: np.ndarray, radius, factor: float) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows of ``q`` whose relaxed ball may reach it). ``radius`` is called at each leaf and node, so it may shrink."""
    todo = [(tree, np.arange(len(q)), np.zeros(len(q)))]
    while todo:
        node, idx, bound = todo.pop()
        reach = bound * factor <= radius(idx)
        idx, bound = idx[reach], bound[reach]
        if not len(idx):
            continue
        if not isinstance(node, tuple):
            yield node, idx
            continue
        d = _dist(q[idx], node[0])
        # Less what rounding may add: a bound must not be too great.
        slack = 1e-9 * (d + node[1])
        todo.append((node[3], idx, np.maximum(bound, node[1] - d - slack)))
        todo.append((node[2], idx, np.maximum(bound, d - node[1] - slack)))


class Shard:
    """Points in a vantage-point tree."""

    def __init__(self, x: np.ndarray, least: int = LEAF):
        self.x, self.norm = x, (x * x).sum(axis=1)
        self.tree, self.leaves = build(x, least)

    def _best(self, q: np.ndarray, rows: np.ndarray, dist: np.ndarray, at: np.ndarray, idx: np.ndarray, limit: np.ndarray
              ) -> None:
        """Merge the points ``rows`` into the best of the queries ``idx``; ``dist`` ascending, ``at`` the points."""
        k = dist.shape[1]
        qn = (q[idx] * q[idx]).sum(axis=1)
        square = qn[:, None] + self.norm[rows][None, :] - 2 * (q[idx] @ self.x[rows].T)
        margin = _ROUND * (qn[:, None] + self.norm[rows][None, :])
        worst = np.minimum(dist[idx, -1], limit[idx])
        if len(rows) > k:  # nothing beyond the k-th of these can be among the best
            worst = np.minimum(worst, np.sqrt(np.maximum(np.partition(square + margin, k - 1, axis=1)[:, k - 1], 0)))
        i, j = np.nonzero(square - margin <= (worst * worst * (1 + 1e-12))[:, None])
        if not len(i):
            return
        exact = _dist(q[idx[i]], self.x[rows[j]])
        # Old and new by query, distance and point; the first k of each query stay.
        which = np.concatenate([np.repeat(np.arange(len(idx)), k), i])
        d = np.concatenate([dist[idx].ravel(), exact])
        p = np.concatenate([at[idx].ravel(), rows[j]])
        order = np.lexsort((p, d, which))
        which, d, p = which[order], d[order], p[order]
        first = np.searchsorted(which, np.arange(len(idx)))
        take = first[:, None] + np.arange(k)
        dist[idx], at[idx] = d[take], p[take]

    def search(self, q: np.ndarray, k: int, factor: float = 1.0, radius: np.ndarray | None = None
               ) -> tuple[np.ndarray, np.ndarray]:
        """(distance, point) of the k nearest found for each row of ``q``, ascending; infinity and -1 where there are none.

        ``radius``: only nearer points, or equally near ones, are wanted.
        """
        dist = np.full((len(q), k), np.inf)
        at = np.full((len(q), k), -1, dtype=np.int64)
        limit = np.full(len(q), np.inf) if radius is None else radius
        done = np.full(len(q), -1)
        if radius is None and isinstance(self.tree, tuple):  # a first radius from the leaf where the query belongs
            done = home(self.tree, q)
            for leaf in np.unique(done):
                self._best(q, self.leaves[leaf], dist, at, np.nonzero(done == leaf)[0], limit)
        for leaf, idx in touched(self.tree, q, lambda i: np.minimum(limit[i], dist[i, -1]), factor):
            idx = idx[done[idx] != leaf]
            if len(idx):
                self._best(q, self.leaves[leaf], dist, at, idx, limit)
        return dist, at


# ------------------------------------------------------------------ Spark
def _matrix(col: pa.ListArray) -> np.ndarray:
    """Rows of one length as a matrix."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def _by_dim(col: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) of the vectors of each length."""
    dims = col.value_lengths().to_numpy(zero_copy_only=False)
    for n in np.unique(dims):
        rows = np.nonzero(dims == n)[0]
        yield int(n), rows, _matrix(col.take(pa.array(rows)))


def plan_cells(points: DataFrame, sample: int = SAMPLE, max_cells: int = MAX_CELLS, shard_points: int = SHARD_POINTS
               ) -> dict[int, object]:
    """A dealing tree for each length of vector that is in the sample, as deep as the number of points asks for.

    The sample is the points of smallest hash, ``sample`` of them in the mean.
    """
    n = points.count()
    cells = min(max_cells, -(-n // shard_points))
    some = points if n <= sample else points.where(F.col("h1") < (sample * (1 << 64)) // n - (1 << 63))
    trees = {}
    for dim, _, x in _by_dim(some.select("h1", "h2", "v").orderBy("h1", "h2").toArrow().column("v").combine_chunks()):
        trees[dim] = build(x, least=16, depth=max(0, int(np.ceil(np.log2(max(cells, 1))))))[0]
    return trees


def placed(vectors: DataFrame, trees: dict[int, object]) -> DataFrame:
    """``vectors`` (h1, h2, ids, v) with the length of each vector and its cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, dim = np.zeros(b.num_rows, dtype=np.int32), np.zeros(b.num_rows, dtype=np.int32)
            for n, rows, x in _by_dim(b.column(3)):
                dim[rows] = n
                cell[rows] = home(trees.get(n, 0), x)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dim), pa.array(cell)],
                                             names=["h1", "h2", "ids", "v", "dim", "cell"])

    return vectors.select("h1", "h2", "ids", "v").mapInArrow(
        run, "h1 long, h2 long, ids array<long>, v array<double>, dim int, cell int")


def _search_shards(rows: DataFrame, k: int, factor: float, leaf: int) -> DataFrame:
    """h1, h2, d, ids: neighbours of the queries in each shard.

    ``rows``: dim, cell, shard, query (false sorts first), h1, h2, ids, v, radius (NULL: not known). A shard's points come
    first and are held; its queries stream past them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, vectors, ids, shard, waiting = None, [], [], None, []

        def answer(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal shard, waiting
            if not waiting or (not last and sum(len(w[0]) for w in waiting) < QUERY_BLOCK):
                return
            q, radius = np.concatenate([w[2] for w in waiting]), np.concatenate([w[3] for w in waiting])
            h1, h2 = (np.concatenate([w[i] for w in waiting]) for i in (0, 1))
            waiting = []
            if not vectors:
                return
            if shard is None:
                shard = Shard(np.concatenate(vectors), leaf), pa.concat_arrays(ids)
            known = ~np.isnan(radius)
            for some, r in ((~known, None), (known, radius[known])):
                if some.any():
                    d, at = shard[0].search(q[some], k + 1, factor, r)
                    i, j = np.nonzero(at >= 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h1[some][i]), pa.array(h2[some][i]), pa.array(d[i, j]), shard[1].take(pa.array(at[i, j]))],
                        names=["h1", "h2", "d", "ids"])

        for b in batches:
            keys = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            query = b.column(3).to_numpy(zero_copy_only=False).astype(np.int8)
            marks = np.column_stack([keys, query])
            cuts = [0, *(np.nonzero((marks[1:] != marks[:-1]).any(axis=1))[0] + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                if (now := tuple(keys[lo].tolist())) != key:
                    yield from answer(True)
                    key, vectors, ids, shard = now, [], [], None
                part = b.slice(lo, hi - lo)
                x = _matrix(part.column(7))
                if not query[lo]:
                    vectors.append(x)
                    ids.append(part.column(6))
                    continue
                for at in range(0, hi - lo, QUERY_BLOCK):
                    step = slice(at, at + QUERY_BLOCK)
                    waiting.append((*(part.column(i).to_numpy(zero_copy_only=False)[step] for i in (4, 5)), x[step],
                                    part.column(8).to_numpy(zero_copy_only=False).astype(np.float64)[step]))
                    yield from answer(False)
        yield from answer(True)

    unit = ["dim", "cell", "shard"]
    cols = [*unit, "query", "h1", "h2", "ids", "v", "radius"]
    return (rows.select(*cols).repartition(*unit).sortWithinPartitions(*unit, "query")
            .mapInArrow(run, "h1 long, h2 long, d double, ids array<long>"))


def _visits(queries: DataFrame, trees: dict[int, object], factor: float) -> DataFrame:
    """A row of ``queries`` (h1, h2, v, dim, radius) for each cell that its relaxed ball may reach."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            radius = b.column(4).to_numpy(zero_copy_only=False)
            for n, rows, x in _by_dim(b.column(2)):
                r = radius[rows]
                for cell, idx in touched(trees.get(n, 0), x, lambda i, r=r: r[i], factor):
                    some = b.take(pa.array(rows[idx]))
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(np.full(len(idx), cell, dtype=np.int32))],
                                                     names=["h1", "h2", "v", "dim", "radius", "cell"])

    return queries.select("h1", "h2", "v", "dim", "radius").mapInArrow(
        run, "h1 long, h2 long, v array<double>, dim int, radius double, cell int")


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` first (h1, h2, d, id) of each query; as many rows of a query are shuffled per task at most."""
    one = found.select("h1", "h2", "d", F.explode("ids").alias("id"))
    best = Window.partitionBy("h1", "h2").orderBy("d", "id")
    return one.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR, vec_id: str = "vec_id",
           vector: str = "embedding", sample: int = SAMPLE, max_cells: int = MAX_CELLS, shard_points: int = SHARD_POINTS,
           leaf: int = LEAF) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows of ``vectors`` found for each row of ``queries``.

    ``factor`` 1 is exact; greater ones prune more. ``queries`` has the same columns as ``vectors`` and need not be in it.
    """
    if factor < 1:
        raise ValueError("factor is 1 (exact) or more")
    if k < 1:
        raise ValueError("k is 1 or more")
    points = cut(points_of(vectors, vec_id, vector, k), "points")
    trees = plan_cells(points, sample, max_cells, shard_points)
    dealt = cut(placed(points, trees), "dealt")
    shards = dealt.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / shard_points).cast("int").alias("shards"))
    shards = cut(shards, "cells")
    asked = queries.select(F.col(vec_id).alias("query_id"), F.col(vector).cast("array<double>").alias("v"))
    asked = keyed(asked.where(F.col("query_id").isNotNull() & usable(F.col("v"))))
    # Each different vector is asked once.
    none = F.lit(None)
    different = asked.groupBy("h1", "h2").agg(F.first("v").alias("v")).withColumn("ids", none.cast("array<long>"))

    def sharded(d: DataFrame) -> DataFrame:
        n = F.coalesce("shards", F.lit(1))
        return d.join(shards, ["dim", "cell"], "left").withColumn("shard", F.pmod("h2", n).cast("int")).drop("shards")

    dealt, different = sharded(dealt), cut(sharded(placed(different, trees)).drop("ids"), "queries")
    held = dealt.withColumn("query", F.lit(False)).withColumn("radius", none.cast("double"))

    def ask(q: DataFrame) -> DataFrame:
        q = q.withColumn("query", F.lit(True)).withColumn("ids", none.cast("array<long>"))
        return _search_shards(held.unionByName(q), k, factor, leaf)

    own = cut(ask(different.withColumn("radius", none.cast("double"))), "own-shard")
    # A point has an id or more, so the k + 1 nearest points found hold the k + 1 nearest rows found.
    radius = _nearest(own, k + 1).groupBy("h1", "h2").agg(F.max("d").alias("r"), F.count(F.lit(1)).alias("c"))
    radius = radius.select("h1", "h2", F.when(F.col("c") > k, F.col("r")).otherwise(float("inf")).alias("radius"))
    wide = different.join(radius, ["h1", "h2"], "left").withColumn("radius", F.coalesce("radius", F.lit(float("inf"))))
    visits = _visits(wide, trees, factor).join(shards, ["dim", "cell"])
    visits = visits.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards")
    been = different.select("h1", "h2", "cell", "shard")
    other = ask(visits.join(been, ["h1", "h2", "cell", "shard"], "left_anti"))
    best = _nearest(own.unionByName(other), k + 1).groupBy("h1", "h2").agg(
        F.sort_array(F.collect_list(F.struct("d", "id"))).alias("best"))  # k + 1 at most
    # Written first, so that Spark can split the rows of a vector that very many queries share.
    best = cut(best, "best")
    mine = asked.select("query_id", "h1", "h2").distinct().join(best, ["h1", "h2"])
    rest = F.slice(F.filter("best", lambda x: ~((x["d"] == 0) & (x["id"] == F.col("query_id")))), 1, k)
    return mine.select("query_id", F.posexplode(rest)).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.id").alias("vec_id"), F.col("col.d").alias("score"))


def digest(vectors: DataFrame) -> DataFrame:
    """The registered query: every row whose id is divisible by 100, against all rows."""
    return search(vectors, vectors.where(F.col("vec_id") % 100 == 0))
