"""Exact top-k inner product search by dual-tree cover-tree search.

Queries and data are cut into blocks of bounded size by nearest pivot, so that
a block is compact. Every (query block, data block) pair is one group of work:
it indexes both sides with cover trees and walks them together. For a node
pair with centres q, r and covering radii s, t no inner product exceeds

    <q, r> + |q| t + |r| s + s t,

so the pair is dropped when that is below the worst kth score within the query
node. Before any row is copied, each query has a kth score from a bounded set of
seed vectors, and the same bound, with a data block's pivot and its true covering
radius, names the blocks that can still hold a better one: a query goes to those
blocks only, and a data block only to the query blocks that ask for it.

Vectors become integers floor(scale * x); scores are exact (sums of products
below 2^53). A vector that is null or holds a null or non-finite component
takes no part, nor does a row without key; a shorter vector counts as padded
with zeros; rows that share a key are candidates each.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: rows of a data block and of a query block, pivots, seed vectors (pivots are
#: seeds; beyond as many full blocks, a pivot's rows are cut by hash)
DATA_BLOCK, QUERY_BLOCK, PIVOTS, SEEDS = 8192, 2048, 2048, 2048
#: points of a leaf, children of a node
LEAF, FAN = 128, 32


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 64,
                    copies: int = 1) -> DataFrame:
    """(vec_id, v) of the usable rows, components floor(scale * x). Rows equal
    in both are given ``copies`` times at most; of them no more than k can be
    among the best k."""
    x = F.col(vector)
    usable = x.isNotNull() & F.col(key).isNotNull() & F.forall(
        x, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    return (df.where(usable)
            .select(F.col(key).cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double"))).alias("v"))
            .groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("n"))
            .select("vec_id", "v", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(copies)))).alias("n")).drop("n"))


def matrix(column) -> np.ndarray:
    rows = column.to_pylist()
    width = max(map(len, rows), default=0)
    if any(len(r) != width for r in rows):
        rows = [r + [0] * (width - len(r)) for r in rows]
    return np.array(rows, np.float64).reshape(len(rows), width)


class CoverTree:
    """Points of one block; a node has a centre, its true covering radius and
    either children, whose centres are at least half the node's radius apart
    (farthest first, at most ``FAN``), or up to ``LEAF`` points."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.children: list[np.ndarray | None] = []
        self.members: list[np.ndarray] = []
        self.radius: list[float] = []
        centres: list[np.ndarray] = []
        if len(points):
            todo = [(np.arange(len(points)), 0, None)]
            while todo:
                rows, pivot, parent = todo.pop()
                node, centre = len(self.members), points[rows[pivot]]
                far = np.sqrt(((points[rows] - centre) ** 2).sum(1))
                self.members.append(rows)
                self.radius.append(float(far.max()))
                self.children.append(None)
                centres.append(centre)
                if parent is not None:
                    self.children[parent].append(node)
                if len(rows) <= LEAF or self.radius[-1] == 0:
                    continue
                nearest, owner, picks = far, np.zeros(len(rows), np.int64), [pivot]
                while len(picks) < FAN and nearest.max() > self.radius[-1] / 2:
                    picks.append(int(nearest.argmax()))
                    d = np.sqrt(((points[rows] - points[rows[picks[-1]]]) ** 2).sum(1))
                    owner = np.where(d < nearest, len(picks) - 1, owner)
                    nearest = np.minimum(d, nearest)
                self.children[node] = []
                for i, p in enumerate(picks):
                    mine = np.flatnonzero(owner == i)
                    todo.append((rows[mine], int(np.flatnonzero(mine == p)[0]), node))
        self.centre = np.array(centres).reshape(len(centres), points.shape[1])
        self.radii = np.array(self.radius)
        self.norm = np.sqrt((self.centre ** 2).sum(1))


def _widen(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1])))


def dual_search(q_ids, queries, d_ids, data, k: int, worst: np.ndarray):
    """(scores, ids) of each query's best ``k`` among ``data`` that reach
    ``worst``; missing places hold -inf."""
    width = max(queries.shape[1], data.shape[1])
    queries, data = _widen(queries, width), _widen(data, width)
    best = np.full((len(queries), k), -np.inf)
    ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    worst = worst.astype(np.float64).copy()
    if not len(queries) or not len(data):
        return best, ids
    Q, D = CoverTree(queries), CoverTree(data)

    def bound(qs, ds):
        s, t = Q.radii[qs], D.radii[ds]
        top = (Q.centre[qs] * D.centre[ds]).sum(-1) + Q.norm[qs] * t + D.norm[ds] * s + s * t
        return top + 1e-9 * np.abs(top) + 1e-6

    def base(q, d):
        rows, cols = Q.members[q], D.members[d]
        score = queries[rows] @ data[cols].T
        score[q_ids[rows][:, None] == d_ids[cols][None, :]] = -np.inf
        better = (score >= worst[rows][:, None]).any(1)
        if not better.any():
            return
        rows, score = rows[better], score[better]
        s = np.concatenate([best[rows], score], 1)
        i = np.concatenate([ids[rows], np.broadcast_to(d_ids[cols], score.shape)], 1)
        order = np.lexsort((i, -s), axis=-1)[:, :k]
        best[rows] = np.take_along_axis(s, order, 1)
        ids[rows] = np.take_along_axis(i, order, 1)
        worst[rows] = np.maximum(worst[rows], best[rows, -1])

    todo = [(0, 0, float(bound(np.array([0]), np.array([0]))[0]))]
    while todo:
        q, d, top = todo.pop()
        if top < worst[Q.members[q]].min():
            continue
        qc, dc = Q.children[q], D.children[d]
        if qc is None and dc is None:
            base(q, d)
            continue
        if qc is None or (dc is not None and D.radii[d] >= Q.radii[q]):
            qs, ds = np.full(len(dc), q), np.array(dc)
        else:
            qs, ds = np.array(qc), np.full(len(qc), d)
        tops = bound(qs, ds)
        order = np.argsort(tops)  # the most promising is popped first
        todo += zip(qs[order].tolist(), ds[order].tolist(), tops[order].tolist())
    return best, ids


def _blocked(df: DataFrame, pivots: np.ndarray, rows: int, name: str) -> DataFrame:
    """(vec_id, v, far, pivot, block): nearest pivot, the distance to it, and a
    block number; a pivot with more than ``rows`` rows has several blocks."""
    schema = "vec_id long, v array<long>, pivot int, far double"

    def near(batches):
        for b in batches:
            m = matrix(b.column(1))
            w = max(m.shape[1], pivots.shape[1])
            m, p = _widen(m, w), _widen(pivots, w)
            d = (m ** 2).sum(1)[:, None] - 2 * m @ p.T + (p ** 2).sum(1)[None, :]
            at = d.argmin(1)
            far = np.sqrt(((m - p[at]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at.astype(np.int32)), pa.array(far)],
                                             ["vec_id", "v", "pivot", "far"])

    out = common.written(df.select("vec_id", "v").mapInArrow(near, schema), name)
    sizes = out.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).alias("parts"))
    # one row per pivot, at most PIVOTS
    return (out.join(F.broadcast(sizes), "pivot")
            .select("vec_id", "v", "far", "pivot", (F.col("pivot").cast("long") * (1 << 32)
                                                    + F.pmod(F.xxhash64("vec_id", "v"), F.col("parts"))).alias(name)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best rows of
    ``vectors``, its own key left out, ties to the smaller key. Both inputs are
    (vec_id, v); a key's rows are candidates each, and query rows of one key
    share one ranking; fewer than ``k`` candidates give fewer rows; an empty
    side gives none."""
    found = asked(vectors, queries, k)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def pairs_to_walk(vectors: DataFrame, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Query rows, each with the data blocks it goes to, and data rows, each
    with the query blocks that ask for its block."""
    spark = vectors.sparkSession
    # bounded samples by hash: pivots to cut blocks, seeds for first kth scores
    seeds = vectors.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(SEEDS).toArrow()
    seed_ids, seed_v = np.array(seeds.column(0).to_pylist(), np.int64), matrix(seeds.column(1))

    def pivots(df, rows):  # as many as full blocks, at most PIVOTS
        return (seed_v if len(seed_v) else np.zeros((1, 1)))[:max(1, min(PIVOTS, df.count() // rows))]

    d_pivots = pivots(vectors, DATA_BLOCK)
    d = _blocked(vectors, d_pivots, DATA_BLOCK, "d_block")
    q = _blocked(queries, pivots(queries, QUERY_BLOCK), QUERY_BLOCK, "q_block")
    # one narrow row per data block: pivot and covering radius
    blocks = d.groupBy("d_block", "pivot").agg(F.max("far").alias("radius")).toArrow()
    block = np.array(blocks.column("d_block").to_pylist(), np.int64)
    centre = d_pivots[np.array(blocks.column("pivot").to_pylist(), np.int64)]
    radius = np.array(blocks.column("radius").to_pylist(), np.float64)
    shared = spark.sparkContext.broadcast((seed_ids, seed_v, block, centre, radius))

    def ask(batches):
        seed_ids, seed_v, block, centre, radius = shared.value
        for b in batches:
            q_ids, m = np.array(b.column(0).to_pylist(), np.int64), matrix(b.column(1))
            w = max(m.shape[1], seed_v.shape[1], centre.shape[1])
            m = _widen(m, w)
            score = m @ _widen(seed_v, w).T
            score[q_ids[:, None] == seed_ids[None, :]] = -np.inf
            kth = (np.partition(score, -k, axis=1)[:, -k] if score.shape[1] >= k
                   else np.full(len(m), -np.inf))
            top = m @ _widen(centre, w).T + np.sqrt((m ** 2).sum(1))[:, None] * radius[None, :]
            near = top + 1e-9 * np.abs(top) + 1e-6 >= kth[:, None]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), b.column(2), pa.array(kth, pa.float64()),
                pa.array([block[row] for row in near], pa.list_(pa.int64()))],
                ["vec_id", "v", "q_block", "worst", "d_blocks"])

    asking = common.written(q.select("vec_id", "v", "q_block").mapInArrow(
        ask, "vec_id long, v array<long>, q_block long, worst double, d_blocks array<long>"), "asking")
    left = asking.select("vec_id", "v", "q_block", "worst", F.explode("d_blocks").alias("d_block"))
    wanted = (asking.select(F.col("q_block").alias("q_other"), F.explode("d_blocks").alias("d_block"))
              .distinct())
    # an inner join on the block: a block goes once to each query block that asks for it
    right = d.select("vec_id", "v", "d_block").join(wanted, "d_block")
    return left, right


def asked(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best of every (query block, data block)."""
    left, right = pairs_to_walk(vectors, queries, k)

    def pair(lt, rt):
        q_ids = np.array(lt.column("vec_id").to_pylist(), np.int64)
        d_ids = np.array(rt.column("vec_id").to_pylist(), np.int64)
        best, ids = dual_search(q_ids, matrix(lt.column("v")), d_ids, matrix(rt.column("v")), k,
                                np.array(lt.column("worst").to_pylist(), np.float64))
        r, c = np.nonzero(best > -np.inf)
        return pa.table({"query_id": pa.array(q_ids[r] if len(r) else [], pa.int64()),
                         "vec_id": pa.array(ids[r, c], pa.int64()),
                         "score": pa.array(best[r, c].astype(np.int64), pa.int64())})

    return (left.groupBy("q_block", "d_block").cogroup(right.groupBy("q_other", "d_block"))
            .applyInArrow(pair, "query_id long, vec_id long, score long"))
