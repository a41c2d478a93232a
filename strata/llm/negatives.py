"""Hard negatives of anchors by a secondary sort.

Every anchor meets all rows, block by block: anchors and rows are dealt into
blocks of bounded size, and a pair of blocks is one group of work, a matrix
product. A pair (anchor, row) that may count is packed into the key

    (anchor, descending score, positive before negative, id),

the pairs are partitioned by anchor and sorted within partitions by that key
(the DataFrame form of ``repartitionAndSortWithinPartitions``), and an iterator
over the sorted stream opens a window of scores at each positive and emits the
negatives that fall into it. It holds an anchor's open windows, nothing else.

Two passes keep the shuffle small and exact. The first takes only rows of the
anchor's label, of which a block passes on its best few; so the second knows
each anchor's windows, and a block passes on the first few rows of each.

Rows without key, label or vector, or with a null or non-finite component,
take no part; a shorter vector counts as padded with zeros. Anchors equal in
key, label and vector are one; an anchor's own key is no positive of it. Rows
equal in all three are candidates each, as many as can count. Products are
exact while their sums stay below 2^53.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: rows and anchors of a block, anchors scored at once
ROW_BLOCK, ANCHOR_BLOCK, SLICE = 8192, 4096, 256
POSITIVES, NEGATIVES = 5, 10
#: a negative's score lies between these hundredths of the positive's
LOW, HIGH = 30, 90

PAIR = "anchor_id long, anchor long, id long, score long"


def usable(df: DataFrame, scale: int = 256, key: str = "vec_id", vector: str = "embedding", label: str = "label",
           copies: int = max(POSITIVES, NEGATIVES)) -> DataFrame:
    """(vec_id, label, v, copy) of the rows that take part, components
    floor(scale * x); equal rows up to ``copies`` times."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: F.coalesce(
        ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    return (df.where(F.col(key).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & finite)
            .select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("int").alias("label"),
                    F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double"))).alias("v"))
            .groupBy("vec_id", "label", "v").agg(F.count(F.lit(1)).alias("n"))
            .select("vec_id", "label", "v",
                    F.explode(F.sequence(F.lit(1), F.least("n", F.lit(copies)).cast("int"))).alias("copy")))


def matrix(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """A column of lists as rows of at least ``width`` numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        return np.zeros((0, width))
    sizes = np.diff(column.offsets.to_numpy())
    width = max(width, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _ints(column) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


def _scored(anchors, rows):
    """Slices of the block pair: (first anchor, scores of the slice's anchors
    with all rows, rows in ascending key order)."""
    a, d = matrix(anchors.column("v")), matrix(rows.column("v"))
    width = max(a.shape[1], d.shape[1])
    a, d = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, d))
    for lo in range(0, len(a), SLICE):
        yield lo, (a[lo:lo + SLICE] @ d.T).astype(np.int64)


def _by_key(table: pa.Table) -> pa.Table:
    return table.take(pa.array(np.argsort(_ints(table.column("vec_id")), kind="stable")))


def _pairs(anchors: pa.Table, anchor: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.Table:
    return pa.table({"anchor_id": anchors.column("vec_id").take(pa.array(anchor, pa.int64())),
                     "anchor": anchors.column("anchor").take(pa.array(anchor, pa.int64())),
                     "id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.int64())})


def best_positives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """Each anchor's first ``POSITIVES`` rows of its label in this block."""
    rows = _by_key(rows)
    a_ids, d_ids = _ints(anchors.column("vec_id")), _ints(rows.column("vec_id"))
    a_labels, d_labels = _ints(anchors.column("label")), _ints(rows.column("label"))
    found = [(np.zeros(0, np.int64),) * 3]
    for label in np.unique(a_labels):
        mine, same = np.flatnonzero(a_labels == label), np.flatnonzero(d_labels == label)
        if not len(same):
            continue
        for lo, score in _scored(anchors.take(pa.array(mine)), rows.take(pa.array(same))):
            own = a_ids[mine[lo:lo + len(score)], None] == d_ids[None, same]
            down = np.where(own, np.iinfo(np.int64).max, -score)
            order = np.argsort(down, axis=1, kind="stable")[:, :POSITIVES]
            r, c = np.nonzero(~np.take_along_axis(own, order, 1))
            at = order[r, c]
            found.append((mine[lo + r], d_ids[same[at]], score[r, at]))
    return _pairs(anchors, *(np.concatenate(x) for x in zip(*found)))


def in_window(positive, negative):
    return (LOW * positive <= 100 * negative) & (100 * negative <= HIGH * positive)


def window_negatives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """The rows of other labels that are among the first ``NEGATIVES`` of this
    block in one of the anchor's windows."""
    rows = _by_key(rows)
    d_ids, d_labels = _ints(rows.column("vec_id")), _ints(rows.column("label"))
    a_labels = _ints(anchors.column("label"))
    windows = [np.array(sorted(set(w)), np.int64) for w in anchors.column("windows").to_pylist()]
    found = [(np.zeros(0, np.int64),) * 3]
    for lo, score in _scored(anchors, rows):
        for i, s in enumerate(score):
            w = windows[lo + i]
            some = np.flatnonzero((d_labels != a_labels[lo + i]) & (100 * s >= LOW * w[0]) & (100 * s <= HIGH * w[-1]))
            if not len(some):
                continue
            some = some[np.argsort(-s[some], kind="stable")]
            down = -100 * s[some]
            starts = np.searchsorted(down, -HIGH * w)
            take = (starts[:, None] + np.arange(NEGATIVES)[None, :])
            ok = take < len(some)
            at = some[np.minimum(take, len(some) - 1)]
            ok &= in_window(w[:, None], s[at])
            at = np.unique(at[ok])
            found.append((np.full(len(at), lo + i), d_ids[at], s[at]))
    return _pairs(anchors, *(np.concatenate(x) for x in zip(*found)))


def _meet(anchors: DataFrame, rows: DataFrame, a_blocks: int, d_blocks: int, run) -> DataFrame:
    """``run`` over every pair of an anchor block and a row block."""
    left = anchors.select("*", F.pmod("anchor", F.lit(a_blocks)).alias("a_block"),
                          F.explode(F.sequence(F.lit(0), F.lit(d_blocks - 1))).alias("d_block"))
    right = rows.select(
        "vec_id", "label", "v", F.pmod(F.xxhash64("vec_id", "label", "v", "copy"), F.lit(d_blocks)).cast("int").alias("d_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(a_blocks - 1).cast("long"))).alias("a_block"))
    return (left.groupBy("a_block", "d_block").cogroup(right.groupBy("a_block", "d_block"))
            .applyInArrow(lambda a, d: run(a, d), PAIR))


def stream_windows(batches):
    """Negatives from pairs in key order: each positive opens a window, each
    negative goes to the open windows that it falls into and that have room."""
    out, anchor, windows = [], None, []

    def emit(rows):
        cols = list(zip(*rows)) or [()] * 6
        return pa.RecordBatch.from_arrays([
            pa.array(c, pa.int32() if i == 2 else pa.int64()) for i, c in enumerate(cols)],
            ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    for b in batches:
        for a_id, a, down, negative, row in zip(*(c.to_pylist() for c in b.columns)):
            if (a_id, a) != anchor:
                anchor, windows = (a_id, a), []
            if not negative:
                windows.append([row, -down, 0])
                continue
            for w in windows:
                if w[2] < NEGATIVES and in_window(w[1], -down):
                    w[2] += 1
                    out.append((a_id, w[0], w[2], row, w[1], -down))
        if out:
            yield emit(out)
            out = []


def mine(rows: DataFrame, is_anchor) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for the ``usable`` rows that ``is_anchor`` (a condition on
    vec_id and label) picks. An anchor without positives, a positive whose
    window is empty and an empty table give no rows."""
    rows = common.written(rows, "vectors")
    anchors = common.written(
        rows.where(is_anchor).select("vec_id", "label", "v", F.xxhash64("vec_id", "label", "v").alias("anchor"))
        .dropDuplicates(["vec_id", "anchor"]), "anchors")
    a_blocks = max(1, -(-anchors.count() // ANCHOR_BLOCK))
    d_blocks = max(1, -(-rows.count() // ROW_BLOCK))

    near = _meet(anchors, rows, a_blocks, d_blocks, best_positives)
    first = Window.partitionBy("anchor_id", "anchor").orderBy(F.desc("score"), "id")
    positives = common.written(near.withColumn("place", F.row_number().over(first))
                               .where(F.col("place") <= POSITIVES).drop("place"), "positives")
    windows = positives.groupBy("anchor_id", "anchor").agg(F.collect_list("score").alias("windows"))  # at most POSITIVES
    asking = (anchors.withColumnRenamed("vec_id", "anchor_id").join(windows, ["anchor_id", "anchor"])
              .withColumnRenamed("anchor_id", "vec_id"))
    far = _meet(asking, rows, a_blocks, d_blocks, window_negatives)

    pairs = positives.withColumn("negative", F.lit(False)).unionByName(far.withColumn("negative", F.lit(True)))
    key = ["anchor_id", "anchor", "down", "negative", "id"]
    keyed = pairs.select("anchor_id", "anchor", (-F.col("score")).alias("down"), "negative", "id")
    return (keyed.repartition("anchor_id", "anchor").sortWithinPartitions(*key)
            .mapInArrow(stream_windows, "anchor_id long, positive_id long, rank int, negative_id long, "
                                        "positive_score long, negative_score long"))
