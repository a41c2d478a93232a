"""Row-level upsert with MERGE semantics, as DataFrame operations.

    MERGE INTO target USING source ON <keys equal>
    WHEN MATCHED THEN UPDATE SET *  WHEN NOT MATCHED THEN INSERT *

is ``source ∪ (target ▷ source)`` (▷ = left anti join on the keys):
matched target rows are replaced by their source row, unmatched source
rows are inserted, unmatched target rows are kept, and NULL keys never
match (a NULL-key target row is kept, a NULL-key source row inserted).

``newer_by`` names a column that both sides hold, the version of a row, and
makes the update conditional (``WHEN MATCHED AND source.version >=
target.version``): a source row older than the stored one loses, so rows may
come in any order, in one batch or over many.

Like MERGE, more than one source row for one target row is an error
(``on_duplicate="error"``), unless an ordering picks one
(``on_duplicate="last"`` with ``order_by``).
"""
from __future__ import annotations

import contextlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_copy
from ..sinks import paths, swap


class MergeCardinalityError(ValueError):
    pass


def _not_null(keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def align_by_name(df: DataFrame, like: DataFrame) -> DataFrame:
    """Select ``like``'s columns from ``df`` by name, cast to ``like``'s types."""
    missing = [c for c in like.columns if c not in df.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    types = {f.name: f.dataType for f in like.schema.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) for c in like.columns])


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null source keys occurring more than once (partial aggregate: a
    hot key costs one row per map task in the shuffle)."""
    return (source.where(_not_null(keys)).groupBy(*keys).count()
            .where(F.col("count") > 1).drop("count"))


def duplicate_matches(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source keys that occur more than once *and* match a target row —
    exactly the rows MERGE rejects."""
    return duplicate_keys(source, keys).join(target.select(*keys), list(keys), "left_semi")


def latest_per_key(source: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One source row per non-null key: the greatest by ``order_by`` (then by
    the whole row, so the pick is deterministic). Uses ``max(struct)``,
    a partial aggregate, so hot keys are pre-reduced before the shuffle."""
    cols = source.columns
    ranked = F.max(F.struct(*[F.col(c) for c in order_by], F.struct(*cols).alias("r")))
    picked = (source.where(_not_null(keys)).groupBy(*keys).agg(ranked.alias("_m"))
              .select("_m.r.*"))
    return picked.unionByName(source.where(~_not_null(keys)))


def _version(c):
    """A NULL version is older than any other."""
    return F.struct(c.isNotNull(), c)


def not_older(source: DataFrame, target: DataFrame, keys: Sequence[str], newer_by: str) -> DataFrame:
    """The source rows whose version is at least that of their target row (the
    newest one, should the key repeat), or that have none. Target versions are
    reduced per key before they meet the source; only keys and versions of the
    target are read."""
    stored = (target.where(_not_null(keys)).groupBy(*keys)
              .agg(F.max(_version(F.col(newer_by))).alias("_stored")))
    return (source.join(stored, list(keys), "left")
            .where(F.col("_stored").isNull() | (_version(F.col(newer_by)) >= F.col("_stored")))
            .select(*source.columns))


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
                 on_duplicate: str = "error", order_by: Sequence[str] | None = None,
                 newer_by: str | None = None) -> DataFrame:
    """The upserted table as a lazy DataFrame (target's column order). With
    ``newer_by`` the newest source row of a key is taken, the order within a
    version is ``order_by``'s, and it replaces no newer target row."""
    keys = list(keys)
    if newer_by:
        if newer_by not in source.columns or newer_by not in target.columns:
            raise ValueError(f"both sides must hold the version column {newer_by!r}")
        on_duplicate, order_by = "last", [newer_by, *[c for c in order_by or () if c != newer_by]]
    if on_duplicate == "last":
        if not order_by:
            raise ValueError("on_duplicate='last' needs order_by")
        # before alignment: the order may use columns that the target lacks
        source = latest_per_key(source, keys, order_by)
    src = align_by_name(source, target)
    if on_duplicate == "error":
        # the target is only consulted when the source has a repeated key
        bad = duplicate_keys(src, keys).limit(1).collect()
        if bad:
            bad = duplicate_matches(target, src, keys).limit(1).collect()
        if bad:
            raise MergeCardinalityError(
                f"MERGE: several source rows match one target row, e.g. key {bad[0].asDict()}")
    elif on_duplicate not in ("last", "ignore"):
        raise ValueError("on_duplicate must be 'error', 'last' or 'ignore'")
    if newer_by:
        src = not_older(src, target, keys, newer_by)
    kept = target.join(src.select(*keys), keys, "left_anti")
    return src.unionByName(kept)


def _read_existing(spark, path: str, like: DataFrame | None = None) -> DataFrame | None:
    swap.recover(spark, path)
    if not paths.exists(spark, path):
        return None
    df = spark.read.parquet(path)
    if like is not None:
        # partition columns may read back as strings: give them the source's types
        types = dict(like.dtypes)
        fix = {c: F.col(c).cast(types[c]) for c, t in df.dtypes if c in types and t != types[c]}
        df = df.withColumns(fix) if fix else df
    return df


def _same(a: DataFrame, b: DataFrame, cols: Sequence[str]):
    """Null-safe equality on ``cols``: NULL is a partition like any other."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def upsert_table(source: DataFrame, path: str, keys: Sequence[str], *,
                 partition_cols: Sequence[str] = (), keys_fix_partition: bool = True,
                 on_duplicate: str = "error", order_by: Sequence[str] | None = None,
                 newer_by: str | None = None, stored: bool = False) -> DataFrame:
    """Apply an upsert to the parquet table at ``path`` (created if absent).

    With ``partition_cols`` only the affected partitions are read in full
    and rewritten; the rest stay untouched:

    * ``keys_fix_partition=True`` — the partition is a function of the keys
      (e.g. year/month of a key date), so a source row can only match in
      its own partition: affected = partitions present in ``source``.
    * ``keys_fix_partition=False`` — a key may move between partitions:
      affected also includes every partition holding a matched key, found
      by a key-and-partition-column scan of the target (column pruning
      keeps it narrow).

    ``newer_by`` compares versions as in ``merge_frames``; where a key may move
    between partitions, the stored version is found in the one that holds it.

    A NULL partition value is a partition like any other. The source is
    evaluated once, to a copy on shared storage (``stored``: it reads stored
    files as they are, and is not copied again). Which partitions are affected,
    one row each, goes to every task that reads the target, so rows of others
    are dropped where they are read. The merged rows are written
    beside the table and swapped in when complete (``sinks.swap``), so a
    crash at any point loses nothing. Returns the stored table.
    """
    spark = source.sparkSession
    keys, pcols = list(keys), list(partition_cols)
    with contextlib.nullcontext(source) if stored else shared_copy(source, "upsert-source") as staged:
        target = _read_existing(spark, path, like=staged)
        emptied = None
        if target is None:
            merged = merge_frames(staged.limit(0), staged, keys, on_duplicate=on_duplicate, order_by=order_by,
                                  newer_by=newer_by)
            swap.replace(merged, path, pcols)
            return spark.read.schema(merged.schema).parquet(path)
        if pcols:
            touched = staged.select(*pcols).distinct()
            if not keys_fix_partition:
                hit = (target.select(*keys, *pcols).join(staged.select(*keys), keys, "left_semi")
                       .select(*pcols))
                touched = touched.unionByName(hit).distinct()
            target = target.join(F.broadcast(touched), _same(target, touched, pcols), "left_semi")
        merged = merge_frames(target, staged, keys, on_duplicate=on_duplicate, order_by=order_by, newer_by=newer_by)
        if pcols and not keys_fix_partition:
            # partitions whose every row moved away: absent from the merged rows
            left = merged.select(*pcols).distinct()
            emptied = touched.join(left, _same(touched, left, pcols), "left_anti")
        swap.replace(merged, path, pcols, whole=not pcols, emptied=emptied)
        return spark.read.schema(merged.schema).parquet(path)
