"""Batch-stamped versions of a table: as-of reads and expiry.

A versioned table is append-only; every write adds rows stamped with a
increasing ``batch_id``. ``as_of(v)`` is the table as it was after batch
``v``: per key, the row of the latest batch <= v. ``expire(v)`` compacts
history up to ``v`` into that snapshot and keeps later batches as they are,
so as-of reads for versions >= v are unchanged.

The per-key pick is a ``max(struct(batch_id, row))`` aggregate: partial
aggregation reduces a key with many versions map-side, so a hot key does
not gather all its versions in one task.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks import swap
from ..sinks.writer import drop_partitions, replace_partitions


def stamp(df: DataFrame, batch_id: int, col: str = "batch_id") -> DataFrame:
    return df.withColumn(col, F.lit(batch_id).cast("bigint"))


def as_of(versioned: DataFrame, keys: Sequence[str], version: int | None = None,
          col: str = "batch_id") -> DataFrame:
    df = versioned if version is None else versioned.where(F.col(col) <= F.lit(version))
    cols = versioned.columns
    m = F.max(F.struct(F.col(col).alias("_v"), F.struct(*cols).alias("r")))
    return df.groupBy(*keys).agg(m.alias("_m")).select("_m.r.*")


def expire(versioned: DataFrame, keys: Sequence[str], version: int,
           col: str = "batch_id") -> DataFrame:
    later = versioned.where(F.col(col) > F.lit(version))
    return as_of(versioned, keys, version, col).unionByName(later)


def history(versioned: DataFrame, col: str = "batch_id") -> DataFrame:
    """Rows per batch (the table's list of snapshots)."""
    return versioned.groupBy(col).agg(F.count(F.lit(1)).alias("rows")).orderBy(col)


# ---------------------------------------------------------------- stored versions
# A stored versioned table is a parquet folder partitioned by ``_version``
# (the batch a row was written in, or the compaction version), while
# ``batch_id`` stays a data column. An as-of read of version v opens only
# the partitions ``_version <= v``; every row has batch_id <= _version.
PART = "_version"


def append_version(df: DataFrame, path: str, batch_id: int, col: str = "batch_id") -> None:
    """Write ``df`` as batch ``batch_id`` (re-running the same batch replaces it)."""
    replace_partitions(stamp(df, batch_id, col).withColumn(PART, F.lit(batch_id).cast("bigint")), path, [PART])


def read_versions(spark, path: str, version: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    df = df.withColumn(PART, F.col(PART).cast("bigint"))
    if version is not None:
        df = df.where(F.col(PART) <= F.lit(version))   # partition pruning
    return df.drop(PART)


def read_as_of(spark, path: str, keys: Sequence[str], version: int | None = None,
               col: str = "batch_id") -> DataFrame:
    return as_of(read_versions(spark, path, version), keys, version, col)


def expire_stored(spark, path: str, keys: Sequence[str], version: int,
                  col: str = "batch_id") -> None:
    """Compact partitions ``_version <= version`` into one snapshot stored in
    partition ``version`` (rows keep their batch_id); the older partitions go
    in the same swap."""
    swap.recover(spark, path)
    snap = (as_of(read_versions(spark, path, version), keys, version, col)
            .withColumn(PART, F.lit(version).cast("bigint")))
    parts = spark.read.parquet(path).select(F.col(PART).cast("bigint").alias(PART)).distinct()
    swap.replace(snap, path, [PART], whole=False, emptied=parts.where(F.col(PART) < version))


def rollback_stored(spark, path: str, version: int) -> None:
    """Forget every batch after ``version``: the table is again what an as-of
    read of ``version`` gives."""
    swap.recover(spark, path)
    drop_partitions(spark, path, [PART], F.col(PART).cast("bigint") > F.lit(version))
