"""Staged writes: a table's new files are complete before any old one goes.

The new rows are written to a sibling folder ``<path>.staged``; a marker file
inside it says that it is complete. Only then are folders moved: each old one
to ``<path>.old``, the staged one in its place. A job that dies before the
marker leaves the table as it was; one that dies after it is finished by
``recover``, which every reader and writer of a stored table calls first.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from . import paths

MARKER = "_complete"


def _names(path: str) -> tuple[str, str]:
    path = path.rstrip("/")
    return f"{path}.staged", f"{path}.old"


def stage(df: DataFrame, path: str, partition_cols: Sequence[str] = (), *, whole: bool = True,
          emptied: DataFrame | None = None) -> None:
    """Write the rows that will replace the table at ``path`` or, when not
    ``whole``, the partitions that they fall in and those in ``emptied``."""
    spark = df.sparkSession
    staged, _ = _names(path)
    paths.delete(spark, staged)
    w = df.write
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(f"{staged}/rows")
    if emptied is not None:
        for r in emptied.toLocalIterator():  # one folder name at a time
            paths.touch(spark, f"{staged}/gone/{paths.partition_folder(spark, partition_cols, r.asDict())}/_gone")
    # how deep the folders to swap lie: 0 for the whole table
    paths.touch(spark, f"{staged}/_depth-{0 if whole else len(partition_cols)}")
    paths.touch(spark, f"{staged}/{MARKER}")


def recover(spark: SparkSession, path: str) -> None:
    """Finish a swap that has begun; drop a staged write that is incomplete."""
    staged, old = _names(path)
    if not paths.exists(spark, staged):
        return
    if paths.exists(spark, f"{staged}/{MARKER}"):
        _swap(spark, path.rstrip("/"), staged, old)
    paths.delete(spark, staged)
    paths.delete(spark, old)


def _swap(spark: SparkSession, path: str, staged: str, old: str) -> None:
    depth = next((d for d in range(16) if paths.exists(spark, f"{staged}/_depth-{d}")), 0)
    if not depth:
        # on a second try the folder may already have moved
        if paths.exists(spark, f"{staged}/rows"):
            if paths.exists(spark, path):
                paths.delete(spark, old)
                paths.rename(spark, path, old)
            paths.rename(spark, f"{staged}/rows", path)
        return
    for folder in paths.folders(spark, f"{staged}/rows", depth):
        if paths.exists(spark, f"{path}/{folder}"):
            paths.delete(spark, f"{old}/{folder}")
            paths.rename(spark, f"{path}/{folder}", f"{old}/{folder}")
        paths.rename(spark, f"{staged}/rows/{folder}", f"{path}/{folder}")
    for folder in paths.folders(spark, f"{staged}/gone", depth):
        paths.delete(spark, f"{path}/{folder}")


def replace(df: DataFrame, path: str, partition_cols: Sequence[str] = (), *, whole: bool = True,
            emptied: DataFrame | None = None) -> None:
    """Stage, then swap. ``df`` may read the table that it replaces."""
    recover(df.sparkSession, path)
    stage(df, path, partition_cols, whole=whole, emptied=emptied)
    recover(df.sparkSession, path)
