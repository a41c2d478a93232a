"""Archive tier: cold partitions move to it, packed into files of target size.

A hot table collects small files, a partition at a time. The job takes the
partitions that a condition calls cold, reads their sizes from the files, and
rewrites each into as many files as its bytes ask for: rows are dealt to them
by hash, whatever the number and sizes of the old files. The archive's copy is
checked against the hot one by multiset fingerprints before the hot partitions
go, so a run that dies in between loses nothing and is repeated by the next one:
a partition is replaced as a whole, and one that is gone from hot is not cold
any more.

Readers use ``tiers``: a partition that both hold (a run died) counts once.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_copy
from ..sinks import paths
from ..sinks.writer import drop_partitions, replace_partitions
from .reconcile import fingerprint

TARGET_BYTES = 256 << 20


def partition_sizes(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    """(parts, files, bytes, rows) of a partitioned table, from its files'
    sizes; no data column is read."""
    files = (spark.read.parquet(path)
             .select(*parts, F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b"))
             .groupBy(*parts, "f").agg(F.max("b").alias("b"), F.count(F.lit(1)).alias("n")))
    return files.groupBy(*parts).agg(F.count(F.lit(1)).alias("files"), F.sum("b").alias("bytes"), F.sum("n").alias("rows"))


def _same(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def archive(spark: SparkSession, hot: str, cold: str, parts: Sequence[str], is_cold: Column,
            target_bytes: int = TARGET_BYTES) -> int:
    """Move the partitions of ``hot`` for which ``is_cold`` (over the partition
    columns, which read as strings) holds to ``cold``; returns how many went.
    A second run finds none."""
    parts = list(parts)
    sizes = partition_sizes(spark, hot, parts).where(F.coalesce(is_cold, F.lit(False)))
    with shared_copy(sizes.withColumn("pieces", F.ceil(F.col("bytes") / F.lit(target_bytes))), "cold") as moving:
        if moving.isEmpty():
            return 0
        table = spark.read.parquet(hot)
        cols = [c for c in table.columns if c not in parts]
        joined = table.join(moving.select(*parts, "pieces"), _same(table, moving, parts))
        rows = joined.select(*[table[c] for c in table.columns],
                             F.pmod(F.xxhash64(*[table[c] for c in cols]), F.col("pieces")).alias("_piece"))
        # a task holds whole pieces, so a piece is one file
        packed = rows.repartition(*parts, "_piece").sortWithinPartitions(*parts, "_piece")
        _write_pieces(packed, cold, parts)
        _verify(spark, hot, cold, parts, moving, cols)
        # the partitions are dropped by their values, one folder each
        n = 0
        for r in moving.select(*parts).toLocalIterator():
            cond = F.lit(True)
            for c in parts:
                cond = cond & F.col(c).eqNullSafe(F.lit(r[c]))
            n += drop_partitions(spark, hot, parts, cond)
    return n


def _write_pieces(packed: DataFrame, cold: str, parts: list[str]) -> None:
    """Replace the partitions; a piece is a folder level while it is written,
    so that every piece is a file of its own."""
    replace_partitions(packed.withColumnRenamed("_piece", "piece"), cold, [*parts, "piece"])


def _verify(spark: SparkSession, hot: str, cold: str, parts: list[str], moving: DataFrame, cols: list[str]) -> None:
    """Raise unless both tiers hold the same rows in the moved partitions."""
    sides = []
    for i, path in enumerate((hot, cold)):
        df = spark.read.parquet(path)
        df = df.join(moving.select(*parts), _same(df, moving, parts), "left_semi")
        sides.append(df.groupBy(*parts).agg(*fingerprint(cols)))
    left, right = sides[0].exceptAll(sides[1]), sides[1].exceptAll(sides[0])
    if bad := left.unionByName(right).select(*parts).limit(1).collect():
        raise ValueError(f"archive differs from the table in partition {bad[0].asDict()}")


def tiers(spark: SparkSession, hot: str, cold: str, parts: Sequence[str]) -> DataFrame:
    """All rows of the table, with ``tier``."""
    warm = spark.read.parquet(hot).withColumn("tier", F.lit("hot"))
    if not paths.exists(spark, cold):
        return warm
    old = spark.read.parquet(cold).drop("piece").withColumn("tier", F.lit("archive"))
    there = warm.select(*parts).distinct()
    # partitions that a dying run left in both count as hot
    return warm.unionByName(old.join(there, _same(old, there, list(parts)), "left_anti"))
