"""Table writers: create-or-replace, append by name, partitioned layouts.

Tables are parquet directories (no table-format jar is assumed). Writes go
through Spark's commit protocol, so a failed task or lost executor leaves
no partial output.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import paths, swap


def clustered(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Route rows so each output partition directory is written by tasks of
    bounded size: a REBALANCE on the partition columns. AQE then splits a
    hot directory (a day or month holding a large share of the data) into
    several tasks of ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and
    merges small ones, so the number of files per directory follows its
    volume, no task writes into every directory, and no task is unbounded."""
    if not partition_cols:
        return df
    return df.hint("rebalance", *partition_cols)


def write_table(df: DataFrame, path: str, *, mode: str = "overwrite",
                partition_cols: Sequence[str] = (), rebalance: bool = True) -> None:
    """Create or replace (``mode="overwrite"``: complete beside the old table,
    then swapped in) or append a parquet table."""
    out = df
    if partition_cols and rebalance:
        out = clustered(out, partition_cols)
    if mode == "overwrite":
        swap.replace(out, path, partition_cols)
        return
    w = out.write.mode(mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def write_by_name(df: DataFrame, path: str, contract: T.StructType,
                  partition_cols: Sequence[str] = (), *, mode: str = "append") -> None:
    """Append to (or replace) a table with columns matched by *name* to a
    fixed contract (the select order of ``df`` does not matter; missing
    columns are typed NULLs; extra columns are rejected)."""
    extra = [c for c in df.columns if c not in contract.fieldNames()]
    if extra:
        raise ValueError(f"columns not in contract: {extra}")
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in contract.fields]
    write_table(df.select(*cols), path, mode=mode, partition_cols=partition_cols, rebalance=False)


def replace_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``."""
    swap.replace(df, path, partition_cols, whole=False)


def save_star(spark: SparkSession, star, root: str) -> dict[str, str]:
    """Write every table of a ``Star`` under ``root``; the fact is
    partitioned (year, month) — day stays a column, which keeps the
    directory count at ~12 per year instead of ~365 — and rebalanced so
    each month is written by tasks of bounded size."""
    written = {}
    for name, df in star.tables().items():
        p = f"{root.rstrip('/')}/{name}"
        if name == "fact_sales":
            write_table(df, p, partition_cols=star.partition_cols)
        else:
            write_table(df, p)
        written[name] = p
    return written


def drop_partitions(spark: SparkSession, path: str, partition_cols: Sequence[str], where) -> int:
    """Remove the partitions whose values satisfy the Column ``where`` (NULL
    values and escaped names included); returns how many went."""
    gone = spark.read.parquet(path).select(*partition_cols).where(where).distinct()
    n = 0
    for r in gone.toLocalIterator():  # one folder name at a time
        paths.delete(spark, f"{path.rstrip('/')}/{paths.partition_folder(spark, partition_cols, r.asDict())}")
        n += 1
    return n
