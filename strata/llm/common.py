"""Helpers shared by the corpus operators."""
from __future__ import annotations

import contextlib
import gc
import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sinks import paths


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage once and read it back: cuts the lineage
    and lets several consumers share one evaluation. Executors may be lost
    afterwards without recomputing anything."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return stored_in(spark.read.schema(df.schema).parquet(path), path)


def stored_in(df: DataFrame, *folders: str) -> DataFrame:
    """``df``, which reads these folders of ``written``."""
    df._folders = folders
    return df


def forget(*frames: DataFrame) -> None:
    """Remove what ``written`` stored for these frames: nothing reads them, or
    anything made from them, after this."""
    for df in frames:
        for path in getattr(df, "_folders", ()):
            paths.delete(df.sparkSession, path)


def release_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files of finished jobs go: Spark removes them when the
    driver has collected their plans, which else may take half an hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextlib.contextmanager
def temporary(df: DataFrame, name: str, **options):
    """Like ``written``, for rows that nothing reads after the ``with`` block:
    their folder is removed at its end."""
    spark = df.sparkSession
    path = scratch(spark, name)
    try:
        df.write.options(**options).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        paths.delete(spark, path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def window(*keys: str):
    return Window.partitionBy(*keys)


def doc_crc(col: str = "doc_id"):
    """crc32 of the key written as text (the split rule of the contracts)."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of ``counts`` (column ``n``) with the largest ``n``: all down
    to an eighth of a power of two, so that at most ``most`` rows are left.
    Only the sizes of those steps reach the driver."""
    counts = written(counts.withColumn("_step", F.floor(F.log2("n") * 8).cast("int")), "counts")
    left, cut = most, None
    for r in counts.groupBy("_step").count().orderBy(F.desc("_step")).collect():  # at most 8 * 63 rows
        left -= r["count"]
        if left < 0:
            break
        cut = r["_step"]
    kept = counts.where(F.col("_step") >= cut) if cut is not None else counts.limit(0)
    return kept.drop("_step")


#: rows of an Arrow batch: texts are long, and a batch is held several times
#: over on its way to a worker and back
BATCH_ROWS = 1000


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` in batches of at most ``BATCH_ROWS`` rows (a larger
    setting of the session is lowered)."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def keep_rows(docs: DataFrame, keep) -> DataFrame:
    """Rows for whose ``text`` ``keep`` (texts -> booleans) holds, all columns."""

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(list(keep([t.as_py() for t in b.column("text")])), pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def is_local(path: str) -> bool:
    return path.startswith("file:") or "://" not in path


def local_path(path: str) -> str:
    return "/" + path[5:].lstrip("/") if path.startswith("file:") else path


def open_write(path: str):
    """Binary output on shared storage: a mounted folder, or any store that
    Arrow's file systems know."""
    if is_local(path):
        p = local_path(path)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        return open(p, "wb")
    from pyarrow import fs
    store, p = fs.FileSystem.from_uri(path)
    store.create_dir(os.path.dirname(p), recursive=True)
    return store.open_output_stream(p)


def open_read(path: str):
    if is_local(path):
        return open(local_path(path), "rb")
    from pyarrow import fs
    store, p = fs.FileSystem.from_uri(path)
    return store.open_input_file(p)
