"""Run ledger: one row per pipeline step (job history and row counts).

The ledger is an append-only parquet table. It also stores high-water marks
for incremental extracts and the batch ids a streaming sink has committed,
so a replayed run or micro-batch can be recognised and skipped.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks import paths, swap

LEDGER_SCHEMA = T.StructType([
    T.StructField("job", T.StringType(), False),
    T.StructField("target", T.StringType(), False),
    T.StructField("batch_id", T.LongType(), True),
    T.StructField("run_ts", T.TimestampType(), False),
    T.StructField("rows_in", T.LongType(), True),
    T.StructField("rows_out", T.LongType(), True),
    T.StructField("watermark", T.StringType(), True),
    # of a stream: its query id, which stays with its checkpoint
    T.StructField("stream", T.StringType(), True),
])


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    swap.recover(spark, path)
    if not paths.exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def record(spark: SparkSession, path: str, job: str, target: str, *, batch_id: int | None = None,
           rows_in: int | None = None, rows_out: int | None = None,
           watermark: str | None = None, run_ts: dt.datetime | None = None,
           stream: str | None = None) -> None:
    row = (job, target, batch_id, run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
           rows_in, rows_out, watermark, stream)
    spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def last_watermark(spark: SparkSession, path: str, job: str, target: str) -> str | None:
    """High-water mark of (job, target): the largest recorded mark.

    Incremental check columns are numeric and only grow, so the maximum is
    the current mark whatever the run times (several runs may share one
    ingest hour). Non-numeric marks fall back to the latest run."""
    rows = (read_ledger(spark, path).where((F.col("job") == job) & (F.col("target") == target))
            .where(F.col("watermark").isNotNull()))
    num = F.expr("try_cast(watermark AS DECIMAL(38,0))")
    r = rows.agg(F.max(num).alias("m")).first()
    if r is not None and r["m"] is not None:
        return str(r["m"])
    r = rows.orderBy(F.desc("run_ts")).select("watermark").limit(1).collect()
    return r[0][0] if r else None


def committed(spark: SparkSession, path: str, job: str, batch_id: int, stream: str | None = None) -> bool:
    """Whether the batch of this stream is in the ledger. A fresh checkpoint
    counts its batches from 0 again, but under another stream id."""
    return bool(read_ledger(spark, path)
                .where((F.col("job") == job) & (F.col("batch_id") == batch_id)
                       & F.col("stream").eqNullSafe(F.lit(stream)))
                .limit(1).collect())


def compact(spark: SparkSession, path: str) -> None:
    """Rewrite the ledger (one small file per entry) as one file per job,
    beside the old files, then swap."""
    swap.recover(spark, path)
    if paths.exists(spark, path):
        swap.replace(read_ledger(spark, path).repartition("job"), path)
