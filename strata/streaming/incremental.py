"""Incremental ingestion as a Structured Streaming query.

New files arriving in a landing folder are read as a file-source stream
(``maxFilesPerTrigger`` bounds each micro-batch), and every micro-batch is
upserted into a partitioned parquet table by ``foreachBatch``. Exactly-once
result: a batch id already recorded in the ledger is skipped, and the upsert
itself is idempotent, so a batch replayed after a failure between the write
and the ledger entry rewrites the same rows. With ``newer_by``, a version
column that is stored beside each row, a row that arrives in a later batch than
a newer one of its key loses, so files may come in any order. Stream progress lives in the
checkpoint location on shared storage (``spark.checkpoint.dir``).

``trigger="availableNow"`` processes everything present and stops (a
scheduled incremental run); ``trigger="continuous"`` keeps the query
running with a processing-time trigger.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.upsert import upsert_table
from ..plans import ledger
from ..session import checkpoint_dir


def upsert_sink(target_path: str, keys: Sequence[str], ledger_path: str, job: str, *,
                order_by: Sequence[str], partition_cols: Sequence[str] = (),
                keys_fix_partition: bool = False, newer_by: str | None = None,
                transform: Callable[[DataFrame], DataFrame] | None = None):
    """foreachBatch function: (batch_df, batch_id) -> upsert + ledger entry.
    ``order_by`` says which of a batch's rows of one key is the latest; its
    columns need not be stored. ``newer_by`` is stored, comes before
    ``order_by`` and holds between batches too."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # set by the running query; stays the same over restarts of a checkpoint
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if ledger.committed(spark, ledger_path, job, batch_id, stream):
            return
        df = transform(batch) if transform else batch
        upsert_table(df, target_path, keys, partition_cols=partition_cols,
                     keys_fix_partition=keys_fix_partition, on_duplicate="last",
                     order_by=order_by, newer_by=newer_by)
        ledger.record(spark, ledger_path, job, target_path, batch_id=batch_id, stream=stream)
    return sink


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, *, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int = 1,
                options: dict | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger",
                                                           max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(folder)


def run_incremental(spark: SparkSession, stream: DataFrame, target_path: str, keys: Sequence[str],
                    *, job: str, order_by: Sequence[str], partition_cols: Sequence[str] = (),
                    keys_fix_partition: bool = False, newer_by: str | None = None,
                    transform: Callable[[DataFrame], DataFrame] | None = None,
                    trigger: str = "availableNow",
                    processing_time: str = "1 minute", checkpoint: str | None = None,
                    ledger_path: str | None = None):
    """Start the stream → upsert query; with ``availableNow`` wait for it."""
    base = checkpoint_dir(spark).rstrip("/")
    checkpoint = checkpoint or f"{base}/streams/{job}"
    ledger_path = ledger_path or f"{base}/ledger"
    ledger.compact(spark, ledger_path)  # the entries of earlier runs, one file per job
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(upsert_sink(target_path, keys, ledger_path, job,
                                   partition_cols=partition_cols, transform=transform,
                                   keys_fix_partition=keys_fix_partition, order_by=order_by,
                                   newer_by=newer_by)))
    w = w.trigger(availableNow=True) if trigger == "availableNow" else \
        w.trigger(processingTime=processing_time)
    q = w.start()
    if trigger == "availableNow":
        q.awaitTermination()
    return q


def raw_zone_stream(spark: SparkSession, raw_root: str, table: str, *,
                    max_files_per_trigger: int = 1) -> DataFrame:
    """The RAW text zone of ``table`` as a stream: every newly landed file
    (any ingest hour) arrives once, parsed with the RAW contract, the
    ``year/month/day/hour`` partition values included as columns."""
    from ..sources import rawzone
    lines = file_stream(spark, f"{raw_root.rstrip('/')}/{table}", rawzone.line_schema(),
                        fmt="text", max_files_per_trigger=max_files_per_trigger)
    return rawzone.parse_lines(lines, table)
