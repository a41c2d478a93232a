"""Batch and incremental ingestion into the RAW zone.

* ``ingest_batch``: for each table spec, extract (JDBC, parallel splits, an
  optional half-open date window) and land it under this run's ingest
  hour, replacing that hour.
* ``ingest_incremental``: extract only rows beyond the table's high-water
  mark (check column), append them, and record the new mark in the
  ledger — the mark comes from the data landed, so windows cannot leave
  gaps or re-read rows.
* ``window_batches``: the same window rule as a distributed query over any
  DataFrame (used to audit an extract and in tests).
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_copy
from ..sources import rawzone
from ..sources.jdbc import BATCH_SPECS, INCREMENTAL_SPECS, ExtractSpec, window_filter
from . import ledger
from .reconcile import landing

class Source:
    """Where extracts come from: ``extract(spec, last, upper)`` gives the
    rows of a spec with ``last < check <= upper``; ``upper(spec, last)``
    gives the current MAX(check column) beyond ``last``."""

    def extract(self, spec: ExtractSpec, last=None, upper=None) -> DataFrame:
        raise NotImplementedError

    def upper(self, spec: ExtractSpec, last=None):
        raise NotImplementedError


class JdbcSource(Source):
    def __init__(self, spark: SparkSession, url: str, props: dict | None = None):
        self.spark, self.url, self.props = spark, url, props

    def extract(self, spec, last=None, upper=None):
        from ..sources.jdbc import extract
        return extract(self.spark, self.url, spec, self.props, last, upper)

    def upper(self, spec, last=None):
        from ..sources.jdbc import check_upper
        return check_upper(self.spark, self.url, spec, self.props, last)


class FrameSource(Source):
    """Source over existing DataFrames (e.g. parquet tables): same windows
    and marks, applied as pushed-down filters."""

    def __init__(self, frames: dict[str, DataFrame]):
        self.frames = frames

    def extract(self, spec, last=None, upper=None):
        return window_filter(self.frames[spec.table], spec, last, upper)

    def upper(self, spec, last=None):
        return window_filter(self.frames[spec.table], spec, last).agg(
            F.max(spec.check_column)).first()[0]


jdbc_source, frame_source = JdbcSource, FrameSource


def ingest_batch(spark: SparkSession, source: Source, raw_root: str, run_ts: dt.datetime,
                 specs: dict[str, ExtractSpec] | None = None,
                 ledger_path: str | None = None, fmt: str = "text") -> dict[str, str]:
    """Land every spec's extract under ``run_ts``'s hour (replacing it)."""
    out = {}
    for name, spec in (specs or BATCH_SPECS).items():
        df = source.extract(spec)
        out[name] = rawzone.land(df, raw_root, name, run_ts, mode="overwrite", fmt=fmt)
        if ledger_path:
            ledger.record(spark, ledger_path, "ingest_batch", name, run_ts=run_ts,
                          rows_out=spark.read.format(fmt).load(out[name]).count())
    return out


class LandingMismatch(ValueError):
    pass


def validate_landing(spark: SparkSession, source: Source, raw_root: str, run_ts: dt.datetime, name: str,
                     spec: ExtractSpec, window, key: str, ledger_path: str | None = None, fmt: str = "text") -> int:
    """Compare what this run's hour holds of a table with the source's extract,
    as multisets per ``window`` (an expression over the RAW columns). Returns
    the rows; a difference raises ``LandingMismatch`` with the first windows
    that differ. The ledger gets source rows in and landed rows out."""
    hour = dict(p.split("=") for p in rawzone.partition_path(run_ts).split("/"))
    landed = rawzone.read_raw(spark, raw_root, name, fmt=fmt)
    for c, v in hour.items():
        landed = landed.where(F.col(c) == v)
    found = landing(source.extract(spec), landed, name, window, key)
    with shared_copy(found.windows(), "windows") as windows:
        total = windows.agg(F.sum("source_rows"), F.sum("landed_rows")).first()
        bad = windows.where(~F.col("same")).orderBy("window").limit(5).collect()
    if ledger_path:
        ledger.record(spark, ledger_path, "validate_landing", name, run_ts=run_ts, rows_in=total[0] or 0, rows_out=total[1] or 0)
    if bad:
        raise LandingMismatch(f"{name}: " + "; ".join(
            f"window {r['window']}: {r['source_rows']} rows in the source, {r['landed_rows']} landed" for r in bad))
    return total[0] or 0


def ingest_incremental(spark: SparkSession, source: Source, raw_root: str, run_ts: dt.datetime,
                       ledger_path: str, specs: dict[str, ExtractSpec] | None = None) -> dict:
    """Append rows past each table's high-water mark; record the new mark.

    The upper mark is read first (MAX of the check column, computed by the
    source), the run extracts exactly ``last < check <= upper`` and appends
    it to this run's hour (two runs in one hour keep both batches), then
    ``upper`` goes to the ledger. Rows arriving meanwhile wait for the next
    run, so there are no gaps even if the extract is re-read after a lost
    executor. A crash before the ledger entry re-extracts the same range on
    retry; identical copies collapse downstream (``rawzone.latest_ingest``).
    Tables without a check column are re-landed in full for the hour.
    """
    marks = {}
    for name, spec in (specs or INCREMENTAL_SPECS).items():
        last = ledger.last_watermark(spark, ledger_path, "ingest_incremental", name) \
            if spec.check_column else None
        mark = None
        if spec.check_column:
            lo = None if last is None else int(last)
            upper = source.upper(spec, lo)
            if upper is not None:
                rawzone.land(source.extract(spec, lo, upper), raw_root, name, run_ts,
                             mode="append")
            mark = str(upper) if upper is not None else last
        else:
            rawzone.land(source.extract(spec), raw_root, name, run_ts, mode="overwrite")
        ledger.record(spark, ledger_path, "ingest_incremental", name, watermark=mark,
                      run_ts=run_ts)
        marks[name] = mark
    return marks


def window_batches(df: DataFrame, col: str, bounds: Sequence[str], key: str) -> DataFrame:
    """Assign each row to the half-open window ``[bounds[i], bounds[i+1])``
    of ``col`` it falls in and summarise each window: rows and
    MAX(``key``) (the high-water mark after that batch). One pass; rows
    outside all windows are dropped."""
    c = F.col(col)
    idx = None
    for i in range(len(bounds) - 1):
        lo, hi = F.lit(bounds[i]).cast("date"), F.lit(bounds[i + 1]).cast("date")
        cond = (c >= lo) & (c < hi)
        idx = F.when(cond, F.lit(i)) if idx is None else idx.when(cond, F.lit(i))
    w = df.select(idx.alias("_w"), F.col(key)).where(F.col("_w").isNotNull())
    agg = w.groupBy("_w").agg(F.count(F.lit(1)).alias("rows"), F.max(key).alias("watermark"))
    lo_map = F.element_at(F.array(*[F.lit(b) for b in bounds[:-1]]), F.col("_w") + 1)
    hi_map = F.element_at(F.array(*[F.lit(b) for b in bounds[1:]]), F.col("_w") + 1)
    return agg.select(lo_map.cast("date").alias("window_lo"), hi_map.cast("date").alias("window_hi"),
                      "rows", "watermark")

