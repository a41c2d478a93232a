"""Refresh of the star after new RAW data arrived.

The source pipeline cleans and de-duplicates orders, rebuilds the fact's
staging rows (lineitem ⋈ orders, DISTINCT) and MERGEs them into the fact
on (orderkey, partkey, suppkey, custkey, orderdate). Two modes:

* ``mode="reference"`` — that key. DISTINCT collapses two identical lines
  of one order, and two different lines with the same five values make
  MERGE fail (reported as ``MergeCardinalityError``).
* ``mode="line_safe"`` — the fact keeps ``linenumber`` and it joins the key,
  so every line survives and the key is unique per line.

``dims=True`` also upserts dim_order on orderkey (the source pipeline has
that step commented out, leaving the dimension stale).
"""
from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.upsert import merge_frames, upsert_table
from ..session import shared_copy
from . import star as star_mod

FACT_KEYS = ("orderkey", "partkey", "suppkey", "custkey", "orderdate")


def fact_keys(mode: str = "reference") -> list[str]:
    return list(FACT_KEYS) + (["linenumber"] if mode == "line_safe" else [])


def staging_fact(lineitem: DataFrame, orders: DataFrame, mode: str = "reference") -> DataFrame:
    """Fact rows to merge: cleaned distinct orders joined to lines, DISTINCT.

    Only (orderkey, custkey, orderdate) of an order reach the fact, so the
    orders are de-duplicated on those columns (a far narrower shuffle than
    whole RAW rows); rows the narrower DISTINCT keeps apart would yield
    identical fact rows, which the final DISTINCT collapses — same result."""
    orders_clean = orders.select("o_orderkey", "o_custkey", "o_orderdate").distinct()
    return star_mod.fact_sales(lineitem, orders_clean, "orderdate",
                               line_safe=(mode == "line_safe")).distinct()


def refreshed_fact(target: DataFrame, lineitem: DataFrame, orders: DataFrame,
                   mode: str = "reference", on_duplicate: str = "error") -> DataFrame:
    """The refreshed fact as a lazy DataFrame (no write)."""
    return merge_frames(target, staging_fact(lineitem, orders, mode), fact_keys(mode),
                        on_duplicate=on_duplicate, order_by=["extendedprice"])


def refresh_tables(raw, fact_path: str, dim_order_path: str | None = None,
                   mode: str = "reference", dims: bool = False,
                   on_duplicate: str = "error") -> int:
    """Upsert the staging rows into the stored fact (touched year/month
    partitions only) and, with ``dims``, upsert dim_order on orderkey. Returns
    the number of rows merged into the fact."""
    with shared_copy(staging_fact(raw.lineitem, raw.orders, mode), "staging") as staging:
        upsert_table(staging, fact_path, fact_keys(mode), partition_cols=("year", "month"),
                     on_duplicate=on_duplicate, order_by=["extendedprice"], stored=True)
        merged = staging.count()
    if dims and dim_order_path:
        refresh_dim_order(raw, dim_order_path, on_duplicate)
    return merged


def refresh_dim_order(raw, path: str, on_duplicate: str = "error") -> None:
    upsert_table(star_mod.dim_order(raw.orders).distinct(), path, ["orderkey"],
                 on_duplicate=on_duplicate, order_by=["orderdate"])
