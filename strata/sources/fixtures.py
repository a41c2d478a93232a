"""Labelled derivations for columns the source tables do not carry.

The parquet ``lineitem`` has no l_commitdate / l_receiptdate, which the
order-fulfilment mart needs. ``with_line_dates`` derives them
deterministically from columns that exist, so the mart can run over the
whole table. This is test data, not business data: it is only applied when
the columns are missing.

    commit  = ship + ((orderkey % 61) - 30) days
    receipt = ship + linenumber days
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date


def with_line_dates(lineitem: DataFrame) -> DataFrame:
    out = lineitem
    ship = as_date(lineitem, "l_shipdate")
    if "l_commitdate" not in lineitem.columns:
        out = out.withColumn(
            "l_commitdate",
            F.date_add(ship, (F.pmod(F.col("l_orderkey"), F.lit(61)) - 30).cast("int")))
    if "l_receiptdate" not in lineitem.columns:
        out = out.withColumn("l_receiptdate", F.date_add(ship, F.col("l_linenumber").cast("int")))
    return out
