"""Hot / archive split of a dated table.

Rows dated before ``cutoff`` go to the archive tier, the rest stay hot.
When the table is partitioned by date parts, both sides are partition
filters, so each tier reads only its own directories.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def retention_split(df: DataFrame, date_col: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    c = F.col(date_col)
    cut = F.lit(cutoff).cast("date")
    return df.where(c >= cut), df.where(c < cut)


def tier_counts(df: DataFrame, date_col: str, cutoff: str) -> DataFrame:
    """Rows per tier ('hot', 'archive'; NULL dates are 'undated')."""
    c = F.col(date_col)
    tier = (F.when(c.isNull(), "undated").when(c < F.lit(cutoff).cast("date"), "archive")
            .otherwise("hot"))
    return df.groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("rows"))
