"""Type-tolerant column accessors.

RAW tables hold money and dates as STRING; the parquet tables hold them typed.
These helpers give the same typed Column for either input, and a typed NULL
when a column is absent, so one pipeline serves both.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def col_or_null(df: DataFrame, name: str, dtype: str) -> Column:
    """``df[name]`` cast to ``dtype``, or a typed NULL if the column is missing."""
    if has_column(df, name):
        return safe_cast(df, name, dtype)
    return F.lit(None).cast(dtype)


def safe_cast(df: DataFrame, name: str, dtype: str) -> Column:
    """Cast that yields NULL on bad input instead of failing (ANSI stays on)."""
    src = df.schema[name].dataType
    if src.simpleString() == T._parse_datatype_string(dtype).simpleString():
        return F.col(name)
    if isinstance(src, T.StringType):
        return F.expr(f"try_cast(`{name}` AS {dtype})")
    return F.col(name).cast(dtype)
