"""Date parsing and calendar parts."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_date(df: DataFrame, name: str, fmt: str | None = "yyyy-MM-dd") -> Column:
    """DATE from a string, date or timestamp column.

    Strings are parsed with ``try_to_date`` so a bad value becomes NULL (the
    non-ANSI behaviour the pipelines were written for); typed inputs are
    truncated to their calendar day.
    """
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, T.DateType):
        return c
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    if isinstance(dt, T.StringType):
        return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)
    return F.lit(None).cast("date")


def quarter_int(d: Column) -> Column:
    return F.quarter(d)


def quarter_str(d: Column) -> Column:
    """Quarter as the one-character string ``date_format(d, 'Q')`` gives."""
    return F.date_format(d, "Q")


def iso_week(d: Column) -> Column:
    return F.weekofyear(d)
