"""Column masking and role views as projections.

``mask(df, {col: rule})`` replaces columns by masked expressions; rules:
``redact`` (fixed ``*****``), ``last4`` (keep the last four characters),
``sha2`` (SHA-256 hex), ``null`` (typed NULL), ``year`` (a date truncated to
January 1st). ``role_view`` keeps only a role's columns and optional row
filter. Both are plain projections/filters, so pruning and pushdown still
reach the scan.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rule(c: Column, rule: str, dtype: str) -> Column:
    if rule == "redact":
        return F.when(c.isNull(), None).otherwise(F.lit("*****"))
    if rule == "last4":
        s = c.cast("string")
        return F.concat(F.repeat(F.lit("*"), F.greatest(F.length(s) - 4, F.lit(0))),
                        F.substring(s, -4, 4))
    if rule == "sha2":
        return F.sha2(c.cast("string"), 256)
    if rule == "null":
        return F.lit(None).cast(dtype)
    if rule == "year":
        return F.trunc(c.cast("date"), "year")
    raise ValueError(f"unknown mask rule {rule}")


def mask(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(*[_rule(F.col(c), rules[c], types[c]).alias(c) if c in rules else F.col(c)
                       for c in df.columns])


def role_view(df: DataFrame, columns: list[str], row_filter: Column | None = None,
              rules: dict[str, str] | None = None) -> DataFrame:
    out = df.where(row_filter) if row_filter is not None else df
    out = out.select(*columns)
    return mask(out, rules) if rules else out
