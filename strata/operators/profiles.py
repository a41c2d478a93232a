"""Column profiles that merge.

The profile of a partition (a day, a file load) is one small row per column:
counts, least and greatest value, and three sketches of bounded size. Profiles
are stored beside the data and merged by aggregates over those rows, so the
profile of a month, or of a table that got a new partition, reads no old data.

* distinct values: HyperLogLog (``hll_sketch_agg``, lgConfigK 12: standard
  error 1.6 %)
* quantiles of numbers: KLL (``kll_sketch_agg_double``, k 200: rank error about
  1.7 % of the rows)
* heavy hitters: frequent items (``approx_top_k_accumulate``): exact while a
  column has at most ``TRACKED`` values, else a count is off by at most some
  rows / (0.75 * TRACKED)

Counts, nulls, least and greatest are exact.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRACKED = 1000
#: what is stored of a column; one of the three least/greatest pairs is filled
_KINDS = ("long", "double", "string")
_MERGED = ["rows", "nulls", *[f"{end}_{k}" for k in _KINDS for end in ("least", "greatest")], "hll", "kll", "top"]


def _kind(t: T.DataType) -> str:
    if isinstance(t, T.IntegralType):
        return "long"
    return "double" if isinstance(t, T.NumericType) else "string"


def partial(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per partition (the columns ``by``) and column of ``df``. One
    scan; a task sends one row of sketches per partition."""
    aggs, names = [F.count(F.lit(1)).alias("rows")], []
    for i, c in enumerate(cols):
        kind = _kind(df.schema[c].dataType)
        x = F.col(c).cast(kind)
        none = {k: F.lit(None).cast(k) for k in _KINDS}
        ends = {k: (F.min(x), F.max(x)) if k == kind else (F.max(none[k]), F.max(none[k])) for k in _KINDS}
        quantiles = F.kll_sketch_agg_double(x.cast("double") if kind != "string" else none["double"])
        top = F.call_function("approx_top_k_accumulate", F.col(c).cast("string"), F.lit(TRACKED))
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.count(F.when(F.col(c).isNull(), 1)).alias("nulls"),
            *[e.alias(f"{end}_{k}") for k in _KINDS for end, e in zip(("least", "greatest"), ends[k])],
            F.hll_sketch_agg(F.col(c).cast("string")).alias("hll"), quantiles.alias("kll"), top.alias("top")).alias(f"p{i}"))
        names.append(f"p{i}")
    one = df.groupBy(*by).agg(*aggs)
    return one.select(*by, "rows", F.explode(F.array(*names)).alias("p")).select(*by, "rows", "p.*")


def merged(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of larger parts: of the whole, or of each value of ``by``."""
    ends = [(F.min if end == "least" else F.max)(f"{end}_{k}").alias(f"{end}_{k}")
            for k in _KINDS for end in ("least", "greatest")]
    return profiles.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), *ends,
        F.hll_union_agg("hll").alias("hll"), F.kll_merge_agg_double("kll").alias("kll"),
        F.call_function("approx_top_k_combine", F.col("top"), F.lit(TRACKED)).alias("top"))


def summary(profiles: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), most: int = 3) -> DataFrame:
    """Readable form: estimates instead of sketches. ``quantiles`` is null for
    columns that hold no number, ``top`` the ``most`` most frequent values."""
    ends = [F.coalesce(*[F.col(f"{end}_{k}").cast("string") for k in _KINDS]).alias(name)
            for end, name in (("least", "min"), ("greatest", "max"))]
    some = F.coalesce(F.kll_sketch_get_n_double("kll"), F.lit(0)) > 0
    at = F.when(some, F.array(*[F.kll_sketch_get_quantile_double("kll", F.lit(float(q))) for q in quantiles]))
    kept = [c for c in profiles.columns if c not in _MERGED]
    return profiles.select(*kept, "rows", "nulls", *ends, F.hll_sketch_estimate("hll").alias("distinct"),
                           at.alias("quantiles"),
                           F.call_function("approx_top_k_estimate", F.col("top"), F.lit(most)).alias("top"))
