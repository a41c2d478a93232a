"""Parallel JDBC extraction.

One extract = one table (or query) read by ``num_partitions`` concurrent
tasks. Splitting follows the column type:

* ``split="quantile"``: split points are the keys of equally spaced ranks,
  asked from the database (one counting query, then one row per point), so a
  dense key range is cut where its rows are. Numbers, dates and text alike;
  both ends are open and NULL keys go with the first split. One key is never
  cut: a split holds at most a share of the rows and the copies of one key;
* ``split="range"``: equal-width ranges between a number's or date's MIN and MAX
  (one aggregate row), the built-in ``partitionColumn / lowerBound /
  upperBound / numPartitions``, without ordered queries in the database;
* explicit ``predicates``, one task each;
* no ``split_by``: a single task (small tables).

A half-open window ``lo <= col < hi`` and an incremental high-water mark
``col > last`` are DataFrame filters; Spark pushes them into the
database's WHERE clause.
"""
from __future__ import annotations

import decimal
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ExtractSpec:
    table: str
    split_by: str | None = None
    num_partitions: int = 4
    window_col: str | None = None
    window: tuple[str, str] | None = None      # half-open [lo, hi)
    check_column: str | None = None             # incremental append column
    predicates: tuple[str, ...] = ()            # explicit splits
    split: str = "range"                        # or "quantile"
    # the row of a rank in an ordered query, in the database's dialect
    row_at: str = "OFFSET {rank} ROWS FETCH NEXT 1 ROWS ONLY"
    fetchsize: int = 10_000
    lower_case_columns: bool = True             # o_orderkey whatever the DB's case
    options: dict = field(default_factory=dict)


# The eight TPC-H extracts of the batch and incremental pipelines, with
# their split columns, task counts and date windows (fixed values of the
# source pipelines; windows are parameters of each run).
BATCH_SPECS = {
    "nation": ExtractSpec("nation", num_partitions=1),
    "region": ExtractSpec("region", num_partitions=1),
    "supplier": ExtractSpec("supplier", num_partitions=1),
    "customer": ExtractSpec("customer", split_by="c_nationkey", num_partitions=4, split="quantile"),
    "part": ExtractSpec("part", split_by="p_size", num_partitions=4, split="quantile"),
    "partsupp": ExtractSpec("partsupp", split_by="ps_partkey", num_partitions=4, split="quantile"),
    "orders": ExtractSpec("orders", split_by="o_orderdate", num_partitions=4, split="quantile",
                          window_col="o_orderdate", window=("1992-01-01", "1994-01-01")),
    "lineitem": ExtractSpec("lineitem", split_by="l_shipdate", num_partitions=4, split="quantile",
                            window_col="l_shipdate", window=("1992-01-01", "1992-06-01")),
}
INCREMENTAL_SPECS = {
    # by mark alone: a date window beside it would leave rows out for good
    "orders": ExtractSpec("orders", split_by="o_orderdate", num_partitions=4, split="quantile",
                          check_column="o_orderkey"),
    "lineitem": ExtractSpec("lineitem", split_by="l_shipdate", num_partitions=4, split="quantile",
                            check_column="l_orderkey"),
}


def _reader(spark: SparkSession, url: str, props: dict, spec: ExtractSpec):
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", spec.fetchsize)
    for k, v in {**props, **spec.options}.items():
        r = r.option(k, v)
    return r


def _where(spec: ExtractSpec, last_value=None, upper_value=None) -> list[str]:
    conds = []
    if spec.window and spec.window_col:
        lo, hi = spec.window
        conds.append(f"{spec.window_col} >= '{lo}' AND {spec.window_col} < '{hi}'")
    if spec.check_column and last_value is not None:
        conds.append(f"{spec.check_column} > {last_value}")
    if spec.check_column and upper_value is not None:
        conds.append(f"{spec.check_column} <= {upper_value}")
    return conds


def check_upper(spark: SparkSession, url: str, spec: ExtractSpec, props: dict | None = None,
                last_value=None):
    """MAX(check column) of the rows an incremental extract may take now,
    computed by the database (one row): the run extracts (last, upper]."""
    where = _where(spec, last_value)
    q = (f"SELECT MAX({spec.check_column}) AS hi FROM {spec.table}"
         + (" WHERE " + " AND ".join(where) if where else ""))
    return _reader(spark, url, dict(props or {}), spec).option("query", q).load().first()[0]


def split_bounds(spark: SparkSession, url: str, props: dict, spec: ExtractSpec,
                 last_value=None, upper_value=None):
    """MIN/MAX of the split column, computed by the database (one row)."""
    where = _where(spec, last_value, upper_value)
    q = (f"SELECT MIN({spec.split_by}) AS lo, MAX({spec.split_by}) AS hi FROM {spec.table}"
         + (" WHERE " + " AND ".join(where) if where else ""))
    row = _reader(spark, url, props, spec).option("query", q).load().first()
    return row[0], row[1]


def _literal(value) -> str:
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def quantile_points(spark: SparkSession, url: str, props: dict, spec: ExtractSpec,
                    last_value=None, upper_value=None) -> list:
    """Distinct keys of ranks n/k, 2n/k, ... of the rows that the extract takes
    (its window and marks), ascending; at most ``num_partitions - 1``."""
    where = " WHERE " + " AND ".join([*_where(spec, last_value, upper_value), f"{spec.split_by} IS NOT NULL"])
    ask = lambda q: _reader(spark, url, props, spec).option("query", q).load()
    rows = int(ask(f"SELECT COUNT(*) AS n FROM {spec.table}{where}").first()[0])
    ranks = sorted({rows * i // spec.num_partitions for i in range(1, spec.num_partitions)} - {0})
    points = []
    for rank in ranks:
        q = (f"SELECT {spec.split_by} AS k FROM {spec.table}{where} ORDER BY {spec.split_by} "
             + spec.row_at.format(rank=rank))
        key = ask(q).first()[0]
        if not points or key != points[-1]:
            points.append(key)
    return points


def quantile_predicates(spark: SparkSession, url: str, props: dict, spec: ExtractSpec,
                        last_value=None, upper_value=None) -> tuple[str, ...]:
    """One predicate per split; together they hold every row once. A key that
    spans a whole split is a split of its own start."""
    points, c = quantile_points(spark, url, props, spec, last_value, upper_value), spec.split_by
    if not points:
        return ()
    at = [_literal(p) for p in points]
    first = f"({c} < {at[0]} OR {c} IS NULL)"
    middle = [f"{c} >= {a} AND {c} < {b}" for a, b in zip(at, at[1:])]
    return (first, *middle, f"{c} >= {at[-1]}")


def extract(spark: SparkSession, url: str, spec: ExtractSpec, props: dict | None = None,
            last_value=None, upper_value=None) -> DataFrame:
    """Read one table according to ``spec`` (lazy apart from the bounds query)."""
    props = dict(props or {})
    r = _reader(spark, url, props, spec)
    predicates = spec.predicates
    if not predicates and spec.split == "quantile" and spec.split_by and spec.num_partitions > 1:
        predicates = quantile_predicates(spark, url, props, spec, last_value, upper_value)
        if not predicates:  # too few rows to split
            spec = replace(spec, split_by=None)
    if predicates:
        df = spark.read.jdbc(url, spec.table, predicates=list(predicates),
                             properties={**props, **spec.options,
                                         "fetchsize": str(spec.fetchsize)})
    elif spec.split_by and spec.num_partitions > 1:
        lo, hi = split_bounds(spark, url, props, spec, last_value, upper_value)
        if lo is None:   # empty window: nothing to split
            df = r.option("dbtable", spec.table).load()
        else:
            df = (r.option("dbtable", spec.table).option("partitionColumn", spec.split_by)
                  .option("lowerBound", str(lo)).option("upperBound", str(hi))
                  .option("numPartitions", spec.num_partitions).load())
    else:
        df = r.option("dbtable", spec.table).load()
    if spec.lower_case_columns:
        df = df.toDF(*[c.lower() for c in df.columns])
    return window_filter(df, spec, last_value, upper_value)


def window_filter(df: DataFrame, spec: ExtractSpec, last_value=None,
                  upper_value=None) -> DataFrame:
    """Apply the half-open window and the high-water marks ``last <
    check <= upper`` as filters (pushed down to JDBC or parquet sources)."""
    if spec.window and spec.window_col:
        lo, hi = spec.window
        c = F.col(spec.window_col)
        df = df.where((c >= F.lit(lo).cast("date")) & (c < F.lit(hi).cast("date")))
    if spec.check_column and last_value is not None:
        df = df.where(F.col(spec.check_column) > F.lit(last_value))
    if spec.check_column and upper_value is not None:
        df = df.where(F.col(spec.check_column) <= F.lit(upper_value))
    return df


def text_predicates(column: str, boundaries: Sequence[str]) -> tuple[str, ...]:
    """Predicates splitting a text column at the given sorted boundaries
    (plus a NULL split), for ``ExtractSpec.predicates``; ``split="quantile"``
    finds boundaries itself."""
    preds, prev = [], None
    for b in map(_literal, boundaries):
        preds.append(f"{column} < {b}" if prev is None else f"{column} >= {prev} AND {column} < {b}")
        prev = b
    preds.append(f"{column} >= {prev}" if prev is not None else f"{column} IS NOT NULL")
    preds.append(f"{column} IS NULL")
    return tuple(preds)


def probe(spark: SparkSession, url: str, sql: str, props: dict | None = None) -> DataFrame:
    """Run an arbitrary query in the source database (e.g. a LIMIT 5 look
    at a table) and return its rows as a DataFrame."""
    r = spark.read.format("jdbc").option("url", url).option("query", sql)
    for k, v in (props or {}).items():
        r = r.option(k, v)
    return r.load()


def register_view(spark: SparkSession, url: str, table: str, view: str | None = None,
                  props: dict | None = None) -> str:
    """Expose a source-database table as a temp view (federated query:
    filters and projections on the view are pushed into the database)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (props or {}).items():
        r = r.option(k, v)
    name = view or table
    r.load().createOrReplaceTempView(name)
    return name
