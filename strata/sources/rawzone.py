"""RAW landing zone: delimited text partitioned by ingest time.

Layout: ``{root}/{table}/year=YYYY/month=MM/day=DD/hour=HH/part-*``, comma
separated, no quoting but an escape for what would break a line, snappy-compressed
text by default, or Parquet. The partition
values are strings (``month=01`` stays ``"01"``) and the run time is a
parameter, so a re-run of the same hour replaces that hour only.

The schemas below are the fixed RAW contracts (column order = file order);
money and dates stay STRING at this zone and are parsed downstream.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLS = ("year", "month", "day", "hour")

# RAW table contracts of the ingestion pipelines (column order and
# types as landed), except that the TPC-H key columns are BIGINT instead of INT:
# INT keys overflow beyond 2^31 rows (lineitem past SF ~350), far below 100 TB.
RAW_DDL = {
    "customer": "c_custkey BIGINT, c_name STRING, c_address STRING, c_nationkey INT, "
                "c_phone STRING, c_acctbal STRING, c_mktsegment STRING, c_comment STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate STRING, "
                "l_commitdate STRING, l_receiptdate STRING, l_shipinstruct STRING, "
                "l_shipmode STRING, l_comment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT, n_comment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice STRING, "
              "o_orderdate STRING, o_orderpriority STRING, o_clerk STRING, "
              "o_shippriority INT, o_comment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_mfgr STRING, p_brand STRING, p_type STRING, "
            "p_size INT, p_container STRING, p_retailprice STRING, p_comment STRING",
    "partsupp": "ps_partkey BIGINT, ps_suppkey BIGINT, ps_availqty INT, ps_supplycost STRING, "
                "ps_comment STRING",
    "region": "r_regionkey INT, r_name STRING, r_comment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_address STRING, s_nationkey INT, "
                "s_phone STRING, s_acctbal STRING, s_comment STRING",
    "customer_comments": "custkey BIGINT NOT NULL, comment STRING NOT NULL",
    "social_comments": "comment_id STRING, customer_id STRING, product_id STRING, "
                       "comment_text STRING, comment_date STRING",
}


def raw_schema(table: str, with_partitions: bool = True) -> T.StructType:
    s = T._parse_datatype_string(RAW_DDL[table])
    if with_partitions:
        for c in PARTITION_COLS:
            s = s.add(c, T.StringType())
    return s


def partition_path(run_ts: dt.datetime) -> str:
    return run_ts.strftime("year=%Y/month=%m/day=%d/hour=%H")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project ``df`` onto the RAW column order; columns the source lacks
    are empty, every value is written as its string form."""
    cols = []
    for f in raw_schema(table, with_partitions=False).fields:
        if f.name in df.columns:
            src = df.schema[f.name].dataType
            c = F.col(f.name)
            if isinstance(src, (T.TimestampType, T.TimestampNTZType)):
                c = F.to_date(c)
            cols.append(c.cast("string").alias(f.name))
        else:
            cols.append(F.lit(None).cast("string").alias(f.name))
    return df.select(*cols)


def _escaped(c) -> F.Column:
    r"""A field as it stands in the text: backslash, comma and line ends are
    escaped (``\\``, ``\c``, ``\n``, ``\r``), so that no value holds a
    separator; NULL is ``\N``, an empty string an empty field."""
    for raw, mark in (("\\", "\\\\"), (",", "\\c"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(raw), F.lit(mark))
    return F.coalesce(c, F.lit("\\N"))


def _unescaped(c) -> F.Column:
    # the escape of a backslash goes by way of a character no text line holds
    c = F.replace(c, F.lit("\\\\"), F.lit("\n"))
    for mark, raw in (("\\c", ","), ("\\r", "\r")):
        c = F.replace(c, F.lit(mark), F.lit(raw))
    # \n last but one: its result must not be taken for the stand-in
    parts = F.transform(F.split(c, "\n"), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def land(df: DataFrame, root: str, table: str, run_ts: dt.datetime, *,
         mode: str = "overwrite", fmt: str = "text", compression: str = "snappy",
         partitions: int | None = None, max_records_per_file: int = 2_000_000) -> str:
    r"""Write one extract into its ingest-hour directory.

    ``mode="overwrite"`` replaces that hour (re-running the same hour is
    idempotent); ``mode="append"`` adds files (incremental append).
    ``fmt="text"`` writes unquoted comma-separated lines, values escaped as in
    ``_escaped``: plain values look as any unquoted text does, and every value
    reads back as it was. ``fmt="parquet"`` writes the same columns as Parquet.

    Snappy-compressed text cannot be split on read, so file count is read
    parallelism: give ``partitions`` for an extract that arrives in few (a
    JDBC read with a few connections); no file holds more than
    ``max_records_per_file`` rows.
    """
    path = f"{root.rstrip('/')}/{table}/{partition_path(run_ts)}"
    out = conform(df, table)
    if partitions:
        out = out.repartition(partitions)
    if fmt == "parquet":
        out.write.mode(mode).option("maxRecordsPerFile", max_records_per_file).parquet(path)
        return path
    # numbers and dates hold no separator
    plain = {c for c, kind in df.dtypes if kind in ("date", "timestamp", "timestamp_ntz", "boolean", "float", "double",
                                                    "tinyint", "smallint", "int", "bigint") or kind.startswith("decimal")}
    line = F.concat_ws(",", *[F.lit("\\N") if c not in df.columns else
                              F.coalesce(F.col(c), F.lit("\\N")) if c in plain else _escaped(F.col(c)) for c in out.columns])
    (out.select(line.alias("value")).write.mode(mode).option("compression", compression)
        .option("maxRecordsPerFile", max_records_per_file).text(path))
    return path


#: when a row's file was landed; orders copies within one ingest hour
LANDED = "_landed"
#: which write a row's file came from: the job id that Spark puts into the names
#: of all its files ('' for files of other writers: one landing an hour)
LANDING = "_landing"


def _landing_columns() -> list[F.Column]:
    return [F.col("_metadata.file_modification_time").alias(LANDED),
            F.regexp_extract("_metadata.file_name", r"^part-\d+-([0-9a-f-]{36})", 1).alias(LANDING)]


def read_raw(spark: SparkSession, root: str, table: str, *, fmt: str = "text",
             landed: bool = False) -> DataFrame:
    """Scan every landed hour of a RAW table with its fixed schema.

    Text fields are split on every comma (no quote handling, so an unescaped
    comma shifts the following columns, as with the Hive text format) and
    unescaped; ``\\N``, missing fields and unparseable numbers are NULL.
    Partition columns are strings and prune directories when filtered.
    ``landed`` adds the landing time of each row's file, and its landing."""
    path = f"{root.rstrip('/')}/{table}"
    data = raw_schema(table, with_partitions=False)
    parts = T.StructType([T.StructField(c, T.StringType()) for c in PARTITION_COLS])
    extra = _landing_columns() if landed else []
    if fmt == "parquet":
        strings = T.StructType([T.StructField(f.name, T.StringType()) for f in data.fields] + parts.fields)
        df = spark.read.schema(strings).parquet(path)
        return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in data.fields],
                         *PARTITION_COLS, *extra)
    return parse_lines(spark.read.schema(line_schema()).text(path), table, landed=landed)


def line_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in ("value", *PARTITION_COLS)])


def parse_lines(lines: DataFrame, table: str, *, landed: bool = False) -> DataFrame:
    """Lines of a RAW text table (batch or stream) by its contract."""
    extra = _landing_columns() if landed else []
    # the fields are cut once, below the projection that reads them; the first
    # one, mostly a key, has a cut of its own, so that filters on it and scans
    # of nothing else don't cut the whole line again
    lines = lines.select(F.split("value", ",", -1).alias("_f"), F.substring_index("value", ",", 1).alias("_first"),
                         *PARTITION_COLS, *extra)
    fields = []
    for i, f in enumerate(raw_schema(table, with_partitions=False).fields):
        v = F.get("_f", F.lit(i)) if i else F.col("_first")
        escaped = F.when(v.contains("\\") & (v != F.lit("\\N")), _unescaped(v))
        if isinstance(f.dataType, T.StringType):
            v = F.coalesce(escaped, F.when(v != F.lit("\\N"), v))
        else:  # what holds a backslash is no number as it stands
            v = F.coalesce(v.try_cast(f.dataType), escaped.try_cast(f.dataType))
        fields.append(v.alias(f.name))
    return lines.select(*fields, *PARTITION_COLS, *([LANDED, LANDING] if landed else []))


def read_csv_with_header(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                         escape: str = '"', multi_line: bool = False) -> DataFrame:
    """CSV with a header line and ``"`` escaping (the social-comments files).
    ``multi_line`` reads values with line breaks; such files are not split."""
    r = spark.read.option("header", "true").option("escape", escape).option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def ingest_time(df: DataFrame) -> F.Column:
    """Sortable ingest hour 'YYYYMMDDHH' from the partition columns."""
    return F.concat(*[F.lpad(F.col(c), 2 if c != "year" else 4, "0") for c in PARTITION_COLS])


def latest_ingest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Collapse re-ingested copies: per business key keep the row of the
    latest ingest hour and, within it, of the file landed last (where the
    column ``LANDED`` is there). One ``max(struct)`` aggregate: a key with
    many copies is reduced map-side, but the whole row travels through the
    aggregate's buffer, which plans as a sort aggregate."""
    cols = df.columns
    order = [ingest_time(df).alias("_t")] + ([F.col(LANDED)] if LANDED in cols else [])
    m = F.max(F.struct(*order, F.struct(*cols).alias("r")))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    picked = df.where(known).groupBy(*keys).agg(m.alias("_m")).select("_m.r.*")
    # rows without a full key cannot be matched to a copy: keep them all
    return picked.unionByName(df.where(~known))


def latest_groups(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Collapse re-landed copies of rows that have no key of their own: per
    group (the lines of an order), the rows of the newest landing that holds
    it, all of them, equal ones included. Older landings of the group go as a
    whole, so a line that a later copy changed or no longer has goes too.

    A landing is one write into one hour, so ``df`` needs ``LANDED`` and
    ``LANDING``; within an hour the landing with the latest file is the newest.
    The newest landing of a group is a partial maximum (a hot order is one row
    per task), and rows meet it in one join on the group, which AQE splits; what
    is joined on the group next needs no other shuffle. Rows without a full group
    key meet none, and are kept."""
    known = F.lit(True)
    for k in group:
        known = known & F.col(k).isNotNull()
    stamp = F.struct(ingest_time(df).alias("t"), F.col(LANDED).alias("at"), F.col(LANDING).alias("id"))
    newest = df.where(known).groupBy(*group).agg(F.max(stamp).alias("_newest"))
    return (df.join(newest, list(group), "left")
            .where(F.col("_newest").isNull()
                   | ((ingest_time(df) == F.col("_newest.t")) & (F.col(LANDING) == F.col("_newest.id"))))
            .select(*df.columns))


# Business keys of the RAW tables. A line has none: an order may
# repeat (l_orderkey, l_linenumber), so lines are replaced order by order.
KEYS = {"customer": ["c_custkey"], "nation": ["n_nationkey"], "orders": ["o_orderkey"], "part": ["p_partkey"],
        "partsupp": ["ps_partkey", "ps_suppkey"], "region": ["r_regionkey"], "supplier": ["s_suppkey"]}
GROUPS = {"lineitem": ["l_orderkey"]}


class RawTables:
    """The tables of a RAW zone by attribute, each row's latest copy: by
    business key, or by group where rows have none.

    ``windows`` names the date column by which a table is landed in windows
    (``{"lineitem": "l_shipdate"}``): a landing then holds an order's lines of
    some dates only, and replaces no others."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "text", windows: dict[str, str] | None = None):
        self._spark, self._root, self._fmt, self._windows = spark, root, fmt, windows or {}

    def __getattr__(self, table: str) -> DataFrame:
        if table not in KEYS and table not in GROUPS:
            raise AttributeError(table)
        copies = read_raw(self._spark, self._root, table, fmt=self._fmt, landed=True)
        if table in KEYS:
            rows = latest_ingest(copies, KEYS[table])
        else:
            window = [self._windows[table]] if table in self._windows else []
            rows = latest_groups(copies, GROUPS[table] + window)
        return rows.drop(LANDED, LANDING, *PARTITION_COLS)
