"""Zones (databases) and catalog tables in the session catalog.

* ``create_zones`` / ``drop_zones`` — ``CREATE DATABASE IF NOT EXISTS`` for
  raw, datawarehouse, delivery and sandbox; dropping (``CASCADE``) only with
  an explicit ``reset=True``.
* ``register_raw_table`` — an external, partitioned, unquoted-CSV table over
  a RAW folder (``CREATE TABLE IF NOT EXISTS ... LOCATION``), then
  ``repair`` (``MSCK REPAIR TABLE``) to pick up newly landed hours;
  ``add_partition`` registers one hour explicitly.
* ``save_table`` — create or replace a managed table (``saveAsTable``).
* ``describe`` — databases, tables, partitions and the DDL of a table.
Dropping an external table or zone never deletes landed files.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources import rawzone

ZONES = ("raw", "datawarehouse", "delivery", "sandbox")


def create_zones(spark: SparkSession, zones: Sequence[str] = ZONES) -> None:
    for z in zones:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {z}")


def drop_zones(spark: SparkSession, zones: Sequence[str] = ("datawarehouse", "delivery", "sandbox"),
               *, reset: bool = False) -> None:
    if not reset:
        raise ValueError("drop_zones deletes every table of the zones: pass reset=True")
    for z in zones:
        spark.sql(f"DROP DATABASE IF EXISTS {z} CASCADE")


def register_raw_table(spark: SparkSession, table: str, root: str, db: str = "raw") -> str:
    cols = rawzone.RAW_DDL[table].replace(" NOT NULL", "")
    parts = ", ".join(f"{c} STRING" for c in rawzone.PARTITION_COLS)
    name = f"{db}.{table}"
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} ({cols}, {parts})
        USING csv OPTIONS (sep ',', quote '', nullValue '\\\\N')
        PARTITIONED BY ({', '.join(rawzone.PARTITION_COLS)})
        LOCATION '{root.rstrip('/')}/{table}'""")
    repair(spark, name)
    return name


def _plain(column: str) -> str:
    """SQL of a RAW text field as it was before landing (``rawzone.land``
    escapes backslash, comma and line ends)."""
    step = f"replace({column}, '{BS * 2}', chr(10))"  # no text line holds a line end
    for mark, code in (("c", 44), ("r", 13)):
        step = f"replace({step}, '{BS}{mark}', chr({code}))"
    return (f"array_join(transform(split({step}, chr(10)), x -> replace(x, '{BS}n', chr(10))), '{BS}')")


#: a backslash inside a SQL string
BS = "\\" * 2


def register_raw_view(spark: SparkSession, table: str, db: str = "raw") -> str:
    """View ``<table>_plain`` over a registered RAW text table: text columns
    unescaped, everything else as it is."""
    cols = [f"{_plain(f.name)} AS {f.name}" if f.dataType == T.StringType() else f.name
            for f in rawzone.raw_schema(table, with_partitions=False).fields]
    name = f"{db}.{table}_plain"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join([*cols, *rawzone.PARTITION_COLS])} FROM {db}.{table}")
    return name


def register_csv_table(spark: SparkSession, name: str, location: str, ddl: str) -> str:
    """External CSV table whose files start with a header line (skipped)
    and quote with ``"`` (escape ``"``), e.g. the social-comments files."""
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} ({ddl})
        USING csv OPTIONS (header 'true', escape '"')
        LOCATION '{location}'""")
    return name


def repair(spark: SparkSession, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")


def add_partition(spark: SparkSession, name: str, values: dict) -> None:
    spec = ", ".join(f"{k}='{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec})")


def save_table(df: DataFrame, name: str, partition_cols: Sequence[str] = ()) -> None:
    w = df.write.mode("overwrite").format("parquet")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, buckets: int, by: Sequence[str],
                  partition_cols: Sequence[str] = ()) -> None:
    """Create or replace a managed table hash-bucketed on ``by`` (files
    sorted by it). A later aggregate on ``by``, or a join on ``by`` with
    another table bucketed the same way (or with a shuffle of the same
    partition count), reads the buckets as partitions: no exchange."""
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *by).sortBy(*by)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(name)


def describe(spark: SparkSession, name: str | None = None) -> dict:
    out = {"databases": [d.name for d in spark.catalog.listDatabases()]}
    if name:
        out["ddl"] = spark.sql(f"SHOW CREATE TABLE {name}").first()[0]
        parted = any(c.isPartition for c in spark.catalog.listColumns(name))
        out["partitions"] = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] if parted else []
    return out
