"""End-to-end jobs over the zones of a warehouse folder.

    {warehouse}/datawarehouse/<star table>     parquet (fact partitioned by year, month)
    {warehouse}/datawarehouse_shipdate/...     the ship-date variant beside it
    {warehouse}/delivery/<mart>                parquet, replaced each run
    {warehouse}/delivery_shipdate/...
    {warehouse}/sandbox/<table>                parquet
    {warehouse}/ledger                         run ledger

Each job is one Spark application step: read → transform → write. The
order the scheduler used (create → populate; generate → score) is plain
function order here.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import checks
from ..session import shared_copy
from ..sinks import swap
from ..sinks.writer import save_star, write_by_name, write_table
from ..sources import rawzone
from ..sources.comments import generate_comments
from . import archive, classifier, ledger, maintain, marts, refresh, sentiment, star

STAR_TABLES = ("dim_customer", "dim_supplier", "dim_part", "dim_order", "dim_geography", "dim_time", "fact_sales")
SANDBOX_CONTRACT = T.StructType([
    T.StructField("custkey", T.StringType()), T.StructField("customer_name", T.StringType()),
    T.StructField("nationkey", T.LongType()), T.StructField("comment", T.StringType()),
    T.StructField("predicted_label", T.StringType()), T.StructField("score", T.DoubleType())])


def _zone(warehouse: str, zone: str) -> str:
    return f"{warehouse.rstrip('/')}/{zone}"


def _of(variant: str, zone: str) -> str:
    """Zone folder of a star variant: the two can live in one warehouse."""
    return zone if variant == "orderdate" else f"{zone}_{variant}"


def init_datawarehouse(spark: SparkSession, raw, warehouse: str, variant: str = "orderdate",
                       line_safe: bool = False) -> dict[str, str]:
    """Build and write every star table (create-or-replace, idempotent).
    ``raw`` may be ``rawzone.RawTables``, which holds the latest copy of each
    row. ``line_safe`` keeps ``linenumber`` in the fact, for refreshes of the
    same mode."""
    s = star.build_star(raw, variant, line_safe)
    paths = save_star(spark, s, _zone(warehouse, _of(variant, "datawarehouse")))
    ledger.record(spark, f"{warehouse}/ledger", "init_datawarehouse", variant,
                  rows_out=spark.read.parquet(paths["fact_sales"]).count())
    return paths


def read_star(spark: SparkSession, warehouse: str, variant: str = "orderdate") -> star.Star:
    root = _zone(warehouse, _of(variant, "datawarehouse"))
    for n in STAR_TABLES:
        swap.recover(spark, f"{root}/{n}")
    t = {n: spark.read.parquet(f"{root}/{n}") for n in STAR_TABLES}
    # partition values come back as strings (type inference is off so RAW
    # hours keep their zeros); the fact contract has them as INT
    f = t["fact_sales"]
    parts = [c for c in ("year", "month", "day", "order_year", "order_month", "order_day")
             if c in f.columns and dict(f.dtypes)[c] != "int"]
    t["fact_sales"] = f.withColumns({c: F.col(c).cast("int") for c in parts}) if parts else f
    return star.Star(variant=variant, **t)


def create_datamarts(spark: SparkSession, warehouse: str, variant: str = "orderdate") -> dict[str, str]:
    """Write the marts of the stored star into the delivery zone. Marts
    are small aggregates: not partitioned by their grouping key (that would
    make one directory per customer / part / supplier)."""
    out = {}
    s = read_star(spark, warehouse, variant)
    if variant == "shipdate":
        # the marts leave out the left joins to these dimensions, which change
        # nothing as long as their keys are unique
        keys = [checks.unique(s.dim_customer, ["customer_key"]), checks.unique(s.dim_supplier, ["supplier_key"]),
                checks.unique(s.dim_part, ["part_key"])]
        if bad := [r["check"] for r in checks.run_checks(keys).where("violations > 0").collect()]:
            raise ValueError(f"dimension keys repeat: {bad}")
    for name, df in marts.build_marts(s).items():
        p = f"{_zone(warehouse, _of(variant, 'delivery'))}/{name}"
        write_table(df, p)
        out[name] = p
    return out


def refresh_datawarehouse(spark: SparkSession, raw, warehouse: str, mode: str = "reference",
                          dims: bool = False, on_duplicate: str = "error", maintain_marts: bool = False) -> int:
    """Merge the staging rows into the stored order-date fact; the ledger gets
    how many this run merged. With ``maintain_marts`` the marts' state
    (``init_maintained_marts``) follows by the changes alone."""
    root = _zone(warehouse, "datawarehouse")
    if maintain_marts:
        merged = maintain.refresh_marts(spark, raw, lambda: read_star(spark, warehouse), f"{root}/fact_sales",
                                        warehouse, mode=mode, on_duplicate=on_duplicate)
        if dims:
            refresh.refresh_dim_order(raw, f"{root}/dim_order", on_duplicate)
    else:
        merged = refresh.refresh_tables(raw, f"{root}/fact_sales", f"{root}/dim_order", mode=mode, dims=dims,
                                        on_duplicate=on_duplicate)
    ledger.record(spark, f"{warehouse}/ledger", "refresh_datawarehouse", mode, rows_out=merged)
    return merged


def init_maintained_marts(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """Build the state of the order-date marts from the stored star; refreshes
    with ``maintain_marts`` keep it up to date."""
    maintain.rebuild(spark, read_star(spark, warehouse), warehouse)
    return maintain.view(spark, warehouse)


def archive_fact(spark: SparkSession, warehouse: str, before: str, target_bytes: int = archive.TARGET_BYTES) -> int:
    """Move the fact's months before the date ``before`` (its month stays hot)
    to the archive zone, packed into files of ``target_bytes``; the ledger gets
    how many partitions went. ``read_fact_tiers`` reads both."""
    year, month = F.col("year").cast("int"), F.col("month").cast("int")
    cut = F.to_date(F.lit(before))
    cold = (year * 12 + month) < (F.year(cut) * 12 + F.month(cut))
    moved = archive.archive(spark, f"{_zone(warehouse, 'datawarehouse')}/fact_sales",
                            f"{_zone(warehouse, 'archive')}/fact_sales", ["year", "month"], cold, target_bytes)
    ledger.record(spark, f"{warehouse}/ledger", "archive_fact", before, rows_out=moved)
    return moved


def read_fact_tiers(spark: SparkSession, warehouse: str) -> DataFrame:
    """The fact with both tiers' rows, and ``tier``."""
    rows = archive.tiers(spark, f"{_zone(warehouse, 'datawarehouse')}/fact_sales",
                         f"{_zone(warehouse, 'archive')}/fact_sales", ["year", "month"])
    return rows.withColumns({c: F.col(c).cast("int") for c in ("year", "month")})


def init_sandbox(spark: SparkSession, warehouse: str, n_comments: int, customers: int,
                 mode: str = "hash", seed: int = 42) -> DataFrame:
    """Generate comments into raw/customer_comments, score and enrich them
    with the customer dimension and replace sandbox/sentiment_analysis_results
    (columns matched by name), so a second run gives the same table. The
    ledger gets the run's row count, read back from the written files."""
    comments_path = f"{_zone(warehouse, 'raw')}/customer_comments"
    write_table(generate_comments(spark, n_comments, customers, mode=mode, seed=seed), comments_path)
    comments = spark.read.parquet(comments_path)
    dim = read_star(spark, warehouse).dim_customer
    out = sentiment.enrich(comments, dim)
    target = f"{_zone(warehouse, 'sandbox')}/sentiment_analysis_results"
    write_by_name(out, target, SANDBOX_CONTRACT, mode="overwrite")
    written = spark.read.parquet(target)
    ledger.record(spark, f"{warehouse}/ledger", "init_sandbox", target,
                  rows_in=n_comments, rows_out=written.count())
    return written


def customer_sentiment(spark: SparkSession, warehouse: str) -> str:
    """Classify the stored comments by the weakly supervised model, join the
    customer dimension (left) and replace sandbox/customer_sentiment."""
    comments = (spark.read.parquet(f"{_zone(warehouse, 'raw')}/customer_comments")
                .withColumn("comment_id", F.monotonically_increasing_id()))
    target = f"{_zone(warehouse, 'sandbox')}/customer_sentiment"
    with shared_copy(comments, "comments") as stored:  # ids must not change between passes
        rated = classifier.classify(stored, "comment_id", "comment")
        dim = read_star(spark, warehouse).dim_customer.select("custkey", F.col("name").alias("customer_name"))
        out = (stored.join(rated, "comment_id").join(dim, "custkey", "left")
               .select("custkey", "customer_name", "comment", "p_positive", "sentiment"))
        write_table(out, target)
    ledger.record(spark, f"{warehouse}/ledger", "customer_sentiment", target,
                  rows_out=spark.read.parquet(target).count())
    return target


def sentiment_products(spark: SparkSession, comments_dir: str, warehouse: str) -> str:
    """Score CSV comment files (header, ``"`` escaping) with lexicon B and
    join them to the ship-date star's customer and part dimensions; replace
    sandbox/sentiment_analysis_results_b."""
    comments = rawzone.read_csv_with_header(spark, comments_dir,
                                            rawzone.raw_schema("social_comments", False))
    s = read_star(spark, warehouse, "shipdate")
    out = sentiment.enrich_products(comments, s.dim_customer, s.dim_part)
    target = f"{_zone(warehouse, 'sandbox')}/sentiment_analysis_results_b"
    write_table(out, target)
    return target


# ---------------------------------------------------------------- bucketed catalog star
# Keys the star tables are bucketed on (variant A names).
BUCKET_KEYS = {"dim_customer": ["custkey"], "dim_supplier": ["suppkey"], "dim_part": ["partkey"],
               "dim_order": ["orderkey"], "fact_sales": ["custkey"]}


def init_datawarehouse_catalog(spark: SparkSession, raw, db: str = "datawarehouse",
                               buckets: int | None = None) -> dict[str, str]:
    """Write the order-date star as catalog tables: dimensions bucketed on
    their keys, the fact partitioned by (year, month) and bucketed on
    custkey. With ``buckets`` equal to ``spark.sql.shuffle.partitions`` the
    customer marts aggregate the fact and join dim_customer without any
    exchange of either table. Small dimensions (geography, time) are plain
    tables."""
    from ..sinks import catalog
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    catalog.create_zones(spark, [db])
    s = star.build_star(raw, "orderdate")
    names = {}
    for name, df in s.tables().items():
        full = f"{db}.{name}"
        if name in BUCKET_KEYS:
            parts = list(s.partition_cols) if name == "fact_sales" else []
            catalog.save_bucketed(df, full, buckets, BUCKET_KEYS[name], parts)
        else:
            catalog.save_table(df, full)
        names[name] = full
    return names


def read_star_catalog(spark: SparkSession, db: str = "datawarehouse") -> star.Star:
    t = {n: spark.table(f"{db}.{n}") for n in STAR_TABLES}
    return star.Star(variant="orderdate", **t)


def run_all(spark: SparkSession, raw, warehouse: str, *, n_comments: int | None = None,
            customers: int | None = None) -> dict:
    """The jobs in the order the scheduled pipelines ran them: build the
    star (create → populate), write the marts, then generate and score the
    comments (generate → sentiment). Each step is re-run safe."""
    paths = init_datawarehouse(spark, raw, warehouse)
    mart_paths = create_datamarts(spark, warehouse)
    customers = customers or read_star(spark, warehouse).dim_customer.count()
    sandbox = init_sandbox(spark, warehouse, n_comments or customers, customers)
    customer_sentiment(spark, warehouse)
    return {"star": paths, "marts": mart_paths, "sandbox_rows": sandbox.count()}
