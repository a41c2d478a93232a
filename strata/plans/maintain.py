"""Marts kept up to date from the changes of a refresh.

Rebuilding a mart reads the whole fact. A refresh changes few orders, and every
figure of the order-date marts is a sum over lines, so a mart can be kept as
sums and corrected: the old lines of the touched orders with sign -1, the new
ones with sign +1.

* ``order_state``: one row per (order, customer, month) with the exact unit
  sums, counts and NaN counts of its lines. It is the old side of a change, and
  it decides distinct counts: an order that a group holds before but not after
  is -1, the other way round +1.
* one state table per mart: the same sums per group, and ``orders``.

A run is one batch. It first stores what it is going to apply: the staged
source rows, and the old and new order-grain rows of every order that changes
(``changes/<batch>``). Then it upserts the fact, adds the changes to the groups
they touch and replaces the touched orders. A group's row carries the batch that
changed it last and takes none twice, and the other two steps may be repeated,
so a run that dies anywhere is finished by the next one from what was stored.
(A merged fact is noted in the ledger: rows with a NULL key, which a MERGE
inserts each time, must not come twice. Only a driver that dies between the
merge and its note would repeat those.)
State tables are partitioned by a hash bucket of the group (the monthly one by
year); only partitions that hold a changed group are written.

Dimensions are read as they are when a change is applied: after a customer
moved to another nation, rebuild (``rebuild``).
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import NET_SCALE, SCALE, net_units, sum_units, to_amount, units
from ..operators.upsert import merge_frames, upsert_table
from ..sinks import paths
from ..sinks.writer import replace_partitions, write_table
from . import ledger, refresh
from .star import Star

JOB, MERGED = "maintain_marts", "maintain_marts:fact"
#: additive measures of the lines: name -> (units of a line, decimals, inputs that may be NaN)
MEASURES = {
    "net": (lambda: net_units("extendedprice", "discount"), NET_SCALE, ("extendedprice", "discount")),
    "price": (lambda: units("extendedprice"), SCALE, ("extendedprice",)),
    "discount": (lambda: units("discount"), SCALE, ("discount",)),
    "tax": (lambda: units("tax"), SCALE, ("tax",)),
    "quantity": (lambda: units("quantity"), SCALE, ("quantity",)),
}
ORDER = ["orderkey", "custkey", "year", "month"]
BUCKETS, SUM = 64, "decimal(38,0)"


def _columns(names) -> list[str]:
    """Sum, count of values and count of NaN of each measure."""
    return [f"{kind}_{n}" for n in names for kind in ("sum", "n", "nan")]


STATE = ["lines", *_columns(MEASURES)]


def order_grain(fact: DataFrame) -> DataFrame:
    """The fact's lines summed per (order, customer, month)."""
    aggs = [F.count(F.lit(1)).alias("lines")]
    for name, (unit, _, inputs) in MEASURES.items():
        nan = F.lit(False)
        for c in inputs:
            nan = nan | F.coalesce(F.isnan(c), F.lit(False))
        aggs += [F.coalesce(sum_units(unit()), F.lit(0)).cast(SUM).alias(f"sum_{name}"),
                 F.count(unit()).alias(f"n_{name}"), F.count(F.when(nan, 1)).alias(f"nan_{name}")]
    return fact.groupBy(*ORDER).agg(*aggs)


def changed_orders(old: DataFrame, new: DataFrame) -> DataFrame:
    """All old rows (sign -1) and all new rows (+1) of the orders that differ."""
    both = old.withColumn("sign", F.lit(-1)).unionByName(new.withColumn("sign", F.lit(1)))
    differ = (both.groupBy(*ORDER, *STATE).agg(F.sum("sign").alias("sign")).where(F.col("sign") != 0)
              .select("orderkey").distinct())
    return both.join(differ, "orderkey", "left_semi")


def _sums(names) -> list[Column]:
    """Signed sums of state columns (aggregates)."""
    return [F.sum(F.when(F.col("sign") < 0, -F.col(c)).otherwise(F.col(c))).cast(SUM if c.startswith("sum_") else "long")
            .alias(c) for c in names]


@dataclass(frozen=True)
class Mart:
    """Group columns, measures, whether distinct orders are counted, and the
    partition of a group's state row."""

    name: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    orders: bool

    @property
    def sums(self) -> list[str]:
        return ["lines", *_columns(self.measures)]

    @property
    def part(self) -> Column:
        if self.name == "sales_summary":
            return F.coalesce(F.col("year"), F.lit(-1)).cast("int")
        return F.pmod(F.xxhash64(self.keys[0]), F.lit(BUCKETS)).cast("int")

    def grouped(self, rows: DataFrame, star: Star) -> DataFrame:
        """Order-grain rows with the mart's group columns."""
        if self.name == "sales_by_customer":
            return rows.join(star.dim_customer.select("custkey", "name"), "custkey")
        if self.name == "sales_by_region":
            geo = star.dim_geography.select("nationkey", "regionname")
            return rows.join(star.dim_customer.select("custkey", "nationkey").join(geo, "nationkey"), "custkey")
        return rows

    def delta(self, changes: DataFrame, star: Star) -> DataFrame:
        """What changes in every group that changes: sums and distinct orders."""
        rows, orders = self.grouped(changes, star), F.max(F.lit(0)).cast("long")
        if self.orders:
            # an order's rows are all there: it was, and is, in a group that one of them is in
            there = lambda sign: F.max((F.col("sign") == sign).cast("long"))
            rows = (rows.groupBy(*self.keys, "orderkey").agg(*_sums(self.sums), (there(1) - there(-1)).alias("orders"))
                    .withColumn("sign", F.lit(1)))
            orders = F.sum("orders")
        out = rows.groupBy(*self.keys).agg(*_sums(self.sums), orders.alias("orders"))
        changed = F.lit(False)
        for c in (*self.sums, "orders"):
            changed = changed | (F.col(c) != 0)
        return out.where(changed).withColumn("part", self.part)

    def total(self, name: str) -> Column:
        return (F.when(F.col(f"nan_{name}") > 0, F.lit(float("nan")))
                .when(F.col(f"n_{name}") > 0, to_amount(F.col(f"sum_{name}"), MEASURES[name][1])))

    def view(self, state: DataFrame) -> DataFrame:
        """The mart's published columns; a group without lines is none."""
        rows = state.where(F.col("lines") > 0)
        if self.name == "sales_summary":
            mean = lambda n: F.try_divide(self.total(n), F.col(f"n_{n}") + F.col(f"nan_{n}"))
            return rows.select("year", "month", self.total("price").alias("total_revenue"),
                               mean("discount").alias("avg_discount"), mean("tax").alias("avg_tax"),
                               self.total("quantity").alias("total_quantity"))
        return rows.select(*self.keys, self.total("net").alias("total_revenue"), F.col("orders").alias("total_orders"))


MARTS = (
    Mart("sales_by_customer", ("custkey", "name"), ("net",), True),
    Mart("sales_by_region", ("regionname",), ("net",), True),
    Mart("sales_summary", ("year", "month"), ("price", "discount", "tax", "quantity"), False),
)


def _root(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/delivery_state"


def _read(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.withColumn("part", F.col("part").cast("int"))  # partition values come back as strings


def rebuild(spark: SparkSession, star: Star, warehouse: str) -> None:
    """Write every state table anew from the fact."""
    root = _root(warehouse)
    bucket = F.pmod(F.xxhash64("orderkey"), F.lit(BUCKETS)).cast("int")
    write_table(order_grain(star.fact_sales).withColumn("part", bucket), f"{root}/order_state", partition_cols=["part"])
    whole = _read(spark, f"{root}/order_state").drop("part").withColumn("sign", F.lit(1))
    for m in MARTS:
        write_table(m.delta(whole, star).withColumn("batch", F.lit(0).cast("long")), f"{root}/{m.name}",
                    partition_cols=["part"])


def view(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """The marts as of the last batch."""
    return {m.name: m.view(_read(spark, f"{_root(warehouse)}/{m.name}")) for m in MARTS}


def _same(a: DataFrame, b: DataFrame, cols) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def store_changes(spark: SparkSession, source: DataFrame, fact: DataFrame, warehouse: str, folder: str, keys,
                  on_duplicate: str) -> None:
    """Store the source rows and what they will change at order grain. Of the
    fact, only the source's months are read; the rest of an order is its state."""
    source.write.mode("overwrite").parquet(f"{folder}/source")
    source = spark.read.schema(source.schema).parquet(f"{folder}/source")
    orders, months = source.select("orderkey").distinct(), F.broadcast(source.select("year", "month").distinct())
    state = _read(spark, f"{_root(warehouse)}/order_state").drop("part").join(orders, "orderkey", "left_semi")
    here = fact.join(months, _same(fact, months, ["year", "month"]), "left_semi").join(orders, "orderkey", "left_semi")
    merged = merge_frames(here, source, keys, on_duplicate=on_duplicate, order_by=["extendedprice"])
    elsewhere = state.join(months, _same(state, months, ["year", "month"]), "left_anti")
    changes = changed_orders(state, order_grain(merged).unionByName(elsewhere))
    changes.write.mode("overwrite").parquet(f"{folder}/changes")


def apply_to_groups(spark: SparkSession, mart: Mart, changes: DataFrame, star: Star, warehouse: str, batch: int) -> None:
    """Add the changes to the mart's groups, unless they have this batch."""
    path = f"{_root(warehouse)}/{mart.name}"
    delta = mart.delta(changes, star)
    state = _read(spark, path)
    names = [*mart.sums, "orders"]
    old = state.join(F.broadcast(delta.select("part").distinct()), "part", "left_semi").withColumn("_new", F.lit(False))
    both = old.unionByName(delta.withColumns({"batch": F.lit(None).cast("long"), "_new": F.lit(True)}))
    of = lambda c, new: F.coalesce(F.max(F.when(F.col("_new") == new, F.col(c))), F.lit(0))
    pair = both.groupBy(*mart.keys, "part").agg(  # a row of either side at most
        F.max("batch").alias("batch"), F.max("_new").alias("_new"),
        *[of(c, new).alias(f"{c}_{new}") for c in names for new in (False, True)])
    todo = F.coalesce(F.col("batch"), F.lit(-1)) < batch
    merged = pair.select(
        *mart.keys, *[(F.col(f"{c}_False") + F.when(todo, F.col(f"{c}_True")).otherwise(F.lit(0)))
                      .cast(state.schema[c].dataType).alias(c) for c in names],
        F.when(F.col("_new"), F.lit(batch)).otherwise(F.col("batch")).cast("long").alias("batch"), "part")
    replace_partitions(merged, path, ["part"])


def apply_to_orders(spark: SparkSession, changes: DataFrame, warehouse: str) -> None:
    """The touched orders' state is replaced by their new rows."""
    path = f"{_root(warehouse)}/order_state"
    bucket = F.pmod(F.xxhash64("orderkey"), F.lit(BUCKETS)).cast("int")
    touched = changes.select("orderkey").distinct()
    state = _read(spark, path)
    old = (state.join(F.broadcast(touched.select(bucket.alias("part")).distinct()), "part", "left_semi")
           .join(touched, "orderkey", "left_anti"))
    new = changes.where(F.col("sign") > 0).drop("sign").withColumn("part", bucket)
    replace_partitions(old.unionByName(new), path, ["part"])


def next_batch(spark: SparkSession, ledger_path: str) -> int:
    last = (ledger.read_ledger(spark, ledger_path).where(F.col("job") == JOB).agg(F.max("batch_id")).first()[0])
    return (last or 0) + 1


def _finish(spark: SparkSession, star: Star, fact_path: str, warehouse: str, batch: int, folder: str, keys,
            on_duplicate: str) -> int:
    """Apply a stored batch; every step may be done again. Returns the number
    of source rows."""
    source, changes = (spark.read.parquet(f"{folder}/{n}") for n in ("source", "changes"))
    log = f"{warehouse}/ledger"
    if not ledger.committed(spark, log, MERGED, batch):
        upsert_table(source, fact_path, keys, partition_cols=("year", "month"), on_duplicate=on_duplicate,
                     order_by=["extendedprice"], stored=True)
        ledger.record(spark, log, MERGED, fact_path, batch_id=batch)
    for m in MARTS:
        apply_to_groups(spark, m, changes, star, warehouse, batch)
    apply_to_orders(spark, changes, warehouse)
    rows = source.count()
    ledger.record(spark, log, JOB, fact_path, batch_id=batch, rows_in=rows, rows_out=changes.count())
    paths.delete(spark, folder)
    return rows


def refresh_marts(spark: SparkSession, raw, read_star: Callable[[], Star], fact_path: str, warehouse: str,
                  mode: str = "reference", on_duplicate: str = "error") -> int:
    """Refresh the stored order-date fact from ``raw`` and keep the marts up to
    date; ``read_star`` opens the stored star. A batch that an earlier run left
    unfinished is finished first. Returns how many source rows this run merged."""
    keys = refresh.fact_keys(mode)
    batch = next_batch(spark, f"{warehouse}/ledger")
    folder = f"{_root(warehouse)}/changes/{batch}"
    if paths.exists(spark, f"{folder}/changes/_SUCCESS"):
        _finish(spark, read_star(), fact_path, warehouse, batch, folder, keys, on_duplicate)
        batch, folder = batch + 1, f"{_root(warehouse)}/changes/{batch + 1}"
    star, source = read_star(), refresh.staging_fact(raw.lineitem, raw.orders, mode)
    store_changes(spark, source, star.fact_sales, warehouse, folder, keys, on_duplicate)
    return _finish(spark, star, fact_path, warehouse, batch, folder, keys, on_duplicate)
