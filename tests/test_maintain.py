"""Marts that follow a refresh by its changes."""
import os

import pytest
from pyspark.sql import functions as F

from strata.plans import jobs, ledger, maintain, marts, star

CUT = "1999-06-01"


def _sorted(df):
    return sorted(repr(tuple(r)) for r in df.collect())  # NaN equals NaN


class Source:
    def __init__(self, tables, **changed):
        self._tables, self._changed = tables, changed

    def __getattr__(self, name):
        return self._changed[name] if name in self._changed else getattr(self._tables, name)


def small(spark):
    """Orders over three years, one shared by two customers, one without date."""
    orders = [(1, 1, "1998-01-05"), (2, 1, "1998-01-09"), (3, 2, "1998-02-01"), (4, 3, "1999-07-01"), (5, 2, None),
              (6, 1, "1998-01-05"), (6, 2, "1998-01-05"), (7, 3, "1999-08-01")]
    lines = [(k, p, p, 1, float(10 * k + p), 0.1, 0.05, 2.0) for k in range(1, 8) for p in (1, 2)]
    lines += [(7, 9, 9, 1, float("nan"), 0.1, None, 1.0)]
    return Tiny(spark, orders, lines)


class Tiny:
    def __init__(self, spark, orders, lines):
        self.orders = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate string").withColumns(
            {"o_orderstatus": F.lit("O"), "o_totalprice": F.lit(1.0), "o_orderpriority": F.lit("1")})
        self.lineitem = spark.createDataFrame(
            lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, "
                   "l_discount double, l_tax double, l_quantity double")
        self.customer = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2)],
                                              "c_custkey long, c_name string, c_nationkey int").withColumns(
            {"c_acctbal": F.lit(0.0), "c_mktsegment": F.lit("m")})
        self.nation = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], "n_nationkey int, n_name string, n_regionkey int")
        self.region = spark.createDataFrame([(1, "r"), (2, "q")], "r_regionkey int, r_name string")
        self.supplier = spark.createDataFrame([(1, "s", 1, 0.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
        self.part = spark.createDataFrame([(1, "p")], "p_partkey long, p_name string").withColumns(
            {"p_brand": F.lit("b"), "p_type": F.lit("t"), "p_size": F.lit(1), "p_retailprice": F.lit(1.0)})


def same_as_rebuilt(spark, warehouse):
    s = jobs.read_star(spark, warehouse)
    want = marts.build_marts(s)
    for name, df in maintain.view(spark, warehouse).items():
        assert _sorted(df.select(*want[name].columns)) == _sorted(want[name]), name


def files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def test_marts_follow_refreshes(spark, scratch):
    """Changed prices, a new order, an order that moves to another customer
    (new key: its old rows stay), NaN and NULL; then nothing new."""
    raw = small(spark)
    jobs.init_datawarehouse(spark, raw, scratch)
    jobs.init_maintained_marts(spark, scratch)
    same_as_rebuilt(spark, scratch)
    state = f"{scratch}/delivery_state"
    before = {n: files(f"{state}/{n}") for n in ("order_state", "sales_by_customer", "sales_summary")}
    lines = raw.lineitem.withColumn("l_extendedprice", F.when(F.col("l_orderkey") == 4, F.col("l_extendedprice") + 5)
                                    .otherwise(F.col("l_extendedprice")))
    lines = lines.unionByName(lines.where("l_orderkey = 3").withColumn("l_orderkey", F.lit(8).cast("long")))
    orders = raw.orders.withColumn("o_custkey", F.when(F.col("o_orderkey") == 7, 1).otherwise(F.col("o_custkey")).cast("long"))
    orders = orders.unionByName(orders.where("o_orderkey = 4").withColumn("o_orderkey", F.lit(8).cast("long")))
    again = Source(raw, lineitem=lines, orders=orders.where("o_orderkey in (1, 4, 7, 8)"))
    jobs.refresh_datawarehouse(spark, again, scratch, maintain_marts=True)
    same_as_rebuilt(spark, scratch)
    # only partitions of touched groups were written: those of 1998 stayed
    for name, old in before.items():
        kept, gone = old & files(f"{state}/{name}"), old - files(f"{state}/{name}")
        assert kept and gone, name
    assert all("part=1998" in f or "part=-1" in f for f in before["sales_summary"] & files(f"{state}/sales_summary"))
    assert not any("part=1998" in f for f in before["sales_summary"] - files(f"{state}/sales_summary"))
    everything = {n: files(f"{state}/{n}") for n in before}
    jobs.refresh_datawarehouse(spark, again, scratch, maintain_marts=True)
    assert {n: files(f"{state}/{n}") for n in before} == everything
    entries = [r for r in ledger.read_ledger(spark, f"{scratch}/ledger").collect() if r.job == maintain.JOB]
    assert sorted((r.batch_id, r.rows_in, r.rows_out > 0) for r in entries) == [(1, 9, True), (2, 9, False)]


@pytest.mark.parametrize("broken", ["upsert_table", "apply_to_groups", "apply_to_orders", "second group"])
def test_a_run_that_dies_is_finished_by_the_next(spark, scratch, monkeypatch, broken):
    raw = small(spark)
    jobs.init_datawarehouse(spark, raw, scratch)
    jobs.init_maintained_marts(spark, scratch)
    dearer = Source(raw, lineitem=raw.lineitem.withColumn("l_extendedprice", F.col("l_extendedprice") + 1))
    with monkeypatch.context() as m:
        calls, whole = [], maintain.apply_to_groups

        def dies(*args, **kwargs):
            calls.append(1)
            if broken == "second group" and len(calls) == 1:
                return whole(*args, **kwargs)
            raise RuntimeError("executor lost")
        m.setattr(maintain, "apply_to_groups" if broken == "second group" else broken, dies)
        with pytest.raises(RuntimeError):
            jobs.refresh_datawarehouse(spark, dearer, scratch, maintain_marts=True)
    # the next run has other rows: it first finishes what was stored
    cheaper = Source(raw, lineitem=raw.lineitem.withColumn("l_extendedprice", F.col("l_extendedprice") - 1),
                     orders=raw.orders.where("o_orderkey < 3"))
    jobs.refresh_datawarehouse(spark, cheaper, scratch, maintain_marts=True)
    same_as_rebuilt(spark, scratch)
    prices = {r.orderkey: r.extendedprice for r in jobs.read_star(spark, scratch).fact_sales.where("partkey = 1").collect()}
    assert prices[1] == 10.0 and prices[4] == 42.0


def test_refresh_stores_its_source_once(spark, scratch, monkeypatch):
    """The merge reads the stored source rows: they are not copied again."""
    from strata.operators import upsert
    raw = small(spark)
    jobs.init_datawarehouse(spark, raw, scratch)
    jobs.init_maintained_marts(spark, scratch)
    monkeypatch.setattr(upsert, "shared_copy", lambda *a: pytest.fail("the source is copied again"))
    later = raw.orders.where(F.col("o_orderdate") >= CUT)
    assert jobs.refresh_datawarehouse(spark, Source(raw, orders=later), scratch, on_duplicate="ignore", maintain_marts=True)
    kept, built = maintain.view(spark, scratch), marts.build_marts(jobs.read_star(spark, scratch))
    assert _sorted(kept["sales_by_customer"]) == _sorted(built["sales_by_customer"].select(*kept["sales_by_customer"].columns))
