"""Jobs over a warehouse folder: build, marts, refresh, sandbox, storage."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import jobs, ledger, marts, star
from strata.plans.storage import storage_report
from strata.sources import rawzone


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_warehouse_build_marts_and_rerun(spark, tables, scratch):
    jobs.init_datawarehouse(spark, tables, scratch)
    jobs.init_datawarehouse(spark, tables, scratch)          # re-run replaces
    s = jobs.read_star(spark, scratch)
    assert s.fact_sales.count() == tables.lineitem.count()
    paths = jobs.create_datamarts(spark, scratch)
    want = marts.build_marts(star.build_star(tables))
    for k, p in paths.items():
        assert _sorted(spark.read.parquet(p).select(*want[k].columns)) == _sorted(want[k]), k
    assert ledger.read_ledger(spark, f"{scratch}/ledger").where("job='init_datawarehouse'").count() == 2


def test_refresh_after_new_orders_line_safe(spark, tables, scratch):
    base = star.build_star(tables)
    cut = F.lit("2000-01-01").cast("date")

    class Old:
        def __getattr__(self, n):
            return getattr(tables, n)
    old = Old()
    old.orders = tables.orders.where(F.col("o_orderdate") < cut)
    jobs.init_datawarehouse(spark, old, scratch, line_safe=True)
    jobs.refresh_datawarehouse(spark, tables, scratch, mode="line_safe", dims=True,
                               on_duplicate="ignore")
    fact = spark.read.parquet(f"{scratch}/datawarehouse/fact_sales")
    want = star.fact_sales(tables.lineitem, tables.orders, line_safe=True).distinct()
    assert fact.count() == want.count()
    assert spark.read.parquet(f"{scratch}/datawarehouse/dim_order").count() == \
        base.dim_order.count()


def test_sandbox_job(spark, tables, scratch):
    jobs.init_datawarehouse(spark, tables, scratch)
    out = jobs.init_sandbox(spark, scratch, 2000, tables.customer.count())
    assert out.count() == 2000
    assert out.schema == jobs.SANDBOX_CONTRACT or [f.name for f in out.schema] == \
        [f.name for f in jobs.SANDBOX_CONTRACT]
    # generated keys run from 1 to n, the sample's customers from 0 to n - 1
    n = tables.customer.count()
    assert {r.custkey for r in out.where(F.col("customer_name").isNull()).collect()} <= {str(n)}


def test_storage_report(spark, tables, scratch):
    r = storage_report(tables.customer, scratch, "customer")
    assert r["rows"] == tables.customer.count() and r["text_bytes"] > 0 and r["parquet_bytes"] > 0


def test_raw_zone_to_warehouse(spark, tables, scratch):
    """Whole tables, landed in one hour and again in a second, give the star
    of the tables: every line, those that share order and number included."""
    lines = tables.lineitem.count()
    want = _sorted(marts.sales_by_region(star.fact_sales(tables.lineitem, tables.orders),
                                         star.dim_customer(tables.customer),
                                         star.dim_geography(tables.nation, tables.region)))
    for hour in (0, 1):
        for n in ("customer", "orders", "lineitem", "nation", "region", "supplier", "part"):
            rawzone.land(getattr(tables, n), f"{scratch}/rawzone", n, dt.datetime(2024, 5, 1, hour),
                         partitions=3 if n == "lineitem" else None)
        raw = rawzone.RawTables(spark, f"{scratch}/rawzone")
        assert raw.lineitem.count() == lines == 6000
        jobs.init_datawarehouse(spark, raw, scratch)
        s = jobs.read_star(spark, scratch)
        assert s.fact_sales.count() == lines and s.dim_customer.count() == tables.customer.count()
        region = marts.sales_by_region(s.fact_sales, s.dim_customer, s.dim_geography)
        assert _sorted(region) == want
    jobs.refresh_datawarehouse(spark, raw, scratch, on_duplicate="last")


def test_refresh_twice_equals_once(spark, tables, scratch):
    jobs.init_datawarehouse(spark, tables, scratch)
    jobs.refresh_datawarehouse(spark, tables, scratch, mode="reference", on_duplicate="last")
    once = _sorted(spark.read.parquet(f"{scratch}/datawarehouse/fact_sales"))
    jobs.refresh_datawarehouse(spark, tables, scratch, mode="reference", on_duplicate="last")
    assert _sorted(spark.read.parquet(f"{scratch}/datawarehouse/fact_sales")) == once


def test_product_sentiment_job_from_csv(spark, tables, scratch):
    import os
    from strata.sinks import catalog
    jobs.init_datawarehouse(spark, tables, scratch, variant="shipdate")
    d = f"{scratch}/comments"
    os.makedirs(d)
    with open(f"{d}/c1.csv", "w") as fh:
        fh.write("comment_id,customer_id,product_id,comment_text,comment_date\n"
                 '1,3,5,"Great, ""fast"" delivery",2024-01-01\n'
                 "2,x,7,terrible,2024-01-02\n")
    out = spark.read.parquet(jobs.sentiment_products(spark, d, scratch))
    rows = {r.comment_id: r for r in out.collect()}
    assert rows["1"].sentiment == "Positive" and rows["1"].sentiment_score == 2.0
    assert rows["1"].customer_name is not None and rows["1"].part_name is not None
    assert rows["2"].sentiment == "Negative" and rows["2"].customer_name is None
    catalog.create_zones(spark, ["raw_csv"])
    catalog.register_csv_table(spark, "raw_csv.social_comments", d,
                               "comment_id STRING, customer_id STRING, product_id STRING, "
                               "comment_text STRING, comment_date STRING")
    assert spark.table("raw_csv.social_comments").count() == 2
    catalog.drop_zones(spark, ["raw_csv"], reset=True)


def test_bucketed_catalog_star_runs_customer_mart_without_shuffle(spark, tables):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        jobs.init_datawarehouse_catalog(spark, tables, db="dw_bucketed")
        s = jobs.read_star_catalog(spark, "dw_bucketed")
        df = marts.sales_by_customer(s.fact_sales, s.dim_customer)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        want = marts.sales_by_customer(star.fact_sales(tables.lineitem, tables.orders),
                                       star.dim_customer(tables.customer))
        assert _sorted(df) == _sorted(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP DATABASE IF EXISTS dw_bucketed CASCADE")


def test_run_all_twice_and_both_variants(spark, tables, scratch):
    for _ in range(2):
        out = jobs.run_all(spark, tables, scratch, n_comments=500)
        assert set(out["marts"]) == set(marts.MARTS_A) and out["sandbox_rows"] == 500
    assert spark.read.parquet(f"{scratch}/sandbox/customer_sentiment").count() == 500
    entries = ledger.read_ledger(spark, f"{scratch}/ledger").collect()
    assert sorted(r.job for r in entries) == sorted(2 * ["init_datawarehouse", "init_sandbox", "customer_sentiment"])
    assert {r.rows_out for r in entries if r.job == "init_sandbox"} == {500}
    jobs.init_datawarehouse(spark, tables, scratch, "shipdate")
    assert set(jobs.create_datamarts(spark, scratch, "shipdate")) == set(marts.MARTS_B)
    assert set(jobs.create_datamarts(spark, scratch)) == set(marts.MARTS_A)


def test_marts_refuse_repeated_dimension_keys(spark, tables, scratch):
    class Twice:
        def __getattr__(self, n):
            df = getattr(tables, n)
            return df.unionByName(df) if n == "supplier" else df
    jobs.init_datawarehouse(spark, Twice(), scratch, "shipdate")
    with pytest.raises(ValueError, match="supplier_key"):
        jobs.create_datamarts(spark, scratch, "shipdate")
