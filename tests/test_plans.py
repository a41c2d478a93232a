"""Plan-shape assertions: pruning, pushdown, top-k, no Python, pre-aggregation."""
import __spark_entry__ as E
from conftest import SF001
from strata.plans.catalog import QUERIES

# they run jobs while they are built
EAGER = {"stream_incremental_orders", "stream_late_orders", "fact_via_raw_twice", "marts_maintained", "archived_orders",
         "profile_merged", "fact_upsert", "upsert_stored_orders", "rollback_orders"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_q1_prunes_columns_and_uses_top_k(spark):
    df = E.queries()["q1_projection_limit"](spark, SF001)
    p = plan(df)
    assert "TakeOrderedAndProject" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in \
        df._jdf.queryExecution().executedPlan().treeString() or "l_shipdate" in p
    assert "l_comment" not in p and "l_extendedprice" not in p


def test_q2_filter_reaches_the_scan(spark):
    p = plan(E.queries()["q2_filter"](spark, SF001))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p


def test_q5_aggregates_lineitem_before_joining(spark):
    opt = optimized(E.queries()["q5_join_sum"](spark, SF001))
    # the lineitem aggregate sits below the join with orders
    li_agg = opt.find("Aggregate [l_orderkey")
    assert li_agg != -1
    assert opt.rfind("Join", 0, li_agg) != -1


def test_no_python_udf_in_any_sql_checked_query(spark):
    for name, fn in E.queries().items():
        if name in EAGER or name not in QUERIES:
            continue
        assert "EvalPython" not in plan(fn(spark, SF001)), name


def test_cluster_shape_has_no_funnels(spark):
    """With size-based broadcasting off (the 100 TB shape): no cartesian or
    nested-loop joins, and a single-partition exchange only ever carries
    partial aggregates or a limit — never raw rows into one task."""
    import re
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, fn in E.queries().items():
            if name in EAGER or name not in QUERIES:
                continue
            lines = plan(fn(spark, SF001)).splitlines()
            text = "\n".join(lines)
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
            for i, line in enumerate(lines):
                if "Exchange SinglePartition" in line:
                    child = lines[i + 1]
                    assert re.search(r"Aggregate\(.*partial_|Limit|TakeOrderedAndProject", child), \
                        (name, child)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_q5_cluster_shape_shuffles_lineitem_once(spark):
    """Sort-merge shape: lineitem is exchanged once (the per-order aggregate's
    exchange also serves the join with orders); five exchanges in all."""
    import re
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()["q5_join_sum"](spark, SF001)
        p = df._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in p
        ex = df._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", ex)) == 5, ex
        assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", ex)) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_line_marts_read_no_orders(spark):
    for name in ("supplier_performance", "inventory_summary", "order_fulfillment"):
        p = plan(E.queries()[name](spark, SF001))
        assert "orders.parquet" not in p and "Join" not in p, name


def test_sales_by_region_takes_five_shuffles(spark):
    """Cluster shape: orders and customers by customer, orders and lines by
    order, regions. The distinct count reuses the order key's partitioning."""
    import re
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(E.queries()["sales_by_region"](spark, SF001))
        keys = re.findall(r"Exchange hashpartitioning\((\w+?)#", p)
        assert sorted(keys) == ["c_custkey", "l_orderkey", "o_custkey", "o_orderkey", "regionname"] or len(keys) == 5, keys
        assert p.count("Exchange hashpartitioning") == 5, p
        # the geography goes to the tasks: at most GEOGRAPHY rows, which the driver has counted
        assert p.count("BroadcastExchange") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_large_geographies_are_joined(spark, tables, monkeypatch):
    from strata.plans import marts, star
    args = (tables.lineitem, tables.orders, star.dim_customer(tables.customer), star.dim_geography(tables.nation, tables.region))
    few = sorted(map(tuple, marts.region_sales(*args).collect()))
    monkeypatch.setattr(marts, "GEOGRAPHY", 3)
    assert sorted(map(tuple, marts.region_sales(*args).collect())) == few
    fact = star.fact_sales(tables.lineitem, tables.orders)
    assert sorted(map(tuple, marts.sales_by_region(fact, *args[2:]).collect())) == few
