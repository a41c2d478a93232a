"""Mart shapes, plan properties and exactness."""
from strata.plans import marts, star


def test_marts_a_and_b_columns(tables):
    a = marts.build_marts(star.build_star(tables))
    assert a["sales_by_customer"].columns == ["custkey", "name", "total_revenue", "total_orders"]
    assert a["sales_by_region"].columns == ["regionname", "total_revenue", "total_orders"]
    assert a["sales_summary"].columns == ["year", "month", "total_revenue", "avg_discount",
                                          "avg_tax", "total_quantity"]
    b = marts.build_marts(star.build_star(tables, "shipdate"))
    assert b["order_fulfillment"].columns == ["supplier_key", "avg_ship_delay",
                                              "avg_fulfillment_days", "orders"]


def test_region_mart_totals_equal_fact_totals(tables, spark):
    s = star.build_star(tables)
    by_region = marts.sales_by_region(s.fact_sales, s.dim_customer, s.dim_geography)
    total = sum(r.total_orders for r in by_region.collect())
    assert total == s.fact_sales.select("orderkey").distinct().count()


def test_sum_is_independent_of_partitioning(tables):
    s = star.build_star(tables)
    a = {r.year * 100 + r.month: r.total_revenue for r in marts.sales_summary(s.fact_sales).collect()}
    b = {r.year * 100 + r.month: r.total_revenue
         for r in marts.sales_summary(s.fact_sales.repartition(7)).collect()}
    assert a == b
