"""Business data marts over the star schema.

Variant A (order-date star): sales_by_customer, sales_by_region, sales_summary.
Variant B (ship-date star): revenue_by_customer, supplier_performance,
inventory_summary, order_fulfillment.

Plan shape: the fact is aggregated to the grain the mart needs *before*
it meets a dimension, so every dimension join is one row per key on both
sides (no skew, no fan-out) and the big shuffle carries partial aggregates
only. Money is summed exactly (functions.money).

Note: "total_revenue" is net (price * (1 - discount)) in the customer and
region marts and gross (sum of extendedprice) in sales_summary, as in the
pipelines these mirror. ``order_fulfillment.orders`` counts lines.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import safe_cast
from ..functions.money import NET_SCALE, amount_avg, amount_sum, any_nan, net_sum, net_units, sum_units, to_amount

#: nations that a task may hold for a look-up
GEOGRAPHY = 10_000

# ---------------------------------------------------------------- variant A


def sales_by_customer(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Net revenue and distinct orders per (custkey, name).

    Aggregated per custkey first (the distinct count is planned as a
    partial aggregate on (custkey, orderkey) then a count per custkey),
    then joined 1:1 to the customer dimension (inner, as the join it
    replaces).
    """
    per_cust = (fact.groupBy("custkey")
                .agg(net_sum("extendedprice", "discount").alias("total_revenue"),
                     F.count_distinct("orderkey").alias("total_orders")))
    return (per_cust.join(dim_customer.select("custkey", "name"), "custkey")
            .select("custkey", "name", "total_revenue", "total_orders"))


def sales_by_region(fact: DataFrame, dim_customer: DataFrame,
                    dim_geography: DataFrame) -> DataFrame:
    """Net revenue and distinct orders per region name.

    The fact is reduced to one row per (custkey, orderkey) before the
    customer join; whether the geography dimension is broadcast is left to
    the optimizer's size threshold. The distinct-order count stays exact without assuming an
    order belongs to a single customer.
    """
    per_order = (fact.groupBy("custkey", "orderkey")
                 .agg(sum_units(net_units("extendedprice", "discount")).alias("_rev"),
                      any_nan("extendedprice", "discount").alias("_nan")))
    geo = dim_geography.select("nationkey", "regionname")
    cust_region = dim_customer.select("custkey", "nationkey").join(geo, "nationkey")
    return (per_order.join(cust_region, "custkey")
            .groupBy("regionname")
            .agg(F.when(F.max("_nan"), F.lit(float("nan"))).otherwise(to_amount(F.sum("_rev"), NET_SCALE))
                 .alias("total_revenue"),
                 F.count_distinct("orderkey").alias("total_orders")))


def sales_summary(fact: DataFrame) -> DataFrame:
    """Per (year, month): gross revenue, average discount and tax, units."""
    return (fact.groupBy("year", "month")
            .agg(amount_sum("extendedprice").alias("total_revenue"),
                 amount_avg("discount").alias("avg_discount"),
                 amount_avg("tax").alias("avg_tax"),
                 amount_sum("quantity").alias("total_quantity")))


def region_sales(lineitem: DataFrame, orders: DataFrame, dim_customer: DataFrame,
                 dim_geography: DataFrame) -> DataFrame:
    """``sales_by_region`` from lines and orders, without a stored fact.

    The customer's region joins the narrow orders before lines do, so the last
    join is on the order key and its partitioning serves the distinct count:
    one row per (region, order) is made where the order is, and only partial
    counts and sums per region are shuffled after it. Five shuffles: orders and
    customers by customer, orders and lines (summed per order first) by order,
    regions. Distinct orders need no bitmaps or second shuffle.

    The geography is looked up in the task when it has at most ``GEOGRAPHY``
    nations, which its rows prove; beyond that it is joined."""
    geo = dim_geography.select("nationkey", "regionname")
    cust = dim_customer.select("custkey", "nationkey")
    few = geo.limit(GEOGRAPHY + 1).collect()
    if len(few) <= GEOGRAPHY:
        geo = F.broadcast(geo.sparkSession.createDataFrame(few, geo.schema))
    cust = cust.join(geo, "nationkey").select("custkey", "regionname")
    o = orders.select(safe_cast(orders, "o_orderkey", "bigint").alias("orderkey"),
                      safe_cast(orders, "o_custkey", "bigint").alias("custkey"))
    of_region = o.join(cust, "custkey").select("orderkey", "regionname")
    price, discount = (safe_cast(lineitem, c, "double") for c in ("l_extendedprice", "l_discount"))
    lines = lineitem.select(safe_cast(lineitem, "l_orderkey", "bigint").alias("orderkey"),
                            price.alias("price"), discount.alias("discount"))
    per_order = lines.groupBy("orderkey").agg(sum_units(net_units("price", "discount")).alias("_rev"),
                                              any_nan("price", "discount").alias("_nan"))
    # an order that several rows bring to a region counts once, its lines each time
    both = (of_region.join(per_order, "orderkey").groupBy("orderkey", "regionname")
            .agg(F.sum("_rev").alias("_rev"), F.max("_nan").alias("_nan")))
    return both.groupBy("regionname").agg(
        F.when(F.max("_nan"), F.lit(float("nan"))).otherwise(to_amount(F.sum("_rev"), NET_SCALE)).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"))


# ---------------------------------------------------------------- variant B
# The dimension left joins of the source pipeline do not change these
# aggregates (dimension keys are unique), so they are not planned.


def revenue_by_customer(fact_b: DataFrame) -> DataFrame:
    return (fact_b.groupBy("customer_key")
            .agg(net_sum("extended_price", "discount").alias("total_revenue"),
                 amount_sum("quantity").alias("total_units")))


def supplier_performance(fact_b: DataFrame) -> DataFrame:
    return (fact_b.groupBy("supplier_key")
            .agg(net_sum("extended_price", "discount").alias("total_revenue"),
                 amount_sum("quantity").alias("total_units"),
                 F.count(F.lit(1)).alias("transactions")))


def inventory_summary(fact_b: DataFrame) -> DataFrame:
    return (fact_b.groupBy("part_key")
            .agg(amount_sum("quantity").alias("units_ordered"),
                 net_sum("extended_price", "discount").alias("revenue")))


def order_fulfillment(fact_b: DataFrame) -> DataFrame:
    """Average ship delay (ship - commit) and fulfilment time (receipt -
    ship) in days, and line count, per supplier."""
    return (fact_b.groupBy("supplier_key")
            .agg(F.avg(F.datediff("ship_date", "commit_date")).alias("avg_ship_delay"),
                 F.avg(F.datediff("receipt_date", "ship_date")).alias("avg_fulfillment_days"),
                 F.count(F.lit(1)).alias("orders")))


def sorted_desc(mart: DataFrame, by: str) -> DataFrame:
    """A mart ordered by ``by`` descending (ties by the other columns): a
    distributed range-partitioned sort, no single-task window."""
    rest = [c for c in mart.columns if c != by]
    return mart.orderBy(F.desc(by), *rest)


MARTS_A = ("sales_by_customer", "sales_by_region", "sales_summary")
MARTS_B = ("revenue_by_customer", "supplier_performance", "inventory_summary",
           "order_fulfillment")


def build_marts(star) -> dict[str, DataFrame]:
    """All marts of a star (lazy)."""
    f = star.fact_sales
    if star.variant == "orderdate":
        return {"sales_by_customer": sales_by_customer(f, star.dim_customer),
                "sales_by_region": sales_by_region(f, star.dim_customer, star.dim_geography),
                "sales_summary": sales_summary(f)}
    return {"revenue_by_customer": revenue_by_customer(f),
            "supplier_performance": supplier_performance(f),
            "inventory_summary": inventory_summary(f),
            "order_fulfillment": order_fulfillment(f)}
