"""The five benchmark queries and the top-customers example.

Each function takes a ``Tables`` handle and returns a lazy DataFrame.
Money sums are exact decimals returned as DOUBLE (see functions.money).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..functions.money import SCALE, sum_units, to_amount, units
from ..sources.tables import Tables


def q1_projection_limit(t: Tables, n: int = 1000, ordered: bool = False) -> DataFrame:
    """Two-column projection with LIMIT: any ``n`` rows, so the scan stops early.

    ``ordered`` sorts by both output columns, which makes the sample
    deterministic at the cost of a whole scan; Spark plans ORDER BY + LIMIT as a per-partition top-k (TakeOrderedAndProject),
    never a full sort.
    """
    li = t.lineitem
    rows = li.select("l_orderkey", as_date(li, "l_shipdate").alias("l_shipdate"))
    return (rows.orderBy("l_orderkey", "l_shipdate") if ordered else rows).limit(n)


def q2_filter(t: Tables, status: str = "F") -> DataFrame:
    """All order columns where o_orderstatus = status (pushed into the scan)."""
    o = t.orders
    cols = [as_date(o, c).alias(c) if c == "o_orderdate" else F.col(c) for c in o.columns]
    return o.where(F.col("o_orderstatus") == status).select(*cols)


def q3_count_by_customer(t: Tables) -> DataFrame:
    """Orders per customer; map-side partial counts make a hot key cheap."""
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("order_count"))


def q4_count_sort(t: Tables) -> DataFrame:
    """Orders per priority, most first; ties broken by priority."""
    return (t.orders.groupBy("o_orderpriority")
            .agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), "o_orderpriority"))


def _revenue_by_customer(t: Tables, revenue_col: str = "rev") -> DataFrame:
    """SUM(l_extendedprice) over lineitem ⋈ orders, per o_custkey.

    Eager aggregation: lineitem is summed per order before the join (its
    shuffle on l_orderkey is reused by the join), and the joined rows are
    summed per customer before meeting the customer table. The result is
    one row per customer, so the later customer join is 1:1 whatever the
    key skew. Exact for any key multiplicities because SUM distributes
    over the join.
    """
    per_order = (t.lineitem.groupBy("l_orderkey")
                 .agg(sum_units(units("l_extendedprice")).alias("_rev")))
    o = t.orders.select("o_orderkey", "o_custkey")
    per_cust = (per_order.join(o, per_order.l_orderkey == o.o_orderkey)
                .groupBy("o_custkey").agg(F.sum("_rev").alias(revenue_col)))
    return per_cust


def q5_join_sum(t: Tables) -> DataFrame:
    """SUM(l_extendedprice) per c_nationkey over customer ⋈ orders ⋈ lineitem."""
    per_cust = _revenue_by_customer(t)
    c = t.customer.select("c_custkey", "c_nationkey")
    return (per_cust.join(c, per_cust.o_custkey == c.c_custkey)
            .groupBy("c_nationkey")
            .agg(to_amount(F.sum("rev"), SCALE).alias("total_revenue")))


def top_customers_by_spend(t: Tables, k: int = 10) -> DataFrame:
    """Top-k customer names by gross spend (ties broken by name)."""
    per_cust = _revenue_by_customer(t)
    c = t.customer.select("c_custkey", "c_name")
    return (per_cust.join(c, per_cust.o_custkey == c.c_custkey)
            .groupBy("c_name")
            .agg(to_amount(F.sum("rev"), SCALE).alias("total_spent"))
            .orderBy(F.desc("total_spent"), "c_name")
            .limit(k))
