"""Star schema: six dimensions and the sales fact, in two variants.

``variant="orderdate"`` (A) names columns ``custkey, name, ...``, builds the
fact with an inner join to orders and partitions it by order date.
``variant="shipdate"`` (B) names columns ``customer_key, customer_name, ...``,
left-joins orders, carries ship/commit/receipt dates and derives the
``order_year/month/day`` partition columns from the **ship** date (as the
pipeline it mirrors does).

Inputs are the RAW tables (STRING money and dates) or the typed parquet
tables; either gives the same typed contract. Columns a source lacks
become typed NULLs.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import col_or_null, safe_cast
from ..functions.dates import as_date, iso_week, quarter_int, quarter_str

VARIANTS = ("orderdate", "shipdate")


def _sel(df: DataFrame, spec: list[tuple[str, str, str]]) -> DataFrame:
    """Project ``(source, target, type)`` triples; missing sources become typed NULLs."""
    return df.select(*[col_or_null(df, s, ty).alias(t) for s, t, ty in spec])


# The output column contracts of both variants, in table order,
# as (source column, target column, type).
_CUSTOMER = {
    "orderdate": [("c_custkey", "custkey", "bigint"), ("c_name", "name", "string"),
                  ("c_address", "address", "string"), ("c_phone", "phone", "string"),
                  ("c_acctbal", "acctbal", "double"), ("c_mktsegment", "mktsegment", "string"),
                  ("c_nationkey", "nationkey", "bigint")],
    "shipdate": [("c_custkey", "customer_key", "bigint"), ("c_name", "customer_name", "string"),
                 ("c_address", "address", "string"), ("c_phone", "phone", "string"),
                 ("c_acctbal", "acctbal", "double"), ("c_mktsegment", "mktsegment", "string"),
                 ("c_nationkey", "nation_key", "bigint")],
}
_SUPPLIER = {
    "orderdate": [("s_suppkey", "suppkey", "bigint"), ("s_name", "name", "string"),
                  ("s_address", "address", "string"), ("s_phone", "phone", "string"),
                  ("s_acctbal", "acctbal", "double"), ("s_nationkey", "nationkey", "bigint")],
    "shipdate": [("s_suppkey", "supplier_key", "bigint"), ("s_name", "supplier_name", "string"),
                 ("s_address", "address", "string"), ("s_phone", "phone", "string"),
                 ("s_acctbal", "acctbal", "double"), ("s_nationkey", "nation_key", "bigint")],
}
_PART = {
    "orderdate": [("p_partkey", "partkey", "bigint"), ("p_name", "name", "string"),
                  ("p_mfgr", "mfgr", "string"), ("p_brand", "brand", "string"),
                  ("p_type", "type", "string"), ("p_size", "size", "int"),
                  ("p_container", "container", "string"), ("p_retailprice", "retailprice", "double")],
    "shipdate": [("p_partkey", "part_key", "bigint"), ("p_name", "part_name", "string"),
                 ("p_mfgr", "mfgr", "string"), ("p_brand", "brand", "string"),
                 ("p_type", "type", "string"), ("p_size", "size", "int"),
                 ("p_container", "container", "string"), ("p_retailprice", "retail_price", "double")],
}
_ORDER = {
    "orderdate": [("o_orderkey", "orderkey", "bigint"), ("o_orderstatus", "orderstatus", "string"),
                  ("o_totalprice", "totalprice", "double"), ("o_orderdate", "orderdate", "date"),
                  ("o_orderpriority", "priority", "string"), ("o_custkey", "custkey", "bigint")],
    "shipdate": [("o_orderkey", "order_key", "bigint"), ("o_orderstatus", "order_status", "string"),
                 ("o_totalprice", "total_price", "double"), ("o_orderdate", "order_date", "date"),
                 ("o_orderpriority", "order_priority", "string"), ("o_custkey", "customer_key", "bigint")],
}


# Date parsing per variant: A parses strings with the pattern yyyy-MM-dd;
# B uses the format-less parse (cast rules: also accepts 1996-1-2).
_DATE_FMT = {"orderdate": "yyyy-MM-dd", "shipdate": None}


def _with_dates(df: DataFrame, names: list[str], variant: str = "orderdate") -> DataFrame:
    """Replace date-like columns by parsed DATEs (bad strings → NULL)."""
    present = [n for n in names if n in df.columns]
    fmt = _DATE_FMT[variant]
    return df.withColumns({n: as_date(df, n, fmt) for n in present}) if present else df


def dim_customer(customer: DataFrame, variant: str = "orderdate") -> DataFrame:
    return _sel(customer, _CUSTOMER[variant])


def dim_supplier(supplier: DataFrame, variant: str = "orderdate") -> DataFrame:
    return _sel(supplier, _SUPPLIER[variant])


def dim_part(part: DataFrame, variant: str = "orderdate") -> DataFrame:
    return _sel(part, _PART[variant])


def dim_order(orders: DataFrame, variant: str = "orderdate") -> DataFrame:
    return _sel(_with_dates(orders, ["o_orderdate"], variant), _ORDER[variant])


def dim_geography(nation: DataFrame, region: DataFrame, variant: str = "orderdate",
                  how: str | None = None) -> DataFrame:
    """nation ⋈ region. A: inner join; B: left join (nations without a region kept).

    Both are small reference tables; Spark's planner broadcasts them from
    their size statistics (no hint needed).
    """
    how = how or ("inner" if variant == "orderdate" else "left")
    r = region.select(safe_cast(region, "r_regionkey", "bigint").alias("_rk"),
                      F.col("r_name").alias("_rn"))
    n = nation.select(safe_cast(nation, "n_nationkey", "bigint").alias("_nk"),
                      F.col("n_name").alias("_nn"),
                      safe_cast(nation, "n_regionkey", "bigint").alias("_nrk"))
    j = n.join(r, n._nrk == r._rk, how)
    if variant == "orderdate":
        return j.select(F.col("_rk").alias("regionkey"), F.col("_rn").alias("regionname"),
                        F.col("_nk").alias("nationkey"), F.col("_nn").alias("nationname"))
    return j.select(F.col("_nrk").alias("region_key"), F.col("_nk").alias("nation_key"),
                    F.col("_nn").alias("nation_name"), F.col("_rn").alias("region_name"))


def dim_time(orders: DataFrame, variant: str = "orderdate") -> DataFrame:
    """One row per distinct order date.

    The date is parsed *before* DISTINCT, so two spellings of one day give
    one row, and NULL/unparseable dates are dropped after parsing.
    A: (datekey, year, quarter INT, month, day); B: (date, year, month, day,
    quarter STRING, week ISO).
    """
    d = as_date(orders, "o_orderdate", _DATE_FMT[variant])
    days = orders.select(d.alias("d")).where(F.col("d").isNotNull()).distinct()
    if variant == "orderdate":
        return days.select(F.col("d").alias("datekey"), F.year("d").alias("year"),
                           quarter_int(F.col("d")).alias("quarter"),
                           F.month("d").alias("month"), F.dayofmonth("d").alias("day"))
    return days.select(F.col("d").alias("date"), F.year("d").alias("year"),
                       F.month("d").alias("month"), F.dayofmonth("d").alias("day"),
                       quarter_str(F.col("d")).alias("quarter"),
                       iso_week(F.col("d")).alias("week"))


def fact_sales(lineitem: DataFrame, orders: DataFrame, variant: str = "orderdate",
               line_safe: bool = False) -> DataFrame:
    """Sales fact at line grain.

    A: lineitem ⋈ orders (inner), order date and its year/month/day.
    B: lineitem ⟕ orders (left), ship/commit/receipt dates, and
       order_year/month/day taken from the ship date.
    ``line_safe`` keeps ``linenumber`` so two identical lines of one order
    stay two rows under DISTINCT and upsert.
    Both sides are shuffled on the order key (sort-merge join; AQE splits a
    skewed key); only the needed order columns are read.
    """
    li = _with_dates(lineitem, ["l_shipdate", "l_commitdate", "l_receiptdate"], variant)
    o = _with_dates(orders, ["o_orderdate"], variant).select(
        safe_cast(orders, "o_orderkey", "bigint").alias("_ok"),
        safe_cast(orders, "o_custkey", "bigint").alias("_ck"),
        F.col("o_orderdate").alias("_od"))
    lk = safe_cast(lineitem, "l_orderkey", "bigint")
    if variant == "orderdate":
        j = li.join(o, lk == o._ok, "inner")
        cols = [lk.alias("orderkey"),
                safe_cast(lineitem, "l_partkey", "bigint").alias("partkey"),
                safe_cast(lineitem, "l_suppkey", "bigint").alias("suppkey"),
                F.col("_ck").alias("custkey"),
                safe_cast(lineitem, "l_extendedprice", "double").alias("extendedprice"),
                safe_cast(lineitem, "l_discount", "double").alias("discount"),
                safe_cast(lineitem, "l_tax", "double").alias("tax"),
                safe_cast(lineitem, "l_quantity", "double").alias("quantity"),
                F.col("_od").alias("orderdate")]
        if line_safe:
            cols.append(safe_cast(lineitem, "l_linenumber", "int").alias("linenumber"))
        f = j.select(*cols)
        return f.withColumns({"year": F.year("orderdate"), "month": F.month("orderdate"),
                              "day": F.dayofmonth("orderdate")})
    j = li.join(o, lk == o._ok, "left")
    cols = [lk.alias("order_key"),
            safe_cast(lineitem, "l_partkey", "bigint").alias("part_key"),
            safe_cast(lineitem, "l_suppkey", "bigint").alias("supplier_key"),
            F.col("_ck").alias("customer_key"),
            safe_cast(lineitem, "l_extendedprice", "double").alias("extended_price"),
            safe_cast(lineitem, "l_discount", "double").alias("discount"),
            safe_cast(lineitem, "l_tax", "double").alias("tax"),
            safe_cast(lineitem, "l_quantity", "double").alias("quantity"),
            col_or_null(li, "l_shipdate", "date").alias("ship_date"),
            col_or_null(li, "l_commitdate", "date").alias("commit_date"),
            col_or_null(li, "l_receiptdate", "date").alias("receipt_date")]
    if line_safe:
        cols.append(safe_cast(lineitem, "l_linenumber", "int").alias("linenumber"))
    f = j.select(*cols)
    return f.withColumns({"order_year": F.year("ship_date"), "order_month": F.month("ship_date"),
                          "order_day": F.dayofmonth("ship_date")})


def line_fact(lineitem: DataFrame, variant: str = "shipdate") -> DataFrame:
    """The ship-date fact without its customer key: for marts that take
    nothing from orders, lines alone give the same rows (a left join on a
    unique order key), without shuffling either table."""
    li = _with_dates(lineitem, ["l_shipdate", "l_commitdate", "l_receiptdate"], variant)
    return li.select(safe_cast(lineitem, "l_orderkey", "bigint").alias("order_key"),
                     safe_cast(lineitem, "l_partkey", "bigint").alias("part_key"),
                     safe_cast(lineitem, "l_suppkey", "bigint").alias("supplier_key"),
                     safe_cast(lineitem, "l_extendedprice", "double").alias("extended_price"),
                     safe_cast(lineitem, "l_discount", "double").alias("discount"),
                     safe_cast(lineitem, "l_quantity", "double").alias("quantity"),
                     col_or_null(li, "l_shipdate", "date").alias("ship_date"),
                     col_or_null(li, "l_commitdate", "date").alias("commit_date"),
                     col_or_null(li, "l_receiptdate", "date").alias("receipt_date"))


@dataclass
class Star:
    variant: str
    dim_customer: DataFrame
    dim_supplier: DataFrame
    dim_part: DataFrame
    dim_order: DataFrame
    dim_geography: DataFrame
    dim_time: DataFrame
    fact_sales: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {k: getattr(self, k) for k in ("dim_customer", "dim_supplier", "dim_part",
                                              "dim_order", "dim_geography", "dim_time",
                                              "fact_sales")}

    @property
    def partition_cols(self) -> tuple[str, ...]:
        return ("year", "month") if self.variant == "orderdate" else ("order_year", "order_month")


def build_star(raw, variant: str = "orderdate", line_safe: bool = False) -> Star:
    """All star tables from an object with ``customer supplier part orders
    nation region lineitem`` DataFrame attributes (lazy; nothing runs yet)."""
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}")
    return Star(
        variant=variant,
        dim_customer=dim_customer(raw.customer, variant),
        dim_supplier=dim_supplier(raw.supplier, variant),
        dim_part=dim_part(raw.part, variant),
        dim_order=dim_order(raw.orders, variant),
        dim_geography=dim_geography(raw.nation, raw.region, variant),
        dim_time=dim_time(raw.orders, variant),
        fact_sales=fact_sales(raw.lineitem, raw.orders, variant, line_safe),
    )
