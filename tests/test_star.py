"""Star-schema traps: parsing, time dimension, joins, typed NULLs, grain."""
import datetime as dt

from pyspark.sql import functions as F

from strata.plans import star


class Raw:
    def __init__(self, **kw):
        self.__dict__.update(kw)


def test_bad_dates_and_prices_become_null_not_errors(spark):
    o = spark.createDataFrame(
        [("1", "1", "F", "abc", "1992-13-40", "1-URGENT"), ("2", "1", "O", "10.5", "", "2-HIGH"),
         ("3", "1", "O", "7", None, "3-MEDIUM"), ("4", "2", "P", "1.25", "1996-01-02", "5-LOW")],
        "o_orderkey string, o_custkey string, o_orderstatus string, o_totalprice string, "
        "o_orderdate string, o_orderpriority string")
    d = {r.orderkey: r for r in star.dim_order(o).collect()}
    assert d[1].totalprice is None and d[1].orderdate is None
    assert d[2].totalprice == 10.5 and d[2].orderdate is None
    assert d[4].orderdate == dt.date(1996, 1, 2)


def test_time_dimension_one_row_per_day_no_null(spark):
    o = spark.createDataFrame([("1996-01-02",), ("1996-01-02",), ("1996-1-2",), (None,), ("bad",)],
                              "o_orderdate string")
    for variant in star.VARIANTS:
        t = star.dim_time(o, variant).collect()
        assert len(t) == 1
        assert t[0][0] == dt.date(1996, 1, 2)


def test_variant_date_parsing_rules(spark):
    o = spark.createDataFrame([("1", "1996-1-2"), ("2", "1996-01-02")],
                              "o_orderkey string, o_orderdate string")
    a = {r.orderkey: r.orderdate for r in star.dim_order(o).collect()}
    b = {r.order_key: r.order_date for r in star.dim_order(o, "shipdate").collect()}
    assert a == {1: None, 2: dt.date(1996, 1, 2)}
    assert b == {1: dt.date(1996, 1, 2), 2: dt.date(1996, 1, 2)}


def test_quarter_and_iso_week(spark):
    days = [(dt.date(1995, m, 15),) for m in range(1, 13)] + [(dt.date(1993, 1, 1),)]
    o = spark.createDataFrame(days, "o_orderdate date")
    a = {r.datekey: r for r in star.dim_time(o).collect()}
    b = {r.date: r for r in star.dim_time(o, "shipdate").collect()}
    for m in range(1, 13):
        d = dt.date(1995, m, 15)
        assert a[d].quarter == (m - 1) // 3 + 1
        assert b[d].quarter == str((m - 1) // 3 + 1)
    assert b[dt.date(1993, 1, 1)].week == 53


def test_geography_inner_vs_left(spark):
    n = spark.createDataFrame([(0, "A", 0), (1, "B", 9)], "n_nationkey int, n_name string, n_regionkey int")
    r = spark.createDataFrame([(0, "R0")], "r_regionkey int, r_name string")
    assert star.dim_geography(n, r).count() == 1
    left = {x.nation_key: x.region_name for x in star.dim_geography(n, r, "shipdate").collect()}
    assert left == {0: "R0", 1: None}


def test_fact_inner_vs_left_join_with_orphan_line(spark):
    li = spark.createDataFrame(
        [(1, 1, 1, 1, 1.0, 10.0, 0.1, 0.0, dt.date(1996, 3, 1)),
         (99, 1, 1, 1, 1.0, 10.0, 0.1, 0.0, dt.date(1996, 3, 2))],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_shipdate date")
    o = spark.createDataFrame([(1, 5, dt.date(1996, 1, 2))],
                              "o_orderkey bigint, o_custkey bigint, o_orderdate date")
    a = star.fact_sales(li, o).collect()
    assert len(a) == 1 and (a[0].year, a[0].month, a[0].day) == (1996, 1, 2)
    b = {r.order_key: r for r in star.fact_sales(li, o, "shipdate").collect()}
    assert b[99].customer_key is None
    # variant B partitions by the ship date
    assert (b[1].order_year, b[1].order_month) == (1996, 3)


def test_missing_columns_are_typed_nulls(tables):
    c = star.dim_customer(tables.customer)
    types = dict(c.dtypes)
    assert types["address"] == "string" and types["phone"] == "string"
    assert types["custkey"] == "bigint" and types["nationkey"] == "bigint"
    assert c.where(F.col("address").isNotNull()).count() == 0


def test_line_safe_grain_keeps_identical_lines(spark):
    li = spark.createDataFrame(
        [(1, 2, 3, 1, 1.0, 10.0, 0.0, 0.0), (1, 2, 3, 2, 1.0, 10.0, 0.0, 0.0)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double")
    o = spark.createDataFrame([(1, 5, "1996-01-02")], "o_orderkey bigint, o_custkey bigint, o_orderdate string")
    assert star.fact_sales(li, o).distinct().count() == 1
    assert star.fact_sales(li, o, line_safe=True).distinct().count() == 2


def test_raw_string_inputs_give_the_typed_contract(spark):
    raw = Raw(
        customer=spark.createDataFrame([(1, "C1", "addr", 3, "ph", "12.50", "AUTO", "x")],
                                       "c_custkey int, c_name string, c_address string, c_nationkey int, "
                                       "c_phone string, c_acctbal string, c_mktsegment string, c_comment string"),
    )
    c = star.dim_customer(raw.customer).collect()[0]
    assert c.acctbal == 12.5 and c.custkey == 1 and c.address == "addr"
