"""RAW landing zone: layout, unquoted text, string partitions, re-runs."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.sources import rawzone

RUN1 = dt.datetime(2024, 1, 5, 3)
RUN2 = dt.datetime(2024, 1, 5, 4)


def test_land_and_read_round_trip(spark, tables, scratch):
    path = rawzone.land(tables.orders, scratch, "orders", RUN1)
    assert path.endswith("orders/year=2024/month=01/day=05/hour=03")
    raw = rawzone.read_raw(spark, scratch, "orders")
    assert raw.count() == tables.orders.count()
    row = raw.select("year", "month", "day", "hour").distinct().collect()
    assert [tuple(r) for r in row] == [("2024", "01", "05", "03")]
    assert dict(raw.dtypes)["o_totalprice"] == "string"
    assert dict(raw.dtypes)["month"] == "string"
    # dates are landed as yyyy-MM-dd text
    assert raw.where(F.col("o_orderdate").rlike(r"^\d{4}-\d{2}-\d{2}$")).count() == raw.count()


def test_rerun_same_hour_replaces_and_other_hour_adds_copy(spark, tables, scratch):
    rawzone.land(tables.region, scratch, "region", RUN1)
    rawzone.land(tables.region, scratch, "region", RUN1)
    assert rawzone.read_raw(spark, scratch, "region").count() == 5
    rawzone.land(tables.region, scratch, "region", RUN2)
    raw = rawzone.read_raw(spark, scratch, "region")
    assert raw.count() == 10
    dedup = rawzone.latest_ingest(raw, ["r_regionkey"])
    assert dedup.count() == 5
    assert {r.hour for r in raw.join(dedup.select("r_regionkey", "hour"), ["r_regionkey", "hour"])
            .select("hour").collect()} == {"04"}


def test_unquoted_text_splits_on_every_comma(spark, scratch):
    d = f"{scratch}/region/year=2024/month=01/day=01/hour=00"
    os.makedirs(d)
    with open(f"{d}/part-0.txt", "w") as fh:
        fh.write('1,"a,b",3\n2,\\N,null\n')
    raw = rawzone.read_raw(spark, scratch, "region").orderBy("r_regionkey").collect()
    assert raw[0].r_name == '"a' and raw[0].r_comment == 'b"'
    assert raw[1].r_name is None and raw[1].r_comment == "null"


def test_partition_filter_prunes_directories(spark, tables, scratch):
    rawzone.land(tables.nation, scratch, "nation", RUN1)
    rawzone.land(tables.nation, scratch, "nation", RUN2)
    df = rawzone.read_raw(spark, scratch, "nation").where(F.col("hour") == "04")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "hour" in plan
    assert df.count() == 25


def test_csv_with_header_and_escape(spark, scratch):
    p = f"{scratch}/c.csv"
    with open(p, "w") as fh:
        fh.write('comment_id,customer_id,product_id,comment_text,comment_date\n'
                 '1,2,3,"Great, ""really"" fast",2024-01-01\n')
    df = rawzone.read_csv_with_header(spark, p, rawzone.raw_schema("social_comments", False))
    assert df.collect()[0].comment_text == 'Great, "really" fast'


AWKWARD = ["plain", "", None, "a,b", "line\nbreak", "cr\r\nlf", "back\\slash", "\\N", "\\", "\\n", "\\\\c", ",", '"q"', " s "]


def test_every_value_survives_the_text(spark, scratch):
    df = spark.createDataFrame(list(enumerate(AWKWARD)), "custkey long, comment string")
    rawzone.land(df, scratch, "customer_comments", RUN1, partitions=2)
    for fmt in ("text", "parquet"):
        if fmt == "parquet":
            rawzone.land(df, f"{scratch}/p", "customer_comments", RUN1, fmt=fmt)
        got = rawzone.read_raw(spark, scratch if fmt == "text" else f"{scratch}/p", "customer_comments", fmt=fmt)
        assert sorted((r.custkey, r.comment) for r in got.collect()) == list(enumerate(AWKWARD))
    # values without a separator look as in any unquoted text
    assert "0,plain" in [r.value for r in spark.read.text(f"{scratch}/customer_comments").collect()]


def test_latest_copy_within_one_hour(spark, scratch):
    for v in ("old", "new"):
        rawzone.land(spark.createDataFrame([(1, v)], "r_regionkey int, r_name string"), scratch, "region", RUN1,
                     mode="append")
        import time
        time.sleep(1.1)  # the store's clock for file times may count seconds
    assert [r.r_name for r in rawzone.RawTables(spark, scratch).region.collect()] == ["new"]


def _lines(spark, rows):
    """rows of (order, line number, price, ship date)"""
    return spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_extendedprice double, l_shipdate string")


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_lines_are_replaced_order_by_order(spark, scratch, mode):
    """A later landing replaces an order's lines as a whole: equal lines stay
    as often as they come, changed and vanished ones go, other orders stay.
    The same within one hour."""
    import time
    old = [(1, 1, 10.0, "d"), (1, 1, 10.0, "d"), (1, 2, 11.0, "d"), (2, 1, 20.0, "d"), (2, 1, 21.0, "d"),
           (None, 1, 1.0, "d")]
    new = [(1, 1, 10.5, "d"), (1, 1, 10.5, "d"), (3, 1, 30.0, "d")]
    rawzone.land(_lines(spark, old), scratch, "lineitem", RUN1, partitions=4)
    time.sleep(1.1)
    rawzone.land(_lines(spark, new), scratch, "lineitem", RUN1 if mode == "append" else RUN2, mode=mode, partitions=4)
    got = _prices_of(rawzone.RawTables(spark, scratch))
    assert got == [(1, 10.5), (1, 10.5), (2, 20.0), (2, 21.0), (3, 30.0), (None, 1.0)]


def _prices_of(raw):
    return sorted(((r.l_orderkey, r.l_extendedprice) for r in raw.lineitem.collect()), key=lambda r: (r[0] is None, r))


def test_lines_landed_by_window(spark, scratch):
    """Windows of ship dates: a landing replaces the order's lines of its own
    dates, and leaves those of other windows."""
    rawzone.land(_lines(spark, [(1, 1, 1.0, "1992-01-05"), (1, 2, 2.0, "1992-03-01")]), scratch, "lineitem", RUN1)
    rawzone.land(_lines(spark, [(1, 2, 2.5, "1992-03-01"), (1, 3, 3.0, "1992-03-02")]), scratch, "lineitem", RUN2)
    assert _prices_of(rawzone.RawTables(spark, scratch)) == [(1, 2.5), (1, 3.0)]
    by_date = rawzone.RawTables(spark, scratch, windows={"lineitem": "l_shipdate"})
    assert _prices_of(by_date) == [(1, 1.0), (1, 2.5), (1, 3.0)]


def test_files_of_other_writers_are_one_landing_an_hour(spark, scratch):
    for hour, files in (("01", [["1,1"], ["1,2"]]), ("02", [["2,9"]])):
        d = f"{scratch}/lineitem/year=2024/month=01/day=01/hour={hour}"
        os.makedirs(d)
        for i, lines in enumerate(files):
            with open(f"{d}/part-m-0000{i}", "w") as fh:
                fh.write("".join(f"{x.split(',')[0]},7,7,{x.split(',')[1]}\n" for x in lines))
    rows = rawzone.RawTables(spark, scratch).lineitem.collect()
    assert sorted((r.l_orderkey, r.l_linenumber) for r in rows) == [(1, 1), (1, 2), (2, 9)]


def test_latest_lines_cut_their_text_twice_at_most(spark, scratch):
    """One scan for the newest landings, one for the rows, those without an
    order included; escapes in numbers and texts, missing fields and NULLs."""
    kinds = "l_orderkey long, l_linenumber int, l_quantity double, l_comment string"
    rawzone.land(spark.createDataFrame([(1, 1, 1.5, "a,b\\"), (1, 2, None, "\\N"), (2, 1, 2.0, ""), (None, 1, 3.0, "x\r\ny")],
                                       kinds), scratch, "lineitem", RUN1)
    rawzone.land(spark.createDataFrame([(1, 1, 9.0, None), (None, 2, 4.0, "\\c")], kinds), scratch, "lineitem", RUN2)
    rows = rawzone.RawTables(spark, scratch).lineitem
    got = {(r.l_orderkey, r.l_linenumber, r.l_quantity, r.l_comment, r.l_tax) for r in rows.collect()}
    assert got == {(1, 1, 9.0, None, None), (2, 1, 2.0, "", None), (None, 1, 3.0, "x\r\ny", None), (None, 2, 4.0, "\\c", None)}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "Union" not in plan


def test_numbers_landed_as_text_are_read_as_before(spark, scratch):
    odd = ["12", " 7 ", "5\n", "1\\", "", "x", None, "\\N"]
    rawzone.land(spark.createDataFrame([(i, v) for i, v in enumerate(odd)], "l_orderkey long, l_quantity string"),
                 scratch, "lineitem", RUN1)
    got = {r.l_orderkey: r.l_quantity for r in rawzone.read_raw(spark, scratch, "lineitem").collect()}
    assert [got[i] for i in range(len(odd))] == [12.0, 7.0, 5.0, None, None, None, None, None]
