"""Reconciliation, check suites, mergeable profiles, archive tier."""
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import checks, profiles
from strata.plans import archive
from strata.plans.reconcile import Reconciliation


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- reconciliation

ROWS = "k long, w string, a string, b string"


def test_equal_multisets_agree_whatever_their_order(spark):
    rows = [(i % 40, "w", None if i % 3 else "x", str(i % 7)) for i in range(300)] + [(None, None, None, None)] * 2
    shuffled = random.Random(1).sample(rows, len(rows))
    r = Reconciliation(spark.createDataFrame(rows, ROWS), spark.createDataFrame(shuffled, ROWS).repartition(7),
                       F.col("w"), "k", ranges=8)
    assert r.differences().collect() == []
    assert {(x.window, x.source_rows, x.landed_rows, x.same) for x in r.windows().collect()} == {
        ("w", 300, 300, True), (None, 2, 2, True)}


def test_differences_are_named(spark):
    """NULL and '' differ, as do values that swap columns; a row that moves to
    another window is changed; keys outside the source's range are found."""
    source = [(1, "a", "x", None), (2, "a", "x", "y"), (3, "a", "p", "q"), (4, "a", "1", "1"), (5, "b", "m", "m"),
              (6, "b", "d", "d"), (7, "b", "same", "same"), (8, "b", "r", "r"), (8, "b", "r", "r"), (None, "a", "n", "n")]
    landed = [(1, "a", "x", ""), (2, "a", "y", "x"), (3, "c", "p", "q"), (5, "b", "m", "m"), (6, "b", "d", "d"),
              (6, "b", "d", "d"), (6, "b", "d", "d"), (7, "b", "same", "same"), (8, "b", "r", "r"), (99, "a", "new", "new"),
              (-4, "z", "new", "new")]
    r = Reconciliation(spark.createDataFrame(source, ROWS), spark.createDataFrame(landed, ROWS), F.col("w"), "k", ranges=3)
    got = {x.key: (x.kind, x.source_rows, x.landed_rows) for x in r.differences().collect()}
    assert got == {1: ("changed", 1, 1), 2: ("changed", 1, 1), 3: ("changed", 1, 1), 4: ("lost", 1, 0),
                   6: ("doubled", 1, 3), 8: ("lost", 2, 1), 99: ("added", 0, 1), -4: ("added", 0, 1), None: ("lost", 1, 0)}
    assert {x.window: x.same for x in r.windows().collect()} == {"a": False, "b": False, "c": False, "z": False}


def test_empty_sides(spark):
    none, one = spark.createDataFrame([], ROWS), spark.createDataFrame([(1, "a", "x", "y")], ROWS)
    assert Reconciliation(none, none, F.col("w"), "k").differences().collect() == []
    assert [r.kind for r in Reconciliation(one, none, F.col("w"), "k").differences().collect()] == ["lost"]
    assert [r.kind for r in Reconciliation(none, one, F.col("w"), "k").differences().collect()] == ["added"]


# ---------------------------------------------------------------- check suites

def suite(spark, child, parent, buckets):
    c = spark.createDataFrame(child, "k long, v double, s string")
    p = spark.createDataFrame([(x,) for x in parent], "p long")
    return (checks.Suite(buckets).foreign_key(c, "k", p, "p").unique(c, ["k", "s"]).unique(p, ["p"])
            .not_null(c, "v").in_range(c, "v", 0, 10).accepted(c, "s", ["a", "b"])), c, p


@pytest.mark.parametrize("buckets", [8192, 0])
@pytest.mark.parametrize("keys", [range(0, 100), range(-70_000, 70_000, 997), [0, 2**40, -2**40, 5], []])
def test_suite_equals_single_checks(spark, buckets, keys):
    """Orphans inside and outside the parents' buckets, negative and far keys,
    NULLs, a key that a third of the rows share; with bitmaps and without."""
    rnd, keys = random.Random(len(keys)), list(keys)
    child = [(rnd.choice(keys) if keys else None, rnd.choice([None, -1.0, 3.0, 11.0]), rnd.choice(["a", "b", "c", None]))
             for _ in range(300)]
    child += [(k, 1.0, "a") for k in (3, 3, 10**6, -1, 2**41, None)] + [(77, 2.0, "b")] * 150
    s, c, p = suite(spark, child, keys + keys[:2], buckets)
    got = {r.check: r.violations for r in s.run().collect()}
    single = [checks.foreign_key(c, "k", p, "p"), checks.unique(c, ["k", "s"]), checks.unique(p, ["p"]),
              checks.not_null(c, "v"), checks.in_range(c, "v", 0, 10)]
    want = {r.check: r.violations for x in single for r in x.collect()}
    assert {k: v for k, v in got.items() if k != "accepted:s"} == want
    assert got["accepted:s"] == sum(x == "c" for _, _, x in child)


def test_suite_shares_scans_and_shuffles(spark, tables):
    import __spark_entry__ as E
    from conftest import SF001
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = tables
        single = checks.run_checks([
            checks.foreign_key(t.orders, "o_custkey", t.customer, "c_custkey"),
            checks.foreign_key(t.lineitem, "l_orderkey", t.orders, "o_orderkey"),
            checks.foreign_key(t.lineitem, "l_partkey", t.part, "p_partkey"),
            checks.foreign_key(t.lineitem, "l_suppkey", t.supplier, "s_suppkey"),
            checks.unique(t.orders, ["o_orderkey"]), checks.unique(t.lineitem, ["l_orderkey", "l_linenumber"]),
            checks.not_null(t.orders, "o_orderdate"), checks.in_range(t.lineitem, "l_discount", 0.0, 0.1)])
        count = lambda df: plan(df).count("Exchange ")
        fused = E.queries()["fk_checks"](spark, SF001)
        assert 2 * count(fused) <= count(single), (count(fused), count(single))
        assert sorted(map(tuple, fused.collect())) == sorted(map(tuple, single.collect()))
        rows = checks.Suite().not_null(t.lineitem, "l_tax").in_range(t.lineitem, "l_tax", 0, 1)
        lines = t.lineitem
        rows = checks.Suite().not_null(lines, "l_tax").in_range(lines, "l_tax", 0, 1).accepted(lines, "l_tax", [0.0])
        assert plan(rows.run()).count("Scan parquet") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ---------------------------------------------------------------- mergeable profiles

def test_halves_merge_to_the_whole(spark, scratch):
    """Exact figures equal those of the whole; estimates keep their errors."""
    n = 20_000
    df = spark.range(n).select(
        (F.col("id") % 2).alias("half"), F.col("id").alias("k"), F.when(F.col("id") % 10 != 0, F.col("id") * 1.5).alias("x"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("s"),
        F.to_date(F.lit("2020-01-01")).alias("d"), F.lit(None).cast("double").alias("none"))
    cols = ["k", "x", "s", "d", "none"]
    profiles.partial(df, cols, ["half"]).write.partitionBy("half").parquet(f"{scratch}/p")
    both = {r["column"]: r for r in profiles.summary(profiles.merged(spark.read.parquet(f"{scratch}/p"))).collect()}
    whole = {r["column"]: r for r in profiles.summary(profiles.partial(df, cols)).collect()}
    exact = {r["column"]: r for r in checks.profile(df, cols).collect()}
    assert set(both) == set(cols)
    for c in cols:
        assert all(both[c][f] == whole[c][f] == exact[c][f] for f in ("rows", "nulls", "min", "max")), c
        assert abs(both[c]["distinct"] - exact[c]["distinct"]) <= 0.06 * exact[c]["distinct"], c
    for q, v in zip((0.25, 0.5, 0.75), both["k"]["quantiles"]):
        assert abs(v / n - q) <= 0.03
    assert both["s"]["quantiles"] is None and both["none"]["quantiles"] is None
    top = both["s"]["top"][0]
    assert top["item"] == "hot" and top["count"] == -(-n // 3)
    # a third part arrives: only its rows are read
    profiles.partial(df.where("half = 0").withColumn("half", F.lit(2)), cols, ["half"]).write.mode("append") \
        .partitionBy("half").parquet(f"{scratch}/p")
    more = {r["column"]: r for r in profiles.summary(profiles.merged(spark.read.parquet(f"{scratch}/p"))).collect()}
    assert more["k"]["rows"] == n * 3 // 2 and abs(more["k"]["distinct"] - n) <= 0.06 * n


def test_profiles_of_an_empty_table(spark):
    none = spark.createDataFrame([], "k long, s string")
    assert profiles.partial(none, ["k", "s"], ["k"]).collect() == []
    rows = profiles.summary(profiles.partial(none, ["k", "s"])).collect()
    assert {(r["column"], r["rows"], r["distinct"], r["min"]) for r in rows} == {("k", 0, 0, None), ("s", 0, 0, None)}


# ---------------------------------------------------------------- archive tier

PARTS = ["year", "month"]


def hot_table(spark, path, n=4000):
    df = spark.range(n).select(
        F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.when(F.col("id") % 11 != 0, 1996 + F.col("id") % 5).cast("int").alias("year"), (F.col("id") % 3).cast("int").alias("month"))
    df.repartition(8).write.partitionBy(*PARTS).parquet(path)
    return df


def rows_of(df):
    return sorted(((r.k, r.v, r.year, r.month) for r in df.collect()), key=repr)


def sizes(folder):
    return {os.path.relpath(os.path.join(d, f), folder): os.path.getsize(os.path.join(d, f))
            for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def test_cold_partitions_move_in_files_of_target_size(spark, scratch):
    hot, cold, target = f"{scratch}/hot", f"{scratch}/cold", 20_000
    hot_table(spark, hot)
    want, before = rows_of(spark.read.parquet(hot)), sizes(hot)
    cold_files = [f for f in before if f.startswith(("year=1996", "year=1997"))]
    moved = archive.archive(spark, hot, cold, PARTS, F.col("year").cast("int") < 1998, target)
    assert moved == 6 and rows_of(archive.tiers(spark, hot, cold, PARTS)) == want
    packed = sizes(cold)
    assert len(packed) < len(cold_files) / 2 and max(packed.values()) <= 1.5 * target
    # a year without value is not cold; a second run finds nothing and changes nothing
    left = sizes(hot)
    assert any("year=__HIVE_DEFAULT_PARTITION__" in f for f in left)
    assert archive.archive(spark, hot, cold, PARTS, F.col("year").cast("int") < 1998, target) == 0
    assert sizes(cold) == packed and sizes(hot) == left
    # the next month gets cold
    assert archive.archive(spark, hot, cold, PARTS, F.col("year").cast("int") < 1999, target) == 3
    assert rows_of(archive.tiers(spark, hot, cold, PARTS)) == want


@pytest.mark.parametrize("step", ["_verify", "drop_partitions"])
def test_a_move_that_dies_loses_and_doubles_nothing(spark, scratch, monkeypatch, step):
    hot, cold = f"{scratch}/hot", f"{scratch}/cold"
    hot_table(spark, hot, 600)
    want = rows_of(spark.read.parquet(hot))
    is_cold = F.col("year").cast("int") < 1998
    with monkeypatch.context() as m:
        def dies(*args):
            raise RuntimeError("executor lost")
        m.setattr(archive, step, dies)
        with pytest.raises(RuntimeError):
            archive.archive(spark, hot, cold, PARTS, is_cold)
    assert rows_of(archive.tiers(spark, hot, cold, PARTS)) == want
    assert archive.archive(spark, hot, cold, PARTS, is_cold) == 6
    assert rows_of(archive.tiers(spark, hot, cold, PARTS)) == want


def test_a_wrong_copy_keeps_the_hot_rows(spark, scratch, monkeypatch):
    hot, cold = f"{scratch}/hot", f"{scratch}/cold"
    hot_table(spark, hot, 600)
    want = rows_of(spark.read.parquet(hot))
    write = archive._write_pieces
    monkeypatch.setattr(archive, "_write_pieces", lambda packed, *rest: write(packed.where("k <> 6"), *rest))
    with pytest.raises(ValueError, match="archive differs"):
        archive.archive(spark, hot, cold, PARTS, F.col("year").cast("int") < 1998)
    assert rows_of(spark.read.parquet(hot)) == want


# ---------------------------------------------------------------- in the jobs

def test_landing_is_validated_against_its_source(spark, tables, scratch):
    import datetime as dt
    from strata.plans import ingest, ledger
    from strata.sources import rawzone
    from strata.sources.jdbc import ExtractSpec
    run, specs = dt.datetime(2024, 1, 1, 5), {"orders": ExtractSpec("orders"), "lineitem": ExtractSpec("lineitem")}
    src = ingest.frame_source({"orders": tables.orders, "lineitem": tables.lineitem})
    ingest.ingest_batch(spark, src, scratch, run, specs)
    day = {"orders": (F.substring("o_orderdate", 1, 4), "o_orderkey"), "lineitem": (F.substring("l_shipdate", 1, 4), "l_orderkey")}
    for name, (window, key) in day.items():
        n = ingest.validate_landing(spark, src, scratch, run, name, specs[name], window, key, f"{scratch}/ledger")
        assert n == getattr(tables, name).count()
    rawzone.land(tables.orders.where("o_orderkey = 7"), scratch, "orders", run, mode="append")
    with pytest.raises(ingest.LandingMismatch, match="landed"):
        ingest.validate_landing(spark, src, scratch, run, "orders", specs["orders"], *day["orders"], f"{scratch}/ledger")
    entries = [r for r in ledger.read_ledger(spark, f"{scratch}/ledger").collect() if r.target == "orders"]
    assert sorted(r.rows_out - r.rows_in for r in entries) == [0, 1]


def test_fact_archive_job(spark, tables, scratch):
    from strata.plans import jobs
    jobs.init_datawarehouse(spark, tables, scratch)
    whole = jobs.read_star(spark, scratch).fact_sales
    cols, want = whole.columns, whole.count()
    old = whole.where("orderdate < '1997-05-01'").count()
    assert jobs.archive_fact(spark, scratch, "1997-05-20") == 28  # months of 1995, 1996, and four
    both = jobs.read_fact_tiers(spark, scratch)
    assert {r["tier"]: r["count"] for r in both.groupBy("tier").count().collect()} == {"archive": old, "hot": want - old}
    assert both.select(*cols).exceptAll(jobs.star.fact_sales(tables.lineitem, tables.orders).select(*cols)).count() == 0
    assert jobs.archive_fact(spark, scratch, "1997-05-20") == 0


def test_escaped_raw_text_reads_plain_from_the_catalog(spark, scratch):
    import datetime as dt
    from strata.sinks import catalog
    from strata.sources import rawzone
    rows = [(1, "a,b"), (2, "back\\slash"), (3, "\\n"), (4, "line\nend\r"), (5, None), (6, "\\\\c"), (7, "plain"), (8, "")]
    rawzone.land(spark.createDataFrame(rows, "custkey long, comment string"), scratch, "customer_comments", dt.datetime(2024, 1, 1))
    catalog.create_zones(spark, ["raw_plain"])
    try:
        table = catalog.register_raw_table(spark, "customer_comments", scratch, db="raw_plain")
        view = catalog.register_raw_view(spark, "customer_comments", db="raw_plain")
        got = {r.custkey: r.comment for r in spark.table(view).collect()}
        assert {k: v or None for k, v in got.items()} == {k: v or None for k, v in rows}
        assert catalog.describe(spark, table)["partitions"] and catalog.describe(spark, view)["partitions"] == []
    finally:
        catalog.drop_zones(spark, ["raw_plain"], reset=True)


def test_entry_without_the_corpus_modules(tmp_path):
    """An empty folder left of the subpackage, or one of its libraries absent."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "repo"
    shutil.copytree(os.path.join(root, "strata"), copy / "strata", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), copy)
    ask = [sys.executable, "-B", "-c", "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"]
    for make in (None, "__pycache__"):
        if make:
            (copy / "strata" / "llm" / make).mkdir(parents=True)
        out = subprocess.run(ask, cwd=copy, capture_output=True, text=True, timeout=120)
        from strata.plans.catalog import QUERIES
        assert out.stdout.split() == [str(len(QUERIES)), "False"], out.stderr


def test_foreign_keys_sort_no_keys(spark):
    """Keys are counted in hash tables of fixed-size rows; words of 64 keys,
    their edges and negative ones included, give the orphans exactly."""
    child = spark.createDataFrame([(k,) for k in (-65, -64, -1, 0, 63, 64, 127, 2**62, None) for _ in range(3)], "k long")
    parent = spark.createDataFrame([(k,) for k in (-64, 0, 63, 128, None)], "p long")
    out = checks.Suite().foreign_key(child, "k", parent, "p").run()
    assert [tuple(r) for r in out.collect()] == [("fk:k", 15)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
