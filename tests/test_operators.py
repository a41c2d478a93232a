"""Versions (as-of / expire), checks, profile, masking, retention, schema
alignment."""
import pytest
from pyspark.sql import functions as F

from strata.operators import checks, masking, retention, versions
from strata.schemas import SchemaMismatch, align, union_evolving


def test_as_of_and_expire(spark):
    v = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "x", 1), (1, "c", 3), (3, "y", 3)],
                              "k int, v string, batch_id bigint")
    assert sorted(map(tuple, versions.as_of(v, ["k"], 2).collect())) == [(1, "b", 2), (2, "x", 1)]
    assert sorted(map(tuple, versions.as_of(v, ["k"]).collect())) == [(1, "c", 3), (2, "x", 1), (3, "y", 3)]
    e = versions.expire(v, ["k"], 2)
    assert e.count() == 4
    for ver in (2, 3):
        assert sorted(map(tuple, versions.as_of(e, ["k"], ver).collect())) == \
            sorted(map(tuple, versions.as_of(v, ["k"], ver).collect()))


def test_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, 5.0), (3, -1.0), (None, 2.0), (1, 1.0)], "pid int, x double")
    res = dict(map(tuple, checks.run_checks([
        checks.foreign_key(child, "pid", parent, "id"),
        checks.unique(child, ["pid"]),
        checks.not_null(child, "pid"),
        checks.in_range(child, "x", 0, 4)]).collect()))
    assert res == {"fk:pid": 1, "unique:pid": 1, "not_null:pid": 1, "range:x": 2}


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "n int, s string")
    p = {r.column: r for r in checks.profile(df).collect()}
    assert (p["n"].rows, p["n"].nulls, p["n"].distinct, p["n"].min, p["n"].max) == (3, 0, 2, "1", "2")
    assert (p["s"].nulls, p["s"].distinct) == (1, 2)


def test_masking_rules(spark):
    import datetime as dt
    df = spark.createDataFrame([("Alice", "555-1234", 10.0, dt.date(1990, 5, 6))],
                               "name string, phone string, bal double, born date")
    r = masking.mask(df, {"name": "redact", "phone": "last4", "bal": "null", "born": "year"}).first()
    assert r.name == "*****" and r.phone == "****1234" and r.bal is None
    assert r.born == dt.date(1990, 1, 1)
    h = masking.mask(df, {"name": "sha2"}).first().name
    assert len(h) == 64
    v = masking.role_view(df, ["name", "bal"], F.col("bal") > 5, {"name": "redact"})
    assert v.columns == ["name", "bal"] and v.count() == 1


def test_retention_split(tables):
    hot, archive = retention.retention_split(tables.orders, "o_orderdate", "1999-01-01")
    assert hot.count() + archive.count() == tables.orders.count()


def test_align_and_union_evolving(spark):
    from pyspark.sql import types as T
    contract = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()),
                             T.StructField("new", T.StringType())])
    df = spark.createDataFrame([(1, 2.5)], "id int, x float")
    out = align(df, contract)
    assert out.dtypes == [("id", "bigint"), ("x", "double"), ("new", "string")]
    with pytest.raises(SchemaMismatch):
        align(spark.createDataFrame([(1,)], "id string"), contract)
    with pytest.raises(SchemaMismatch):
        align(spark.createDataFrame([(1, 1.0, "a", 2)], "id int, x double, new string, extra int"),
              contract)
    u = union_evolving(spark.createDataFrame([(1,)], "id int"),
                       spark.createDataFrame([(2, "z")], "id bigint, tag string"))
    assert u.dtypes == [("id", "bigint"), ("tag", "string")]
    assert sorted(map(tuple, u.collect())) == [(1, None), (2, "z")]


def test_stored_versions_as_of_and_expire(spark, scratch):
    path = f"{scratch}/v"
    versions.append_version(spark.createDataFrame([(1, "a"), (2, "x")], "k int, v string"), path, 1)
    versions.append_version(spark.createDataFrame([(1, "b")], "k int, v string"), path, 2)
    versions.append_version(spark.createDataFrame([(1, "c"), (3, "y")], "k int, v string"), path, 3)
    versions.append_version(spark.createDataFrame([(1, "c"), (3, "y")], "k int, v string"), path, 3)
    df = versions.read_as_of(spark, path, ["k"], 2).where("k = 1")
    assert "PartitionFilters: [isnotnull(_version" in df._jdf.queryExecution().executedPlan().toString()
    before = {v: sorted(map(tuple, versions.read_as_of(spark, path, ["k"], v).collect())) for v in (2, 3)}
    assert before[2] == [(1, "b", 2), (2, "x", 1)]
    versions.expire_stored(spark, path, ["k"], 2)
    after = {v: sorted(map(tuple, versions.read_as_of(spark, path, ["k"], v).collect())) for v in (2, 3)}
    assert after == before
    assert [r[0] for r in versions.history(versions.read_versions(spark, path)).collect()] == [1, 2, 3]
    import os
    assert sorted(d for d in os.listdir(path) if d.startswith("_version=")) == ["_version=2", "_version=3"]


def test_profile_approx_matches_exact_on_small_data(tables):
    cols = ["o_orderkey", "o_custkey", "o_orderstatus"]
    exact = {r.column: r for r in checks.profile(tables.orders, cols).collect()}
    approx = {r.column: r for r in checks.profile(tables.orders, cols, approx=True).collect()}
    for c in cols:
        e, a = exact[c], approx[c]
        assert (a.rows, a.nulls, a.min, a.max) == (e.rows, e.nulls, e.min, e.max)
        assert abs(a.distinct - e.distinct) <= 0.05 * e.distinct


def test_ledger_compaction(spark, scratch):
    from strata.plans import ledger
    p = f"{scratch}/ledger"
    for i in range(5):
        ledger.record(spark, p, "job", "t", batch_id=i, watermark=str(i))
    ledger.compact(spark, p)
    assert ledger.read_ledger(spark, p).count() == 5
    assert len(spark.read.parquet(p).inputFiles()) == 1
    assert ledger.committed(spark, p, "job", 3)


def test_rollback_forgets_later_batches(spark, scratch):
    path = f"{scratch}/v"
    for batch, rows in ((1, [(1, "a"), (2, "x")]), (2, [(1, "b")]), (3, [(1, "c")])):
        versions.append_version(spark.createDataFrame(rows, "k int, v string"), path, batch)
    want = sorted(map(tuple, versions.read_as_of(spark, path, ["k"], 2).collect()))
    versions.rollback_stored(spark, path, 2)
    assert sorted(map(tuple, versions.read_as_of(spark, path, ["k"]).collect())) == want == [(1, "b", 2), (2, "x", 1)]


def test_a_swap_that_was_cut_short_is_finished_or_dropped(spark, scratch):
    from strata.sinks import swap
    path = f"{scratch}/t"
    row = lambda v, y: spark.createDataFrame([(v, y)], "v int, y string")
    read = lambda: sorted(map(tuple, spark.read.parquet(path).select("v", "y").collect()))
    swap.replace(row(1, "a").unionByName(row(2, None)), path, ["y"])
    row(9, "a").write.partitionBy("y").parquet(f"{path}.staged/rows")     # died before the marker
    swap.recover(spark, path)
    assert sorted(map(repr, read())) == ["(1, 'a')", "(2, None)"]
    swap.stage(row(3, "a"), path, ["y"], whole=False)                     # died after it
    swap.recover(spark, path)
    swap.recover(spark, path)
    assert sorted(map(repr, read())) == ["(2, None)", "(3, 'a')"]


def test_drop_partitions_with_null_and_escaped_names(spark, scratch):
    from strata.sinks.writer import drop_partitions, write_table
    path = f"{scratch}/t"
    write_table(spark.createDataFrame([(1, None), (2, "a/b=c"), (3, "z")], "v int, y string"), path,
                partition_cols=["y"])
    assert drop_partitions(spark, path, ["y"], F.col("y").isNull() | (F.col("y") == "a/b=c")) == 2
    assert [r.v for r in spark.read.parquet(path).collect()] == [3]


def test_a_rewritten_table_reads_its_new_schema(spark, scratch):
    from strata.sources.tables import Tables
    spark.range(2).write.parquet(f"{scratch}/orders.parquet")
    assert Tables(spark, scratch).orders.columns == ["id"]
    spark.range(2).withColumnRenamed("id", "x").write.mode("overwrite").parquet(f"{scratch}/orders.parquet")
    assert Tables(spark, scratch).orders.columns == ["x"] and Tables(spark, scratch).orders.count() == 2


def test_a_cluster_needs_a_checkpoint_folder():
    from types import SimpleNamespace
    from strata.session import checkpoint_dir
    conf = SimpleNamespace(get=lambda k, d=None: d)
    for master in ("spark://h:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))
