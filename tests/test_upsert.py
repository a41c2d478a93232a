"""Upsert (MERGE) semantics: toy fixture, cardinality, a model-based
property test, and the on-disk partition-scoped rewrite."""
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.upsert import MergeCardinalityError, merge_frames, upsert_table

SCHEMA = "k int, v int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0], r[1]))


def test_toy_merge_null_keys_never_match(spark):
    target = spark.createDataFrame([(1, 10), (2, 20), (None, 99)], SCHEMA)
    source = spark.createDataFrame([(2, 200), (3, 300), (None, 77)], SCHEMA)
    out = merge_frames(target, source, ["k"])
    assert rows(out) == [(1, 10), (2, 200), (3, 300), (None, 77), (None, 99)]


def test_two_source_rows_for_one_target_row_fail(spark):
    target = spark.createDataFrame([(1, 10)], SCHEMA)
    source = spark.createDataFrame([(1, 11), (1, 12)], SCHEMA)
    with pytest.raises(MergeCardinalityError):
        merge_frames(target, source, ["k"])
    out = merge_frames(target, source, ["k"], on_duplicate="last", order_by=["v"])
    assert rows(out) == [(1, 12)]


def test_duplicate_source_rows_without_a_target_match_are_inserted(spark):
    target = spark.createDataFrame([(1, 10)], SCHEMA)
    source = spark.createDataFrame([(5, 1), (5, 2)], SCHEMA)
    assert rows(merge_frames(target, source, ["k"])) == [(1, 10), (5, 1), (5, 2)]


def test_source_columns_aligned_by_name(spark):
    target = spark.createDataFrame([(1, 10)], SCHEMA)
    source = spark.createDataFrame([(30, 3)], "v int, k int")
    assert rows(merge_frames(target, source, ["k"])) == [(1, 10), (3, 30)]


keys = st.one_of(st.none(), st.integers(0, 6))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(t=st.lists(st.tuples(keys, st.integers(0, 99)), max_size=8),
       s=st.dictionaries(st.integers(0, 6), st.integers(100, 199), max_size=5),
       s_null=st.lists(st.integers(100, 199), max_size=2))
def test_merge_matches_dict_model(spark, t, s, s_null):
    source_rows = list(s.items()) + [(None, v) for v in s_null]
    target = spark.createDataFrame(t, SCHEMA)
    source = spark.createDataFrame(source_rows, SCHEMA)
    # model: every target row whose key is in the source is replaced
    expected = [r for r in t if r[0] is None or r[0] not in s] + source_rows
    got = rows(merge_frames(target, source, ["k"], on_duplicate="ignore"))
    assert got == sorted(expected, key=lambda r: (r[0] is None, r[0], r[1]))


def _files(path):
    out = {}
    for root, _, files in os.walk(path):
        for f in files:
            if f.endswith(".parquet"):
                out[os.path.join(root, f)] = os.path.getmtime(os.path.join(root, f))
    return out


def test_upsert_table_rewrites_only_touched_partitions(spark, scratch):
    path = f"{scratch}/t"
    base = spark.createDataFrame(
        [(1, 10, "2020"), (2, 20, "2020"), (3, 30, "2021"), (4, 40, "2022")], "k int, v int, y string")
    base.write.partitionBy("y").parquet(path)
    before = _files(path)
    src = spark.createDataFrame([(3, 300, "2021"), (5, 500, "2021")], "k int, v int, y string")
    upsert_table(src, path, ["k", "y"], partition_cols=["y"])
    after = _files(path)
    untouched = [p for p in before if "y=2021" not in p]
    assert all(p in after and after[p] == before[p] for p in untouched)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "y").collect())
    assert got == [(1, 10, "2020"), (2, 20, "2020"), (3, 300, "2021"), (4, 40, "2022"),
                   (5, 500, "2021")]
    # idempotent: the same upsert again changes nothing
    upsert_table(src, path, ["k", "y"], partition_cols=["y"])
    again = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "y").collect())
    assert again == got


def test_upsert_table_key_moving_between_partitions(spark, scratch):
    path = f"{scratch}/t"
    spark.createDataFrame([(1, 10, "2020"), (2, 20, "2021")], "k int, v int, y string") \
        .write.partitionBy("y").parquet(path)
    src = spark.createDataFrame([(1, 11, "2022")], "k int, v int, y string")
    upsert_table(src, path, ["k"], partition_cols=["y"], keys_fix_partition=False)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "y").collect())
    assert got == [(1, 11, "2022"), (2, 20, "2021")]


def test_upsert_table_creates_missing_table(spark, scratch):
    path = f"{scratch}/new"
    src = spark.createDataFrame([(1, 1)], SCHEMA)
    upsert_table(src, path, ["k"])
    assert rows(spark.read.parquet(path)) == [(1, 1)]


def test_refresh_reference_key_is_not_unique_at_sf0001(spark, tables):
    """Different lines sharing all five MERGE columns: the reference key
    makes MERGE fail; the line-safe key keeps every line."""
    from strata.plans import refresh, star
    target = star.fact_sales(tables.lineitem, tables.orders).limit(0)
    ref = refresh.staging_fact(tables.lineitem, tables.orders, "reference")
    dup = ref.groupBy(*refresh.FACT_KEYS).count().where(F.col("count") > 1).count()
    assert dup > 0
    # matching those rows against an existing fact must raise
    with pytest.raises(MergeCardinalityError):
        refresh.refreshed_fact(ref, tables.lineitem, tables.orders, "reference")
    safe_target = star.fact_sales(tables.lineitem, tables.orders, line_safe=True).limit(0)
    out = refresh.refreshed_fact(safe_target, tables.lineitem, tables.orders, "line_safe",
                                 on_duplicate="ignore")
    # identical lines (same linenumber too) still collapse under DISTINCT
    distinct_lines = star.fact_sales(tables.lineitem, tables.orders, line_safe=True).distinct()
    assert out.count() == distinct_lines.count()
    assert target.count() == 0


def test_key_moving_out_of_partition_that_keeps_other_rows(spark, scratch):
    path = f"{scratch}/t"
    spark.createDataFrame([(1, 10, "2020"), (2, 20, "2020"), (3, 30, "2021")],
                          "k int, v int, y string").write.partitionBy("y").parquet(path)
    src = spark.createDataFrame([(1, 11, "2022"), (3, 31, "2020")], "k int, v int, y string")
    upsert_table(src, path, ["k"], partition_cols=["y"], keys_fix_partition=False)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "y").collect())
    assert got == [(1, 11, "2022"), (2, 20, "2020"), (3, 31, "2020")]
    assert not os.path.exists(f"{path}/y=2021")


def test_null_partitions_keep_their_rows(spark, scratch):
    path = f"{scratch}/t"
    schema = "k int, v int, y int"
    spark.createDataFrame([(1, 10, None), (3, 30, 2000)], schema).write.partitionBy("y").parquet(path)
    for fixed in (True, False):
        upsert_table(spark.createDataFrame([(2, 20, None)], schema), path, ["k"], partition_cols=["y"],
                     keys_fix_partition=fixed)
        got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v").collect())
        assert got == [(1, 10), (2, 20), (3, 30)]
    # the last row of the NULL partition moves away: the partition goes
    upsert_table(spark.createDataFrame([(1, 11, 2000), (2, 21, 2000)], schema), path, ["k"], partition_cols=["y"],
                 keys_fix_partition=False)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v").collect())
    assert got == [(1, 11), (2, 21), (3, 30)]
    assert not [d for d in os.listdir(path) if "HIVE_DEFAULT" in d]


def test_upsert_evaluates_its_source_once(spark, scratch):
    path, seen = f"{scratch}/t", spark.sparkContext.accumulator(0)
    spark.createDataFrame([(1, 10, "a")], "k int, v int, y string").write.partitionBy("y").parquet(path)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    src = spark.createDataFrame([(1, 11, "a"), (2, 20, "b")], "k int, v int, y string")
    upsert_table(src.mapInArrow(count, src.schema), path, ["k"], partition_cols=["y"], keys_fix_partition=False)
    assert seen.value == 2 and spark.read.parquet(path).count() == 2


def test_a_crash_between_write_and_swap_loses_nothing(spark, scratch, monkeypatch):
    from strata.sinks import paths, swap
    path = f"{scratch}/t"
    spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "k int, v int, y string").write.partitionBy("y").parquet(path)
    src = spark.createDataFrame([(1, 11, "a"), (2, 21, "b"), (3, 30, "c")], "k int, v int, y string")
    moves = []

    def die(spark_, old, new, rename=paths.rename):
        moves.append(old)
        if len(moves) == 3:
            raise OSError("killed")
        rename(spark_, old, new)
    monkeypatch.setattr(paths, "rename", die)
    with pytest.raises(OSError):
        upsert_table(src, path, ["k"], partition_cols=["y"])
    monkeypatch.undo()
    swap.recover(spark, path)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "y").collect())
    assert got == [(1, 11, "a"), (2, 21, "b"), (3, 30, "c")]


def test_conditional_merge_compares_versions(spark):
    """A source row older than the stored one loses, an equally old one wins
    (a replay is a no-op), a NULL version is the oldest, keys of either side
    alone stay, repeated source keys take the newest."""
    target = spark.createDataFrame([(1, 5, "t"), (2, 5, "t"), (3, None, "t"), (4, 9, "t"), (None, 1, "t"), (7, 2, "t")],
                                   "k int, ver int, v string")
    source = spark.createDataFrame([("old", 4, 1), ("same", 5, 2), ("new", 1, 3), ("null", None, 4), ("in", None, 6),
                                    ("a", 1, 8), ("b", 3, 8), ("c", 2, 8), ("n", 0, None), ("late", 1, 7), ("mid", 2, 7)],
                                   "v string, ver int, k int")
    got = {(r.k, r.ver, r.v) for r in merge_frames(target, source, ["k"], newer_by="ver").collect()}
    assert got == {(1, 5, "t"), (2, 5, "same"), (3, 1, "new"), (4, 9, "t"), (6, None, "in"), (8, 3, "b"),
                   (None, 0, "n"), (None, 1, "t"), (7, 2, "mid")}
    with pytest.raises(ValueError, match="version column"):
        merge_frames(target.drop("ver"), source, ["k"], newer_by="ver")


def test_stored_versions_in_any_order(spark, scratch):
    """Three batches of versions in every order give one table, rows that move
    between partitions included."""
    import itertools
    from functools import reduce
    batches = [[(k, v, v % 2, f"{k}:{v}") for k in range(12) if (k + v) % 3] for v in (1, 2, 3)]
    seen = set()
    for i, order in enumerate(itertools.permutations(batches)):
        path = f"{scratch}/t{i}"
        for b in order:
            upsert_table(spark.createDataFrame(b, "k int, ver int, part int, v string"), path, ["k"],
                         partition_cols=["part"], keys_fix_partition=False, newer_by="ver")
        seen.add(tuple(sorted((r.k, r.ver, r.v) for r in spark.read.parquet(path).collect())))
    newest = reduce(lambda a, r: a | {r[0]: max(a.get(r[0], (0, "")), (r[1], r[3]))}, sum(batches, []), {})
    assert seen == {tuple(sorted((k, *r) for k, r in newest.items()))}
