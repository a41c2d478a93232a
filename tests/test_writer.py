"""Writers: partition replacement and by-name appends against a contract."""
import pytest
from pyspark.sql import types as T

from strata.sinks.writer import write_by_name, replace_partitions, write_table


def test_replace_partitions_keeps_the_others(spark, scratch):
    p = f"{scratch}/t"
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, y string"), p,
                partition_cols=["y"])
    replace_partitions(spark.createDataFrame([(9, "b")], "v int, y string"), p, ["y"])
    got = sorted(tuple(r) for r in spark.read.parquet(p).select("v", "y").collect())
    assert got == [(1, "a"), (9, "b")]


def test_write_by_name_aligns_and_rejects_extras(spark, scratch):
    contract = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                             T.StructField("score", T.DoubleType())])
    p = f"{scratch}/a"
    write_by_name(spark.createDataFrame([(1.5, 1)], "score double, id int"), p, contract)
    write_by_name(spark.createDataFrame([("x", 2)], "name string, id long"), p, contract)
    df = spark.read.parquet(p)
    assert df.dtypes == [("id", "bigint"), ("name", "string"), ("score", "double")]
    assert sorted(tuple(r) for r in df.collect()) == [(1, None, 1.5), (2, "x", None)]
    with pytest.raises(ValueError):
        write_by_name(spark.createDataFrame([(3, 1)], "id int, other int"), p, contract)


def test_write_by_name_replaces(spark, scratch):
    contract = T.StructType([T.StructField("id", T.LongType())])
    for _ in range(2):
        write_by_name(spark.range(3), f"{scratch}/r", contract, mode="overwrite")
    assert spark.read.parquet(f"{scratch}/r").count() == 3
