"""Exact money aggregation: split-long sums equal exact integer sums."""
import math
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import money as M


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-(1 << 40), 1 << 40), min_size=1, max_size=40))
def test_sum_units_is_exact(spark, values):
    df = spark.createDataFrame([(v % 3, v) for v in values], "g int, u long").repartition(3)
    got = {r.g: r.t for r in df.groupBy("g").agg(M.sum_units(F.col("u")).alias("t")).collect()}
    want = {}
    for v in values:
        want[v % 3] = want.get(v % 3, 0) + v
    assert {k: int(v) for k, v in got.items()} == want


def test_amounts_equal_the_exact_decimal_sum(spark):
    rows = [(12345.67, 0.07), (0.01, 0.0), (104997.88, 0.1), (100.0, 0.055), (-0.125, 0.5), (None, 0.02),
            (7.5, None)]
    df = spark.createDataFrame(rows, "p double, d double")
    r = df.agg(M.net_sum("p", "d").alias("a"), M.amount_sum("p").alias("b"), M.amount_avg("d").alias("c")).first()
    both = [(Decimal(str(p)), Decimal(str(d))) for p, d in rows if p is not None and d is not None]
    assert r.a == float(sum(p * (1 - d) for p, d in both))
    assert r.b == float(sum(Decimal(str(p)) for p, _ in rows if p is not None))
    assert r.c == float(sum(Decimal(str(d)) for _, d in rows if d is not None)) / 6


def test_a_rate_finer_than_a_percent_and_nan(spark):
    df = spark.createDataFrame([(1, 100.0, 0.055), (2, float("nan"), 0.1), (2, 1.0, 0.1), (3, 1.0, float("nan"))],
                               "g int, p double, d double")
    got = {r.g: r.s for r in df.groupBy("g").agg(M.net_sum("p", "d").alias("s")).collect()}
    assert got[1] == 94.5 and math.isnan(got[2]) and math.isnan(got[3])


def test_empty_and_null_groups(spark):
    df = spark.createDataFrame([(1, None)], "g int, p double")
    r = df.groupBy("g").agg(M.amount_sum("p").alias("s"),
                            M.amount_avg("p").alias("a")).first()
    assert r.s is None and r.a is None
