"""Every registered query on a skewed copy of the sf0.001 tables: one
order, one part and one supplier carry a third of all lines, one customer
a third of all orders. Results must still equal the DuckDB oracle run on
the same copy."""
import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle import compare, duck
from strata.operators.upsert import MergeCardinalityError
from strata.plans import marts, star
from strata.sources.tables import TABLES, Tables

ORACLE = E.oracle_sql()
SKIP = {"stream_incremental_orders", "stream_late_orders"}   # covered on the plain tables (slow here)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("skewed"))
    con = duck(SF001)
    for t in TABLES:
        if t == "lineitem":
            sql = """SELECT CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_orderkey END AS l_orderkey,
                            CASE WHEN l_linenumber % 3 = 1 THEN 0 ELSE l_partkey END AS l_partkey,
                            CASE WHEN l_linenumber % 3 = 2 THEN 0 ELSE l_suppkey END AS l_suppkey,
                            * EXCLUDE (l_orderkey, l_partkey, l_suppkey) FROM lineitem"""
        elif t == "orders":
            sql = """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS o_custkey,
                            * EXCLUDE (o_orderkey, o_custkey) FROM orders"""
        else:
            sql = f"SELECT * FROM {t}"
        con.execute(f"COPY ({sql}) TO '{d}/{t}.parquet' (FORMAT PARQUET)")
    return d


@pytest.mark.parametrize("name", sorted(k for k in E.queries() if k in ORACLE and k not in SKIP))
def test_query_on_skewed_tables(spark, skewed, name):
    con = duck(skewed)
    if name == "fact_upsert":
        # lines of the hot order now share the five MERGE columns: MERGE must refuse
        with pytest.raises(MergeCardinalityError):
            E.queries()[name](spark, skewed)
        return
    compare(E.queries()[name](spark, skewed), con, ORACLE[name])


def test_aqe_splits_the_hot_customer_join(spark, skewed):
    """With thresholds scaled down to the fixture, the (customer, order) ⋈
    customer join of the region mart runs as an AQE skew join: the hot
    customer's partition is split across tasks instead of landing in one."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # of a fact, as it is stored: several tasks hold lines of the hot customer
        t = Tables(spark, skewed)
        df = marts.sales_by_region(star.fact_sales(t.lineitem, t.orders), star.dim_customer(t.customer),
                                   star.dim_geography(t.nation, t.region))
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in final or "skew=true" in final, final
        compare(df, duck(skewed), ORACLE["sales_by_region"])
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
