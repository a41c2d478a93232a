"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver gate runs the same comparison at sf0.01)."""
import pytest

import __spark_entry__ as E
from conftest import SF001, SF01
from oracle import compare, duck
from strata.operators.upsert import MergeCardinalityError

ORACLE = E.oracle_sql()
# sf0.001 holds lines that share all five MERGE key columns: a MERGE of
# them must fail, so the upsert query is compared at sf0.01 instead.
AT_SF01 = {"fact_upsert"}
KEYS = sorted(k for k in E.queries() if k in ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.fixture(scope="module")
def con01():
    return duck(SF01)


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, con, con01, name):
    if name in AT_SF01:
        compare(E.queries()[name](spark, SF01), con01, ORACLE[name])
    else:
        compare(E.queries()[name](spark, SF001), con, ORACLE[name])


def test_fact_upsert_rejects_ambiguous_matches_at_sf0001(spark):
    with pytest.raises(MergeCardinalityError):
        E.queries()["fact_upsert"](spark, SF001)


def test_every_query_has_oracle_or_is_rows_only():
    from strata.plans.catalog import QUERIES
    assert set(QUERIES) <= set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["regionname", "total_revenue", "total_orders"]
    assert df.count() == 5
