import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    wh = tempfile.mkdtemp(prefix="strata-test-wh-")
    s = build_session("local[4]", app="strata-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from strata.sources.tables import Tables
    return Tables(spark, SF001)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="strata-test-")
