"""Shared Spark-vs-DuckDB comparison used by the tests."""
import datetime as dt
import decimal
import math

import duckdb

from strata.sources.tables import TABLES


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_key(r):
    return tuple((0, "") if x is None else (1, repr(x)) for x in r)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(sdf, con, sql):
    scols = sdf.columns
    srows = sorted((tuple(norm(x) for x in r) for r in sdf.collect()), key=rows_key)
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(scols) == sorted(ocols), (scols, ocols)
    perm = [ocols.index(c) for c in scols]
    orows = sorted((tuple(norm(r[i]) for i in perm) for r in res.fetchall()), key=rows_key)
    assert len(srows) == len(orows)
    assert srows == orows
    return len(srows)
