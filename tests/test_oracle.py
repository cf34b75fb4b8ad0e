"""Every registered query against its DuckDB oracle on the smallest
tables (the driver repeats this at sf0.01), plus the entry contract."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from core_helpers import SF_SMALL
from tidewater.views import TABLES

SQLS = E.oracle_sql()


def norm(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        if f == int(f) and abs(f) < 1e15:
            return int(f)
        return float(f"{f:.6g}") if abs(f) >= 1e6 else round(f, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["email", "usage", "quota", "timestamp"]
    rows = df.collect()
    assert rows and all(r.usage > r.quota for r in rows)


def test_every_sql_key_is_a_query():
    assert set(SQLS) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    got = canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    cur = duck.execute(SQLS[name])
    want = canon([d[0] for d in cur.description], cur.fetchall())
    assert got == want
