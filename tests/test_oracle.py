"""Every registered query against its DuckDB oracle on sf0.001: row count,
column names, and the order-insensitive multiset of values."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from gridloom.sources.tables import TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _key(t):
    return tuple((x is None, x or "") for x in t)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    drows = sorted((tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in cur.fetchall()), key=_key)
    assert len(srows) == len(drows)
    assert srows == drows
