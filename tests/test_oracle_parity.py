"""Every registered query with an oracle matches DuckDB on the smallest tables
(the driver runs the same comparison at sf0.01)."""
import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from shelfwise.sources.tables import TABLES, table_path

SF_SMALL = "/root/testdata/sf0.001"

ORACLE = E.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in recs]
    return sorted(rows, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    a = _rows(sdf.columns, [tuple(r) for r in sdf.collect()])
    b = _rows(dcols, res.fetchall())
    assert len(a) == len(b)
    assert a == b


def test_every_query_runs_or_has_oracle(spark):
    qs = E.queries()
    assert set(ORACLE) <= set(qs)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "churn" in df.columns
