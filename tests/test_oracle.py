"""Every catalogued query against its DuckDB oracle at sf0.001."""

import datetime as dt
import math
import os

import duckdb
import pytest

from caseflow.plans.catalog import queries
from caseflow.plans.oracle import oracle_sql

from .conftest import SF_SMALL

SQL = oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["orders", "supplier", "documents", "labels"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(SF_SMALL, t)}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    res = con.execute(SQL[name])
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(o_cols, res.fetchall())


def test_every_query_without_oracle_is_deliberate():
    assert set(queries()) - set(SQL) == {"evidence_pack"}
