"""Every registered query against its DuckDB twin on the smallest tables."""

import math

import duckdb
import pytest

from conftest import SF_SMALL
from mound.plans.registry import load_all

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SQL_QUERIES = sorted(n for n, q in load_all().items() if q.sql is not None)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple(str(x) for x in t))


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_matches_duckdb(spark, duck, name):
    q = load_all()[name]
    df = q.run(spark, SF_SMALL)
    res = duck.execute(q.sql)
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, res.fetchall())
