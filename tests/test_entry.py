import duckdb

from conftest import SF_SMALL
from mound.plans.registry import load_all

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_contract_keys_and_sql_plan():
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    own = load_all()
    assert set(sqls) <= set(qs) and set(own) <= set(qs)
    assert all(sqls.get(name) == q.sql for name, q in own.items())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in sqls.items():
        con.execute("EXPLAIN " + sql)


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert {"home_avg_hits", "away_avg_hits", "home_avg_pitch_speed", "home_win"} <= set(df.columns)
