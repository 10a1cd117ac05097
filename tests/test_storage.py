"""Stored tables: replaced seasons, buckets, files of several schemas, versioned dictionaries."""

import os
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from mound.plans import queries_io as QIO
from mound.session import path_bytes
from mound.sources import fixtures as FX
from mound.functions import versions as V
from mound.operators import games as G
from mound.sources import reconcile as R
from mound.sources import sinks as S

ROWS = "game string, pitch int, season int, v string, load int"


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def read(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(ROWS).parquet(path).select("game", "pitch", "season", "v", "load").collect())


def test_replace_one_season(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_parquet(spark.createDataFrame([("a", 1, 1, "x", 0), ("a", 2, 1, "x", 0), ("b", 1, 2, "y", 0), ("c", 1, 2, "y", 0)], ROWS), path, ["season"])
    before = files(path)
    new = spark.createDataFrame([("b", 1, 2, "old", 1), ("b", 1, 2, "new", 2), ("d", 1, 2, "z", 1)], ROWS)
    S.replace_seasons(new, path, ["game", "pitch"], ["load"])
    want = [("a", 1, 1, "x", 0), ("a", 2, 1, "x", 0), ("b", 1, 2, "new", 2), ("d", 1, 2, "z", 1)]
    assert read(spark, path) == want
    after = files(path)
    assert {f: t for f, t in after.items() if "season=1" in f} == {f: t for f, t in before.items() if "season=1" in f}
    S.replace_seasons(new.repartition(5), path, ["game", "pitch"], ["load"])
    assert read(spark, path) == want


def test_replace_keeps_the_rest_of_a_season(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_parquet(spark.createDataFrame([("b", 1, 2, "y", 5), ("c", 1, 2, "y", 0)], ROWS), path, ["season"])
    new = spark.createDataFrame([("b", 1, 2, "late", 4), ("c", 1, 2, "c2", 1), ("e", 1, 3, "e", 1), ("e", 1, 3, None, 1)], ROWS)
    S.replace_seasons(new, path, ["game", "pitch"], ["load"], keep=True)
    assert read(spark, path) == [("b", 1, 2, "y", 5), ("c", 1, 2, "c2", 1), ("e", 1, 3, "e", 1)]
    with pytest.raises(ValueError, match="columns differ"):
        S.replace_seasons(new.withColumn("w", F.lit(1)), path, ["game", "pitch"], ["load"])
    S.replace_seasons(new, str(tmp_path / "fresh"), ["game", "pitch"], ["load"])
    assert len(read(spark, str(tmp_path / "fresh"))) == 3


def test_buckets_need_no_shuffle(spark, make_pitches, tmp_path):
    from conftest import pitch

    rows = [pitch(f"2024-04-0{d}", d, n, h, "B", "Top" if n % 2 else "Bot", hs=n, as_=d) for d in range(1, 6) for h in ("A", "C") for n in range(6)]
    log = make_pitches(rows)
    name = f"log_{uuid.uuid4().hex}"
    stored = S.write_bucketed(log, name, str(tmp_path / "b"), ["game_date"], ["game_date", "home_team"], buckets=4)
    out = G.with_day_stats(G.game_partials(stored))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert sorted(map(str, out.collect())) == sorted(map(str, G.with_day_stats(G.game_partials(log)).select(out.columns).collect()))
    assert "Exchange" in G.game_partials(log)._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("a, b, want", [
    ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("smallint", "float", "double"), ("float", "double", "double"), ("string", "string", "string"),
    ("date", "timestamp", "timestamp"), ("decimal(5,2)", "decimal(8,1)", "decimal(9,2)"), ("decimal(5,2)", "int", "double"), ("void", "string", "string")])
def test_wider(a, b, want):
    parse = lambda t: T.NullType() if t == "void" else T._parse_datatype_string(t)
    try:
        x, y = parse(a), parse(b)
    except Exception:
        pytest.skip("needs a session")
    assert R.wider(x, y).simpleString() == R.wider(y, x).simpleString() == want


def test_season_schemas(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("a", "b", "c", "d")]
    spark.createDataFrame([(1, 10)], "id int, speed int").write.parquet(paths[0])
    spark.createDataFrame([(2, 2.5, "FF")], "id bigint, speed double, kind string").write.parquet(paths[1])
    spark.createDataFrame([(3, 30)], "id int, speed int").write.parquet(paths[2])
    spark.createDataFrame([], "speed int, id int").write.parquet(paths[3])
    out = R.read_seasons(spark, paths)
    assert out.dtypes == [("id", "bigint"), ("speed", "double"), ("kind", "string")]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 10.0, None), (2, 2.5, "FF"), (3, 30.0, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3  # three schemas, four paths
    pruned = out.where("speed > 20").select("id")
    assert [r.id for r in pruned.collect()] == [3]
    spark.createDataFrame([("x",)], "id string").write.parquet(str(tmp_path / "e"))
    with pytest.raises(R.SchemaConflictError, match="id"):
        R.read_seasons(spark, [paths[0], str(tmp_path / "e")])
    only = R.read_seasons(spark, paths[:2], T.StructType([T.StructField("kind", T.StringType()), T.StructField("id", T.LongType())]))
    assert sorted(map(tuple, only.collect()), key=str) == [("FF", 2), (None, 1)]


def test_dictionary_versions(spark, tmp_path):
    path = str(tmp_path / "dict")
    first = spark.createDataFrame([("b", 2), ("a", None), (None, 10)], "t string, n int")
    one = {(r.column, r.value): r.code for r in V.append_version(first, ["t", "n"], path, 1).collect()}
    assert one == {("t", "a"): 0, ("t", "b"): 1, ("n", "10"): 0, ("n", "2"): 1}
    kept = files(path)
    second = spark.createDataFrame([("aa", 2), ("b", 11), ("A", 1)], "t string, n int")
    for _ in range(2):  # a repeated load gives the same codes
        two = {(r.column, r.value): (r.code, r.version) for r in V.append_version(second.repartition(3), ["t", "n"], path, 2).collect()}
        assert two == {k: (v, 1) for k, v in one.items()} | {("t", "A"): (2, 2), ("t", "aa"): (3, 2), ("n", "1"): (2, 2), ("n", "11"): (3, 2)}
    assert {f: t for f, t in files(path).items() if "version=1" in f} == kept
    with pytest.raises(ValueError, match="version 2"):
        V.append_version(first, ["t", "n"], path, 1)
    coded = V.encode_with_dictionary(spark.createDataFrame([("aa", 2), ("zz", None)], "t string, n int"), ["t", "n"], V.read_dictionary(spark, path))
    assert sorted(map(tuple, coded.collect()), key=str) == [("aa", 2, 3, 1), ("zz", None, None, None)]
    assert V.append_version(spark.createDataFrame([(date(2024, 1, 2),)], "d date"), ["d"], str(tmp_path / "days"), 1).first()["value"] == "2024-01-02"


def test_parts_follow_the_size_of_the_log(spark, monkeypatch):
    """A large log meets its games, and is stored, in as many parts as its bytes ask for; the rows are the same."""
    small = FX.pitches(spark, SF_SMALL)
    size = path_bytes(spark, f"{SF_SMALL}/lineitem.parquet")
    monkeypatch.setattr(FX, "PART_BYTES", size // 20)
    parts = FX.parts_of(spark, SF_SMALL, "lineitem")
    large, buckets, write = FX.pitches(spark, SF_SMALL), [], QIO.SK.write_bucketed
    assert parts >= 20 and "REPARTITION_BY_NUM" in large._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in small._jdf.queryExecution().executedPlan().toString()
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
    monkeypatch.setattr(QIO.SK, "write_bucketed", lambda *a, buckets: seen.append(buckets) or write(*a, buckets=buckets))
    seen = buckets
    QIO.q_bucketed_day_features(spark, SF_SMALL)
    assert seen == [parts]
