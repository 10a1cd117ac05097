from datetime import date

import pytest
from pyspark.sql import functions as F

from mound.schemas import MissingColumnsError
from mound.operators import seasons as S
from mound.schemas import PITCH_SCHEMA
from mound.session import scratch_path
from mound.sources import pitchlog as PL
from mound.sources import sinks as SK


def test_declared_schema_reads_seasons_with_missing_columns(spark):
    base = scratch_path(spark, "seasons")
    old = spark.createDataFrame([("2015-05-01", "NYY", "BOS", 90.0)],
                                "game_date string, home_team string, away_team string, release_speed double")
    new = spark.createDataFrame([("2024-05-01", "NYY", "BOS", 95.0, 101.5)],
                                "game_date string, home_team string, away_team string, release_speed double, "
                                "launch_speed double")
    SK.write_parquet(old, f"{base}/season=2015")
    SK.write_parquet(new, f"{base}/season=2024")
    df = PL.read_pitch_log(spark, [f"{base}/season=2015", f"{base}/season=2024"])
    assert df.schema == PITCH_SCHEMA
    rows = {r.game_date: r.launch_speed for r in df.collect()}
    assert rows == {"2015-05-01": None, "2024-05-01": 101.5}
    merged = PL.read_pitch_log(spark, base, schema=None, merge_schema=True)
    assert {"season", "launch_speed"} <= set(merged.columns) and merged.count() == 2


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, 2.0)], "x long, y double")
    b = spark.createDataFrame([(3,)], "x long")
    rows = sorted(S.union_seasons([a, b]).collect(), key=lambda r: r.x)
    assert [(r.x, r.y) for r in rows] == [(1, 2.0), (3, None)]


def test_write_if_absent_keeps_first(spark):
    path = scratch_path(spark, "keep") + "/t"
    SK.write_if_absent(spark.range(3), path)
    SK.write_if_absent(spark.range(10), path)
    assert spark.read.parquet(path).count() == 3


def test_csv_round_trip_with_nulls(spark):
    path = scratch_path(spark, "csv") + "/t"
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double")
    SK.write_csv(df, path)
    back = PL.read_csv(spark, path, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_season_tag_outside_any_season(spark):
    cal = S.calendar_frame(spark, [(2023, date(2023, 3, 30), date(2023, 10, 1))])
    df = spark.createDataFrame([("2023-04-02",), ("2023-12-01",), ("2022-05-01",)], "game_date string")
    tags = {r.game_date: r.season for r in S.season_tag(df, cal).collect()}
    assert tags == {"2023-04-02": 2023, "2023-12-01": None, "2022-05-01": None}


def test_season_crossing_new_year(spark):
    cal = S.calendar_frame(spark, [(2023, date(2023, 10, 20), date(2024, 2, 1)), (2024, date(2024, 3, 1), date(2024, 9, 1))])
    days = ["2023-10-20", "2023-12-31", "2024-01-01", "2024-02-01", "2024-02-02", "2024-03-01"]
    tags = {r.game_date: r.season for r in S.season_tag(spark.createDataFrame([(d,) for d in days], "game_date string"), cal).collect()}
    assert [tags[d] for d in days] == [2023, 2023, 2023, 2023, None, 2024]


def test_size_subset_equals_sorted_prefix(spark):
    import random

    from mound.operators import subsets as L

    rnd = random.Random(3)
    rows = [(rnd.choice([None, 1, 2, 3]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for n in (0, 1, 30, 60, 199, 200, 500):
        assert [tuple(r) for r in L.size_subset(df, ("k", "v"), n).collect()] == want[:n]
    assert L.size_subset(df.where("false"), ("k", "v"), 5).count() == 0


def test_size_subset_makes_its_rows_once(spark):
    from mound.operators import subsets as L

    made = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(v):
        made.add(1)
        return v

    df = spark.range(200).select((F.col("id") % 7).alias("k"), seen(F.col("id").cast("int")).alias("v"))
    assert [tuple(r) for r in L.size_subset(df, ("v", "k"), 3).collect()] == [(0, 0), (1, 1), (2, 2)]
    assert made.value == 200


def test_season_slice_pushes_filter(spark):
    path = scratch_path(spark, "slice") + "/t"
    spark.createDataFrame([("2023-04-02",), ("2023-12-01",)], "game_date string").write.parquet(path)
    df = S.season_slice(spark.read.parquet(path), "2023-03-30", "2023-10-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(game_date,2023-03-30)" in plan
    assert [r.game_date for r in df.collect()] == ["2023-04-02"]


def test_player_map_last_line_wins(spark, tmp_path):
    (tmp_path / "map.csv").write_text("name,code,note\nOld,AA,x\nBoth,BB,y\nNew,AA,z\n")
    got = {(r["code"], r["name"]) for r in PL.read_player_map(spark, str(tmp_path / "map.csv")).collect()}
    assert got == {("AA", "New"), ("BB", "Both")}


def test_player_map_needs_both_columns(spark, tmp_path):
    (tmp_path / "map.csv").write_text("code,nickname\nAA,x\n")
    with pytest.raises(MissingColumnsError):
        PL.read_player_map(spark, str(tmp_path / "map.csv"))


def test_partitioned_write_has_few_files(spark, tmp_path):
    df = spark.range(0, 4000, 1, 16).selectExpr("id", "cast(id % 3 as int) as season")
    SK.write_parquet(df, str(tmp_path / "out"), partition_by=["season"])
    files = list((tmp_path / "out").rglob("*.parquet"))
    assert len(files) <= 6 and spark.read.parquet(str(tmp_path / "out")).count() == 4000
