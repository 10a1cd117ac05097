from pyspark.sql import functions as F

from conftest import SF_SMALL, pitch
from mound.functions.clean import home_win
from mound.operators import games as G
from mound.sources.fixtures import pitches


def test_game_stats_counts_and_label(make_pitches):
    p = make_pitches([
        pitch("2023-04-01", 1, 1, "NYY", "BOS", "Top", "strikeout", "called_strike", "S", hs=1, as_=0),
        pitch("2023-04-01", 1, 2, "NYY", "BOS", "Bot", "home_run", "hit_into_play", "X", ls=100.0, la=30.0, hs=2),
        pitch("2023-04-01", 1, 3, "NYY", "BOS", "Bot", "strikeout", "called_strike", "S", hs=2, as_=1),
    ])
    r = G.game_stats(p).withColumn("home_win", home_win()).collect()[0]
    assert (r.total_pitches, r.home_strikeouts, r.away_strikeouts, r.home_runs) == (3, 1, 1, 1)
    assert (r.home_score, r.away_score, r.home_win) == (2, 1, 1)
    assert r.avg_exit_velocity == 100.0 and r.avg_launch_angle == 30.0


def test_game_without_hit_balls_has_null_launch_averages(make_pitches):
    p = make_pitches([pitch("2023-04-01", 1, 1, "NYY", "BOS", "Top")])
    r = G.game_stats(p).collect()[0]
    assert r.avg_exit_velocity is None and r.home_runs == 0


def test_null_scores_two_rules(spark):
    df = spark.createDataFrame([(None, 1), (3, 1), (1, 1)], "home_score long, away_score long")
    out = df.select(home_win(nulls="null").alias("a"), home_win(nulls="zero").alias("b")).collect()
    assert [(r.a, r.b) for r in out] == [(None, 0), (1, 1), (0, 0)]


def test_doubleheader_key_is_a_parameter(make_pitches):
    p = make_pitches([
        pitch("2023-04-01", 1, 1, "NYY", "BOS", "Top", hs=1),
        pitch("2023-04-01", 2, 1, "NYY", "BOS", "Top", as_=3),
    ])
    assert G.game_stats(p).count() == 1
    assert G.game_stats(p, keys=("game_date", "game_pk", "home_team", "away_team")).count() == 2
    assert {r.game_pk: r.home_win for r in G.game_features(p).collect()} == {1: 1, 2: 0}  # the default keeps them apart
    assert G.game_features(p.drop("game_pk")).count() == G.game_features(p, G.GAME_KEY).count() == 1


def test_empty_input_keeps_schema(make_pitches):
    p = make_pitches([])
    out = G.game_features(p)
    assert out.count() == 0
    assert {"home_avg_hits", "away_avg_pitch_speed", "home_win"} <= set(out.columns)


def test_single_pass_equals_joined_form_when_each_team_meets_one_opponent(spark):
    p = pitches(spark, SF_SMALL)
    # keep dates on which no home team and no away team meets two opponents
    g = p.select(*G.GAME_KEY).distinct()
    ok_dates = (g.groupBy("game_date", "home_team").count().where("count > 1").select("game_date")
                .union(g.groupBy("game_date", "away_team").count().where("count > 1").select("game_date")))
    clean = p.join(ok_dates.distinct(), "game_date", "left_anti")
    a5 = G.game_stats_single_pass(clean).select(*G.GAME_KEY, "home_half_pitches", "away_half_pitches", "total_pitches")
    joined = (G.game_stats(clean, full=False).join(G.home_day_stats(clean), ["game_date", "home_team"])
              .join(G.away_day_stats(clean), ["game_date", "away_team"])
              .select(*G.GAME_KEY, "home_half_pitches", "away_half_pitches", "total_pitches"))
    assert clean.count() > 0
    assert a5.exceptAll(joined).count() == 0 and joined.exceptAll(a5).count() == 0


def test_game_features_equals_window_form(spark):
    from pyspark.sql import Window

    p = pitches(spark, SF_SMALL)
    fast = G.game_features(p, G.GAME_KEY)
    w_home, w_away = Window.partitionBy("home_team"), Window.partitionBy("away_team")
    slow = (G.game_stats(p).join(G.home_day_stats(p), ["game_date", "home_team"], "left")
            .join(G.away_day_stats(p), ["game_date", "away_team"], "left")
            .withColumn("home_avg_hits", F.col("home_half_pitches") / F.count("game_date").over(w_home))
            .withColumn("home_team_speed", F.avg("home_avg_pitch_speed").over(w_home))
            .withColumn("away_team_speed", F.avg("away_avg_pitch_speed").over(w_away)))
    a = {(r.game_date, r.home_team, r.away_team): (round(r.home_avg_hits, 9), round(r.home_avg_pitch_speed, 6),
                                                   round(r.away_avg_pitch_speed, 6)) for r in fast.collect()}
    b = {(r.game_date, r.home_team, r.away_team): (round(r.home_avg_hits, 9), round(r.home_team_speed, 6),
                                                   round(r.away_team_speed, 6)) for r in slow.collect()}
    assert a == b


def test_game_nested_first_last(make_pitches):
    p = make_pitches([
        pitch("2023-04-01", 1, 3, "NYY", "BOS", "Top", desc="c"),
        pitch("2023-04-01", 1, 1, "NYY", "BOS", "Top", desc="a"),
        pitch("2023-04-01", 1, 2, "NYY", "BOS", "Bot", desc="b"),
    ])
    r = G.game_nested(p, order=("pitch_number", "description")).collect()[0]
    assert (r.n_pitches, r.first_description, r.last_description) == (3, "a", "c")


def test_join_small_broadcasts_only_within_bound(spark):
    from mound.operators.joins import join_small

    big = spark.range(1000).withColumn("k", F.col("id") % 3)
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    joined = join_small(big, small, "k")
    assert "BroadcastExchange" in joined._jdf.queryExecution().executedPlan().toString()
    within = sorted(joined.collect(), key=lambda r: r.id)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        joined = join_small(big, small, "k")
        assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(joined.collect(), key=lambda r: r.id) == within and len(within) == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_game_features_null_speed_day(make_pitches):
    p = make_pitches([
        pitch("2023-04-01", 1, 1, "NYY", "BOS", "Bot", speed=None, hs=3, as_=1),
        pitch("2023-04-02", 2, 1, "NYY", "TOR", "Bot", speed=90.0, hs=0, as_=2),
        pitch("2023-04-02", 2, 2, "NYY", "TOR", "Top", speed=94.0, hs=0, as_=2),
    ])
    rows = {r.game_date: r for r in G.game_features(p).collect()}
    assert rows["2023-04-01"].home_day_avg_pitch_speed is None
    assert rows["2023-04-02"].home_day_avg_pitch_speed == 92.0
    # the team average skips the day without speeds; W2 divides by the team's 2 home games
    assert rows["2023-04-01"].home_avg_pitch_speed == 92.0
    assert rows["2023-04-01"].home_avg_hits == 0.5 and rows["2023-04-02"].home_avg_hits == 0.5
    assert (rows["2023-04-01"].home_win, rows["2023-04-02"].home_win) == (1, 0)
