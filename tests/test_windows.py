from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mound.operators import games as G
from mound.operators import team_windows as TW
from mound.sources.fixtures import pitches


def _tg(spark, results):
    # one team, consecutive dates; result is given through runs
    rows = []
    for i, r in enumerate(results):
        rf, ra = {"W": (2, 1), "L": (1, 2), "T": (1, 1), "N": (None, 1)}[r]
        rows.append(("A", "B", 1, f"2023-04-{i + 1:02d}", rf, ra))
    df = spark.createDataFrame(rows, "team string, opponent string, is_home int, game_date string, "
                                     "runs_for long, runs_against long")
    return df.withColumn("result", F.signum(F.col("runs_for") - F.col("runs_against")).cast("int"))


def test_streaks(spark):
    out = TW.streaks(_tg(spark, "WWLTWWWNL")).orderBy("game_date").collect()
    assert [r.streak_before for r in out] == [0, 1, 2, -1, 0, 1, 2, 3, 0]


def test_prior_n_team_without_prior_game(spark):
    out = TW.prior_n_averages(_tg(spark, "WLW"), 5).orderBy("game_date").collect()
    assert out[0].prior_games == 0 and out[0].prior_avg_runs_for is None
    assert out[2].prior_games == 2 and out[2].prior_avg_runs_for == 1.5


def test_season_to_date_resets_each_season(spark):
    rows = [("A", "B", 1, d, 3, 1) for d in ("2022-09-01", "2022-09-02", "2023-04-01")]
    df = spark.createDataFrame(rows, "team string, opponent string, is_home int, game_date string, "
                                     "runs_for long, runs_against long").withColumn("result", F.lit(1))
    out = TW.season_to_date(df).orderBy("game_date").collect()
    assert [r.games_before for r in out] == [0, 1, 0]
    assert [r.wins_before for r in out] == [0, 1, 0]


def _fanout_brute(p):
    """The literal date-only join + team windows, reduced per team."""
    g = p.groupBy("game_date", F.col("home_team").alias("gh"), F.col("away_team").alias("ga")).count().drop("count")
    h = G.home_day_stats(p).withColumnsRenamed({"home_team": "h_team"})
    a = G.away_day_stats(p).withColumnsRenamed({"away_team": "a_team"})
    f = g.join(h, "game_date", "left").join(a, "game_date", "left")
    home = f.groupBy(F.col("gh").alias("team")).agg(
        F.count(F.lit(1)).alias("fanout_rows"), F.sum("home_half_pitches").alias("sum_hits_stat"),
        F.avg("home_avg_pitch_speed").alias("team_avg_pitch_speed")).withColumn("side", F.lit("home"))
    away = f.groupBy(F.col("ga").alias("team")).agg(
        F.count(F.lit(1)).alias("fanout_rows"), F.sum("away_half_pitches").alias("sum_hits_stat"),
        F.avg("away_avg_pitch_speed").alias("team_avg_pitch_speed")).withColumn("side", F.lit("away"))
    return {(r.side, r.team): (r.fanout_rows, r.sum_hits_stat,
                               None if r.team_avg_pitch_speed is None else round(r.team_avg_pitch_speed, 6))
            for r in home.unionByName(away).collect()}


def _fanout_fast(p):
    return {(r.side, r.team): (r.fanout_rows, r.sum_hits_stat,
                               None if r.team_avg_pitch_speed is None else round(r.team_avg_pitch_speed, 6))
            for r in TW.fanout_team_features(p).collect()}


def test_fanout_reduction_equals_brute_force(spark):
    """The algebraic J1 form against the literal date-only join + windows."""
    p = pitches(spark, SF_SMALL)
    fast = _fanout_fast(p)
    assert fast == _fanout_brute(p) and len(fast) > 0


def test_fanout_reduction_with_null_speeds(make_pitches):
    from conftest import pitch

    p = make_pitches([
        pitch("2023-04-01", 1, 1, "NYY", "BOS", "Bot", speed=None),
        pitch("2023-04-01", 1, 2, "NYY", "BOS", "Top", speed=None),
        pitch("2023-04-01", 2, 1, "NYY", "TOR", "Bot", speed=None),
        pitch("2023-04-01", 3, 1, "SEA", "TEX", "Top", speed=91.0),
        pitch("2023-04-02", 4, 1, "BOS", "NYY", "Bot", speed=88.5),
        pitch("2023-04-02", 4, 2, "BOS", "NYY", "Top", speed=92.0),
        pitch("2023-04-03", 5, 1, "TEX", "SEA", "Top", speed=None),
    ])
    fast = _fanout_fast(p)
    assert fast == _fanout_brute(p)
    assert fast[("home", "TEX")][2] is None


def test_team_games_stack(spark):
    g = spark.createDataFrame([("2023-04-01", "H", "A", 3, 2)],
                              "game_date string, home_team string, away_team string, home_score long, away_score long")
    rows = sorted(G.team_games(g).collect(), key=lambda r: -r.is_home)
    assert [(r.team, r.opponent, r.result) for r in rows] == [("H", "A", 1), ("A", "H", -1)]


def test_prior_window_matches_plain_window(spark):
    tg = G.team_games(G.game_stats(pitches(spark, SF_SMALL), full=False))
    w = Window.partitionBy("team").orderBy(*TW.TEAM_ORDER).rowsBetween(-5, -1)
    plain = tg.select("team", "game_date", "is_home", "opponent", F.avg("runs_for").over(w).alias("x"))
    ours = TW.prior_n_averages(tg, 5).select("team", "game_date", "is_home", "opponent",
                                             F.col("prior_avg_runs_for").alias("x"))
    a = {tuple(r[:4]): None if r.x is None else round(r.x, 9) for r in plain.collect()}
    b = {tuple(r[:4]): None if r.x is None else round(r.x, 9) for r in ours.collect()}
    assert a == b


def _plain(tg):
    """Baseline: plain windows over the whole team (one task per team)."""
    w = Window.partitionBy("team").orderBy(*TW.TEAM_ORDER)
    r = F.coalesce(F.col("result"), F.lit(0))
    x = tg.withColumn("_r", r).withColumn("_new", F.when(F.lag("_r").over(w) == F.col("_r"), 0).otherwise(1))
    x = x.withColumn("_isl", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    x = x.withColumn("_pos", F.row_number().over(Window.partitionBy("team", "_isl").orderBy(*TW.TEAM_ORDER)))
    ws = Window.partitionBy("team", "_season").orderBy(*TW.TEAM_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    w5 = w.rowsBetween(-5, -1)
    x = x.withColumn("_season", F.year(F.to_date("game_date")))
    return x.select(
        "team", "game_date", "is_home", "opponent",
        F.coalesce(F.lag(F.col("_pos") * F.col("_r")).over(w), F.lit(0)).alias("streak"),
        F.count(F.lit(1)).over(ws).alias("gb"),
        F.avg("runs_for").over(ws).alias("std_rf"),
        F.count(F.lit(1)).over(w5).alias("pg"),
        F.avg("runs_against").over(w5).alias("p_ra"),
    )


def test_team_windows_match_plain_windows_randomized(spark):
    import random

    rnd = random.Random(7)
    teams = ["A", "B", "C", "D", "E"]
    dates = [f"2022-09-{d:02d}" for d in range(20, 31)] + [f"2023-04-{d:02d}" for d in range(1, 6)]
    games = set()
    for _ in range(400):
        h, a = rnd.sample(teams, 2)
        games.add((rnd.choice(dates), h, a))
    rows = []
    for d, h, a in sorted(games):
        hs = rnd.choice([None, 1, 2, 3, 3, 3])
        as_ = rnd.choice([1, 2, 3])
        rows.append((d, h, a, hs, as_))
    g = spark.createDataFrame(rows, "game_date string, home_team string, away_team string, "
                                    "home_score long, away_score long")
    tg = G.team_games(g)
    ref = {tuple(r[:4]): (r.streak, r.gb, None if r.std_rf is None else round(r.std_rf, 9), r.pg,
                          None if r.p_ra is None else round(r.p_ra, 9)) for r in _plain(tg).collect()}
    st = {tuple(r[:4]): r.streak_before for r in
          TW.streaks(tg).select("team", "game_date", "is_home", "opponent", "streak_before").collect()}
    sd = {tuple(r[:4]): (r.games_before, None if r.std_avg_runs_for is None else round(r.std_avg_runs_for, 9))
          for r in TW.season_to_date(tg).select("team", "game_date", "is_home", "opponent", "games_before",
                                                 "std_avg_runs_for").collect()}
    p5 = {tuple(r[:4]): (r.prior_games, None if r.prior_avg_runs_against is None else round(r.prior_avg_runs_against, 9))
          for r in TW.prior_n_averages(tg, 5).select("team", "game_date", "is_home", "opponent", "prior_games",
                                                     "prior_avg_runs_against").collect()}
    assert set(ref) == set(st) == set(sd) == set(p5)
    for k, (streak, gb, std_rf, pg, p_ra) in ref.items():
        assert st[k] == streak, k
        assert sd[k] == (gb, std_rf), k
        assert p5[k] == (pg, p_ra), k


def test_doubleheader_ordered_by_game_pk(spark):
    g = spark.createDataFrame(
        [("2023-04-01", 2, "A", "B", 1, 5), ("2023-04-01", 1, "A", "B", 4, 2), ("2023-04-02", 3, "A", "B", 3, 0)],
        "game_date string, game_pk long, home_team string, away_team string, home_score long, away_score long")
    tg = G.team_games(g, extra=("game_pk",))
    a = {r.game_pk: r.streak_before for r in TW.streaks(tg).where("team = 'A'").collect()}
    assert a == {1: 0, 2: 1, 3: -1}
    p5 = {r.game_pk: r.prior_games for r in TW.prior_n_averages(tg).where("team = 'A'").collect()}
    assert p5 == {1: 0, 2: 1, 3: 2}
    sd = {r.game_pk: r.wins_before for r in TW.season_to_date(tg).where("team = 'A'").collect()}
    assert sd == {1: 0, 2: 1, 3: 1}


def test_season_to_date_uses_given_season(spark):
    rows = [("A", "B", 1, d, 3, 1, s) for d, s in (("2022-09-01", 1), ("2022-09-02", 2), ("2022-09-03", 2))]
    df = spark.createDataFrame(rows, "team string, opponent string, is_home int, game_date string, "
                                     "runs_for long, runs_against long, season int").withColumn("result", F.lit(1))
    out = TW.season_to_date(df).orderBy("game_date").collect()
    assert [(r.season, r.games_before) for r in out] == [(1, 0), (2, 0), (2, 1)]
