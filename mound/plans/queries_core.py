"""Registered queries: game aggregates, team features and team windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from mound.dictionaries import HIT_EVENTS
from mound.functions.clean import home_win, round_doubles
from mound.operators import games as G
from mound.operators import nested as N
from mound.operators import team_windows as TW
from mound.plans.registry import register
from mound.sources.fixtures import pitches, with_pitches


def _cnt(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


# ---------------------------------------------------------------- SQL pieces
_HITS = ", ".join(f"'{e}'" for e in HIT_EVENTS)

GAME_SQL = f"""SELECT game_date, home_team, away_team,
       MAX(home_score) AS home_score, MAX(away_score) AS away_score, COUNT(*) AS total_pitches,
       {_cnt("events = 'strikeout' AND inning_topbot = 'Bot'")} AS home_strikeouts,
       {_cnt("events = 'strikeout' AND inning_topbot = 'Top'")} AS away_strikeouts,
       (CAST(SUM(launch_speed) AS DOUBLE) / NULLIF(COUNT(launch_speed), 0)) AS avg_exit_velocity, (CAST(SUM(launch_angle) AS DOUBLE) / NULLIF(COUNT(launch_angle), 0)) AS avg_launch_angle,
       {_cnt("events = 'home_run'")} AS home_runs
FROM pitches GROUP BY game_date, home_team, away_team"""

HOME_DAY_SQL = f"""SELECT game_date, home_team, {_cnt("inning_topbot = 'Bot'")} AS home_half_pitches,
       (CAST(SUM(release_speed) AS DOUBLE) / NULLIF(COUNT(release_speed), 0)) AS home_day_avg_pitch_speed, (CAST(SUM(release_spin_rate) AS DOUBLE) / NULLIF(COUNT(release_spin_rate), 0)) AS home_day_avg_spin_rate
FROM pitches GROUP BY game_date, home_team"""

AWAY_DAY_SQL = f"""SELECT game_date, away_team, {_cnt("inning_topbot = 'Top'")} AS away_half_pitches,
       (CAST(SUM(release_speed) AS DOUBLE) / NULLIF(COUNT(release_speed), 0)) AS away_day_avg_pitch_speed, (CAST(SUM(release_spin_rate) AS DOUBLE) / NULLIF(COUNT(release_spin_rate), 0)) AS away_day_avg_spin_rate
FROM pitches GROUP BY game_date, away_team"""

# Games joined with their own team-day statistics (correct keys).
GAMES_KEYED_CTES = f"""g AS ({GAME_SQL}),
hd AS ({HOME_DAY_SQL}),
ad AS ({AWAY_DAY_SQL}),
j AS (SELECT g.*, hd.home_half_pitches, hd.home_day_avg_pitch_speed, hd.home_day_avg_spin_rate,
             ad.away_half_pitches, ad.away_day_avg_pitch_speed, ad.away_day_avg_spin_rate
      FROM g LEFT JOIN hd ON g.game_date = hd.game_date AND g.home_team = hd.home_team
             LEFT JOIN ad ON g.game_date = ad.game_date AND g.away_team = ad.away_team)"""

TEAM_GAMES_CTES = f"""g AS ({GAME_SQL}),
tg AS (SELECT home_team AS team, away_team AS opponent, 1 AS is_home, game_date,
              home_score AS runs_for, away_score AS runs_against FROM g
       UNION ALL
       SELECT away_team, home_team, 0, game_date, away_score, home_score FROM g),
tgr AS (SELECT *, CAST(sign(runs_for - runs_against) AS INTEGER) AS result FROM tg)"""

TEAM_ORDER_SQL = "PARTITION BY team ORDER BY game_date, is_home, opponent"


# ------------------------------------------------------------------ queries
@register(
    "game_stats", ("A3", "P8"),
    with_pitches(f"""SELECT game_date, home_team, away_team, home_score, away_score, total_pitches,
       home_strikeouts, away_strikeouts, avg_exit_velocity AS avg_exit_velocity,
       avg_launch_angle AS avg_launch_angle, home_runs,
       CAST(home_score > away_score AS INTEGER) AS home_win
FROM ({GAME_SQL}) g"""),
)
def q_game_stats(spark, sf):
    return G.game_stats(pitches(spark, sf)).withColumn("home_win", home_win())


@register(
    "game_stats_short", ("A4", "P8"),
    with_pitches(f"""SELECT game_date, home_team, away_team,
       MAX(home_score) AS home_score, MAX(away_score) AS away_score, COUNT(*) AS total_pitches,
       {_cnt("events = 'strikeout' AND inning_topbot = 'Bot'")} AS home_strikeouts,
       {_cnt("events = 'strikeout' AND inning_topbot = 'Top'")} AS away_strikeouts,
       CAST(MAX(home_score) > MAX(away_score) AS INTEGER) AS home_win
FROM pitches GROUP BY game_date, home_team, away_team"""),
)
def q_game_stats_short(spark, sf):
    return G.game_stats(pitches(spark, sf), full=False).withColumn("home_win", home_win())


A5_SQL = f"""SELECT game_date, home_team, away_team,
       {_cnt("inning_topbot = 'Bot'")} AS home_half_pitches,
       {_cnt("inning_topbot = 'Top'")} AS away_half_pitches,
       {_cnt(f"events IN ({_HITS}) AND inning_topbot = 'Bot'")} AS home_hits,
       {_cnt(f"events IN ({_HITS}) AND inning_topbot = 'Top'")} AS away_hits,
       MAX(home_score) AS home_score, MAX(away_score) AS away_score, COUNT(*) AS total_pitches,
       {_cnt("events = 'strikeout' AND inning_topbot = 'Bot'")} AS home_strikeouts,
       {_cnt("events = 'strikeout' AND inning_topbot = 'Top'")} AS away_strikeouts,
       CAST(MAX(home_score) > MAX(away_score) AS INTEGER) AS home_win
FROM pitches GROUP BY game_date, home_team, away_team"""


@register("game_stats_single_pass", ("A5", "P8"), with_pitches(A5_SQL))
def q_game_stats_single_pass(spark, sf):
    return G.game_stats_single_pass(pitches(spark, sf))


@register(
    "home_day_stats", ("A1",),
    with_pitches(f"""SELECT game_date, home_team, {_cnt("inning_topbot = 'Bot'")} AS home_half_pitches,
       (CAST(SUM(release_speed) AS DOUBLE) / NULLIF(COUNT(release_speed), 0)) AS home_avg_pitch_speed, (CAST(SUM(release_spin_rate) AS DOUBLE) / NULLIF(COUNT(release_spin_rate), 0)) AS home_avg_spin_rate
FROM pitches GROUP BY game_date, home_team"""),
)
def q_home_day_stats(spark, sf):
    return G.home_day_stats(pitches(spark, sf))


@register(
    "away_day_stats", ("A2",),
    with_pitches(f"""SELECT game_date, away_team, {_cnt("inning_topbot = 'Top'")} AS away_half_pitches,
       (CAST(SUM(release_speed) AS DOUBLE) / NULLIF(COUNT(release_speed), 0)) AS away_avg_pitch_speed, (CAST(SUM(release_spin_rate) AS DOUBLE) / NULLIF(COUNT(release_spin_rate), 0)) AS away_avg_spin_rate
FROM pitches GROUP BY game_date, away_team"""),
)
def q_away_day_stats(spark, sf):
    return G.away_day_stats(pitches(spark, sf))


def _avg_if(cond: str, c: str) -> str:
    return f"(SUM(CASE WHEN {cond} THEN {c} END) / NULLIF(COUNT(CASE WHEN {cond} THEN {c} END), 0))"


@register(
    "pitching_speed_by_side", ("A1", "A2", "Q4"),
    with_pitches(f"""SELECT game_date, home_team, away_team,
       {_avg_if("inning_topbot = 'Top'", "release_speed")} AS home_pitchers_avg_speed,
       {_avg_if("inning_topbot = 'Bot'", "release_speed")} AS away_pitchers_avg_speed,
       {_avg_if("inning_topbot = 'Top'", "release_spin_rate")} AS home_pitchers_avg_spin,
       {_avg_if("inning_topbot = 'Bot'", "release_spin_rate")} AS away_pitchers_avg_spin
FROM pitches GROUP BY game_date, home_team, away_team"""),
)
def q_pitching_speed_by_side(spark, sf):
    return G.pitching_speed_by_side(pitches(spark, sf))


@register(
    "home_runs_by_side", ("A7",),
    with_pitches(f"""SELECT game_date, home_team, away_team,
       {_cnt("events = 'home_run' AND inning_topbot = 'Bot'")} AS home_team_home_runs,
       {_cnt("events = 'home_run' AND inning_topbot = 'Top'")} AS away_team_home_runs,
       {_cnt("events = 'home_run'")} AS home_runs
FROM pitches GROUP BY game_date, home_team, away_team"""),
)
def q_home_runs_by_side(spark, sf):
    return G.home_runs_by_side(pitches(spark, sf))


_KEYED_COLS = """game_date, home_team, away_team, home_score, away_score, total_pitches, home_strikeouts,
       away_strikeouts, avg_exit_velocity AS avg_exit_velocity,
       avg_launch_angle AS avg_launch_angle, home_runs, home_half_pitches,
       home_day_avg_pitch_speed AS home_day_avg_pitch_speed,
       home_day_avg_spin_rate AS home_day_avg_spin_rate, away_half_pitches,
       away_day_avg_pitch_speed AS away_day_avg_pitch_speed,
       away_day_avg_spin_rate AS away_day_avg_spin_rate"""


@register(
    "team_features_keyed", ("J1k", "W1", "W2", "W3", "A1", "A2", "A3", "P4"),
    with_pitches(f"""SELECT {_KEYED_COLS},
       round(AVG(home_day_avg_pitch_speed) OVER (PARTITION BY home_team), 6) AS home_avg_pitch_speed,
       round(AVG(away_day_avg_pitch_speed) OVER (PARTITION BY away_team), 6) AS away_avg_pitch_speed,
       home_half_pitches / COUNT(game_date) OVER (PARTITION BY home_team) AS home_avg_hits,
       away_half_pitches / COUNT(game_date) OVER (PARTITION BY away_team) AS away_avg_hits,
       CAST(home_score > away_score AS INTEGER) AS home_win
FROM j""", extra_ctes=GAMES_KEYED_CTES),
)
def q_team_features_keyed(spark, sf):
    return round_doubles(G.game_features(pitches(spark, sf), G.GAME_KEY), columns=["home_avg_pitch_speed", "away_avg_pitch_speed"])


@register(
    "team_features_fanout", ("J1", "W1", "W2", "W3", "P2"),
    with_pitches("""SELECT 'home' AS side, game_home_team_stat AS team, COUNT(*) AS fanout_rows,
       CAST(SUM(home_hits_stat) AS BIGINT) AS sum_hits_stat,
       round(AVG(home_avg_pitch_speed), 6) AS team_avg_pitch_speed
FROM f GROUP BY game_home_team_stat
UNION ALL
SELECT 'away', game_away_team_stat, COUNT(*), CAST(SUM(away_hits_stat) AS BIGINT),
       round(AVG(away_avg_pitch_speed), 6)
FROM f GROUP BY game_away_team_stat""", extra_ctes="""g AS (SELECT game_date, home_team AS game_home_team_stat, away_team AS game_away_team_stat
      FROM pitches GROUP BY game_date, home_team, away_team),
h AS (SELECT game_date, home_team AS home_team_stat,
             SUM(CASE WHEN inning_topbot = 'Bot' THEN 1 ELSE 0 END) AS home_hits_stat,
             (CAST(SUM(release_speed) AS DOUBLE) / NULLIF(COUNT(release_speed), 0)) AS home_avg_pitch_speed
      FROM pitches GROUP BY game_date, home_team),
a AS (SELECT game_date, away_team AS away_team_stat,
             SUM(CASE WHEN inning_topbot = 'Top' THEN 1 ELSE 0 END) AS away_hits_stat,
             (CAST(SUM(release_speed) AS DOUBLE) / NULLIF(COUNT(release_speed), 0)) AS away_avg_pitch_speed
      FROM pitches GROUP BY game_date, away_team),
f AS (SELECT g.game_home_team_stat, g.game_away_team_stat, h.home_hits_stat, h.home_avg_pitch_speed,
             a.away_hits_stat, a.away_avg_pitch_speed
      FROM g LEFT JOIN h ON g.game_date = h.game_date LEFT JOIN a ON g.game_date = a.game_date)"""),
)
def q_team_features_fanout(spark, sf):
    return round_doubles(TW.fanout_team_features(pitches(spark, sf)))


_PERF_CTES = GAMES_KEYED_CTES + """,
hp AS (SELECT home_team AS team, (CAST(SUM(home_score) AS DOUBLE) / NULLIF(COUNT(home_score), 0)) AS avg_home_score, (CAST(SUM(home_half_pitches) AS DOUBLE) / NULLIF(COUNT(home_half_pitches), 0)) AS avg_home_hits,
              AVG(home_day_avg_pitch_speed) AS avg_home_pitch_speed, AVG(home_day_avg_spin_rate) AS avg_home_spin_rate
       FROM j GROUP BY home_team),
ap AS (SELECT away_team AS team, (CAST(SUM(away_score) AS DOUBLE) / NULLIF(COUNT(away_score), 0)) AS avg_away_score, (CAST(SUM(away_half_pitches) AS DOUBLE) / NULLIF(COUNT(away_half_pitches), 0)) AS avg_away_hits,
              AVG(away_day_avg_pitch_speed) AS avg_away_pitch_speed, AVG(away_day_avg_spin_rate) AS avg_away_spin_rate
       FROM j GROUP BY away_team),
perf AS (SELECT COALESCE(hp.team, ap.team) AS team, avg_home_score, avg_home_hits, avg_home_pitch_speed,
                avg_home_spin_rate, avg_away_score, avg_away_hits, avg_away_pitch_speed, avg_away_spin_rate
         FROM hp FULL OUTER JOIN ap ON hp.team = ap.team)"""

# Averages of per-day averages depend on summation order: rounded.
_PERF_INEXACT = ("avg_home_pitch_speed", "avg_home_spin_rate", "avg_away_pitch_speed", "avg_away_spin_rate")
_PERF_COLS = ("avg_home_score", "avg_home_hits", "avg_home_pitch_speed", "avg_home_spin_rate",
              "avg_away_score", "avg_away_hits", "avg_away_pitch_speed", "avg_away_spin_rate")


@register(
    "team_averages", ("A6",),
    with_pitches("SELECT team, " + ", ".join(f"round({c}, 6) AS {c}" if c in _PERF_INEXACT else c
                                              for c in _PERF_COLS) + " FROM perf",
                 extra_ctes=_PERF_CTES),
)
def q_team_averages(spark, sf):
    return round_doubles(G.team_performance(G.game_features(pitches(spark, sf), G.GAME_KEY)), columns=_PERF_INEXACT)


@register(
    "game_vs_team_average", ("J2", "A6", "A3"),
    with_pitches("""SELECT g.game_date, g.home_team, g.away_team, g.home_score, g.away_score, g.total_pitches,
       g.home_strikeouts, g.away_strikeouts, g.avg_exit_velocity AS avg_exit_velocity,
       g.avg_launch_angle AS avg_launch_angle, g.home_runs,
       h.avg_home_score AS avg_home_score, h.avg_home_hits AS avg_home_hits,
       round(h.avg_home_pitch_speed, 6) AS avg_home_pitch_speed, round(h.avg_home_spin_rate, 6) AS avg_home_spin_rate,
       a.avg_away_score AS avg_away_score, a.avg_away_hits AS avg_away_hits,
       round(a.avg_away_pitch_speed, 6) AS avg_away_pitch_speed, round(a.avg_away_spin_rate, 6) AS avg_away_spin_rate,
       CAST(g.home_score > g.away_score AS INTEGER) AS home_win
FROM g LEFT JOIN perf h ON g.home_team = h.team LEFT JOIN perf a ON g.away_team = a.team""", extra_ctes=_PERF_CTES),
)
def q_game_vs_team_average(spark, sf):
    p = pitches(spark, sf)
    feats = G.game_features(p, G.GAME_KEY)
    games = feats.select(*[c for c in feats.columns if c in (
        "game_date", "home_team", "away_team", "home_score", "away_score", "total_pitches", "home_strikeouts",
        "away_strikeouts", "avg_exit_velocity", "avg_launch_angle", "home_runs")])
    out = G.game_vs_team_average(games, G.team_performance(feats)).withColumn("home_win", home_win())
    return round_doubles(out, columns=_PERF_INEXACT)


def _team_games(spark, sf):
    return G.team_games(G.game_stats(pitches(spark, sf), full=False))


@register(
    "prior5_averages", ("U2", "W4"),
    with_pitches(f"""SELECT team, opponent, is_home, game_date, COUNT(*) OVER w AS prior_games,
       (CAST(SUM(runs_for) OVER w AS DOUBLE) / NULLIF(COUNT(runs_for) OVER w, 0)) AS prior_avg_runs_for,
       (CAST(SUM(runs_against) OVER w AS DOUBLE) / NULLIF(COUNT(runs_against) OVER w, 0)) AS prior_avg_runs_against
FROM tgr WINDOW w AS ({TEAM_ORDER_SQL} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""", extra_ctes=TEAM_GAMES_CTES),
)
def q_prior5(spark, sf):
    return TW.prior_n_averages(_team_games(spark, sf), 5)


@register(
    "season_to_date", ("U2", "W5"),
    with_pitches("""SELECT team, opponent, is_home, game_date, season, COUNT(*) OVER w AS games_before,
       CAST(COALESCE(SUM(CASE WHEN result = 1 THEN 1 ELSE 0 END) OVER w, 0) AS BIGINT) AS wins_before,
       (CAST(SUM(runs_for) OVER w AS DOUBLE) / NULLIF(COUNT(runs_for) OVER w, 0)) AS std_avg_runs_for,
       (CAST(SUM(runs_against) OVER w AS DOUBLE) / NULLIF(COUNT(runs_against) OVER w, 0)) AS std_avg_runs_against
FROM (SELECT *, CAST(year(CAST(game_date AS DATE)) AS INTEGER) AS season FROM tgr) t
WINDOW w AS (PARTITION BY team, season ORDER BY game_date, is_home, opponent
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""", extra_ctes=TEAM_GAMES_CTES),
)
def q_season_to_date(spark, sf):
    return TW.season_to_date(_team_games(spark, sf))


@register(
    "streaks", ("U2", "W6"),
    with_pitches(f"""SELECT team, opponent, is_home, game_date, result,
       CAST(COALESCE(LAG(pos * r) OVER ({TEAM_ORDER_SQL}), 0) AS INTEGER) AS streak_before
FROM c""", extra_ctes=TEAM_GAMES_CTES + f""",
a AS (SELECT *, COALESCE(result, 0) AS r FROM tgr),
b AS (SELECT *, CASE WHEN LAG(r) OVER ({TEAM_ORDER_SQL}) = r THEN 0 ELSE 1 END AS new_run FROM a),
bi AS (SELECT *, SUM(new_run) OVER ({TEAM_ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
       FROM b),
c AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY team, island ORDER BY game_date, is_home, opponent) AS pos
      FROM bi)"""),
)
def q_streaks(spark, sf):
    return TW.streaks(_team_games(spark, sf))


@register(
    "label_null_rules", ("P8",),
    with_pitches("""SELECT game_date, home_team, away_team, MAX(home_score) AS home_score,
       MAX(away_score) AS away_score,
       CAST(MAX(home_score) > MAX(away_score) AS INTEGER) AS home_win,
       CASE WHEN MAX(home_score) > MAX(away_score) THEN 1 ELSE 0 END AS home_win_zero
FROM pitches GROUP BY game_date, home_team, away_team"""),
)
def q_label_null_rules(spark, sf):
    g = pitches(spark, sf).groupBy(*G.GAME_KEY).agg(
        F.max("home_score").alias("home_score"), F.max("away_score").alias("away_score"))
    return g.withColumn("home_win", home_win(nulls="null")).withColumn("home_win_zero", home_win(nulls="zero"))


_NEST_ORDER = ("pitch_number", "game_pk", "pitcher", "release_spin_rate", "description")


@register(
    "game_nested", ("A11",),
    with_pitches("""SELECT game_date, home_team, away_team, n_pitches,
       fr.pitch_number AS first_pitch_number, fr.game_pk AS first_game_pk, fr.pitcher AS first_pitcher,
       fr.release_spin_rate AS first_release_spin_rate, fr.description AS first_description,
       lr.pitch_number AS last_pitch_number, lr.game_pk AS last_game_pk, lr.pitcher AS last_pitcher,
       lr.release_spin_rate AS last_release_spin_rate, lr.description AS last_description
FROM (SELECT game_date, home_team, away_team, COUNT(*) AS n_pitches, MIN(s) AS fr, MAX(s) AS lr
      FROM (SELECT *, {'pitch_number': pitch_number, 'game_pk': game_pk, 'pitcher': pitcher,
                       'release_spin_rate': release_spin_rate, 'description': description} AS s
            FROM pitches) q
      GROUP BY game_date, home_team, away_team) x"""),
)
def q_game_nested(spark, sf):
    return G.game_nested(pitches(spark, sf), order=_NEST_ORDER)


_PK_CTES = f"""g AS ({GAME_SQL.replace("GROUP BY game_date, home_team, away_team", "GROUP BY game_date, home_team, away_team, game_pk").replace("SELECT game_date,", "SELECT game_pk, game_date,")}),
hd AS ({HOME_DAY_SQL}),
ad AS ({AWAY_DAY_SQL}),
j AS (SELECT g.*, hd.* EXCLUDE (game_date, home_team), ad.* EXCLUDE (game_date, away_team)
      FROM g LEFT JOIN hd USING (game_date, home_team) LEFT JOIN ad USING (game_date, away_team))"""


@register(
    "team_features_by_pk", ("J1k", "W1", "W2", "W3", "A1", "A2", "A3"),
    with_pitches("""SELECT game_date, home_team, away_team, game_pk, home_score, away_score, total_pitches, home_strikeouts, away_strikeouts,
       avg_exit_velocity, avg_launch_angle, home_runs, home_half_pitches, home_day_avg_pitch_speed, home_day_avg_spin_rate,
       away_half_pitches, away_day_avg_pitch_speed, away_day_avg_spin_rate,
       round(AVG(home_day_avg_pitch_speed) OVER (PARTITION BY home_team), 6) AS home_avg_pitch_speed,
       round(AVG(away_day_avg_pitch_speed) OVER (PARTITION BY away_team), 6) AS away_avg_pitch_speed,
       home_half_pitches / COUNT(*) OVER (PARTITION BY home_team) AS home_avg_hits,
       away_half_pitches / COUNT(*) OVER (PARTITION BY away_team) AS away_avg_hits,
       CAST(home_score > away_score AS INTEGER) AS home_win FROM j""", extra_ctes=_PK_CTES),
)
def q_team_features_by_pk(spark, sf):
    """The default key: two games of the same teams on one day stay apart."""
    return round_doubles(G.game_features(pitches(spark, sf)), columns=["home_avg_pitch_speed", "away_avg_pitch_speed"])


def _nested_sql(keys: str, chunk: int) -> str:
    return f"""SELECT {keys}, (i - 1) // {chunk} + 1 AS chunk_no, MIN(i) AS first_pitch, COUNT(*) AS n_pitches,
       string_agg(game_pk || ':' || pitch_number || ':' || pitcher || ':' || coalesce(events, '') || ':' || description, ' ' ORDER BY i) AS pitches
FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY game_pk, pitch_number, pitcher, events NULLS FIRST, description) AS i FROM pitches)
GROUP BY {keys}, (i - 1) // {chunk}"""


def _flat(nested):
    one = lambda p: F.concat_ws(":", p["game_pk"], p["pitch_number"], p["pitcher"], F.coalesce(p["events"], F.lit("")), p["description"])
    return nested.withColumn("pitches", F.array_join(F.transform("pitches", one), " "))


@register("game_pitches_nested", ("A11",), with_pitches(_nested_sql("game_date, home_team, away_team", N.CHUNK)))
def q_game_pitches_nested(spark, sf):
    return _flat(N.game_pitches(pitches(spark, sf)))
