"""Game-level aggregation (A1-A7, A11), team-game stacking (U2) and the
team-feature joins (J1k, J2).

Scale notes
-----------
* Every aggregate here is algebraic (count / sum / max / avg), so Spark
  runs a partial aggregate before the shuffle: a hot game or team costs
  one row per map task, never a whole group in one task.
* ``game_features`` scans the pitch log once.  It aggregates to the finest
  key (date, home, away) keeping sums and counts, and derives the
  per-day and per-team statistics from that small table instead of
  re-scanning pitches for each GROUP BY.
* Per-team statistics are computed with ``groupBy`` + join, not with an
  unordered window over ``team``: a window puts all rows of a team in one
  task, the aggregate does not.  The join side has one row per team and is
  broadcast after a size check (``joins.join_small``), so the game table is
  never shuffled by team.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mound.dictionaries import HIT_EVENTS
from mound.functions.clean import home_win
from mound.operators.joins import join_small
from mound.session import write_through

GAME_KEY = ("game_date", "home_team", "away_team")



def _bot() -> Column:
    return F.col("inning_topbot") == "Bot"


def _top() -> Column:
    return F.col("inning_topbot") == "Top"


def _count_if(cond: Column) -> Column:
    # SUM(CASE WHEN .. THEN 1 ELSE 0 END): 0 (not null) for an empty match.
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def game_stats(pitches: DataFrame, keys: Sequence[str] = GAME_KEY, full: bool = True) -> DataFrame:
    """A3 (``full``) / A4: one row per game key."""
    aggs = [
        F.max("home_score").alias("home_score"),
        F.max("away_score").alias("away_score"),
        F.count(F.lit(1)).alias("total_pitches"),
        _count_if((F.col("events") == "strikeout") & _bot()).alias("home_strikeouts"),
        _count_if((F.col("events") == "strikeout") & _top()).alias("away_strikeouts"),
    ]
    if full:
        aggs += [
            F.avg("launch_speed").alias("avg_exit_velocity"),
            F.avg("launch_angle").alias("avg_launch_angle"),
            _count_if(F.col("events") == "home_run").alias("home_runs"),
        ]
    return pitches.groupBy(*keys).agg(*aggs)


def game_stats_single_pass(pitches: DataFrame, keys: Sequence[str] = GAME_KEY) -> DataFrame:
    """A5: both halves in one GROUP BY, plus the label.

    ``home_half_pitches`` is what the original called ``home_hits``: the
    number of pitches thrown in the bottom half (home team batting).
    ``home_hits`` / ``away_hits`` are true hits (single, double, triple,
    home run) of the home / away batters.
    """
    hit = F.col("events").isin(*HIT_EVENTS)
    return pitches.groupBy(*keys).agg(
        _count_if(_bot()).alias("home_half_pitches"),
        _count_if(_top()).alias("away_half_pitches"),
        _count_if(hit & _bot()).alias("home_hits"),
        _count_if(hit & _top()).alias("away_hits"),
        F.max("home_score").alias("home_score"),
        F.max("away_score").alias("away_score"),
        F.count(F.lit(1)).alias("total_pitches"),
        _count_if((F.col("events") == "strikeout") & _bot()).alias("home_strikeouts"),
        _count_if((F.col("events") == "strikeout") & _top()).alias("away_strikeouts"),
    ).withColumn("home_win", home_win())


def home_day_stats(pitches: DataFrame) -> DataFrame:
    """A1: per (date, home team)."""
    return pitches.groupBy("game_date", "home_team").agg(
        _count_if(_bot()).alias("home_half_pitches"),
        F.avg("release_speed").alias("home_avg_pitch_speed"),
        F.avg("release_spin_rate").alias("home_avg_spin_rate"),
    )


def away_day_stats(pitches: DataFrame) -> DataFrame:
    """A2: per (date, away team)."""
    return pitches.groupBy("game_date", "away_team").agg(
        _count_if(_top()).alias("away_half_pitches"),
        F.avg("release_speed").alias("away_avg_pitch_speed"),
        F.avg("release_spin_rate").alias("away_avg_spin_rate"),
    )


def pitching_speed_by_side(pitches: DataFrame, keys: Sequence[str] = GAME_KEY) -> DataFrame:
    """Q4 variant of A1/A2: speed and spin of each team's own pitchers.
    The home team pitches in the top half, the away team in the bottom."""
    def avg_if(cond: Column, c: str) -> Column:
        return F.avg(F.when(cond, F.col(c)))

    return pitches.groupBy(*keys).agg(
        avg_if(_top(), "release_speed").alias("home_pitchers_avg_speed"),
        avg_if(_bot(), "release_speed").alias("away_pitchers_avg_speed"),
        avg_if(_top(), "release_spin_rate").alias("home_pitchers_avg_spin"),
        avg_if(_bot(), "release_spin_rate").alias("away_pitchers_avg_spin"),
    )


def home_runs_by_side(pitches: DataFrame, keys: Sequence[str] = GAME_KEY) -> DataFrame:
    """Home runs hit by the home side (bottom half), the away side and in total."""
    hr = F.col("events") == "home_run"
    return pitches.groupBy(*keys).agg(
        _count_if(hr & _bot()).alias("home_team_home_runs"),
        _count_if(hr & _top()).alias("away_team_home_runs"),
        _count_if(hr).alias("home_runs"),
    )


def game_partials(pitches: DataFrame, keys: Sequence[str] = GAME_KEY) -> DataFrame:
    """One pass over pitches to the finest key, keeping sums and counts so
    that coarser statistics can be rolled up exactly."""
    so = F.col("events") == "strikeout"
    return pitches.groupBy(*keys).agg(
        F.max("home_score").alias("home_score"),
        F.max("away_score").alias("away_score"),
        F.count(F.lit(1)).alias("total_pitches"),
        _count_if(so & _bot()).alias("home_strikeouts"),
        _count_if(so & _top()).alias("away_strikeouts"),
        F.avg("launch_speed").alias("avg_exit_velocity"),
        F.avg("launch_angle").alias("avg_launch_angle"),
        _count_if(F.col("events") == "home_run").alias("home_runs"),
        _count_if(_bot()).alias("bot_pitches"),
        _count_if(_top()).alias("top_pitches"),
        F.sum("release_speed").alias("sum_speed"),
        F.count("release_speed").alias("n_speed"),
        F.sum("release_spin_rate").alias("sum_spin"),
        F.count("release_spin_rate").alias("n_spin"),
    )


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den)


def _with_day_stats(parts: DataFrame, team: str, half_col: str, prefix: str) -> DataFrame:
    """A1 / A2 attached to each game row: sums over the games of the same
    (date, team).  A window partition is one team-day -- at most one game
    per opponent -- so it is small whatever the data volume, and the
    statistics cost one shuffle instead of an aggregate plus a join."""
    w = Window.partitionBy("game_date", team)
    return parts.withColumns({
        f"{prefix}_half_pitches": F.sum(half_col).over(w),
        f"{prefix}_day_avg_pitch_speed": _ratio(F.sum("sum_speed").over(w), F.sum("n_speed").over(w)),
        f"{prefix}_day_avg_spin_rate": _ratio(F.sum("sum_spin").over(w), F.sum("n_spin").over(w)),
    })


def with_day_stats(parts: DataFrame) -> DataFrame:
    """J1k on ``game_partials``: each game with its home and away team's day statistics (A1, A2)."""
    return _with_day_stats(_with_day_stats(parts, "home_team", "bot_pitches", "home"),
                           "away_team", "top_pitches", "away").drop(
        "bot_pitches", "top_pitches", "sum_speed", "n_speed", "sum_spin", "n_spin")


def default_keys(pitches: DataFrame) -> tuple[str, ...]:
    """Date, home and away team, and the game's id where the log has one: two games of a day stay apart."""
    return GAME_KEY + (("game_pk",) if "game_pk" in pitches.columns else ())


def game_features(pitches: DataFrame, keys: Sequence[str] | None = None, materialize: bool = True) -> DataFrame:
    """J1k + W2 + W3 with correct keys (``default_keys`` if not given); one
    scan of the pitch log.

    Output, one row per game: the A3 columns, the home/away half-inning
    pitch counts of the team's day (``home_half_pitches``), their ratio
    to the team's number of games (``home_avg_hits``, W2), the team's
    average day pitch speed (``home_avg_pitch_speed``, W3), the day
    averages themselves and the label.

    The pitch log is scanned once: the job that writes the game-level
    partials is the only one touching it; every later step reads that
    (roughly pitches-per-game times smaller) table.
    """
    return features_from_partials(game_partials(pitches, default_keys(pitches) if keys is None else keys), materialize)


def features_from_partials(parts: DataFrame, materialize: bool = True) -> DataFrame:
    """``game_features`` from a table of ``game_partials``, all of it or some seasons."""
    if materialize:
        # The game-level table feeds several branches below; write it once
        # so the pitch log is scanned and shuffled once (session.write_through).
        parts = write_through(parts, "game-partials")
    games = with_day_stats(parts)
    if materialize:
        # Feeds the game rows and both per-team aggregates below.
        games = write_through(games, "game-day-stats")
    home_team = games.groupBy("home_team").agg(
        F.count(F.lit(1)).alias("_home_games"),
        F.avg("home_day_avg_pitch_speed").alias("home_avg_pitch_speed"),
    )
    away_team = games.groupBy("away_team").agg(
        F.count(F.lit(1)).alias("_away_games"),
        F.avg("away_day_avg_pitch_speed").alias("away_avg_pitch_speed"),
    )
    # One row per team: broadcast after a size check, so the game table is
    # never hash-partitioned by team (a few keys, possibly very uneven).
    return (
        join_small(join_small(games, home_team, "home_team"), away_team, "away_team")
        .withColumn("home_avg_hits", F.col("home_half_pitches") / F.col("_home_games"))
        .withColumn("away_avg_hits", F.col("away_half_pitches") / F.col("_away_games"))
        .withColumn("home_win", home_win())
        .drop("_home_games", "_away_games")
    )


def team_games(games: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Stack each game as two team rows (home and away view).

    Columns: team, opponent, is_home, game_date, runs_for, runs_against,
    result (1 win, -1 loss, 0 tie, null if a score is null) + ``extra``.
    The two views come from one pass over ``games`` (``inline`` of a
    two-element array), not from a union that would compute ``games``
    twice.
    """
    def side(team: str, opp: str, rf: str, ra: str, is_home: int) -> Column:
        return F.struct(
            F.col(team).alias("team"),
            F.col(opp).alias("opponent"),
            F.lit(is_home).alias("is_home"),
            F.col("game_date").alias("game_date"),
            F.col(rf).alias("runs_for"),
            F.col(ra).alias("runs_against"),
            *[F.col(c).alias(c) for c in extra],
        )

    both = games.select(F.inline(F.array(
        side("home_team", "away_team", "home_score", "away_score", 1),
        side("away_team", "home_team", "away_score", "home_score", 0),
    )))
    return both.withColumn("result", F.signum(F.col("runs_for") - F.col("runs_against")).cast("int"))


def team_performance(games: DataFrame) -> DataFrame:
    """Per-team averages as the home side and as the away side.

    ``games`` needs the A3 scores and the per-day A1/A2 statistics
    (``home_half_pitches``, ``home_day_avg_pitch_speed``, ...), i.e. the
    output of ``game_features``.  Two-level: games first, then teams.
    """
    home = games.groupBy(F.col("home_team").alias("team")).agg(
        F.avg("home_score").alias("avg_home_score"),
        F.avg("home_half_pitches").alias("avg_home_hits"),
        F.avg("home_day_avg_pitch_speed").alias("avg_home_pitch_speed"),
        F.avg("home_day_avg_spin_rate").alias("avg_home_spin_rate"),
    )
    away = games.groupBy(F.col("away_team").alias("team")).agg(
        F.avg("away_score").alias("avg_away_score"),
        F.avg("away_half_pitches").alias("avg_away_hits"),
        F.avg("away_day_avg_pitch_speed").alias("avg_away_pitch_speed"),
        F.avg("away_day_avg_spin_rate").alias("avg_away_spin_rate"),
    )
    return home.join(away, "team", "full")


def game_vs_team_average(games: DataFrame, perf: DataFrame) -> DataFrame:
    """Each game with the season averages of its home and its away team.

    ``perf`` (one row per team) is written once; Spark broadcasts both of its
    sides by the size of its files."""
    perf = write_through(perf, "team-performance")
    home = perf.select(
        F.col("team").alias("home_team"),
        *[F.col(c) for c in ("avg_home_score", "avg_home_hits", "avg_home_pitch_speed", "avg_home_spin_rate")],
    )
    away = perf.select(
        F.col("team").alias("away_team"),
        *[F.col(c) for c in ("avg_away_score", "avg_away_hits", "avg_away_pitch_speed", "avg_away_spin_rate")],
    )
    # Named sub-plans, as the original aliases its game table.
    g = games.alias("game_stats")
    return g.join(home.alias("home_perf"), "home_team", "left").join(away.alias("away_perf"), "away_team", "left")


def game_nested(pitches: DataFrame, keys: Sequence[str] = GAME_KEY,
                order: Sequence[str] = ("pitch_number", "pitcher", "events", "description")) -> DataFrame:
    """Group pitches by game.

    Per game: the number of pitches and the first / last pitch in
    ``order``.  Computed as ``min``/``max`` of a struct, which aggregates
    partially like any other algebraic aggregate, so a game holding a
    large share of the rows never has to be materialised as one array.
    """
    s = F.struct(*[F.col(c) for c in order])
    return pitches.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_pitches"),
        F.min(s).alias("_first"),
        F.max(s).alias("_last"),
    ).select(
        *keys,
        "n_pitches",
        *[F.col(f"_first.{c}").alias(f"first_{c}") for c in order],
        *[F.col(f"_last.{c}").alias(f"last_{c}") for c in order],
    )
