"""Point-in-time features: what was known of a team and a pitcher before a game (W4, W5 into M2).

The pitch log is scanned once, to one row per game, half inning and
pitcher; games, starting pitchers and the day tables of teams and pitchers
all follow from that table.  Running totals are those of a team's (or
pitcher's) days, and an as-of join takes the last ones before a game's day;
so no feature sees the game itself, nor another of that day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mound.functions.clean import home_win
from mound.operators.games import GAME_KEY, team_games
from mound.session import write_through

#: Totals of a team's and of a starting pitcher's earlier games, and what the features divide.
_TEAM = ("games", "wins", "scored_games", "runs_for", "runs_against")
_PITCHER = ("pitches", "strikeouts", "measured", "speed")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, values: Sequence[str]) -> DataFrame:
    """Backward as-of join: each row of ``left`` with the ``values`` of the
    last row of ``right`` for its ``key`` strictly before its ``at``.

    ``right`` has one row per key and ``at``, or equal ones.  The distinct (key, at) of
    ``left`` and the rows of ``right`` are one tagged union, in which the last
    value is carried over; where both have the same ``at``, ``left`` comes
    first.  With days as ``at``, a key's part of that union is bounded by the
    calendar, however many rows ``left`` holds; these join its result on (key,
    at).  A null key or time finds nothing.
    """
    carried = F.struct(*[F.col(v) for v in values])
    asked = left.select(key, at).where(F.col(key).isNotNull() & F.col(at).isNotNull()).distinct()
    known = right.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(key, at, F.lit(1).alias("__tag"), carried.alias("__value"))
    none = F.lit(None).cast(known.schema["__value"].dataType)
    both = asked.select(key, at, F.lit(0).alias("__tag"), none.alias("__value")).unionByName(known)
    so_far = Window.partitionBy(key).orderBy(at, "__tag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("__value", F.last("__value", ignorenulls=True).over(so_far)).where("__tag = 0")
    return left.join(found.select(key, at, "__value"), [key, at], "left").select(*left.columns, *[F.col(f"__value.{v}").alias(v) for v in values])


def running_totals(days: DataFrame, key: str, at: str, values: Sequence[str]) -> DataFrame:
    """A table's sums up to and with each row's day, the same for all rows of a day."""
    so_far = Window.partitionBy(key).orderBy(at).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return days.select(key, at, *[F.sum(v).over(so_far).alias(v) for v in values])


def _ratio(total: str, count: str) -> Column:
    return F.when(F.col(count) > 0, F.col(total) / F.col(count))


def prior_game_features(pitches: DataFrame, keys: Sequence[str] = GAME_KEY, order: Sequence[str] = ("pitch_number", "pitcher")) -> DataFrame:
    """One row per game: its key, label and starting pitchers, and for each
    side the team's earlier games, wins and average runs for and against, and
    the starting pitcher's earlier pitches, strikeouts and average speed.

    "Earlier" is before the game's day.  Counts without history are 0 and
    averages null; games without a score count for neither wins nor runs.
    The starting pitcher of a side threw the first pitch, in ``order``, of the
    half in which that side is in the field (null without such a pitch).
    """
    keys = list(keys)
    parts = write_through(pitches.groupBy(*keys, "inning_topbot", "pitcher").agg(
        F.max("home_score").alias("home_score"), F.max("away_score").alias("away_score"), F.count(F.lit(1)).alias("pitches"),
        F.sum(F.when(F.col("events") == "strikeout", 1).otherwise(0)).alias("strikeouts"),
        F.count("release_speed").alias("measured"), F.coalesce(F.sum("release_speed"), F.lit(0.0)).alias("speed"),
        F.min(F.struct(*order)).alias("first")), "pitcher-games")
    starter = lambda half: F.min(F.when(F.col("inning_topbot") == half, F.struct("first", "pitcher")))["pitcher"]
    games = write_through(parts.groupBy(*keys).agg(
        F.max("home_score").alias("home_score"), F.max("away_score").alias("away_score"),
        starter("Top").alias("home_starter"), starter("Bot").alias("away_starter")), "prior-games")

    tg = team_games(games)
    scored = F.col("runs_for").isNotNull() & F.col("runs_against").isNotNull()
    team_days = tg.groupBy("team", "game_date").agg(
        F.count(F.lit(1)).alias("games"), F.sum((F.coalesce("result", F.lit(0)) == 1).cast("long")).alias("wins"),
        F.sum(scored.cast("long")).alias("scored_games"), F.sum(F.when(scored, F.col("runs_for")).otherwise(0)).alias("runs_for"),
        F.sum(F.when(scored, F.col("runs_against")).otherwise(0)).alias("runs_against"))
    teams = write_through(running_totals(team_days, "team", "game_date", _TEAM), "team-days")
    # One shuffle and one sort for the totals: a pitcher has a row for each half of a game, hardly more than days, and
    # nothing is asked of rows without a pitcher.  Pitches without a day count to the totals of all days.
    thrown = parts.where(F.col("pitcher").isNotNull())
    pitchers = running_totals(thrown, "pitcher", "game_date", _PITCHER)
    # both sides' starting pitchers are asked for at once: one pass over the days of all pitchers
    asked = games.select(F.explode(F.array("home_starter", "away_starter")).alias("pitcher"), "game_date").distinct()
    started = write_through(as_of(asked, pitchers, "pitcher", "game_date", _PITCHER), "starter-days")

    out = games
    for side in ("home", "away"):
        renamed = teams.withColumnsRenamed({"team": f"{side}_team"} | {v: f"{side}_t_{v}" for v in _TEAM})
        out = as_of(out, renamed, f"{side}_team", "game_date", [f"{side}_t_{v}" for v in _TEAM])
        renamed = started.withColumnsRenamed({"pitcher": f"{side}_starter"} | {v: f"{side}_p_{v}" for v in _PITCHER})
        out = out.join(renamed, [f"{side}_starter", "game_date"], "left")
    features: list[Column] = []
    for side in ("home", "away"):
        t, p = f"{side}_t_", f"{side}_p_"
        features += [
            F.coalesce(f"{t}games", F.lit(0)).cast("long").alias(f"{side}_games_before"), F.coalesce(f"{t}wins", F.lit(0)).cast("long").alias(f"{side}_wins_before"),
            _ratio(f"{t}runs_for", f"{t}scored_games").alias(f"{side}_avg_runs_for"), _ratio(f"{t}runs_against", f"{t}scored_games").alias(f"{side}_avg_runs_against"),
            F.coalesce(f"{p}pitches", F.lit(0)).cast("long").alias(f"{side}_starter_pitches"),
            F.coalesce(f"{p}strikeouts", F.lit(0)).cast("long").alias(f"{side}_starter_strikeouts"),
            _ratio(f"{p}speed", f"{p}measured").alias(f"{side}_starter_avg_speed")]
    return out.select(*keys, "home_starter", "away_starter", *features, home_win().alias("home_win"))


#: The features that the model of earlier games is fitted on.
PRIOR_FEATURES = tuple(f"{side}_{f}" for side in ("home", "away") for f in (
    "games_before", "wins_before", "avg_runs_for", "avg_runs_against", "starter_pitches", "starter_strikeouts", "starter_avg_speed"))
