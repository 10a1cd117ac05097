"""Declared schemas.  Nothing in the library infers a schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Columns of the pitch log that the operators read.  The full file has
# 85 columns; a scan with this schema reads only these (column pruning).
PITCH_SCHEMA = T.StructType(
    [
        T.StructField("game_date", T.StringType()),
        T.StructField("game_pk", T.LongType()),
        T.StructField("game_year", T.LongType()),
        T.StructField("pitch_number", T.LongType()),
        T.StructField("pitcher", T.LongType()),
        T.StructField("player_name", T.StringType()),
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("inning_topbot", T.StringType()),
        T.StructField("events", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("pitch_type", T.StringType()),
        T.StructField("stand", T.StringType()),
        T.StructField("p_throws", T.StringType()),
        T.StructField("bb_type", T.StringType()),
        T.StructField("release_speed", T.DoubleType()),
        T.StructField("release_spin_rate", T.DoubleType()),
        T.StructField("launch_speed", T.DoubleType()),
        T.StructField("launch_angle", T.DoubleType()),
        T.StructField("launch_speed_angle", T.DoubleType()),
        T.StructField("on_1b", T.DoubleType()),
        T.StructField("on_2b", T.DoubleType()),
        T.StructField("on_3b", T.DoubleType()),
        T.StructField("if_fielding_alignment", T.StringType()),
        T.StructField("of_fielding_alignment", T.StringType()),
        T.StructField("hit_location", T.DoubleType()),
        T.StructField("home_score", T.LongType()),
        T.StructField("away_score", T.LongType()),
    ]
)

# Headerless team list: code, league (A/N), city, nickname.
TEAM_LIST_SCHEMA = T.StructType(
    [
        T.StructField("team_code", T.StringType()),
        T.StructField("league", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("nickname", T.StringType()),
    ]
)

# Headerless roster: one file per team and season.
ROSTER_SCHEMA = T.StructType(
    [
        T.StructField("player_id", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("bats", T.StringType()),
        T.StructField("throws", T.StringType()),
        T.StructField("team", T.StringType()),
        T.StructField("position", T.StringType()),
    ]
)

# Player dictionary with a header line ``code,name``.
PLAYER_MAP_SCHEMA = T.StructType(
    [T.StructField("code", T.StringType()), T.StructField("name", T.StringType())]
)

SEASON_SCHEMA = T.StructType(
    [
        T.StructField("season", T.IntegerType()),
        T.StructField("season_start", T.DateType()),
        T.StructField("season_end", T.DateType()),
    ]
)


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> DataFrame:
    """Fail at plan time when ``df`` lacks any of ``columns``."""
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    if missing:
        raise MissingColumnsError(f"{what} is missing required columns: {missing}")
    return df
