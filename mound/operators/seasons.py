"""Seasons: slicing by date range (S5), tagging with a season calendar
and union of season tables by column name (U1)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mound.schemas import SEASON_SCHEMA
from mound.session import write_through


def season_slice(df: DataFrame, start: str, end: str, date_col: str = "game_date") -> DataFrame:
    """Rows whose date lies in [start, end].  ``game_date`` is compared
    as stored (ISO string or date) so the predicate reaches the Parquet
    scan as a pushed filter and prunes row groups."""
    return df.where(F.col(date_col).between(F.lit(start), F.lit(end)))


def calendar_frame(spark: SparkSession, rows: Sequence[tuple[int, date, date]]) -> DataFrame:
    """A season calendar (one row per season) as a DataFrame."""
    return spark.createDataFrame(list(rows), SEASON_SCHEMA)


def season_tag(df: DataFrame, calendar: DataFrame, date_col: str = "game_date", out: str = "season") -> DataFrame:
    """Tag each row with the season whose [start, end] holds its date;
    null when the date falls outside every season.

    A season has one calendar row per year that it touches, so the range
    join is an equi-join on the year plus a range condition, also for
    seasons that cross a new year, instead of a nested loop over every
    (row, season) pair.  The calendar is written once and broadcast if its
    files are small enough.
    """
    cal = write_through(calendar.select(
        F.col("season").alias("__season"),
        F.explode(F.sequence(F.year("season_start"), F.year("season_end"))).alias("__year"),
        F.col("season_start").alias("__start"),
        F.col("season_end").alias("__end"),
    ).where(F.col("__start") <= F.col("__end")), "season-calendar")
    d = F.to_date(F.col(date_col))
    keyed = df.withColumn("__d", d).withColumn("__y", F.year("__d"))
    cond = (keyed["__y"] == cal["__year"]) & keyed["__d"].between(cal["__start"], cal["__end"])
    return keyed.join(cal, cond, "left").withColumn(out, F.col("__season")).drop(
        "__season", "__year", "__start", "__end", "__d", "__y"
    )


def union_seasons(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing in one season is null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
