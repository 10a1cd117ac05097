"""Registered queries: seasons, sources and sinks, subsets, profiling, park fences."""

from __future__ import annotations

import math
import uuid
from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from mound.dictionaries import PARK_FENCES
from mound.functions import versions as V
from mound.functions.clean import round_doubles
from mound.operators import games as G
from mound.operators import parks as PK
from mound.operators import profile as PR
from mound.operators import seasons as S
from mound.operators import subsets as L
from mound.plans.queries_core import A5_SQL as _A5_SQL
from mound.plans.queries_core import GAME_SQL, GAMES_KEYED_CTES, _cnt
from mound.plans.registry import register
from mound.session import scratch_path, write_through
from mound.sources import pitchlog as PL
from mound.sources import reconcile as RC
from mound.sources import sinks as SK
from mound.sources.fixtures import parts_of, pitches, varied, varied_sql, with_pitches

# Season calendar of the fixture (order dates span 1995-2001): one season
# per year from March 20 to October 5, so winter dates fall outside.
FIXTURE_SEASONS = [(y, date(y, 3, 20), date(y, 10, 5)) for y in range(1995, 2002)]
_SEASONS_SQL = "(VALUES " + ", ".join(
    f"({y}, DATE '{a.isoformat()}', DATE '{b.isoformat()}')" for y, a, b in FIXTURE_SEASONS
) + ") AS cal(season, season_start, season_end)"

SLICE_START, SLICE_END = "1997-03-20", "1997-10-05"


@register(
    "season_slice", ("S5", "A5"),
    with_pitches(f"""SELECT game_date, home_team, away_team, COUNT(*) AS total_pitches,
       MAX(home_score) AS home_score, MAX(away_score) AS away_score
FROM pitches WHERE game_date BETWEEN '{SLICE_START}' AND '{SLICE_END}'
GROUP BY game_date, home_team, away_team"""),
)
def q_season_slice(spark, sf):
    p = S.season_slice(pitches(spark, sf), SLICE_START, SLICE_END)
    return p.groupBy(*G.GAME_KEY).agg(
        F.count(F.lit(1)).alias("total_pitches"),
        F.max("home_score").alias("home_score"), F.max("away_score").alias("away_score"))


@register(
    "season_tag", ("J4",),
    with_pitches(f"""SELECT cal.season, COUNT(*) AS pitches, COUNT(DISTINCT p.game_pk) AS game_ids,
       MIN(p.game_date) AS first_date, MAX(p.game_date) AS last_date
FROM pitches p LEFT JOIN {_SEASONS_SQL}
  ON CAST(p.game_date AS DATE) BETWEEN cal.season_start AND cal.season_end
GROUP BY cal.season"""),
)
def q_season_tag(spark, sf):
    cal = S.calendar_frame(spark, FIXTURE_SEASONS)
    tagged = S.season_tag(pitches(spark, sf), cal)
    return tagged.groupBy("season").agg(
        F.count(F.lit(1)).alias("pitches"), F.countDistinct("game_pk").alias("game_ids"),
        F.min("game_date").alias("first_date"), F.max("game_date").alias("last_date"))


@register(
    "season_union", ("U1", "S2"),
    with_pitches("""SELECT game_pk, pitch_number, pitcher, game_date, release_speed,
       CASE WHEN game_date >= '1998-01-01' THEN launch_angle END AS launch_angle,
       CASE WHEN game_date < '1998-01-01' THEN 'early' ELSE 'late' END AS era
FROM pitches"""),
)
def q_season_union(spark, sf):
    p = write_through(pitches(spark, sf).select("game_pk", "pitch_number", "pitcher", "game_date", "release_speed", "launch_angle"), "union-source")
    # The early era's files predate the launch_angle column.
    base = scratch_path(spark, "eras")
    SK.write_parquet(p.where(F.col("game_date") < "1998-01-01").drop("launch_angle"), f"{base}/early")
    SK.write_parquet(p.where(F.col("game_date") >= "1998-01-01"), f"{base}/late")
    return S.union_seasons([spark.read.parquet(f"{base}/{era}").withColumn("era", F.lit(era)) for era in ("early", "late")])


@register(
    "season_files_union", ("S2", "U1"),
    with_pitches("""SELECT game_pk, pitch_number, pitcher, game_date,
       CAST(CASE WHEN game_date < '1997-01-01' THEN trunc(release_speed) ELSE release_speed END AS DOUBLE) AS release_speed,
       home_score, CASE WHEN game_date >= '1997-01-01' THEN launch_angle END AS launch_angle,
       CASE WHEN game_date < '1999-01-01' THEN pitch_type END AS pitch_type
FROM pitches"""),
)
def q_season_files_union(spark, sf):
    """Season files of three schemas: speeds as int, long and double, columns that come and go."""
    columns = ("game_pk", "pitch_number", "pitcher", "game_date", "release_speed", "home_score", "launch_angle", "pitch_type")
    p = write_through(pitches(spark, sf).select(*columns).withColumn("season", F.substring("game_date", 1, 4).cast("int")), "season-source")
    base = scratch_path(spark, "season-files")
    eras = {
        1995: lambda d: d.drop("launch_angle").withColumns({"release_speed": F.col("release_speed").cast("int"), "home_score": F.col("home_score").cast("int")}),
        1997: lambda d: d,
        1999: lambda d: d.drop("pitch_type").withColumn("pitch_number", F.col("pitch_number").cast("smallint")),
    }
    paths = []
    for first, shape in eras.items():
        for season in (first, first + 1) if first < 1999 else (1999, 2000, 2001):
            paths.append(f"{base}/{season}")
            SK.write_parquet(shape(p.where(F.col("season") == season).drop("season")), paths[-1])
    out = RC.read_seasons(spark, paths)
    return out.select(*columns)


@register(
    "season_replace", ("S7",),
    with_pitches(f"""SELECT game_date, home_team, away_team, CAST(substr(game_date, 1, 4) AS INTEGER) AS season,
       CASE WHEN substr(game_date, 1, 4) = '1997' THEN total_pitches + 100 ELSE total_pitches END AS total_pitches,
       CASE WHEN substr(game_date, 1, 4) = '1997' THEN 2 ELSE 0 END AS load_no
FROM ({GAME_SQL}) g WHERE substr(game_date, 1, 4) <> '1997' OR total_pitches <> 2"""),
)
def q_season_replace(spark, sf):
    """One season loaded anew: games of two pitches are gone, the others come in two versions; the load is done twice."""
    key = ("game_date", "home_team", "away_team")
    games = G.game_stats(pitches(spark, sf), full=False).select(
        *key, F.substring("game_date", 1, 4).cast("int").alias("season"), "total_pitches", F.lit(0).alias("load_no"))
    path = scratch_path(spark, "season-replace")
    SK.write_parquet(games, path, partition_by=["season"])
    stored = spark.read.schema(games.schema).parquet(path)
    fresh = stored.where((F.col("season") == 1997) & (F.col("total_pitches") != 2))
    fresh = write_through(fresh.withColumn("load_no", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "total_pitches", F.col("total_pitches") + F.col("load_no") * 50), "season-load")
    for _ in range(2):
        SK.replace_seasons(fresh, path, key, ("load_no",))
    return spark.read.schema(games.schema).parquet(path)


_VERSIONED = ("pitcher", "away_team", "pitch_type", "game_date")


@register(
    "dictionary_versions", ("P15", "P19"),
    with_pitches("\nUNION ALL\n".join(f"""SELECT '{c}' AS "column", value, CAST(CASE WHEN old THEN rank ELSE rank + (SELECT COUNT(DISTINCT {c}) FROM pitches WHERE game_date < '1998-01-01') END AS INTEGER) AS code,
       CASE WHEN old THEN 1 ELSE 2 END AS version
FROM (SELECT *, row_number() OVER (PARTITION BY old ORDER BY value) - 1 AS rank
      FROM (SELECT CAST({c} AS VARCHAR) AS value, bool_or(game_date < '1998-01-01') AS old FROM pitches WHERE {c} IS NOT NULL GROUP BY 1))""" for c in _VERSIONED)),
)
def q_dictionary_versions(spark, sf):
    """Old codes stay as they are after a second load, which comes twice."""
    p = write_through(pitches(spark, sf).select(*dict.fromkeys((*_VERSIONED, "game_date"))), "versioned-source")
    path = scratch_path(spark, "dictionary")
    V.append_version(p.where(F.col("game_date") < "1998-01-01"), _VERSIONED, path, 1)
    V.append_version(p, _VERSIONED, path, 2)
    return V.append_version(p, _VERSIONED, path, 2)


@register(
    "bucketed_day_features", ("S7", "A3", "J1k"),
    with_pitches("""SELECT game_date, home_team, away_team, home_score, away_score, total_pitches, home_strikeouts, away_strikeouts,
       avg_exit_velocity, avg_launch_angle, home_runs, home_half_pitches, home_day_avg_pitch_speed, home_day_avg_spin_rate,
       away_half_pitches, away_day_avg_pitch_speed, away_day_avg_spin_rate FROM j""", extra_ctes=GAMES_KEYED_CTES),
)
def q_bucketed_day_features(spark, sf):
    """A3 and J1k over a pitch log stored in buckets by day: no shuffle in the plan."""
    name = f"pitch_log_{uuid.uuid4().hex}"
    log = SK.write_bucketed(pitches(spark, sf), name, scratch_path(spark, "bucketed"), ["game_date"], ["game_date", "home_team", "away_team"],
                            buckets=max(8, parts_of(spark, sf, "lineitem")))
    return G.with_day_stats(G.game_partials(log))


_GAME_ORDER = ("game_date", "home_team", "away_team")


@register(
    "preview", ("L1",),
    with_pitches(f"""SELECT * FROM (SELECT game_date, home_team, away_team, home_score, away_score, total_pitches
      FROM ({GAME_SQL}) g) x ORDER BY game_date, home_team, away_team LIMIT 5"""),
)
def q_preview(spark, sf):
    g = G.game_stats(pitches(spark, sf), full=False).select(
        *_GAME_ORDER, "home_score", "away_score", "total_pitches")
    return L.preview(g, _GAME_ORDER, 5)


@register(
    "size_subset", ("L2",),
    with_pitches("""SELECT game_pk, pitch_number, pitcher, game_date, home_team, away_team, events,
       release_speed, release_spin_rate
FROM pitches ORDER BY game_date, game_pk, pitch_number, pitcher, release_spin_rate, release_speed LIMIT 10000"""),
)
def q_size_subset(spark, sf):
    p = pitches(spark, sf).select("game_pk", "pitch_number", "pitcher", "game_date", "home_team", "away_team",
                                  "events", "release_speed", "release_spin_rate")
    return L.size_subset(p, ("game_date", "game_pk", "pitch_number", "pitcher", "release_spin_rate",
                             "release_speed"), 10000)


_SUBSET_COLS = ("game_pk", "pitch_number", "pitcher", "game_date", "release_spin_rate", "release_speed")


def _register_subset(n: int) -> None:
    @register(f"size_subset_{n // 1000}k", ("L2",), with_pitches(f"""SELECT {', '.join(_SUBSET_COLS)}
FROM pitches ORDER BY game_date, game_pk, pitch_number, pitcher, release_spin_rate, release_speed LIMIT {n}"""))
    def q_size_subset_n(spark, sf):
        p = pitches(spark, sf).select(*_SUBSET_COLS)
        return L.size_subset(p, ("game_date", "game_pk", "pitch_number", "pitcher", "release_spin_rate", "release_speed"), n)


_register_subset(50_000)
_register_subset(100_000)


@register(
    "game_stats_by_pk", ("A3", "A4"),
    with_pitches(f"""SELECT game_date, home_team, away_team, game_pk, MAX(home_score) AS home_score, MAX(away_score) AS away_score,
       COUNT(*) AS total_pitches, {_cnt("events = 'strikeout' AND inning_topbot = 'Bot'")} AS home_strikeouts,
       {_cnt("events = 'strikeout' AND inning_topbot = 'Top'")} AS away_strikeouts
FROM pitches GROUP BY game_date, home_team, away_team, game_pk"""),
)
def q_game_stats_by_pk(spark, sf):
    """Two games of the same teams on one day stay apart by their game id."""
    return G.game_stats(pitches(spark, sf), keys=(*G.GAME_KEY, "game_pk"), full=False)


A5_SCHEMA = T.StructType([
    T.StructField("game_date", T.StringType()), T.StructField("home_team", T.StringType()),
    T.StructField("away_team", T.StringType()), T.StructField("home_half_pitches", T.LongType()),
    T.StructField("away_half_pitches", T.LongType()), T.StructField("home_hits", T.LongType()),
    T.StructField("away_hits", T.LongType()), T.StructField("home_score", T.LongType()),
    T.StructField("away_score", T.LongType()), T.StructField("total_pitches", T.LongType()),
    T.StructField("home_strikeouts", T.LongType()), T.StructField("away_strikeouts", T.LongType()),
    T.StructField("home_win", T.IntegerType()),
])


@register(
    "parquet_round_trip", ("S1", "S2", "S7"),
    with_pitches(f"SELECT *, CAST(substr(game_date, 1, 4) AS INTEGER) AS season FROM ({_A5_SQL}) g"),
)
def q_parquet_round_trip(spark, sf):
    games = G.game_stats_single_pass(pitches(spark, sf)).withColumn(
        "season", F.substring("game_date", 1, 4).cast("int"))
    path = scratch_path(spark, "games-parquet")
    SK.write_parquet(games, path, partition_by=["season"], mode="overwrite")
    schema = T.StructType(A5_SCHEMA.fields + [T.StructField("season", T.IntegerType())])
    return PL.read_pitch_log(spark, path, schema=schema)


@register(
    "season_slice_stored", ("S5", "S1", "S7"),
    with_pitches(f"SELECT * FROM (SELECT *, CAST(substr(game_date, 1, 4) AS INTEGER) AS season FROM ({_A5_SQL}) g) x "
                 f"WHERE season = 1997 AND game_date BETWEEN '{SLICE_START}' AND '{SLICE_END}'"),
)
def q_season_slice_stored(spark, sf):
    """S5 on a stored table: the season folder is pruned (PartitionFilters)
    and the date range reaches the Parquet reader (PushedFilters)."""
    games = G.game_stats_single_pass(pitches(spark, sf)).withColumn(
        "season", F.substring("game_date", 1, 4).cast("int"))
    path = scratch_path(spark, "games-by-season")
    SK.write_parquet(games, path, partition_by=["season"], mode="overwrite")
    schema = T.StructType(A5_SCHEMA.fields + [T.StructField("season", T.IntegerType())])
    stored = PL.read_pitch_log(spark, path, schema=schema)
    return S.season_slice(stored.where(F.col("season") == 1997), SLICE_START, SLICE_END)


@register(
    "csv_round_trip", ("S3", "S6"),
    with_pitches(f"""SELECT game_date, home_team, away_team, home_score, away_score, total_pitches,
       home_strikeouts, away_strikeouts, avg_exit_velocity AS avg_exit_velocity,
       avg_launch_angle AS avg_launch_angle, home_runs FROM ({GAME_SQL}) g"""),
)
def q_csv_round_trip(spark, sf):
    games = G.game_stats(pitches(spark, sf))
    path = scratch_path(spark, "games-csv")
    SK.write_csv(games, path, mode="overwrite")
    schema = T.StructType([
        T.StructField("game_date", T.StringType()), T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()), T.StructField("home_score", T.LongType()),
        T.StructField("away_score", T.LongType()), T.StructField("total_pitches", T.LongType()),
        T.StructField("home_strikeouts", T.LongType()), T.StructField("away_strikeouts", T.LongType()),
        T.StructField("avg_exit_velocity", T.DoubleType()), T.StructField("avg_launch_angle", T.DoubleType()),
        T.StructField("home_runs", T.LongType()),
    ])
    return PL.read_csv(spark, path, schema)


@register(
    "write_if_absent", ("S8",),
    with_pitches(_A5_SQL),
)
def q_write_if_absent(spark, sf):
    p = pitches(spark, sf)
    first = G.game_stats_single_pass(p)
    path = scratch_path(spark, "games-keep")
    SK.write_if_absent(first, path + "/t")
    # A second, different table written to the same path is ignored.
    second = first.withColumn("total_pitches", F.col("total_pitches") + 1)
    SK.write_if_absent(second, path + "/t")
    return PL.read_pitch_log(spark, path + "/t", schema=A5_SCHEMA)


@register(
    "sql_view_game_stats", ("S4", "A3"),
    with_pitches("""SELECT inning_topbot AS half, type AS call, COUNT(*) AS n_pitches, COUNT(DISTINCT pitcher) AS n_pitchers,
       CAST(MAX(release_speed) AS DOUBLE) AS fastest, COUNT(launch_speed) AS n_measured
FROM pitches GROUP BY inning_topbot, type"""),
)
def q_sql_view_game_stats(spark, sf):
    """A statement over the registered view -- calls by half inning."""
    PL.register_view(pitches(spark, sf), "pitch_log")
    return spark.sql("""
        SELECT inning_topbot AS half, type AS call, COUNT(*) AS n_pitches, COUNT(DISTINCT pitcher) AS n_pitchers,
               CAST(MAX(release_speed) AS DOUBLE) AS fastest, COUNT(launch_speed) AS n_measured
        FROM pitch_log GROUP BY inning_topbot, type""")


_PITCHER_SQL = f"""COUNT(*) AS pitches,
       {_cnt("events = 'strikeout'")} AS strikeouts, {_cnt("type = 'S'")} AS strikes,
       {_cnt("type = 'B'")} AS balls, {_cnt("type = 'X'")} AS in_play,
       {_cnt("events = 'hit_by_pitch'")} AS hit_by_pitch,
       {_cnt("description IN ('wild_pitch', 'passed_ball') OR events = 'field_error'")} AS wild_pitches_errors,
       {_cnt("events = 'walk'")} AS walks, {_cnt("events IS NOT NULL")} AS plate_appearances,
       (CAST(SUM(release_spin_rate) AS DOUBLE) / NULLIF(COUNT(release_spin_rate), 0)) AS avg_spin_rate, (CAST(SUM(release_speed) AS DOUBLE) / NULLIF(COUNT(release_speed), 0)) AS avg_velocity,
       SUM(CASE WHEN type = 'B' THEN 1 ELSE 0 END)
         / NULLIF(SUM(CASE WHEN events IS NOT NULL THEN 1 ELSE 0 END), 0) AS balls_per_pa"""


@register("pitcher_stats", ("A8",), with_pitches(f"SELECT pitcher, pitch_type, {_PITCHER_SQL} FROM pitches GROUP BY pitcher, pitch_type"))
def q_pitcher_stats(spark, sf):
    return PR.pitcher_stats(pitches(spark, sf))


@register(
    "pitcher_stats_by_hand", ("A8",),
    with_pitches(f"""SELECT pitcher, pitch_type, p_throws, {_PITCHER_SQL}, round(AVG(sqrt(ax * ax + ay * ay + az * az)), 6) AS avg_acceleration
FROM varied GROUP BY pitcher, pitch_type, p_throws""", extra_ctes=f"varied AS ({varied_sql()})"),
)
def q_pitcher_stats_by_hand(spark, sf):
    """Every event code and description, the pitcher's hand and the acceleration."""
    return round_doubles(PR.pitcher_stats(varied(pitches(spark, sf)), ("pitcher", "pitch_type", "p_throws")), columns=["avg_acceleration"])


_CORR_COLS = ("release_speed", "release_spin_rate", "launch_speed", "launch_angle", "home_score", "away_score")


def _corr_sql() -> str:
    from itertools import combinations

    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM pitches"
             for a, b in combinations(_CORR_COLS, 2)]
    return "\nUNION ALL\n".join(parts)


@register("correlations", ("A9",), with_pitches(_corr_sql()))
def q_correlations(spark, sf):
    return round_doubles(PR.correlations(pitches(spark, sf), _CORR_COLS))


#: As many numeric columns as the full pitch log has, derived from the fixture's; about one value in seven is absent.
_WIDE_COLS = {f"v{k}": f"CASE WHEN (pitch_number + {k}) % 7 <> 0 THEN CAST((CAST(release_spin_rate AS BIGINT) * {k + 1} + game_pk * {2 * k + 1} + pitcher) % {50 + k} AS DOUBLE) END"
              for k in range(79)} | {c: c for c in _CORR_COLS}


def _corr_wide_sql() -> str:
    from itertools import combinations

    rows = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': round(corr({a}, {b}), 6)}}" for a, b in combinations(_WIDE_COLS, 2))
    return (f"SELECT p.a AS col_a, p.b AS col_b, p.r AS r FROM (SELECT unnest([{rows}]) AS p FROM (SELECT "
            + ", ".join(f"{e} AS {c}" for c, e in _WIDE_COLS.items()) + " FROM pitches))")


@register("correlations_wide", ("A9",), with_pitches(_corr_wide_sql()))
def q_correlations_wide(spark, sf):
    wide = pitches(spark, sf).select(*[F.expr(e).alias(c) for c, e in _WIDE_COLS.items()])
    return round_doubles(PR.correlations(wide, list(_WIDE_COLS)))


_DISTINCT_COLS = ("game_date", "home_team", "away_team", "events", "description", "type", "pitch_type", "pitcher")


@register(
    "distinct_counts", ("A10",),
    with_pitches("\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS n_distinct FROM pitches" for c in _DISTINCT_COLS)),
)
def q_distinct_counts(spark, sf):
    return PR.distinct_counts(pitches(spark, sf), _DISTINCT_COLS)


_SKETCHED = ("game_pk", "pitcher", "game_date", "release_spin_rate")
_SKETCH_RANGES = ((1995, 1996), (1996, 1998), (1995, 2001))


@register(
    "distinct_sketches", ("A10",),
    with_pitches("\nUNION ALL\n".join(
        f"SELECT {a} AS first_season, {b} AS last_season, '{c}' AS column_name, COUNT(DISTINCT {c}) AS n_distinct, TRUE AS within_bound FROM pitches "
        f"WHERE CAST(substr(game_date, 1, 4) AS INTEGER) BETWEEN {a} AND {b}" for a, b in _SKETCH_RANGES for c in _SKETCHED)),
)
def q_distinct_sketches(spark, sf):
    """Sketches stored per season and merged for ranges of seasons, against exact counts; the bound is six standard errors."""
    p = pitches(spark, sf).select(*_SKETCHED, F.substring("game_date", 1, 4).cast("int").alias("season"))
    p = write_through(p, "sketched-pitches")
    path = scratch_path(spark, "distinct-sketches")
    SK.write_parquet(PR.distinct_sketches(p, _SKETCHED, "season"), path)
    stored = spark.read.parquet(path)
    out = None
    for a, b in _SKETCH_RANGES:
        exact = PR.distinct_counts(p.where(F.col("season").between(a, b)), _SKETCHED)
        both = exact.join(PR.estimate_distinct(stored, "season", a, b), "column_name", "left")
        near = F.abs(F.coalesce("n_estimate", F.lit(0)) - F.col("n_distinct")) <= 0.05 * F.col("n_distinct")
        both = both.select(F.lit(a).alias("first_season"), F.lit(b).alias("last_season"), "column_name", "n_distinct", near.alias("within_bound"))
        out = both if out is None else out.unionByName(both)
    return out


_RANDOM_COLS = ("game_pk", "pitch_number", "pitcher", "game_date", "events")
_RANDOM_TEXT = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in _RANDOM_COLS)


@register(
    "random_subset", ("L2",),
    with_pitches(f"SELECT {', '.join(_RANDOM_COLS)} FROM pitches ORDER BY md5('7|' || {_RANDOM_TEXT}) LIMIT 10000"),
)
def q_random_subset(spark, sf):
    return L.random_subset(pitches(spark, sf).select(*_RANDOM_COLS), 10_000, seed=7)


_FENCE_SQL = "(VALUES " + ", ".join(
    f"('{p}', {n}, '{s.replace(chr(39), chr(39) * 2)}', CAST({lo!r} AS DOUBLE), CAST({hi!r} AS DOUBLE), "
    f"CAST({d!r} AS DOUBLE))"
    for p, n, s, lo, hi, d in PK.fence_rows(PARK_FENCES)
) + ") AS f(park, segment_no, segment, angle_lo, angle_hi, fence_ft)"


@register(
    "park_fences", ("J5",),
    with_pitches(f"""SELECT b.game_pk, b.pitch_number, b.pitcher, b.park, b.spray_angle, b.distance_ft,
       f.segment_no, f.segment, f.fence_ft, b.distance_ft > f.fence_ft AS over_fence
FROM (SELECT game_pk, pitch_number, pitcher, 'PHI' AS park,
             CAST(CAST(release_spin_rate AS BIGINT) % 91 - 45 AS DOUBLE) AS spray_angle,
             launch_speed * 3.5 + launch_angle AS distance_ft
      FROM pitches WHERE launch_speed IS NOT NULL) b
LEFT JOIN {_FENCE_SQL}
  ON b.park = f.park AND b.spray_angle >= f.angle_lo AND (b.spray_angle < f.angle_hi OR b.spray_angle = 45 AND f.angle_hi = 45)"""),
)
def q_park_fences(spark, sf):
    # The fixture has one described park; every batted ball is placed in it.
    # Spray angle and carry distance are derived from fixture columns.
    batted = pitches(spark, sf).where(F.col("launch_speed").isNotNull()).select(
        "game_pk", "pitch_number", "pitcher", F.lit("PHI").alias("park"),
        (F.col("release_spin_rate").cast("bigint") % 91 - 45.0).alias("spray_angle"),
        (F.col("launch_speed") * 3.5 + F.col("launch_angle")).alias("distance_ft"),
    )
    out = PK.fence_check(batted, PK.fence_frame(spark, PARK_FENCES))
    return out.select("game_pk", "pitch_number", "pitcher", "park", "spray_angle", "distance_ft",
                      "segment_no", "segment", "fence_ft", "over_fence")


@register(
    "streaming_game_stats", ("S7", "U1", "A3"),
    with_pitches(f"""SELECT game_date, home_team, away_team, home_score, away_score, total_pitches,
       home_strikeouts, away_strikeouts, avg_exit_velocity AS avg_exit_velocity,
       avg_launch_angle AS avg_launch_angle, home_runs FROM ({GAME_SQL}) g"""),
)
def q_streaming_game_stats(spark, sf):
    from mound.streaming import incremental as ST

    # Land the pitch log as files split by pitch number, so that every game's
    # pitches arrive over several files and micro-batches.
    base = scratch_path(spark, "stream")
    source = f"{base}/source"
    # A number's rows make one file while they are few, and more as they grow;
    # a batch takes the files of two numbers.
    p = pitches(spark, sf)
    SK.write_parquet(p, source + "_parts", partition_by=["pitch_number"], mode="overwrite")
    landed = spark.read.parquet(source + "_parts")
    files = landed.inputFiles()
    each = math.ceil(len(files) / max(1, len({f.rsplit("/", 1)[0] for f in files})))
    q = ST.start_game_ingest(spark, source + "_parts", f"{base}/partials", f"{base}/checkpoint",
                             landed.schema, max_files_per_trigger=2 * max(1, each))
    q.awaitTermination()
    return ST.game_stats_from_partials(spark, f"{base}/partials")


@register(
    "pitch_log_scan", ("S1", "S2", "S7", "A3"),
    with_pitches(f"""SELECT game_date, home_team, away_team, home_score, away_score, total_pitches,
       home_strikeouts, away_strikeouts, avg_exit_velocity, avg_launch_angle, home_runs FROM ({GAME_SQL}) g"""),
)
def q_pitch_log_scan(spark, sf):
    """The production read path: a season-partitioned pitch log read with
    the declared 29-column schema over a glob; columns absent from the
    files read as null and are never touched by the aggregate."""
    from mound.schemas import PITCH_SCHEMA

    p = pitches(spark, sf)
    typed = p.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PITCH_SCHEMA.fields if f.name in p.columns])
    path = scratch_path(spark, "pitch-log")
    SK.write_parquet(typed.withColumn("season", F.substring("game_date", 1, 4).cast("int")), path,
                     partition_by=["season"], mode="overwrite")
    log = PL.read_pitch_log(spark, f"{path}/season=*")
    return G.game_stats(log)
