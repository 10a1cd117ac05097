"""Registered queries: event files, rosters and team lists.

There are no event files in the test data, so each query writes the
driver's tables out in the file layout (a round trip), scans them with
the operator and is compared with SQL over the original tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from mound.plans.registry import register
from mound.session import scratch_path
from mound.sources import eventlog as EV
from mound.sources import fixtures as FX


# Every call writes its files from the tables as they are then.
def _written(spark, sf, kind, writer):
    path = scratch_path(spark, kind)
    writer(spark, sf, path)
    return path


def _blocks(spark, sf):
    return EV.read_game_blocks(spark, _written(spark, sf, "events", FX.write_event_files))


def _rosters(spark, sf):
    return EV.read_rosters(spark, _written(spark, sf, "rosters", FX.write_rosters))


_TC = "'N' || lpad(CAST({} AS VARCHAR), 2, '0')"
_GAMES_CTE = f"""eg AS (SELECT o.*, {_TC.format('c.c_nationkey')} AS home,
             {_TC.format('(c.c_nationkey + 1 + o.o_orderkey % 24) % 25')} AS vis,
             CAST(o.o_orderdate AS DATE) AS d
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
egi AS (SELECT *, home || strftime(d, '%Y%m%d') || CAST(o_orderkey AS VARCHAR) AS game_id FROM eg)"""

_ITEMS_CTE = _GAMES_CTE + """,
it AS (SELECT egi.game_id, l.*, s.s_name,
              's' || lpad(CAST(l.l_suppkey AS VARCHAR), 7, '0') AS pid,
              'c' || lpad(CAST(l.l_partkey % 1000 + 1 AS VARCHAR), 7, '0') AS batter,
              CASE WHEN l.l_linestatus = 'O' THEN 0 ELSE 1 END AS side,
              CAST(trunc(l.l_quantity) AS BIGINT) AS qty,
              'play,' || CAST(l.l_linenumber AS VARCHAR) || ',' || CASE WHEN l.l_linestatus = 'O' THEN '0' ELSE '1' END
                || ',c' || lpad(CAST(l.l_partkey % 1000 + 1 AS VARCHAR), 7, '0')
                || ',' || CAST(CAST(trunc(l.l_quantity) AS BIGINT) % 4 AS VARCHAR)
                || CAST(CAST(trunc(l.l_quantity) AS BIGINT) % 3 AS VARCHAR)
                || ',' || CASE WHEN l.l_returnflag = 'A' THEN 'CBX' WHEN l.l_returnflag = 'R' THEN 'SSS' ELSE '' END
                || ',' || CASE WHEN l.l_returnflag = 'A' THEN 'HR/F7' WHEN l.l_returnflag = 'R' THEN 'K' ELSE '63/G' END
                AS play_line
       FROM lineitem l JOIN egi ON l.l_orderkey = egi.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""


@register(
    "event_log_games", ("S11",),
    "WITH " + _GAMES_CTE + """
SELECT game_id, home AS home_code, d AS game_day, CAST(year(d) AS INTEGER) AS season,
       CAST(o_orderkey AS VARCHAR) AS game_number, '2' AS version, vis AS visteam, home AS hometeam,
       home || '01' AS site, strftime(d, '%Y/%m/%d') AS date, CAST(o_orderkey % 3 AS VARCHAR) AS number,
       'regular' AS gametype, CASE WHEN starts_with(o_orderpriority, '1') THEN 'night' ELSE 'day' END AS daynight,
       CAST(CAST(trunc(o_totalprice) AS BIGINT) % 100 AS VARCHAR) AS temp, CAST(o_custkey AS VARCHAR) AS attendance,
       o_orderstatus AS sky, 'u' || CAST(o_custkey AS VARCHAR) AS umphome, """
    + ", ".join(f"CAST(NULL AS VARCHAR) AS {k}" for k in EV.INFO_KEYS if k not in FX.FIXTURE_INFO_KEYS) + """,
       'umphome=u' || CAST(o_custkey AS VARCHAR) || ';umphome=v' || CAST(o_custkey AS VARCHAR) || ';roof=' || o_orderpriority
         AS last_records
FROM egi""",
)
def q_event_log_games(spark, sf):
    # umphome is recorded twice (its column holds the first), roof is a key without a column of its own
    last = F.array_join(F.transform(F.slice("info_records", -3, 3), lambda r: F.concat_ws("=", r["key"], r["value"])), ";")
    return EV.event_games(_blocks(spark, sf)).withColumn("last_records", last).drop("file_name", "info_records")


_TIE = "l_linenumber, play_line"


@register(
    "event_log_plays", ("S11",),
    "WITH " + _ITEMS_CTE + f"""
SELECT game_id, CAST(row_number() OVER (PARTITION BY game_id ORDER BY {_TIE}) AS INTEGER) AS play_index,
       l_linenumber AS inning, side, batter AS batter_id,
       CAST(qty % 4 AS VARCHAR) || CAST(qty % 3 AS VARCHAR) AS count,
       CASE WHEN l_returnflag = 'A' THEN 'CBX' WHEN l_returnflag = 'R' THEN 'SSS' ELSE '' END AS pitch_sequence,
       CASE WHEN l_returnflag = 'A' THEN 'HR/F7' WHEN l_returnflag = 'R' THEN 'K' ELSE '63/G' END AS play
FROM it""",
)
def q_event_log_plays(spark, sf):
    return EV.indexed_plays(_blocks(spark, sf)).drop("seq")


@register(
    "event_log_lineups", ("S11",),
    "WITH " + _ITEMS_CTE + """
SELECT game_id, 'start' AS record, pid AS player_id, s_name AS player_name, side, l_linenumber AS batting_order,
       CAST(l_partkey % 10 AS INTEGER) AS field_position FROM it
UNION ALL
SELECT game_id, 'sub', pid, s_name, side, l_linenumber, 11 FROM it WHERE l_tax > 0.06""",
)
def q_event_log_lineups(spark, sf):
    return EV.event_lineups(EV.event_lines(_blocks(spark, sf), ("start", "sub"), nth=False)).drop("seq")


@register(
    "event_log_comments", ("S11",),
    "WITH " + _ITEMS_CTE + """
SELECT game_id, 'note, line ' || CAST(l_linenumber AS VARCHAR) || ' of ' || CAST(l_orderkey AS VARCHAR) AS text
FROM it WHERE l_linenumber = 1
UNION ALL
SELECT game_id, 'radj:' || batter || ':2' FROM it WHERE l_discount >= 0.1
UNION ALL
SELECT game_id, 'badj:' || batter || ':' || CASE WHEN l_suppkey % 2 = 0 THEN 'L' ELSE 'R' END FROM it WHERE l_discount < 0.02""",
)
def q_event_log_comments(spark, sf):
    # com, radj and badj records in one read: a comment's text, or the fields after the record type
    lines = EV.event_lines(_blocks(spark, sf), ("com", "radj", "badj"), nth=False)
    adjusted = F.concat_ws(":", "record", F.array_join("fields", ":"))
    return lines.select("game_id", F.when(F.col("record") == "com", F.get("fields", 0)).otherwise(adjusted).alias("text"))


@register(
    "earned_runs", ("A12", "S11"),
    "WITH " + _ITEMS_CTE + """
SELECT CAST(substr(game_id, 4, 4) AS INTEGER) AS season, pid AS pitcher_id, COUNT(*) AS games,
       CAST(SUM(qty % 5) AS BIGINT) AS earned_runs
FROM it GROUP BY 1, 2""",
)
def q_earned_runs(spark, sf):
    return EV.earned_runs_by_pitcher(EV.event_earned_runs(EV.event_lines(_blocks(spark, sf), ("data",), nth=False)))


_ROSTER_CTE = f"""rb AS (SELECT 'c' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS player_id, c_name AS last_name,
              c_mktsegment AS first_name, ['L', 'R', 'B'][c_custkey % 3 + 1] AS bats,
              CASE WHEN c_custkey % 2 = 0 THEN 'R' ELSE 'L' END AS throws, c_nationkey, c_custkey,
              ['P', 'C', '1B', '2B', '3B', 'SS', 'LF', 'CF', 'RF'][c_custkey % 9 + 1] AS position,
              CAST(s.season AS INTEGER) AS season
       FROM customer CROSS JOIN (SELECT unnest(range({FX.FIXTURE_ROSTER_SEASONS[0]}, {FX.FIXTURE_ROSTER_SEASONS[-1] + 1})) AS season) s),
ra AS (SELECT * FROM rb UNION ALL
       SELECT player_id, last_name, first_name, bats, throws, (c_nationkey + 1) % 25, c_custkey, position, season
       FROM rb WHERE c_custkey % 50 = 0),
ro AS (SELECT player_id, last_name, first_name, bats, throws, {_TC.format('c_nationkey')} AS team, position,
              {_TC.format('c_nationkey')} AS file_team, season FROM ra)"""


@register(
    "roster_scan", ("S10",),
    "WITH " + _ROSTER_CTE + " SELECT * FROM ro",
)
def q_roster_scan(spark, sf):
    return _rosters(spark, sf)


@register(
    "roster_join", ("J6", "P15", "S10", "S11"),
    "WITH " + _ITEMS_CTE + ",\n" + _ROSTER_CTE + f""",
rp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player_id, season ORDER BY file_team DESC) AS rk
                      FROM ro) WHERE rk = 1)
SELECT it.game_id, CAST(row_number() OVER (PARTITION BY it.game_id ORDER BY {_TIE}) AS INTEGER) AS play_index,
       it.batter AS batter_id, CAST(substr(it.game_id, 4, 4) AS INTEGER) AS season,
       rp.last_name AS batter_last_name, rp.team AS batter_team, rp.bats AS batter_bats
FROM it LEFT JOIN rp ON it.batter = rp.player_id AND CAST(substr(it.game_id, 4, 4) AS INTEGER) = rp.season""",
)
def q_roster_join(spark, sf):
    plays = EV.indexed_plays(_blocks(spark, sf))
    players = EV.roster_players(_rosters(spark, sf))
    j = EV.plays_with_batters(plays, players)
    return j.select("game_id", "play_index", "batter_id", "season", "batter_last_name", "batter_team", "batter_bats")


@register(
    "team_list_scan", ("S9",),
    f"""SELECT {_TC.format('n_nationkey')} AS team_code, CASE WHEN n_regionkey % 2 = 0 THEN 'A' ELSE 'N' END AS league,
       upper(substr(lower(n_name), 1, 1)) || substr(lower(n_name), 2) AS city, r_name AS nickname
FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def q_team_list_scan(spark, sf):
    path = scratch_path(spark, "teams")
    FX.write_team_list(spark, sf, path)
    return EV.read_team_list(spark, path)


@register(
    "event_plays_by_inning", ("A12", "S11"),
    "WITH " + _ITEMS_CTE + """
SELECT game_id, l_linenumber AS inning, side, COUNT(*) AS plays,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS strikeouts,
       CAST(SUM(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS home_runs
FROM it GROUP BY game_id, l_linenumber, side""",
)
def q_event_plays_by_inning(spark, sf):
    return EV.plays_by_inning(EV.event_plays(EV.event_lines(_blocks(spark, sf), ("play",), nth=False)))


@register(
    "event_plays_by_batter", ("A12", "S11"),
    "WITH " + _ITEMS_CTE + """
SELECT CAST(substr(game_id, 4, 4) AS INTEGER) AS season, batter AS batter_id, COUNT(*) AS plate_appearances,
       COUNT(DISTINCT game_id) AS games
FROM it GROUP BY 1, 2""",
)
def q_event_plays_by_batter(spark, sf):
    return EV.plays_by_batter(EV.event_plays(EV.event_lines(_blocks(spark, sf), ("play",), nth=False)))


_BAD_CTE = _ITEMS_CTE + """,
bad AS (SELECT game_id, l_linenumber * 10 + 1001 AS n, 'play' AS record, 'play,x3,' || CAST(side AS VARCHAR) || ',' || batter || ',00,,K' AS line,
               'field 1 is not a whole number' AS reason FROM it WHERE l_linenumber = 3
        UNION ALL
        SELECT game_id, l_linenumber * 10 + 1002, 'start', 'start,' || pid || ',' || CAST(side AS VARCHAR), 'too few fields' FROM it WHERE l_linenumber = 5
        UNION ALL
        SELECT game_id, l_linenumber * 10 + 1003, 'zzz', 'zzz,' || pid, 'unknown record' FROM it WHERE l_linenumber = 6)"""


@register(
    "event_log_rejects", ("S11",),
    # 14 header lines follow the id line; the malformed ones come next, in their order
    "WITH " + _BAD_CTE + """
SELECT game_id, CAST(14 + row_number() OVER (PARTITION BY game_id ORDER BY n, line) AS INTEGER) AS seq, record, line, reason FROM bad""",
)
def q_event_log_rejects(spark, sf):
    path = _written(spark, sf, "events", lambda *a: FX.write_event_files(*a, malformed=True))
    return EV.split_lines(EV.read_game_blocks(spark, path))[1].drop("file_name")


@register(
    "event_log_accepted", ("S11",),
    "WITH " + _ITEMS_CTE + """,
every AS (SELECT game_id, 'play' AS record, l_linenumber AS inning FROM it
          UNION ALL SELECT game_id, 'start', NULL FROM it
          UNION ALL SELECT game_id, 'sub', NULL FROM it WHERE l_tax > 0.06
          UNION ALL SELECT game_id, 'com', NULL FROM it WHERE l_linenumber = 1
          UNION ALL SELECT game_id, 'radj', NULL FROM it WHERE l_discount >= 0.1
          UNION ALL SELECT game_id, 'badj', NULL FROM it WHERE l_discount < 0.02
          UNION ALL SELECT game_id, 'data', NULL FROM it
          UNION ALL SELECT game_id, 'version', NULL FROM egi
          UNION ALL SELECT game_id, 'info', NULL FROM egi, range(13))
SELECT game_id, record, COUNT(*) AS n_lines, CAST(SUM(inning) AS BIGINT) AS innings FROM every GROUP BY game_id, record""",
)
def q_event_log_accepted(spark, sf):
    """The other output of the same scan: what is left of files with malformed lines."""
    path = _written(spark, sf, "events", lambda *a: FX.write_event_files(*a, malformed=True))
    lines = EV.split_lines(EV.read_game_blocks(spark, path))[0]
    inning = F.when(F.col("record") == "play", F.get("fields", 0).cast("int"))
    return lines.groupBy("game_id", "record").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(inning).alias("innings"))
