"""Registered queries: cleaning, calendar features and dictionary encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from mound import dictionaries as D
from mound.functions import clean as C
from mound.functions import encode as E
from mound.operators import games as G
from mound.plans.registry import register
from mound.session import scratch_path
from mound.sources.fixtures import pitches, table, varied, varied_sql, with_pitches
from mound.sources.pitchlog import read_player_map
from mound.sources.sinks import write_csv

# Team dictionary of the fixture: NATION_0..NATION_21 -> 1..22; the last
# three nations are left out to exercise unknown codes.
FIXTURE_TEAMS = {f"NATION_{i}": i + 1 for i in range(22)}


def _sql_case(col: str, mapping: dict, default: str = "NULL") -> str:
    if not mapping:
        return default
    whens = " ".join(f"WHEN '{k.replace(chr(39), chr(39) * 2)}' THEN {v}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {default} END"


def _games(spark, sf):
    return pitches(spark, sf).select(*G.GAME_KEY).distinct()


_GAMES_SQL = "SELECT DISTINCT game_date, home_team, away_team FROM pitches"


@register(
    "calendar_features", ("P5", "P6", "P7", "P17"),
    with_pitches(f"""SELECT game_date, home_team, away_team, CAST(game_date AS DATE) AS game_day,
       CAST(CAST(game_date AS DATE) AS VARCHAR) AS game_day_str,
       CAST(dayofweek(CAST(game_date AS DATE)) + 1 AS INTEGER) AS day_of_week,
       CAST(strftime(CAST(game_date AS DATE), '%Y%m%d') AS INTEGER) AS date_key
FROM ({_GAMES_SQL}) g"""),
)
def q_calendar(spark, sf):
    g = _games(spark, sf).withColumn("game_day", C.string_to_date("game_date"))
    return g.select(
        *G.GAME_KEY, "game_day",
        C.date_to_string("game_day").alias("game_day_str"),
        C.day_of_week("game_day").alias("day_of_week"),
        C.date_key("game_day").alias("date_key"),
    )


def _team_sql(col: str, missing: str) -> str:
    return _sql_case(col, FIXTURE_TEAMS, missing)


@register(
    "encode_teams", ("P10", "J3"),
    with_pitches(f"""SELECT game_date, home_team, away_team,
       CAST({_team_sql('home_team', '0')} AS INTEGER) AS home_team_code,
       CAST({_team_sql('away_team', '0')} AS INTEGER) AS away_team_code,
       CAST({_team_sql('home_team', 'NULL')} AS INTEGER) AS home_team_code_or_null,
       CAST(j.value AS BIGINT) AS away_team_code_joined
FROM ({_GAMES_SQL}) g
LEFT JOIN (SELECT 'NATION_' || CAST(n_nationkey AS VARCHAR) AS code, n_nationkey + 1 AS value
           FROM nation WHERE n_nationkey < 22) j ON g.away_team = j.code"""),
)
def q_encode_teams(spark, sf):
    g = _games(spark, sf)
    out = g.select(
        *G.GAME_KEY,
        E.lookup("home_team", FIXTURE_TEAMS, "zero").cast("int").alias("home_team_code"),
        E.lookup("away_team", FIXTURE_TEAMS, "zero").cast("int").alias("away_team_code"),
        E.lookup("home_team", FIXTURE_TEAMS, "null").cast("int").alias("home_team_code_or_null"),
    )
    # The same dictionary as a dimension table derived from ``nation``.
    dim = table(spark, sf, "nation").where(F.col("n_nationkey") < 22).select(
        F.concat(F.lit("NATION_"), F.col("n_nationkey").cast("string")).alias("code"),
        (F.col("n_nationkey") + 1).cast("bigint").alias("value"),
    )
    return E.encode_with_frame(out, "away_team", dim, "null", suffix="_code_joined")


@register(
    "matchup", ("P9",),
    with_pitches(f"""SELECT game_date, home_team, away_team,
       CAST({_team_sql('away_team', '0')} AS VARCHAR) || ':' || CAST({_team_sql('home_team', '0')} AS VARCHAR)
         AS matchup
FROM ({_GAMES_SQL}) g"""),
)
def q_matchup(spark, sf):
    return _games(spark, sf).withColumn("matchup", E.matchup(mapping=FIXTURE_TEAMS))


@register(
    "encode_events", ("P11",),
    with_pitches(f"""SELECT game_pk, pitch_number, pitcher, events, inning_topbot, type,
       if_fielding_alignment, of_fielding_alignment,
       {_sql_case('events', D.EVENTS_INDEX)} AS events_code,
       {_sql_case('inning_topbot', D.TOPBOT_INDEX)} AS inning_topbot_code,
       {_sql_case('type', D.TYPE_INDEX)} AS type_code,
       {_sql_case('if_fielding_alignment', D.IF_ALIGNMENT_INDEX)} AS if_fielding_alignment_code,
       {_sql_case('of_fielding_alignment', D.OF_ALIGNMENT_INDEX)} AS of_fielding_alignment_code
FROM pitches""", wide=True),
)
def q_encode_events(spark, sf):
    p = pitches(spark, sf, wide=True).select(
        "game_pk", "pitch_number", "pitcher", "events", "inning_topbot", "type",
        "if_fielding_alignment", "of_fielding_alignment")
    p = E.encode(p, "events", D.EVENTS_INDEX, suffix="_code")
    p = E.encode(p, "inning_topbot", D.TOPBOT_INDEX, suffix="_code")
    p = E.encode(p, "type", D.TYPE_INDEX, suffix="_code")
    p = E.encode(p, "if_fielding_alignment", D.IF_ALIGNMENT_INDEX, suffix="_code")
    return E.encode(p, "of_fielding_alignment", D.OF_ALIGNMENT_INDEX, suffix="_code")


@register(
    "fill_defaults", ("P12", "P11"),
    with_pitches(f"""SELECT game_pk, pitch_number, pitcher,
       COALESCE(on_1b, 0) AS on_1b, COALESCE(on_2b, 0) AS on_2b, COALESCE(on_3b, 0) AS on_3b,
       COALESCE({_sql_case('if_fielding_alignment', D.IF_ALIGNMENT_INDEX)}, 0) AS if_fielding_alignment,
       COALESCE({_sql_case('of_fielding_alignment', D.OF_ALIGNMENT_INDEX)}, 0) AS of_fielding_alignment,
       COALESCE(launch_speed_angle, 0) AS launch_speed_angle
FROM pitches""", wide=True),
)
def q_fill_defaults(spark, sf):
    p = pitches(spark, sf, wide=True).select(
        "game_pk", "pitch_number", "pitcher", "on_1b", "on_2b", "on_3b",
        "if_fielding_alignment", "of_fielding_alignment", "launch_speed_angle")
    p = E.encode(p, "if_fielding_alignment", D.IF_ALIGNMENT_INDEX)
    p = E.encode(p, "of_fielding_alignment", D.OF_ALIGNMENT_INDEX)
    return C.fill_defaults(p, D.NULL_DEFAULTS)


#: One mapping at three sizes: the number's square plus its size, for numbers from 1.
_SQUARES = {n: {i: i * i + n for i in range(1, n + 1)} for n in (10, 40, 2000)}


@register(
    "encode_numeric_dictionary", ("P10", "P11"),
    with_pitches("SELECT game_pk, pitch_number, pitcher, launch_speed_angle, " + ", ".join(
        f"CAST(CASE WHEN {c} BETWEEN 1 AND {n} AND {c} = trunc({c}) THEN {c} * {c} + {n} END AS INTEGER) AS {c}_{n}"
        for n in _SQUARES for c in ("pitcher", "release_speed", "release_spin_rate"))
        + """, CAST(CASE WHEN launch_speed_angle BETWEEN 0 AND 6 THEN launch_speed_angle END AS INTEGER) AS launch_speed_angle_code,
       CAST(CASE WHEN pitch_type IS NULL THEN 0 ELSE 0 END AS INTEGER) AS pitch_type_code FROM pitches""", wide=True),
)
def q_encode_numeric_dictionary(spark, sf):
    """Whole-number keys on integer and double columns at three sizes; the published keys ``'1.'`` on a double column; an empty dictionary."""
    p = pitches(spark, sf, wide=True)
    out = p.select("game_pk", "pitch_number", "pitcher", "launch_speed_angle", "pitch_type", "release_speed", "release_spin_rate")
    out = out.withColumns({f"{c}_{n}": E.lookup(c, m) for n, m in _SQUARES.items() for c in ("pitcher", "release_speed", "release_spin_rate")})
    out = E.encode(out, "launch_speed_angle", D.LAUNCH_SPEED_ANGLE_INDEX, suffix="_code")
    out = E.encode(out, "pitch_type", D.PITCH_TYPE_INDEX, "zero", suffix="_code")
    return out.drop("pitch_type", "release_speed", "release_spin_rate")


_PR_LIST = ", ".join(f"'{e}'" for e in D.IN_PLAY_OUTCOMES)


@register(
    "pitch_result", ("P13",),
    with_pitches(f"""SELECT game_pk, pitch_number, pitcher, events, description,
       CASE WHEN events IS NULL OR description IS NULL THEN COALESCE(events, description)
            WHEN description = 'hit_into_play' AND events IN ({_PR_LIST}) THEN events
            ELSE description END AS pitch_result
FROM pitches"""),
)
def q_pitch_result(spark, sf):
    return pitches(spark, sf).select(
        "game_pk", "pitch_number", "pitcher", "events", "description", C.pitch_result().alias("pitch_result"))


@register(
    "pitch_result_varied", ("P13", "P11", "P18"),
    with_pitches(f"""SELECT game_pk, pitch_number, pitcher, release_spin_rate, events, description, type, stand, p_throws,
       CASE WHEN events IS NULL OR description IS NULL THEN COALESCE(events, description)
            WHEN description = 'hit_into_play' AND events IN ({_PR_LIST}) THEN events
            ELSE description END AS pitch_result, {_sql_case('events', D.EVENTS_INDEX)} AS events_code,
       COALESCE(events, CASE type WHEN 'B' THEN 'ball' WHEN 'S' THEN 'strike' WHEN 'X' THEN 'in_play' END) AS outcome
FROM varied""", extra_ctes=f"varied AS ({varied_sql()})"),
)
def q_pitch_result_varied(spark, sf):
    """All 21 event codes against all descriptions, so each of the nine outcomes that win occurs."""
    p = varied(pitches(spark, sf)).select("game_pk", "pitch_number", "pitcher", "release_spin_rate", "events", "description", "type", "stand", "p_throws")
    p = p.withColumn("pitch_result", C.pitch_result())
    return E.encode(p, "events", D.EVENTS_INDEX, suffix="_code").withColumn("outcome", C.fill_outcome())


@register(
    "fill_outcome", ("P18",),
    with_pitches("""SELECT game_pk, pitch_number, pitcher, events, type,
       COALESCE(events, CASE type WHEN 'B' THEN 'ball' WHEN 'S' THEN 'strike' WHEN 'X' THEN 'in_play' END)
         AS events_filled
FROM pitches"""),
)
def q_fill_outcome(spark, sf):
    return pitches(spark, sf).select(
        "game_pk", "pitch_number", "pitcher", "events", "type", C.fill_outcome().alias("events_filled"))


# Comma lists of team codes and pitch types; the code -> name
# dictionary comes from nation x region, with every code listed twice so
# that "last duplicate wins" (by an explicit order column) is exercised.
def _player_map(spark, sf):
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    base = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("code"), F.col("r_name"), F.col("n_nationkey"))
    first = base.select("code", F.concat(F.lit("old-"), F.col("r_name")).alias("name"), F.lit(0).alias("seq"))
    last = base.select("code", F.concat(F.lower("r_name"), F.lit("-"), F.col("n_nationkey").cast("string")).alias("name"),
                       F.lit(1).alias("seq"))
    return first.unionByName(last)


@register(
    "translate_codes", ("P14", "P15", "J3"),
    with_pitches("""SELECT game_pk, pitch_number, pitcher, code_list,
       CASE WHEN code_list IS NULL THEN NULL ELSE array_to_string(
         list_transform(string_split(code_list, ','), lambda x: COALESCE(m[x], x)), ', ') END AS names
FROM (SELECT game_pk, pitch_number, pitcher, concat_ws(',', home_team, pitch_type, away_team) AS code_list
      FROM pitches) p,
     (SELECT map(list(n_name), list(lower(r_name) || '-' || CAST(n_nationkey AS VARCHAR))) AS m
      FROM nation JOIN region ON n_regionkey = r_regionkey) d"""),
)
def q_translate_codes(spark, sf):
    p = pitches(spark, sf).select(
        "game_pk", "pitch_number", "pitcher",
        F.concat_ws(",", "home_team", "pitch_type", "away_team").alias("code_list"))
    dictionary = E.load_dictionary(_player_map(spark, sf), order="seq")
    return E.translate_list(p, "code_list", dictionary, "names")


@register(
    "player_map_load", ("P15", "P16", "S3"),
    """SELECT n_name AS code, lower(r_name) || '-' || CAST(n_nationkey AS VARCHAR) AS name
FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def q_player_map_load(spark, sf):
    """Every code stands in the file twice, the outdated name first."""
    path = scratch_path(spark, "player-map")
    lines = _player_map(spark, sf).orderBy("seq", "code").coalesce(1)  # 25 nations, twice
    write_csv(lines.select("seq", "name", "code"), path)
    return read_player_map(spark, path)


_ENCODE_ALL = ("game_date", "home_team", "away_team", "inning_topbot", "events", "description", "type", "pitch_type")


@register(
    "encode_all", ("P19",),
    with_pitches("SELECT game_pk, pitch_number, pitcher, " + ", ".join(_ENCODE_ALL) + ", " + ", ".join(
        f"CAST(CASE WHEN {c} IS NULL THEN NULL ELSE dense_rank() OVER (ORDER BY {c}) - 1 END AS INTEGER) AS {c}_index"
        for c in _ENCODE_ALL) + " FROM pitches"),
)
def q_encode_all(spark, sf):
    p = pitches(spark, sf).select("game_pk", "pitch_number", "pitcher", *_ENCODE_ALL)
    # The fixture view is a six-way join: write it once instead of
    # recomputing it for each of the eight dictionaries.
    return E.encode_all(p, _ENCODE_ALL, materialize_input=True)


@register(
    "prune_rename_select", ("P1", "P2", "P3", "P16"),
    with_pitches("""SELECT game_date, home_team AS game_home_team_stat, away_team AS game_away_team_stat,
       inning_topbot, events, release_speed, launch_speed
FROM pitches""", wide=True),
)
def q_prune_rename_select(spark, sf):
    p = pitches(spark, sf, wide=True)
    p = C.drop_columns(p, D.DROP_COLUMNS_PASS_1 + D.DROP_COLUMNS_PASS_2)
    p = C.rename_columns(p, {"home_team": "game_home_team_stat", "away_team": "game_away_team_stat"})
    return C.select_columns(p, ["game_date", "game_home_team_stat", "game_away_team_stat", "inning_topbot",
                                "events", "release_speed", "launch_speed"])
