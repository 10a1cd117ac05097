"""Play-by-play event files, rosters and team lists.

Event files hold many games one after another; each game starts with an
``id`` line and carries ``version``, ``info``, ``start``, ``play``,
``sub``, ``com``, ``data``, ``radj`` and ``badj`` lines in order.

The scan reads the files as text with ``\\nid,`` as the record
separator, so one input row is one whole game (Hadoop's line reader
handles records that cross split boundaries).  Every line of a game is
therefore in the same row: the games table is built by looking inside
that row's array of lines and the other tables by ``posexplode`` -- all
map-side, no shuffle, and no ordering across rows is ever needed.

A malformed line never fails a job: typed fields that do not parse are
null, and ``checked_lines`` / ``split_lines`` set such lines apart, with
their file, game, place and the reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mound.schemas import ROSTER_SCHEMA, TEAM_LIST_SCHEMA
from mound.session import scratch_path

# --- fixed values: keys of the ``info`` records ------------------------------
INFO_KEYS = (
    "visteam", "hometeam", "site", "date", "number", "gametype", "starttime", "daynight",
    "innings", "tiebreaker", "usedh", "umphome", "ump1b", "ump2b", "ump3b", "umplf", "umprf",
    "inputtime", "howscored", "pitches", "oscorer", "temp", "winddir", "windspeed",
    "fieldcond", "precip", "sky", "timeofgame", "attendance", "wp", "lp", "save",
)
#: Record types, with the number of fields behind the type and the places of those that are whole numbers.
RECORDS = {
    "version": (1, ()), "info": (2, ()), "start": (5, (3, 4, 5)), "sub": (5, (3, 4, 5)), "play": (6, (1, 2)),
    "com": (1, ()), "data": (3, (3,)), "radj": (2, ()), "badj": (2, ()), "ladj": (2, ()), "padj": (2, ()), "presadj": (2, ()),
}
# --- end of fixed values -----------------------------------------------------

#: One field of a line: quoted (a quote inside is doubled) or up to the next comma.
_FIELD = r'(?:^|,)("[^"]*+(?:""[^"]*+)*+"|[^,]*+)'


def read_game_blocks(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """One row per game: ``game_id``, ``lines`` (array of the game's lines
    after the id line, CR stripped) and ``file_name``."""
    reader = spark.read.option("lineSep", "\nid,")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.text(paths if isinstance(paths, str) else list(paths))
    block = F.when(F.col("value").startswith("id,"), F.substr("value", F.lit(4))).otherwise(F.col("value"))
    lf, crlf = F.lit("\n"), F.lit("\r\n")
    block = F.concat(block, lf)
    # a second CR before a line's end is rare: looking for one costs less than replacing twice
    twice = F.contains(block, F.lit("\r\r\n"))
    block = F.replace(F.when(twice, F.replace(block, crlf, lf)).otherwise(block), crlf, lf)
    # behind a generator, so that each later use of the lines does not split the text anew
    once = F.explode(F.array(F.array_remove(F.split(block, "\n"), "")))
    split = raw.select(F.col("_metadata.file_name").alias("file_name"), once.alias("lines"))
    return split.where(F.size("lines") > 0).select(
        "file_name", F.get("lines", F.lit(0)).alias("game_id"),
        F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(1))).alias("lines"))


def _parse(line: Column) -> Column:
    """Every field after the record type; an empty unquoted field is null."""
    fields = F.regexp_extract_all(line, F.lit(_FIELD), 1)
    return F.transform(F.slice(fields, F.lit(2), F.greatest(F.size(fields) - 1, F.lit(0))), lambda f: F.when(
        f.startswith('"') & f.endswith('"') & (F.length(f) > 1),
        F.replace(F.substr(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(F.nullif(f, F.lit(""))))


def _cut(line: str, quotes: str) -> Column:
    """The fields of a line that commas and at most one quoted field, not
    empty, cut plainly (empty ones as they are); null for any other.
    ``quotes`` is the line split at its quotes."""
    def behind_first(text: Column, less: int = 0) -> Column:
        parts = F.split(text, ",")
        return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1 - less, F.lit(0)))

    before, name, after = (F.get(quotes, F.lit(i)) for i in range(3))
    one = (F.size(quotes) == 3) & before.endswith(",") & (name != "") & ((after == "") | after.startswith(","))
    return F.when(~F.col(line).startswith(","), F.when(F.size(quotes) == 1, behind_first(F.col(line))).when(
        one, F.concat(behind_first(before, 1), F.array(name), behind_first(after))))


def with_fields(lines: DataFrame) -> DataFrame:
    """``lines`` with ``fields``: every field of ``line`` after the record type.

    Lambdas run without generated code, so they are left to the lines that
    need them: those with an empty field or with quotes of another shape."""
    columns = lines.columns
    # behind a generator, so that a filter on a field does not cut the line anew
    once = F.explode(F.array(_cut("line", "__quotes")))
    cut = lines.withColumn("__quotes", F.split("line", '"')).select(*columns, once.alias("__cut"))
    blank = F.transform("__cut", lambda f: F.nullif(f, F.lit("")))
    return cut.select(*columns, F.when(F.col("__cut").isNull(), _parse(F.col("line"))).when(
        F.array_contains("__cut", ""), blank).otherwise(F.col("__cut")).alias("fields"))


def event_lines(blocks: DataFrame, records: Sequence[str] | None = None, nth: bool = True) -> DataFrame:
    """(game_id, seq, nth, record, fields, file_name, line): one row per line,
    ``seq`` = position of the line inside its game (the id line is 0),
    ``nth`` = its position among the lines of the chosen record types (from
    1), ``fields`` = all fields after the record type, ``line`` as it stands.

    Lines are numbered and chosen by their raw start inside the game's row;
    only chosen lines are parsed, once.  Without ``nth`` (left out) they are
    chosen behind the explode, by generated code."""
    record = F.substring_index("line", ",", 1)
    if records is None or not nth:
        ex = blocks.select("game_id", "file_name", F.posexplode("lines").alias("pos", "line"))
        ex = ex.select("game_id", (F.col("pos") + 1).alias("seq"), (F.col("pos") + 1).alias("nth"), "file_name", "line")
        if records is not None:
            ex = ex.where(record.isin(*records)).drop("nth")
    else:
        numbered = F.transform("lines", lambda s, i: F.struct((i + 1).alias("seq"), s.alias("line")))
        numbered = F.filter(numbered, lambda x: F.substring_index(x["line"], ",", 1).isin(*records))
        ex = blocks.select("game_id", "file_name", F.posexplode(numbered).alias("pos", "l"))
        ex = ex.select("game_id", F.col("l.seq").alias("seq"), (F.col("pos") + 1).alias("nth"), "file_name", F.col("l.line").alias("line"))
    out = with_fields(ex.withColumn("record", record))
    return out.select("game_id", "seq", *(["nth"] if nth else []), "record", "fields", "file_name", "line")


def _field(i: int) -> Column:
    return F.get("fields", i - 1)


def _whole(i: int) -> Column:
    """A field that is a whole number; null where it is not."""
    return _field(i).try_cast("int")


def checked_lines(blocks: DataFrame) -> DataFrame:
    """Every line, as ``event_lines`` has it, with ``reason``: why it is
    malformed, or null.

    The shapes are those of ``RECORDS``: a known record type, at least as
    many fields, and whole numbers where they belong.  A game whose id has
    no date has its id line as a further row (``seq`` 0).
    """
    lines = event_lines(blocks)
    record = F.col("record")
    reason = F.when(~record.isin(*RECORDS), F.lit("unknown record"))
    for name, (fields, _) in RECORDS.items():
        reason = reason.when((record == name) & (F.size("fields") < fields), F.lit("too few fields"))
    for name, (_, wholes) in RECORDS.items():
        for i in wholes:
            reason = reason.when((record == name) & _whole(i).isNull(), F.lit(f"field {i} is not a whole number"))
    no_date = F.try_to_date(F.substring("game_id", 4, 8), "yyyyMMdd").isNull()
    ids = blocks.where(no_date).select(
        "game_id", F.lit(0).alias("seq"), F.lit(None).cast("int").alias("nth"), F.lit("id").alias("record"),
        F.array("game_id").alias("fields"), "file_name", F.concat(F.lit("id,"), "game_id").alias("line"), F.lit("game id without a date").alias("reason"))
    return lines.withColumn("reason", reason).unionByName(ids)


def split_lines(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, rejects): the well-formed lines, and the malformed ones as
    (file_name, game_id, seq, record, line, reason).

    The event files are scanned once: all lines are written with their
    verdict as they come, so that no task sorts (and spills) its lines, and
    each output reads its own: row groups without a rejected line are skipped
    by their statistics."""
    checked = checked_lines(blocks).withColumn("rejected", F.col("reason").isNotNull())
    path = scratch_path(blocks.sparkSession, "event-lines")
    checked.write.parquet(path, compression="zstd")
    stored = blocks.sparkSession.read.schema(checked.schema).parquet(path)
    good = stored.where(~F.col("rejected")).drop("rejected", "reason")
    return good, stored.where("rejected").select("file_name", "game_id", "seq", "record", "line", "reason")


def event_games(blocks: DataFrame) -> DataFrame:
    """Games with the ``info`` records pivoted to columns -- inside each row,
    without a shuffle.  The info lines are split once into (key, value) in
    their own projection; each key then looks up that small array."""
    info = F.transform(
        F.filter("lines", lambda s: s.startswith("info,")),
        lambda s: F.split(s, ",", 3),
    )
    # behind a generator: split once, for all keys
    staged = blocks.select("game_id", "file_name", "lines", F.explode(F.array(info)).alias("_info"))

    keys = F.transform("_info", lambda r: F.get(r, 1))

    def key(k: str) -> Column:
        """The first record of the key."""
        return F.get("_info", (F.array_position("_keys", k) - 1).cast("int"))

    staged = staged.select("*", F.explode(F.array(keys)).alias("_keys"))
    gid = F.col("game_id")
    return staged.select(
        "game_id",
        F.substring(gid, 1, 3).alias("home_code"),
        F.try_to_date(F.substring(gid, 4, 8), "yyyyMMdd").alias("game_day"),
        F.substring(gid, 4, 4).try_cast("int").alias("season"),
        F.expr("substring(game_id, 12)").alias("game_number"),
        F.regexp_replace(F.get(F.filter("lines", lambda s: s.startswith("version,")), 0), "^version,", "").alias("version"),
        *[F.get(key(k), 2).alias(k) for k in INFO_KEYS],
        "file_name",
        # every info record as it stands: any key, repeats included
        F.transform("_info", lambda r: F.struct(F.get(r, 1).alias("key"), F.get(r, 2).alias("value"))).alias("info_records"),
    )


def event_lineups(lines: DataFrame) -> DataFrame:
    """``start`` and ``sub`` records."""
    return lines.where(F.col("record").isin("start", "sub")).select(
        "game_id", "seq", "record",
        _field(1).alias("player_id"), _field(2).alias("player_name"),
        _whole(3).alias("side"), _whole(4).alias("batting_order"), _whole(5).alias("field_position"),
    )


def _plays(lines: DataFrame, *more: Column) -> DataFrame:
    return lines.where(F.col("record") == "play").select(
        "game_id", "seq", *more,
        _whole(1).alias("inning"), _whole(2).alias("side"),
        _field(3).alias("batter_id"), _field(4).alias("count"),
        F.coalesce(_field(5), F.lit("")).alias("pitch_sequence"), _field(6).alias("play"),
    )


def event_plays(lines: DataFrame) -> DataFrame:
    """``play`` records; the play code is kept raw."""
    return _plays(lines)


def indexed_plays(blocks: DataFrame) -> DataFrame:
    """``play`` records with ``play_index``, their position among the
    game's plays from 1: read off the game's own array, without a shuffle."""
    return _plays(event_lines(blocks, ("play",)), F.col("nth").cast("int").alias("play_index"))


def event_earned_runs(lines: DataFrame) -> DataFrame:
    """``data,er`` records: earned runs charged to a pitcher in a game."""
    return lines.where((F.col("record") == "data") & (_field(1) == "er")).select(
        "game_id", "seq", _field(2).alias("pitcher_id"), _whole(3).alias("earned_runs"))


def event_comments(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("record") == "com").select("game_id", "seq", _field(1).alias("text"))


def event_adjustments(lines: DataFrame) -> DataFrame:
    """``radj`` (runner, base) and ``badj`` (batter, hand) records."""
    return lines.where(F.col("record").isin("radj", "badj")).select(
        "game_id", "seq", "record", _field(1).alias("player_id"), _field(2).alias("value"))


def read_team_list(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Headerless code, league, city, nickname."""
    return spark.read.schema(TEAM_LIST_SCHEMA).option("header", "false").csv(
        path if isinstance(path, str) else list(path))


def read_rosters(spark: SparkSession, path: str | Sequence[str], glob: str = "*.ROS") -> DataFrame:
    """Headerless rosters, one file per team and season named
    ``<TEAM><YYYY>.ROS``; other files in the folder are skipped.  Season
    and file team come from the file name."""
    df = spark.read.schema(ROSTER_SCHEMA).option("header", "false").option("pathGlobFilter", glob).csv(
        path if isinstance(path, str) else list(path))
    name = F.col("_metadata.file_name")
    return df.select(
        *ROSTER_SCHEMA.fieldNames(),
        F.regexp_extract(name, r"^(.+?)(\d{4})\.[A-Za-z]+$", 1).alias("file_team"),
        F.regexp_extract(name, r"^(.+?)(\d{4})\.[A-Za-z]+$", 2).cast("int").alias("season"),
    )


def split_rosters(spark: SparkSession, path: str | Sequence[str], glob: str = "*.ROS") -> tuple[DataFrame, DataFrame]:
    """(rosters, rejects): ``read_rosters`` without its malformed lines, and
    these as (file_name, line, reason).  One scan: all lines are written with
    their verdict, and each output reads its own folder.  Malformed is a line
    with more or fewer than seven fields, without a player id, or in a file
    whose name has no season."""
    schema = T.StructType([*ROSTER_SCHEMA.fields, T.StructField("__line", T.StringType())])
    raw = spark.read.schema(schema).option("header", "false").option("pathGlobFilter", glob).option(
        "mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__line").csv(path if isinstance(path, str) else list(path))
    name = F.col("_metadata.file_name")
    rows = raw.select(
        *ROSTER_SCHEMA.fieldNames(), "__line", name.alias("file_name"),
        F.regexp_extract(name, r"^(.+?)(\d{4})\.[A-Za-z]+$", 1).alias("file_team"),
        F.regexp_extract(name, r"^(.+?)(\d{4})\.[A-Za-z]+$", 2).try_cast("int").alias("season"))
    reason = F.when(F.col("__line").isNotNull(), "not seven fields").when(F.col("player_id").isNull(), "no player id").when(
        F.col("season").isNull(), "no season in the file's name")
    rows = rows.withColumn("reason", reason).withColumn("rejected", F.col("reason").isNotNull())
    out = scratch_path(spark, "roster-lines")
    rows.write.partitionBy("rejected").parquet(out)
    stored = spark.read.schema(rows.schema).parquet(out)
    good = stored.where(~F.col("rejected")).select(*ROSTER_SCHEMA.fieldNames(), "file_team", "season")
    line = F.coalesce("__line", F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in ROSTER_SCHEMA.fieldNames()]))
    return good, stored.where("rejected").select("file_name", line.alias("line"), "reason")


def roster_players(rosters: DataFrame) -> DataFrame:
    """One row per (player_id, season): a player listed by two teams in a
    season keeps the entry of the file team that sorts last."""
    cols = ("last_name", "first_name", "bats", "throws", "team", "position")
    s = F.struct(F.col("file_team").alias("_k"), *[F.col(c) for c in cols])
    return rosters.groupBy("player_id", "season").agg(F.max(s).alias("_r")).select(
        "player_id", "season", *[F.col(f"_r.{c}").alias(c) for c in cols])


def plays_with_batters(plays: DataFrame, players: DataFrame) -> DataFrame:
    """Each play with its batter's roster entry for the game's season.
    The roster table is one row per player and season, broadcast after a
    size check (``joins.join_small``)."""
    from mound.operators.joins import join_small

    p = plays.withColumn("season", F.substring("game_id", 4, 4).try_cast("int"))
    r = players.select(F.col("player_id").alias("batter_id"), "season",
                       F.col("last_name").alias("batter_last_name"), F.col("team").alias("batter_team"),
                       F.col("bats").alias("batter_bats"))
    return join_small(p, r, ["batter_id", "season"], "left")


def earned_runs_by_pitcher(earned: DataFrame) -> DataFrame:
    """Season earned-run totals per pitcher."""
    return earned.withColumn("season", F.substring("game_id", 4, 4).try_cast("int")).groupBy(
        "season", "pitcher_id").agg(F.count(F.lit(1)).alias("games"),
                                    F.sum("earned_runs").cast("bigint").alias("earned_runs"))


def plays_by_inning(plays: DataFrame) -> DataFrame:
    """Plays per game, inning and half (side), with strikeouts and
    home runs read off the leading play code."""
    code = F.col("play")
    return plays.groupBy("game_id", "inning", "side").agg(
        F.count(F.lit(1)).alias("plays"),
        F.sum(F.when(code.startswith("K"), 1).otherwise(0)).cast("bigint").alias("strikeouts"),
        F.sum(F.when(code.startswith("HR"), 1).otherwise(0)).cast("bigint").alias("home_runs"),
    )


def plays_by_batter(plays: DataFrame) -> DataFrame:
    """Plate appearances per batter and season."""
    return plays.withColumn("season", F.substring("game_id", 4, 4).try_cast("int")).groupBy("season", "batter_id").agg(
        F.count(F.lit(1)).alias("plate_appearances"),
        F.countDistinct("game_id").alias("games"),
    )
