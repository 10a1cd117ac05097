"""The ``pitches`` view over the driver's TPC-H-like tables.

There is no pitch data in the test environment, so every pitch-log
operator runs over this view (one lineitem = one pitch, one order = one
game id, supplier nation = home team, customer nation = away team).
The same definition is kept as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mound.dictionaries import EVENTS_INDEX
from mound.session import path_bytes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bytes of a table's files that a task takes, about, where the number of tasks is chosen here.
PART_BYTES = 8 << 20


def parts_of(spark: SparkSession, sf_dir: str, name: str) -> int:
    """In how many parts a table is dealt, by the bytes of its files."""
    return math.ceil(path_bytes(spark, f"{sf_dir.rstrip('/')}/{name}.parquet") / PART_BYTES)


def _case(col: Column, pairs: list[tuple[object, object]]) -> Column:
    out = None
    for k, v in pairs:
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out


#: Pitch descriptions of the varied view, in the order of their numbers.
DESCRIPTIONS = ("hit_into_play", "ball", "called_strike", "swinging_strike", "foul", "foul_tip", "blocked_ball", "hit_by_pitch",
                "wild_pitch", "passed_ball", "missed_bunt")


def varied(log: DataFrame) -> DataFrame:
    """``pitches`` with every published event code (null for one pitch in
    three), all ``DESCRIPTIONS`` (null for one in twelve), the hands of
    batter and pitcher, and the three components of acceleration."""
    codes = list(EVENTS_INDEX)
    n = F.col("game_pk") + F.col("pitcher") * 3 + F.col("pitch_number") * 7
    return log.withColumns({
        "events": F.when(n % 3 != 0, F.get(F.array(*[F.lit(c) for c in codes]), ((n * 5 + F.col("pitcher")) % len(codes)).cast("int"))),
        "description": F.get(F.array(*[F.lit(d) for d in DESCRIPTIONS], F.lit(None)), (F.col("release_spin_rate").cast("bigint") % 12).cast("int")),
        "stand": F.when(n % 2 == 0, "L").otherwise("R"),
        "p_throws": F.when(F.col("pitcher") % 4 == 0, "L").otherwise("R"),
        "ax": (n % 31 - 15).cast("double"), "ay": (n % 17 + 20).cast("double"), "az": F.when(n % 11 != 0, (n % 13 - 30).cast("double")),
    })


def varied_sql() -> str:
    """The varied view as DuckDB SQL (a CTE body over ``pitches``)."""
    codes = ", ".join(f"'{c}'" for c in EVENTS_INDEX)
    said = ", ".join(f"'{d}'" for d in DESCRIPTIONS)
    return f"""SELECT * EXCLUDE (events, description, n), CASE WHEN n % 3 <> 0 THEN [{codes}][(n * 5 + pitcher) % {len(EVENTS_INDEX)} + 1] END AS events,
       [{said}, NULL][CAST(release_spin_rate AS BIGINT) % 12 + 1] AS description, CASE WHEN n % 2 = 0 THEN 'L' ELSE 'R' END AS stand,
       CASE WHEN pitcher % 4 = 0 THEN 'L' ELSE 'R' END AS p_throws, CAST(n % 31 - 15 AS DOUBLE) AS ax, CAST(n % 17 + 20 AS DOUBLE) AS ay,
       CASE WHEN n % 11 <> 0 THEN CAST(n % 13 - 30 AS DOUBLE) END AS az
FROM (SELECT *, game_pk + pitcher * 3 + pitch_number * 7 AS n FROM pitches)"""


def pitches(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """One row per pitch.  ``wide`` adds nullable base-runner / alignment
    columns used by the cleaning operators."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation is a 25-row dimension by definition of the schema: a proven bound.
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    home_n = F.broadcast(nation.withColumnsRenamed({"n_nationkey": "s_nationkey", "n_name": "home_team"}))
    away_n = F.broadcast(nation.withColumnsRenamed({"n_nationkey": "c_nationkey", "n_name": "away_team"}))

    games = orders.join(customer, orders.o_custkey == customer.c_custkey).join(away_n, "c_nationkey")
    parts = parts_of(spark, sf_dir, "lineitem")
    if parts > 8:  # a large log meets its games in as many parts as its size asks for, so no task's share grows with it
        li, games = li.repartition(parts, "l_orderkey"), games.repartition(parts, "o_orderkey")
    rows = (
        li.join(games, li.l_orderkey == games.o_orderkey)
        .join(supplier, li.l_suppkey == supplier.s_suppkey)
        .join(home_n, "s_nationkey")
    )
    flag = F.col("l_returnflag")
    qty = F.col("l_quantity")
    cols = [
        F.col("o_orderdate").cast("date").cast("string").alias("game_date"),
        F.col("o_orderkey").alias("game_pk"),
        F.col("l_linenumber").alias("pitch_number"),
        F.col("l_suppkey").alias("pitcher"),
        F.col("home_team"),
        F.col("away_team"),
        F.when(F.col("l_linestatus") == "O", "Top").otherwise("Bot").alias("inning_topbot"),
        _case(flag, [("R", "strikeout"), ("A", "home_run")]).alias("events"),
        F.when(flag == "A", "hit_into_play").when(qty > 25, "called_strike").otherwise("ball").alias("description"),
        F.when(flag == "A", "X").when(qty > 25, "S").otherwise("B").alias("type"),
        _case(F.col("l_partkey") % 5, [(0, "FF"), (1, "SL"), (2, "CH"), (3, "CU")]).alias("pitch_type"),
        (F.lit(70) + qty / 2).alias("release_speed"),
        (F.lit(1500) + F.floor("l_extendedprice").cast("bigint") % 1000).cast("double").alias("release_spin_rate"),
        F.when(flag == "A", F.lit(60) + qty).alias("launch_speed"),
        F.when(flag == "A", F.round(F.col("l_discount") * 100) * 5 - 10).alias("launch_angle"),
        F.col("l_linenumber").cast("bigint").alias("home_score"),
        (qty.cast("bigint") % 8).alias("away_score"),
    ]
    if wide:
        cols += [
            F.when(F.col("l_tax") >= 0.05, F.col("l_partkey").cast("double")).alias("on_1b"),
            F.when(F.col("l_discount") >= 0.05, F.col("l_suppkey").cast("double")).alias("on_2b"),
            F.when(qty >= 40, F.col("l_orderkey").cast("double")).alias("on_3b"),
            _case(F.col("l_suppkey") % 4, [(0, "Standard"), (1, "Strategic"), (2, "Infield shade")]).alias("if_fielding_alignment"),
            _case(F.col("l_partkey") % 4, [(0, "Standard"), (1, "Strategic"), (2, "4th outfielder")]).alias("of_fielding_alignment"),
            F.when(flag == "A", (F.col("l_linenumber") - 1).cast("double")).alias("launch_speed_angle"),
        ]
    return rows.select(*cols)


# Same view as DuckDB SQL (a CTE body).  Kept textually parallel to the
# DataFrame code above.
PITCHES_SQL = """
SELECT CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS game_date,
       o.o_orderkey AS game_pk,
       l.l_linenumber AS pitch_number,
       l.l_suppkey AS pitcher,
       hn.n_name AS home_team,
       an.n_name AS away_team,
       CASE WHEN l.l_linestatus = 'O' THEN 'Top' ELSE 'Bot' END AS inning_topbot,
       CASE l.l_returnflag WHEN 'R' THEN 'strikeout' WHEN 'A' THEN 'home_run' END AS events,
       CASE WHEN l.l_returnflag = 'A' THEN 'hit_into_play'
            WHEN l.l_quantity > 25 THEN 'called_strike' ELSE 'ball' END AS description,
       CASE WHEN l.l_returnflag = 'A' THEN 'X' WHEN l.l_quantity > 25 THEN 'S' ELSE 'B' END AS type,
       CASE l.l_partkey % 5 WHEN 0 THEN 'FF' WHEN 1 THEN 'SL' WHEN 2 THEN 'CH' WHEN 3 THEN 'CU' END AS pitch_type,
       70 + l.l_quantity / 2 AS release_speed,
       CAST(1500 + CAST(floor(l.l_extendedprice) AS BIGINT) % 1000 AS DOUBLE) AS release_spin_rate,
       CASE WHEN l.l_returnflag = 'A' THEN 60 + l.l_quantity END AS launch_speed,
       CASE WHEN l.l_returnflag = 'A' THEN round(l.l_discount * 100) * 5 - 10 END AS launch_angle,
       CAST(l.l_linenumber AS BIGINT) AS home_score,
       CAST(trunc(l.l_quantity) AS BIGINT) % 8 AS away_score{wide}
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier sp ON l.l_suppkey = sp.s_suppkey
JOIN nation hn ON sp.s_nationkey = hn.n_nationkey
JOIN customer cu ON o.o_custkey = cu.c_custkey
JOIN nation an ON cu.c_nationkey = an.n_nationkey
"""

_WIDE_SQL = """,
       CASE WHEN l.l_tax >= 0.05 THEN CAST(l.l_partkey AS DOUBLE) END AS on_1b,
       CASE WHEN l.l_discount >= 0.05 THEN CAST(l.l_suppkey AS DOUBLE) END AS on_2b,
       CASE WHEN l.l_quantity >= 40 THEN CAST(l.l_orderkey AS DOUBLE) END AS on_3b,
       CASE l.l_suppkey % 4 WHEN 0 THEN 'Standard' WHEN 1 THEN 'Strategic' WHEN 2 THEN 'Infield shade' END AS if_fielding_alignment,
       CASE l.l_partkey % 4 WHEN 0 THEN 'Standard' WHEN 1 THEN 'Strategic' WHEN 2 THEN '4th outfielder' END AS of_fielding_alignment,
       CASE WHEN l.l_returnflag = 'A' THEN CAST(l.l_linenumber - 1 AS DOUBLE) END AS launch_speed_angle"""


def pitches_sql(wide: bool = False) -> str:
    return PITCHES_SQL.format(wide=_WIDE_SQL if wide else "")


def with_pitches(body: str, wide: bool = False, extra_ctes: str = "") -> str:
    """Wrap an oracle query body in ``WITH pitches AS (...)``."""
    ctes = f"pitches AS ({pitches_sql(wide)})"
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


# ----------------------------------------------------------------------------
# Event-file, roster and team-list layouts written from the driver's tables,
# for round trips through the scanners of ``mound.sources.eventlog``.
# ----------------------------------------------------------------------------

FIXTURE_ROSTER_SEASONS = tuple(range(1995, 2002))
#: Info records that the written event files carry, besides one that has no column of its own.
FIXTURE_INFO_KEYS = ("visteam", "hometeam", "site", "date", "number", "gametype", "daynight", "temp", "attendance", "sky", "umphome")


def team_code(nationkey: Column) -> Column:
    return F.concat(F.lit("N"), F.lpad(nationkey.cast("string"), 2, "0"))


def _pid(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), 7, "0"))


def event_file_games(spark: SparkSession, sf_dir: str, malformed: bool = False) -> DataFrame:
    """One row per order = game: its whole event-file text block.

    ``malformed`` adds, behind the header lines, a play without an inning for
    each third line item, a short ``start`` for each fifth and a line of an
    unknown type for each sixth."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    li = table(spark, sf_dir, "lineitem")

    g = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("d"),
        team_code(F.col("c_nationkey")).alias("home"),
        team_code((F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25).alias("vis"),
    ).withColumn("game_id", F.concat("home", F.date_format("d", "yyyyMMdd"), F.col("o_orderkey").cast("string")))

    # Rows go through one shuffle as they are in the tables, not as lines of
    # text: a game's lines are made where its rows meet.
    raw_game = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "d", "home", "vis", "game_id")
    raw_item = ("l_partkey", "l_suppkey", "s_name", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    games = g.select("o_orderkey", F.struct(*raw_game).alias("g"))
    items = li.join(supplier, li.l_suppkey == supplier.s_suppkey).select(F.col("l_orderkey").alias("o_orderkey"), F.struct(*raw_item).alias("i"))
    # Rows are dealt first, those of large tables in as many parts as their
    # bytes ask for: lists gathered before the shuffle would save nothing (a
    # scan task holds few rows of one order) and be sorted, and spilled, by
    # scan tasks that grow with the files.
    met = games.unionByName(items, allowMissingColumns=True)
    parts = parts_of(spark, sf_dir, "lineitem") + parts_of(spark, sf_dir, "orders")
    # Lines are many times the bytes that they are made of, so a part is a
    # quarter of one elsewhere: larger ones are spilled where they are sorted.
    met = met.repartition(4 * parts, "o_orderkey") if parts > 8 else met.repartition("o_orderkey")
    key = F.col("o_orderkey")

    def placed(sections: Sequence[int], places: Sequence[Column], lines: Column) -> Column:
        return F.arrays_zip(F.array(*map(F.lit, sections)).alias("s"), F.array(*places).alias("n"), lines.alias("line"))

    def header(g: Column) -> Column:
        info = [
            ("visteam", g["vis"]), ("hometeam", g["home"]),
            ("site", F.concat(g["home"], F.lit("01"))), ("date", F.date_format(g["d"], "yyyy/MM/dd")),
            ("number", (key % 3).cast("string")), ("gametype", F.lit("regular")),
            ("daynight", F.when(g["o_orderpriority"].startswith("1"), "night").otherwise("day")),
            ("temp", (g["o_totalprice"].cast("bigint") % 100).cast("string")),
            ("attendance", g["o_custkey"].cast("string")), ("sky", g["o_orderstatus"]),
            ("umphome", F.concat(F.lit("u"), g["o_custkey"].cast("string"))),
            ("umphome", F.concat(F.lit("v"), g["o_custkey"].cast("string"))), ("roof", g["o_orderpriority"]),
        ]
        starts, ends = zip(("id,", g["game_id"]), ("version,", F.lit("2")), *[(f"info,{k},", v) for k, v in info], strict=True)
        # a few lines of one shape; spelled out, the code generated for them and
        # the items' lines would be one method too long for the JVM to compile
        lines = F.zip_with(F.array(*map(F.lit, starts)), F.array(*ends), lambda start, end: F.concat(start, end))
        return placed([0] * len(starts), [F.lit(i) for i in range(len(starts))], lines)

    # Lines of a game are ordered by (section, line number, kind) and, for
    # line items sharing a line number, by the text of the line itself.
    def body(i: Column) -> Column:
        pid, batter = _pid("s", i["l_suppkey"]), _pid("c", i["l_partkey"] % 1000 + 1)
        side = F.when(i["l_linestatus"] == "O", "0").otherwise("1")
        qty, ln, flag = i["l_quantity"].cast("bigint"), i["l_linenumber"], i["l_returnflag"]
        name = F.concat(F.lit('"'), i["s_name"], F.lit('"'))

        def one(section: int, sub: int, line: Column, when: Column | None = None) -> tuple[int, Column, Column]:
            return section, ln * 10 + sub, line if when is None else F.when(when, line)

        sections, places, lines = zip(*[
            one(1, 0, F.concat_ws(",", F.lit("start"), pid, name, side, ln.cast("string"), (i["l_partkey"] % 10).cast("string"))),
            one(2, 0, F.concat_ws(",", F.lit("play"), ln.cast("string"), side, batter,
                                  F.concat((qty % 4).cast("string"), (qty % 3).cast("string")),
                                  F.when(flag == "A", "CBX").when(flag == "R", "SSS").otherwise(""),
                                  F.when(flag == "A", "HR/F7").when(flag == "R", "K").otherwise("63/G"))),
            one(2, 1, F.concat_ws(",", F.lit("sub"), pid, name, side, ln.cast("string"), F.lit("11")), i["l_tax"] > 0.06),
            one(2, 2, F.concat(F.lit('com,"note, line '), ln.cast("string"), F.lit(" of "), key.cast("string"), F.lit('"')), ln == 1),
            one(2, 3, F.concat_ws(",", F.lit("radj"), batter, F.lit("2")), i["l_discount"] >= 0.1),
            one(2, 4, F.concat_ws(",", F.lit("badj"), batter, F.when(i["l_suppkey"] % 2 == 0, "L").otherwise("R")), i["l_discount"] < 0.02),
            one(3, 0, F.concat_ws(",", F.lit("data"), F.lit("er"), pid, (qty % 5).cast("string"))),
            *([one(0, 1001, F.concat_ws(",", F.lit("play"), F.concat(F.lit("x"), ln.cast("string")), side, batter, F.lit("00"), F.lit(""), F.lit("K")), ln == 3),
               one(0, 1002, F.concat_ws(",", F.lit("start"), pid, side), ln == 5),
               one(0, 1003, F.concat_ws(",", F.lit("zzz"), pid), ln == 6)] if malformed else []),
        ], strict=True)
        return placed(sections, places, F.array(*lines))

    # A row's lines are made by generated code, row by row; in a lambda over
    # the game's rows they would be made without.  One event-file block is one
    # game, so its rows are gathered per order: a few line items (4 per order
    # on average, 17 at most at sf0.1) -- the size of one game, not of the data.
    made = met.select("o_orderkey", F.when(F.col("g").isNotNull(), header(F.col("g"))).otherwise(body(F.col("i"))).alias("lines"))
    blocks = made.groupBy("o_orderkey").agg(F.collect_list("lines").alias("lines"))
    # lines left out have no text, and so are not joined
    return blocks.select("o_orderkey", F.array_join(F.sort_array(F.flatten("lines"))["line"], "\r\n").alias("block"))


def write_event_files(spark: SparkSession, sf_dir: str, path: str, malformed: bool = False) -> None:
    """Event-file layout: CRLF lines, many games per file, compressed."""
    blocks = event_file_games(spark, sf_dir, malformed)
    # read once, so quickly compressed: the default level takes three times as long for files a quarter smaller
    blocks.select(F.concat("block", F.lit("\r")).alias("value")).write.mode("overwrite").option(
        "zlib.compress.level", "BEST_SPEED").text(path, compression="gzip")


def roster_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as players: one roster entry per season; every 50th
    customer is also listed by the next team in the same season."""
    c = table(spark, sf_dir, "customer")
    seasons = F.array(*[F.lit(y) for y in FIXTURE_ROSTER_SEASONS])
    base = c.select(
        _pid("c", F.col("c_custkey")).alias("player_id"),
        F.col("c_name").alias("last_name"), F.col("c_mktsegment").alias("first_name"),
        F.element_at(F.array(F.lit("L"), F.lit("R"), F.lit("B")), (F.col("c_custkey") % 3 + 1).cast("int")).alias("bats"),
        F.when(F.col("c_custkey") % 2 == 0, "R").otherwise("L").alias("throws"),
        F.col("c_nationkey"), F.col("c_custkey"),
        F.element_at(F.array(*[F.lit(p) for p in ("P", "C", "1B", "2B", "3B", "SS", "LF", "CF", "RF")]),
                     (F.col("c_custkey") % 9 + 1).cast("int")).alias("position"),
        F.explode(seasons).alias("season"),
    )
    second = base.where(F.col("c_custkey") % 50 == 0).withColumn("c_nationkey", (F.col("c_nationkey") + 1) % 25)
    both = base.unionByName(second).withColumn("team", team_code(F.col("c_nationkey")))
    return both.withColumn("file", F.concat("team", F.col("season").cast("string"), F.lit(".ROS")))


def _fs(spark: SparkSession, path: str):
    """Hadoop FileSystem of ``path`` (metadata operations only)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _local(path: str) -> str | None:
    """The local path behind ``path``, or None for a remote file system."""
    for prefix in ("file://", "file:"):
        if path.startswith(prefix):
            return path[len(prefix):]
    return None if "://" in path else path


def _flatten(spark: SparkSession, src: str, dst: str, column: str) -> None:
    """Move the single part file of each ``column=value`` folder to
    ``dst/value`` (file-system metadata only, no data through the driver)."""
    if getattr(spark, "_jvm", None) is None and _local(src) is not None:
        import os

        os.makedirs(_local(dst), exist_ok=True)
        for d in sorted(os.listdir(_local(src))):
            if d.startswith(f"{column}="):
                parts = sorted(f for f in os.listdir(os.path.join(_local(src), d)) if f.startswith("part-"))
                for i, f in enumerate(parts):
                    target = d.split("=", 1)[1] if i == 0 else f"{d.split('=', 1)[1]}.{i}"
                    os.rename(os.path.join(_local(src), d, f), os.path.join(_local(dst), target))
        return
    jvm, fs = _fs(spark, src)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(dst))
    for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(src)):
        name = st.getPath().getName()
        if not name.startswith(f"{column}="):
            continue
        value = name.split("=", 1)[1]
        parts = [p for p in fs.listStatus(st.getPath()) if p.getPath().getName().startswith("part-")]
        for i, p in enumerate(parts):
            target = value if i == 0 else f"{value}.{i}"
            fs.rename(p.getPath(), jvm.org.apache.hadoop.fs.Path(f"{dst}/{target}"))


def write_rosters(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Roster layout: headerless CSV, one ``<TEAM><YYYY>.ROS`` file per
    team and season, plus a stray fragment file the scan must skip."""
    rows = roster_rows(spark, sf_dir)
    staged = path + "_staged"
    cols = ["player_id", "last_name", "first_name", "bats", "throws", "team", "position"]
    rows.repartition("file").select(*cols, "file").write.mode("overwrite").partitionBy("file").csv(staged)
    _flatten(spark, staged, path, "file")
    # A stray file of another layout (the team list) that the *.ROS glob must skip.
    write_team_list(spark, sf_dir, path + "_frag")
    _flatten_single(spark, path + "_frag", f"{path}/ari")


def _flatten_single(spark: SparkSession, src: str, target: str) -> None:
    if getattr(spark, "_jvm", None) is None and _local(src) is not None:
        import os

        for f in sorted(os.listdir(_local(src))):
            if f.startswith("part-"):
                os.rename(os.path.join(_local(src), f), _local(target))
                return
        return
    jvm, fs = _fs(spark, src)
    for p in fs.listStatus(jvm.org.apache.hadoop.fs.Path(src)):
        if p.getPath().getName().startswith("part-"):
            fs.rename(p.getPath(), jvm.org.apache.hadoop.fs.Path(target))
            return


def write_team_list(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Team-list layout: headerless code, league, city, nickname."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    t = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        team_code(F.col("n_nationkey")).alias("code"),
        F.when(F.col("n_regionkey") % 2 == 0, "A").otherwise("N").alias("league"),
        F.initcap(F.lower("n_name")).alias("city"),
        F.col("r_name").alias("nickname"),
    )
    t.coalesce(1).write.mode("overwrite").option("header", "false").csv(path)
