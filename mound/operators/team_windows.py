"""Per-team window features (W2-W6) and the date-only fan-out join.

The team-game table (U2) is ordered inside a team by
``(game_date, is_home, opponent)``, which is unique for the game key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mound.operators.games import game_partials
from mound.operators.joins import join_small
from mound.session import write_through

TEAM_ORDER = ("game_date", "is_home", "opponent")
DAY_ORDER = ("is_home", "opponent")

# Partitioning of the team windows
# --------------------------------
# A window over ``team`` alone would put a team's whole history in one task
# (and a team may hold a large share of all rows).  Instead every window
# here is either
#   * over (team, game_date): the game key is unique, so such a group holds
#     at most two rows per opponent -- bounded by the number of teams; or
#   * over ``team`` on a per-(team, date) summary table, which has one row
#     per date the team played -- bounded by the calendar, not by volume.
# The row-level and day-level results are then joined on (team, game_date).


def _day_order(tg: DataFrame) -> tuple[str, ...]:
    """Order of a team's games within a day.  With ``game_pk`` carried
    along (a game key that keeps doubleheaders apart), it breaks the tie
    between two games against the same opponent on one date."""
    return DAY_ORDER + (("game_pk",) if "game_pk" in tg.columns else ())


def _in_day(order: tuple[str, ...], frame_lo=None, frame_hi=None) -> Window:
    w = Window.partitionBy("team", "game_date").orderBy(*order)
    return w if frame_lo is None else w.rowsBetween(frame_lo, frame_hi)


def _by_date(*extra: str) -> Window:
    return Window.partitionBy("team", *extra).orderBy("game_date")


def _prepare(tg: DataFrame, materialize: bool) -> DataFrame:
    # The team-game table feeds a row-level and a day-level branch; written
    # once, it is not recomputed from the pitch log for each branch.
    return write_through(tg, "team-games") if materialize else tg


def prior_n_averages(tg: DataFrame, n: int = 5, materialize: bool = True) -> DataFrame:
    """Averages over the ``n`` games directly before each game.

    Rows before a game come from the same day (a window over the team-day)
    and from earlier days: each day keeps its last ``n`` rows (its "tail"),
    and the tails of the ``n`` previous playing days -- each has at least one
    row -- hold every earlier row that can be among the last ``n``.  Only
    the team-game table is shuffled (once, by team and date); the day
    tails are a one-row-per-day table.
    """
    tg = _prepare(tg, materialize)
    order = _day_order(tg)
    v = F.struct(F.col("runs_for").alias("rf"), F.col("runs_against").alias("ra"))
    # All row-level windows share one (team, game_date) partitioning: the
    # n rows before each row in its day, the n rows up to it, and whether
    # it is the day's last row -- whose "up to" list is the day's tail.
    rows = tg.select(
        "team", "opponent", "is_home", "game_date", *order[2:],
        F.collect_list(v).over(_in_day(order, -n, -1)).alias("_same_day"),
        F.collect_list(v).over(_in_day(order, -(n - 1), 0)).alias("_upto"),
        F.lead(F.lit(1)).over(_in_day(order)).isNull().alias("_is_last"),
    )
    tails = rows.where(F.col("_is_last")).select("team", "game_date", F.col("_upto").alias("_tail"))
    prev = tails.select("team", "game_date",
                        F.flatten(F.collect_list("_tail").over(_by_date().rowsBetween(-n, -1))).alias("_prev"))

    def last_n(a):
        return F.slice(a, F.greatest(F.size(a) - n + 1, F.lit(1)), n)

    j = rows.join(prev, ["team", "game_date"], "left")
    window = last_n(F.concat(F.coalesce("_prev", F.array().cast(j.schema["_same_day"].dataType)), "_same_day"))

    def avg_of(field: str):
        vals = F.filter(F.transform(window, lambda x: x[field]), lambda x: x.isNotNull())
        total = F.aggregate(vals, F.lit(0).cast("double"), lambda acc, x: acc + x)
        return F.when(F.size(vals) > 0, total / F.size(vals))

    return j.select(
        "team", "opponent", "is_home", "game_date", *order[2:],
        F.size(window).cast("bigint").alias("prior_games"),
        avg_of("rf").alias("prior_avg_runs_for"),
        avg_of("ra").alias("prior_avg_runs_against"),
    )


def season_to_date(tg: DataFrame, materialize: bool = True) -> DataFrame:
    """Season-to-date statistics with the current game excluded (no
    label leakage).  The season is ``tg.season`` when present (e.g. from
    the calendar tag, ``seasons.season_tag``), else the calendar year.

    Prefix sums: (sums over earlier days of the season, from a day table)
    + (sums over earlier rows of the same day)."""
    tg = _prepare(tg, materialize)
    if "season" not in tg.columns:
        tg = tg.withColumn("season", F.year(F.to_date("game_date")))
    order = _day_order(tg)
    win = (F.col("result") == 1).cast("int")
    before = _in_day(order, Window.unboundedPreceding, -1)
    rows = tg.select(
        "team", "opponent", "is_home", "game_date", "season", *order[2:],
        F.count(F.lit(1)).over(before).alias("_n"),
        F.sum(win).over(before).alias("_w"),
        F.sum("runs_for").over(before).alias("_rf"), F.count("runs_for").over(before).alias("_crf"),
        F.sum("runs_against").over(before).alias("_ra"), F.count("runs_against").over(before).alias("_cra"),
    )
    earlier = _by_date("season").rowsBetween(Window.unboundedPreceding, -1)
    day = tg.groupBy("team", "season", "game_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(win).alias("w"),
        F.sum("runs_for").alias("rf"), F.count("runs_for").alias("crf"),
        F.sum("runs_against").alias("ra"), F.count("runs_against").alias("cra"),
    ).select(
        "team", "game_date",
        *[F.sum(c).over(earlier).alias(f"_p{c}") for c in ("n", "w", "rf", "crf", "ra", "cra")],
    )
    j = rows.join(day, ["team", "game_date"], "left")

    def tot(a: str, b: str):
        return F.coalesce(F.col(a), F.lit(0)) + F.coalesce(F.col(b), F.lit(0))

    return j.select(
        "team", "opponent", "is_home", "game_date", "season", *order[2:],
        tot("_n", "_pn").cast("bigint").alias("games_before"),
        tot("_w", "_pw").cast("bigint").alias("wins_before"),
        (tot("_rf", "_prf") / F.when(tot("_crf", "_pcrf") > 0, tot("_crf", "_pcrf"))).alias("std_avg_runs_for"),
        (tot("_ra", "_pra") / F.when(tot("_cra", "_pcra") > 0, tot("_cra", "_pcra"))).alias("std_avg_runs_against"),
    )


def streaks(tg: DataFrame, materialize: bool = True) -> DataFrame:
    """Win / losing streak entering each game.

    ``streak_before`` = +k after k straight wins, -k after k straight
    losses, 0 for a team's first game or right after a tie (a null score
    counts as a tie).

    Gaps and islands twice.  Inside a day: ``_run`` is the length of the
    run of equal results ending at each row.  Across days, on the day
    table: ``L`` is the length of the run ending at the day's last game; a
    day continues the previous day's run when all its games share one
    result equal to the previous day's last result.  A row's previous game
    is either the previous row of its day (whose run may reach back into
    the previous day) or the previous day's last game.
    """
    tg = _prepare(tg, materialize)
    order = _day_order(tg)
    wd = _in_day(order)
    x = (
        tg.withColumn("_r", F.coalesce(F.col("result"), F.lit(0)))
        .withColumn("_k", F.row_number().over(wd) - 1)
        .withColumn("_new", F.when(F.lag("_r").over(wd) == F.col("_r"), 0).otherwise(1))
        .withColumn("_isl", F.sum("_new").over(wd.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_run", F.row_number().over(
            Window.partitionBy("team", "game_date", "_isl").orderBy(*order)))
    )
    day = x.groupBy("team", "game_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by("_r", "_k").alias("last_r"),
        F.max_by("_run", "_k").alias("trail_run"),
        (F.max("_isl") == 1).alias("uniform"),
    )
    wt = _by_date()
    day = day.withColumn("_prev_last", F.lag("last_r").over(wt)).withColumn(
        "_start", F.when(F.col("uniform") & (F.col("_prev_last") == F.col("last_r")), 0).otherwise(1))
    day = day.withColumn("_disl", F.sum("_start").over(wt.rowsBetween(Window.unboundedPreceding, 0)))
    day = day.withColumn("L", F.sum(F.when(F.col("_start") == 1, F.col("trail_run")).otherwise(F.col("n"))).over(
        Window.partitionBy("team", "_disl").orderBy("game_date").rowsBetween(Window.unboundedPreceding, 0)))
    prev_day = day.select(
        "team", "game_date",
        F.lag("L").over(wt).alias("_pL"), F.lag("last_r").over(wt).alias("_pr"))

    j = x.join(prev_day, ["team", "game_date"], "left")
    prev_run = F.lag("_run").over(wd)
    prev_r = F.lag("_r").over(wd)
    prev_isl = F.lag("_isl").over(wd)
    reaches_back = (prev_isl == 1) & (F.col("_pr") == prev_r)
    run_before = F.when(reaches_back, prev_run + F.col("_pL")).otherwise(prev_run)
    streak = F.when(F.col("_k") == 0, F.coalesce(F.col("_pL") * F.col("_pr"), F.lit(0))).otherwise(run_before * prev_r)
    return j.select("team", "opponent", "is_home", "game_date", *order[2:], "result",
                    streak.cast("int").alias("streak_before"))


def fanout_team_features(pitches: DataFrame) -> DataFrame:
    """J1 + W2 + W3 exactly as the original wrote them (side tables joined on
    the date only), reduced to one row per (side, team) -- computed without
    materialising the fan-out.

    The original joins every game of a date with every home-team row and
    every away-team row of that date, i.e. G_d * H_d * A_d rows per date,
    and then takes unordered windows over the game's team.  Each of those
    window values is a sum of products of per-date counts and sums:

      rows(T)        = sum_d G(d,T) * H_d * A_d
      sum_hits(T)    = sum_d G(d,T) * A_d * sum_{h in d} hits_h      (home side)
      avg_speed(T)   = sum_d G(d,T) * A_d * sum speed_h / sum_d G(d,T) * A_d * n speed_h

    (home and away swap H and A).  W2 per fanned row is hits / rows(T), so
    ``sum_hits_stat`` and ``fanout_rows`` give it exactly.  Everything is a
    group-by on (date) or (date, team): no pair is ever emitted, so a busy
    date costs the same as a quiet one.
    """
    # One scan of the pitch log: everything below is derived from the
    # game-level partials, written once.
    parts = write_through(
        game_partials(pitches).select("game_date", "home_team", "away_team", "bot_pitches", "top_pitches",
                                      "sum_speed", "n_speed"),
        "fanout-partials",
    )
    games = parts.select("game_date", "home_team", "away_team")

    def day(team: str, half: str) -> DataFrame:
        return parts.groupBy("game_date", team).agg(
            F.sum(half).alias("hits"), (F.sum("sum_speed") / F.sum("n_speed")).alias("speed"))

    home_d = day("home_team", "bot_pitches").groupBy("game_date").agg(
        F.count(F.lit(1)).alias("H"),
        F.sum("hits").alias("SH"),
        F.sum("speed").alias("SSH"),
        F.count("speed").alias("CSH"),
    )
    away_d = day("away_team", "top_pitches").groupBy("game_date").agg(
        F.count(F.lit(1)).alias("A"),
        F.sum("hits").alias("SA"),
        F.sum("speed").alias("SSA"),
        F.count("speed").alias("CSA"),
    )
    per_date = home_d.join(away_d, "game_date")  # one row per date on each side

    def side(team_col: str, label: str, mult: str, hits: str, ssum: str, scnt: str) -> DataFrame:
        g = games.groupBy("game_date", F.col(team_col).alias("team")).agg(F.count(F.lit(1)).alias("G"))
        j = join_small(g, per_date, "game_date", how="inner")
        return j.groupBy("team").agg(
            F.sum(F.col("G") * F.col("H") * F.col("A")).cast("bigint").alias("fanout_rows"),
            F.sum(F.col("G") * F.col(mult) * F.col(hits)).cast("bigint").alias("sum_hits_stat"),
            (F.sum(F.col("G") * F.col(mult) * F.col(ssum)) / F.sum(F.col("G") * F.col(mult) * F.col(scnt))).alias(
                "team_avg_pitch_speed"
            ),
        ).withColumn("side", F.lit(label))

    return side("home_team", "home", "A", "SH", "SSH", "CSH").unionByName(
        side("away_team", "away", "H", "SA", "SSA", "CSA")
    ).select("side", "team", "fanout_rows", "sum_hits_stat", "team_avg_pitch_speed")
