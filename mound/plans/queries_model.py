"""Registered queries: the game-outcome model."""

from __future__ import annotations

from pyspark.sql import functions as F

from mound.session import write_through
from mound.dictionaries import FEATURES_6, FEATURES_11
from mound.functions.clean import round_doubles
from mound.functions.encode import dense_index
from mound.operators import games as G
from mound.operators import prior as PF
from mound.operators import seasons as S
from mound.operators.joins import join_small
from mound.plans import model as M
from mound.plans.queries_core import GAMES_KEYED_CTES
from mound.plans.queries_io import FIXTURE_SEASONS
from mound.plans.registry import register
from mound.sources.fixtures import pitches, with_pitches

_INDEX_CTES = """gk AS (SELECT DISTINCT game_date, home_team, away_team FROM pitches),
hi AS (SELECT home_team, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, home_team) - 1 AS DOUBLE) AS home_team_index
       FROM gk GROUP BY home_team),
ai AS (SELECT away_team, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, away_team) - 1 AS DOUBLE) AS away_team_index
       FROM gk GROUP BY away_team)"""


@register(
    "team_index", ("M1",),
    with_pitches("""SELECT gk.game_date, gk.home_team, gk.away_team, hi.home_team_index, ai.away_team_index
FROM gk JOIN hi ON gk.home_team = hi.home_team JOIN ai ON gk.away_team = ai.away_team""", extra_ctes=_INDEX_CTES),
)
def q_team_index(spark, sf):
    games = pitches(spark, sf).select(*G.GAME_KEY).distinct()
    return M.index_teams(games)


# Team averages of per-day averages depend on summation order: rounded.
_INEXACT = ("home_avg_pitch_speed", "away_avg_pitch_speed")

_FEATURE_EXPR = {
    "home_team_index": "hi.home_team_index",
    "away_team_index": "ai.away_team_index",
    "home_avg_hits": "home_half_pitches / COUNT(*) OVER (PARTITION BY j.home_team)",
    "away_avg_hits": "away_half_pitches / COUNT(*) OVER (PARTITION BY j.away_team)",
    "home_strikeouts": "CAST(home_strikeouts AS DOUBLE)",
    "away_strikeouts": "CAST(away_strikeouts AS DOUBLE)",
    "avg_exit_velocity": "avg_exit_velocity",
    "avg_launch_angle": "avg_launch_angle",
    "home_runs": "CAST(home_runs AS DOUBLE)",
    "home_avg_pitch_speed": "AVG(home_day_avg_pitch_speed) OVER (PARTITION BY j.home_team)",
    "away_avg_pitch_speed": "AVG(away_day_avg_pitch_speed) OVER (PARTITION BY j.away_team)",
}


@register(
    "feature_rows", ("M2", "M3"),
    with_pitches(
        "SELECT game_date, home_team, away_team, home_win, "
        + ", ".join(f"round(f_{n}, 6) AS f_{n}" if n in _INEXACT else f"f_{n}" for n in FEATURES_11)
        + " FROM x WHERE " + " AND ".join(f"f_{n} IS NOT NULL" for n in FEATURES_11),
        extra_ctes=GAMES_KEYED_CTES + ",\n" + _INDEX_CTES + ",\nx AS (SELECT j.game_date, j.home_team, j.away_team, "
        "CAST(home_score > away_score AS INTEGER) AS home_win, "
        + ", ".join(f"{_FEATURE_EXPR[n]} AS f_{n}" for n in FEATURES_11)
        + " FROM j JOIN hi ON j.home_team = hi.home_team JOIN ai ON j.away_team = ai.away_team)",
    ),
)
def q_feature_rows(spark, sf):
    feats = M.index_teams(G.game_features(pitches(spark, sf), G.GAME_KEY))
    vec = M.assemble(feats, FEATURES_11).select("game_date", "home_team", "away_team", "home_win", "features")
    return round_doubles(M.features_as_columns(vec, FEATURES_11), columns=[f"f_{n}" for n in _INEXACT])


@register(
    "key_split", ("M4",),
    with_pitches("""SELECT game_date, home_team, away_team,
       CASE WHEN (((CAST(game_date AS DATE) - DATE '1970-01-01') % 5) + 5) % 5 < 1 THEN 'test' ELSE 'train' END AS side
FROM (SELECT DISTINCT game_date, home_team, away_team FROM pitches) g"""),
)
def q_key_split(spark, sf):
    games = pitches(spark, sf).select(*G.GAME_KEY).distinct()
    return games.withColumn("side", M.split_flag(M.date_number("game_date")))


def _fit(spark, sf: str, features: tuple[str, ...], split: str, games=None):
    games = G.game_features(pitches(spark, sf), G.GAME_KEY) if games is None else games
    fitted = M.fit_game_outcome(games, list(features), split=split)
    acc = M.accuracy_frame(fitted.predictions, fitted.label).select(
        F.lit(split).alias("split"), F.lit(len(features)).alias("n_features"), "n_test", "accuracy")
    out = {
        "accuracy": M.materialize(acc, "rf-accuracy"),
        "confusion": M.materialize(M.confusion(fitted.predictions, fitted.label), "rf-confusion"),
        "importance": M.materialize(M.importances(fitted.model, fitted.features, spark), "rf-importance"),
    }
    M.release(fitted)
    return out


@register("rf_accuracy", ("M5", "M6", "M7"))
def q_rf_accuracy(spark, sf):
    games = G.game_features(pitches(spark, sf), G.GAME_KEY)
    return _fit(spark, sf, tuple(FEATURES_11), "key", games)["accuracy"].unionByName(
        _fit(spark, sf, tuple(FEATURES_6), "random", games)["accuracy"])


@register("rf_confusion", ("M6", "M7"))
def q_rf_confusion(spark, sf):
    return _fit(spark, sf, tuple(FEATURES_11), "key")["confusion"]


@register("rf_importance", ("M8",))
def q_rf_importance(spark, sf):
    return _fit(spark, sf, tuple(FEATURES_11), "key")["importance"]


_SPLIT_SQL = "CASE WHEN (((CAST(game_date AS DATE) - DATE '1970-01-01') % 5) + 5) % 5 < 1 THEN 'test' ELSE 'train' END"


@register(
    "rf_facts", ("M4", "M5", "M6", "M7", "M8"),
    with_pitches(
        f"SELECT {_SPLIT_SQL} AS side, COUNT(*) AS n_rows, CAST(SUM(home_win) AS BIGINT) AS n_home_wins, COUNT(*) AS n_scored,\n"
        f"       2 AS n_classes, CAST(1.0 AS DOUBLE) AS importance_sum, {len(FEATURES_11)} AS n_features\n"
        "FROM x WHERE home_win IS NOT NULL AND " + " AND ".join(f"f_{n} IS NOT NULL" for n in FEATURES_11) + " GROUP BY 1",
        extra_ctes=GAMES_KEYED_CTES + ",\n" + _INDEX_CTES + ",\nx AS (SELECT j.game_date, "
        "CAST(home_score > away_score AS INTEGER) AS home_win, "
        + ", ".join(f"{_FEATURE_EXPR[n]} AS f_{n}" for n in FEATURES_11)
        + " FROM j JOIN hi ON j.home_team = hi.home_team JOIN ai ON j.away_team = ai.away_team)",
    ),
)
def q_rf_facts(spark, sf):
    """What SQL can state of a fit: rows, labels and scores of each side, classes, importances."""
    fitted = M.fit_game_outcome(G.game_features(pitches(spark, sf), G.GAME_KEY), list(FEATURES_11), split="key")
    scored = fitted.model.transform(fitted.train).withColumn("side", F.lit("train")).unionByName(
        fitted.predictions.withColumn("side", F.lit("test")))
    importance = fitted.model.featureImportances.toArray()
    facts = scored.groupBy("side").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(fitted.label).cast("bigint").alias("n_home_wins"),
        F.count(F.when(F.col("prediction").isin(0.0, 1.0), 1)).alias("n_scored")).withColumns({
            "n_classes": F.lit(fitted.model.numClasses), "importance_sum": F.lit(round(float(importance.sum()), 6)),
            "n_features": F.lit(len(importance))})
    facts = M.materialize(facts, "rf-facts")
    M.release(fitted)
    return facts


def _multiclass_rows(spark, sf):
    # Pitch-level rows; pitch_number (1-7) stands in for hit_location.
    # Rows without a label go; labels are numbered from 0 in their order, so the model has no class beside them.
    p = pitches(spark, sf).select("home_team", "away_team", F.col("pitch_number").alias("code")).where("code is not null")
    p = write_through(p, "rf-multiclass-pitches")
    codes = dense_index(p, "code").select(F.col("value").alias("code"), F.col("index").cast("double").alias("label"))
    data = M.assemble(M.index_teams(join_small(p, codes, "code", "inner")), ["home_team_index", "away_team_index"], handle_invalid="skip")
    return write_through(data, "rf-multiclass-rows")


@register("rf_multiclass", ("M9", "M1", "M2", "M5", "M7"))
def q_rf_multiclass(spark, sf):
    data = _multiclass_rows(spark, sf)
    sides = data.randomSplit([0.7, 0.3], seed=42)
    # There are as many different rows as pairs of teams and labels, however many pitches: equal ones are counted.
    teams = ["home_team_index", "away_team_index"]
    train, test = (M.materialize(M.counted(side.select(*teams, "label"), teams), "rf-multiclass-side") for side in sides)
    n_classes = int(train.agg(F.max("label")).first()[0]) + 1
    trees = M.train_rf_counted(train, "label", n_classes, num_trees=100)
    acc = M.accuracy_counted(M.vote(trees, test), "label").withColumn("n_classes", F.lit(n_classes))
    return M.materialize(acc, "rf-multiclass")


# Season ranges of the multi-season runs, over the fixture's calendar.
SEASON_RANGES = [(1995, 2001), (1998, 2001)]


@register("rf_by_season", ("M10", "J4", "S5"))
def q_rf_by_season(spark, sf):
    cal = S.calendar_frame(spark, FIXTURE_SEASONS)
    # one scan of the log: a game's season follows from its date, so the partials of all ranges are one table
    parts = write_through(S.season_tag(G.game_partials(pitches(spark, sf)), cal).where(F.col("season").isNotNull()), "season-partials")
    frames = []
    for lo, hi in SEASON_RANGES:
        p = parts.where(F.col("season").between(lo, hi)).drop("season")
        fitted = M.fit_game_outcome(G.features_from_partials(p), FEATURES_11, split="key")
        acc = M.accuracy_frame(fitted.predictions, fitted.label).select(
            F.lit(lo).alias("first_season"), F.lit(hi).alias("last_season"), "n_test", "accuracy")
        frames.append(M.materialize(acc, "rf-season"))
        M.release(fitted)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


_PRIOR_CTES = f"""pp AS (SELECT game_date, home_team, away_team, inning_topbot, pitcher, MAX(home_score) AS hs, MAX(away_score) AS aws, COUNT(*) AS pitches,
         SUM(CASE WHEN events = 'strikeout' THEN 1 ELSE 0 END) AS strikeouts, COUNT(release_speed) AS measured, SUM(release_speed) AS speed,
         MIN(pitch_number) AS first FROM pitches GROUP BY ALL),
pg AS (SELECT game_date, home_team, away_team, MAX(hs) AS home_score, MAX(aws) AS away_score,
         arg_min(pitcher, (first, pitcher)) FILTER (inning_topbot = 'Top') AS home_starter,
         arg_min(pitcher, (first, pitcher)) FILTER (inning_topbot = 'Bot') AS away_starter FROM pp GROUP BY ALL),
ptg AS (SELECT home_team AS team, game_date, home_score AS rf, away_score AS ra FROM pg
        UNION ALL SELECT away_team, game_date, away_score, home_score FROM pg),
ptd AS (SELECT team, game_date, COUNT(*) AS games, SUM(CASE WHEN rf > ra THEN 1 ELSE 0 END) AS wins, SUM(rf) AS rf, SUM(ra) AS ra FROM ptg GROUP BY ALL),
ptc AS (SELECT team, game_date, SUM(games) OVER w AS games, SUM(wins) OVER w AS wins, SUM(rf) OVER w AS rf, SUM(ra) OVER w AS ra FROM ptd
        WINDOW w AS (PARTITION BY team ORDER BY game_date ROWS UNBOUNDED PRECEDING)),
ppd AS (SELECT pitcher, game_date, SUM(pitches) AS pitches, SUM(strikeouts) AS strikeouts, SUM(measured) AS measured, SUM(speed) AS speed FROM pp GROUP BY ALL),
ppc AS (SELECT pitcher, game_date, SUM(pitches) OVER w AS pitches, SUM(strikeouts) OVER w AS strikeouts, SUM(measured) OVER w AS measured,
        SUM(speed) OVER w AS speed FROM ppd WINDOW w AS (PARTITION BY pitcher ORDER BY game_date ROWS UNBOUNDED PRECEDING)),
prior AS (SELECT g.game_date, g.home_team, g.away_team, g.home_starter, g.away_starter, """ + ", ".join(
    f"""CAST(coalesce({s}t.games, 0) AS BIGINT) AS {side}_games_before, CAST(coalesce({s}t.wins, 0) AS BIGINT) AS {side}_wins_before,
         CAST({s}t.rf AS DOUBLE) / {s}t.games AS {side}_avg_runs_for, CAST({s}t.ra AS DOUBLE) / {s}t.games AS {side}_avg_runs_against,
         CAST(coalesce({s}p.pitches, 0) AS BIGINT) AS {side}_starter_pitches, CAST(coalesce({s}p.strikeouts, 0) AS BIGINT) AS {side}_starter_strikeouts,
         CAST({s}p.speed AS DOUBLE) / {s}p.measured AS {side}_starter_avg_speed""" for s, side in (("h", "home"), ("v", "away"))) + """,
         CAST(g.home_score > g.away_score AS INTEGER) AS home_win FROM pg g
      ASOF LEFT JOIN ptc ht ON g.home_team = ht.team AND g.game_date > ht.game_date
      ASOF LEFT JOIN ppc hp ON g.home_starter = hp.pitcher AND g.game_date > hp.game_date
      ASOF LEFT JOIN ptc vt ON g.away_team = vt.team AND g.game_date > vt.game_date
      ASOF LEFT JOIN ppc vp ON g.away_starter = vp.pitcher AND g.game_date > vp.game_date)"""


@register("prior_feature_rows", ("W4", "W5", "M2"), with_pitches("SELECT * FROM prior", extra_ctes=_PRIOR_CTES))
def q_prior_feature_rows(spark, sf):
    return PF.prior_game_features(pitches(spark, sf))


def _seasoned(spark, sf):
    rows = PF.prior_game_features(pitches(spark, sf)).withColumn("season", F.substring("game_date", 1, 4).cast("int"))
    return write_through(rows.select("season", *PF.PRIOR_FEATURES, "home_win"), "prior-rows")


_COMPLETE = " AND ".join(f"{f} IS NOT NULL" for f in PF.PRIOR_FEATURES)


@register(
    "season_folds", ("M10", "M4"),
    with_pitches(f"""SELECT test_season, train_rows, train_positives, test_rows, test_positives FROM (
  SELECT season AS test_season, CAST(SUM(n) OVER w AS BIGINT) AS train_rows, CAST(SUM(pos) OVER w AS BIGINT) AS train_positives,
         n AS test_rows, pos AS test_positives
  FROM (SELECT CAST(substr(game_date, 1, 4) AS INTEGER) AS season, COUNT(*) AS n, CAST(SUM(home_win) AS BIGINT) AS pos
        FROM prior WHERE home_win IS NOT NULL AND {_COMPLETE} GROUP BY 1)
  WINDOW w AS (ORDER BY season ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE train_rows IS NOT NULL""", extra_ctes=_PRIOR_CTES),
)
def q_season_folds(spark, sf):
    """What SQL can state of the walk-forward evaluation: rows and labels of each fold."""
    rows = _seasoned(spark, sf).where(F.col("home_win").isNotNull()).dropna(subset=list(PF.PRIOR_FEATURES))
    return M.fold_facts(rows)


@register("rf_walk_forward", ("M5", "M6", "M7", "M10"))
def q_rf_walk_forward(spark, sf):
    return M.walk_forward(_seasoned(spark, sf), PF.PRIOR_FEATURES, num_trees=20)


@register(
    "rf_confusion_totals", ("M6", "M7"),
    with_pitches(
        "SELECT home_win AS label, COUNT(*) AS n FROM x WHERE home_win IS NOT NULL AND " + " AND ".join(f"f_{n} IS NOT NULL" for n in FEATURES_11)
        + f" AND {_SPLIT_SQL} = 'test' GROUP BY 1",
        extra_ctes=GAMES_KEYED_CTES + ",\n" + _INDEX_CTES + ",\nx AS (SELECT j.game_date, "
        "CAST(home_score > away_score AS INTEGER) AS home_win, "
        + ", ".join(f"{_FEATURE_EXPR[n]} AS f_{n}" for n in FEATURES_11)
        + " FROM j JOIN hi ON j.home_team = hi.home_team JOIN ai ON j.away_team = ai.away_team)",
    ),
)
def q_rf_confusion_totals(spark, sf):
    """The rows of the confusion table: how many test games each label has, over both predictions."""
    return _fit(spark, sf, tuple(FEATURES_11), "key")["confusion"].groupBy("label").agg(F.sum("n").alias("n"))


@register(
    "rf_multiclass_labels", ("M9", "M1"),
    with_pitches("""SELECT CAST(dense_rank() OVER (ORDER BY pitch_number) - 1 AS DOUBLE) AS label, COUNT(*) AS n_rows,
       (SELECT COUNT(DISTINCT pitch_number) FROM pitches) AS n_classes FROM pitches GROUP BY pitch_number"""),
)
def q_rf_multiclass_labels(spark, sf):
    """What SQL can state of the multi-class model: its labels, their rows and the number of classes."""
    data = _multiclass_rows(spark, sf)
    return data.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_classes", F.lit(data.select("label").distinct().count()).cast("long"))
