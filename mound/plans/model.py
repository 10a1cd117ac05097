"""Game-outcome model (M1-M10) on MLlib.

Pipeline: pitch log -> game features (one scan, correct keys) -> team
index (M1) -> feature vector (M2/M3) -> split (M4) -> random forest
(M5) -> scores (M6) -> accuracy, confusion counts, importances (M7/M8).

Only ``fit`` and the metric aggregations run jobs.  The assembled
feature table is persisted (memory and disk) once before the fit and
released afterwards; a lost executor recomputes its blocks from lineage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from mound.dictionaries import FEATURES_11


def index_teams(games: DataFrame, cols: Sequence[str] = ("home_team", "away_team"),
                suffix: str = "_index") -> DataFrame:
    """M1: most frequent label -> 0.0; equal counts are ordered by label."""
    indexer = StringIndexer(inputCols=list(cols), outputCols=[f"{c}{suffix}" for c in cols],
                            stringOrderType="frequencyDesc", handleInvalid="keep")
    return indexer.fit(games).transform(games)


def assemble(df: DataFrame, features: Sequence[str], handle_invalid: str = "skip",
             out: str = "features") -> DataFrame:
    """M2: ``skip`` drops rows with a null / NaN feature, ``error`` fails."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=handle_invalid).transform(df)


def features_as_columns(df: DataFrame, features: Sequence[str], col: str = "features") -> DataFrame:
    arr = vector_to_array(F.col(col))
    return df.select(*[c for c in df.columns if c != col], *[arr[i].alias(f"f_{n}") for i, n in enumerate(features)])


def split_flag(key: Column, buckets: int = 5, test_buckets: int = 1) -> Column:
    """M4: deterministic side from an integer key -- ``key mod buckets <
    test_buckets`` is test.  All rows sharing the key land on one side,
    so copies of one game can never leak across the split."""
    return F.when(F.pmod(key, F.lit(buckets)) < test_buckets, F.lit("test")).otherwise(F.lit("train"))


def date_number(date_col: str = "game_date") -> Column:
    """Days since 1970-01-01: the split key when games have no id."""
    return F.datediff(F.to_date(F.col(date_col)), F.lit("1970-01-01").cast("date"))


def train_rf(train: DataFrame, label: str, features: str = "features", num_trees: int = 100,
             seed: int = 42, max_depth: int = 5) -> RandomForestClassificationModel:
    """M5 with an explicit seed (the library default seed depends on the
    Python hash seed, so unseeded runs are not repeatable)."""
    rf = RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees, seed=seed,
                                maxDepth=max_depth)
    return rf.fit(train)


def counted(rows: DataFrame, columns: Sequence[str], features: str = "features") -> DataFrame:
    """Equal rows as one: ``columns`` assembled to ``features``, the other columns, and ``n``, how many rows there are."""
    others = [c for c in rows.columns if c not in (*columns, features)]
    return assemble(rows.groupBy(*columns, *others).agg(F.count(F.lit(1)).alias("n")), columns, out=features).select(*others, features, "n")


def train_rf_counted(train: DataFrame, label: str, n_classes: int, features: str = "features", num_trees: int = 100,
                     seed: int = 42, max_depth: int = 5, at_once: int = 8) -> list[RandomForestClassificationModel]:
    """M5 over counted rows (``n``): the trees of a forest, in order.

    A forest's bootstrap draws each row Poisson(1) times for each tree, so n
    equal rows together Poisson(n) times, which is the weight of their one row
    here.  The library draws a row's own number whatever its weight; so the
    numbers are drawn first, and each tree is fitted to its own.  Labels are
    whole numbers below ``n_classes``.
    """
    @F.pandas_udf("array<double>")
    def drawn(n: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series([np.random.default_rng([seed, k & 0xFFFFFFFFFFFFFFFF]).poisson(m, num_trees).astype(float) for m, k in zip(n, key, strict=True)])

    kind = {"ml_attr": {"type": "nominal", "name": label, "num_vals": n_classes}}
    key = F.xxhash64(label, vector_to_array(features))
    rows = train.select(F.col(label).alias(label, metadata=kind), features, drawn("n", key).alias("draws")).persist(StorageLevel.MEMORY_AND_DISK)

    def tree(t: int) -> RandomForestClassificationModel:
        rf = RandomForestClassifier(featuresCol=features, labelCol=label, weightCol="weight", numTrees=1, bootstrap=False, seed=seed + t,
                                    featureSubsetStrategy="sqrt" if num_trees > 1 else "all", maxDepth=max_depth)
        return rf.fit(rows.select(label, features, F.get("draws", F.lit(t)).alias("weight")))

    with ThreadPool(at_once) as pool:
        models = pool.map(inheritable_thread_target(train.sparkSession)(tree), range(num_trees))
    rows.unpersist()
    return models


def vote(trees: Sequence[RandomForestClassificationModel], rows: DataFrame) -> DataFrame:
    """``rows`` with ``prediction``: the first class of the largest sum of the trees' class shares."""
    columns, names = rows.columns, []
    for t, model in enumerate(trees):
        names.append(f"__share{t}")
        rows = model.setProbabilityCol(names[-1]).setRawPredictionCol("").setPredictionCol("").transform(rows)
    shares = F.array(*[vector_to_array(c) for c in names])
    sums = F.reduce(shares, F.array_repeat(F.lit(0.0), trees[0].numClasses), lambda total, own: F.zip_with(total, own, lambda x, y: x + y))
    rows = rows.select(*columns, F.explode(F.array(sums)).alias("__sums"))
    return rows.select(*columns, (F.array_position("__sums", F.array_max("__sums")) - 1).cast("double").alias("prediction"))


def accuracy(predictions: DataFrame, label: str) -> float:
    """M7 through the library evaluator (a driver-side float)."""
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy").evaluate(predictions)


def accuracy_frame(predictions: DataFrame, label: str) -> DataFrame:
    """M7 as a DataFrame: one aggregation pass."""
    hit = (F.col("prediction") == F.col(label).cast("double")).cast("int")
    return predictions.agg(F.count(F.lit(1)).alias("n_test"), F.avg(hit).alias("accuracy"))


def accuracy_counted(predictions: DataFrame, label: str) -> DataFrame:
    """``accuracy_frame`` of counted rows (``n``)."""
    hits = F.sum(F.when(F.col("prediction") == F.col(label).cast("double"), F.col("n")).otherwise(0))
    return predictions.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_test"), hits.alias("hits")).select(
        "n_test", F.try_divide("hits", "n_test").alias("accuracy"))


def confusion(predictions: DataFrame, label: str) -> DataFrame:
    return predictions.groupBy(F.col(label).cast("int").alias("label"),
                               F.col("prediction").cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def importances(model: RandomForestClassificationModel, names: Sequence[str], spark) -> DataFrame:
    """M8: (feature, importance); the vector has one entry per feature."""
    vals = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, vals)], "feature string, importance double")


@dataclass
class Fitted:
    model: RandomForestClassificationModel
    train: DataFrame
    test: DataFrame
    predictions: DataFrame
    features: list[str]
    label: str
    cached: DataFrame | None = None  # the persisted table train/test are cut from


def fit_game_outcome(games: DataFrame, features: Sequence[str] = FEATURES_11, label: str = "home_win",
                     split: str = "key", num_trees: int = 100, seed: int = 42,
                     split_key: Column | None = None) -> Fitted:
    """M1-M6 over a game-feature table (``operators.games.game_features``).

    ``split='key'`` (default) sends whole days to one side by their date
    number (or ``split_key``); ``split='random'`` is ``randomSplit([0.8,
    0.2], seed)`` as originally written.
    """
    indexed = index_teams(games) if {"home_team_index", "away_team_index"} & set(features) else games
    data = assemble(indexed.where(F.col(label).isNotNull()), features).select(
        "game_date", "features", F.col(label).cast("double").alias(label))
    if split == "key":
        key = split_key if split_key is not None else date_number("game_date")
        flagged = data.withColumn("__side", split_flag(key)).persist(StorageLevel.MEMORY_AND_DISK)
        train = flagged.where(F.col("__side") == "train").drop("__side")
        test = flagged.where(F.col("__side") == "test").drop("__side")
    elif split == "random":
        flagged = data.persist(StorageLevel.MEMORY_AND_DISK)
        train, test = flagged.randomSplit([0.8, 0.2], seed=seed)
    else:
        raise ValueError(split)
    model = train_rf(train, label, num_trees=num_trees, seed=seed)
    return Fitted(model, train, test, model.transform(test), list(features), label, cached=flagged)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Small result tables are written through the shared checkpoint folder
    so the persisted training data can be released."""
    from mound.session import write_through

    return write_through(df, name)


def release(fitted: Fitted) -> None:
    """Drop the cached table that train and test are cut from.  (Calling
    ``unpersist`` on train / test themselves would be a no-op: they are
    filters over the cached plan, not the cached plan.)"""
    if fitted.cached is not None:
        fitted.cached.unpersist()


def fold_facts(rows: DataFrame, label: str = "home_win", season: str = "season") -> DataFrame:
    """(test_season, train_rows, train_positives, test_rows, test_positives):
    walk-forward folds, each tested on one season and trained on all seasons
    before it.  One aggregation; the folds are running sums over the
    seasons (one row each)."""
    per = rows.groupBy(season).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))
    earlier = Window.orderBy(season).rowsBetween(Window.unboundedPreceding, -1)
    return per.select(
        F.col(season).alias("test_season"), F.sum("n").over(earlier).alias("train_rows"), F.sum("pos").over(earlier).alias("train_positives"),
        F.col("n").alias("test_rows"), F.col("pos").alias("test_positives")).where(F.col("train_rows").isNotNull())


def walk_forward(rows: DataFrame, features: Sequence[str], label: str = "home_win", season: str = "season",
                 num_trees: int = 100, seed: int = 42, at_once: int = 3) -> DataFrame:
    """M10, leakage-free: (test_season, train_rows, train_positives,
    test_rows, test_positives, accuracy), a model for every season but the
    first, fitted on the seasons before it.

    ``rows`` is a stored feature table with a season column; rows without
    the label or a feature are left out.  The vectors are assembled and
    persisted once for all folds; a fold is a filter on the season.  A fold
    whose training rows are all of one label is not fitted (null accuracy).
    ``at_once`` folds are fitted at a time, the largest first: a fit is many
    short jobs, which alone leave most cores idle.
    """
    data = assemble(rows.where(F.col(label).isNotNull()), features).select(season, "features", F.col(label).cast("double").alias(label))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    facts = materialize(fold_facts(data, label, season), "fold-facts")
    spark = rows.sparkSession

    def score(fold: Row) -> tuple:
        result = None
        if 0 < fold["train_positives"] < fold["train_rows"]:
            model = train_rf(data.where(F.col(season) < fold["test_season"]), label, num_trees=num_trees, seed=seed)
            result = accuracy_frame(model.transform(data.where(F.col(season) == fold["test_season"])), label).first()["accuracy"]
        return fold["test_season"], result

    with ThreadPool(at_once) as pool:
        folds = facts.orderBy(F.desc("test_season")).collect()  # one row per season
        scores = pool.map(inheritable_thread_target(spark)(score), folds, chunksize=1)
    data.unpersist()
    kind = facts.schema["test_season"].dataType.simpleString()
    return facts.join(F.broadcast(spark.createDataFrame(scores, f"test_season {kind}, accuracy double")), "test_season")
