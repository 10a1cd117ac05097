from pyspark.sql import functions as F

from conftest import SF_SMALL
from mound.dictionaries import FEATURES_6
from mound.operators import games as G
from mound.plans import model as M
from mound.sources.fixtures import pitches


def test_same_seed_same_accuracy_and_no_leak(spark):
    games = G.game_features(pitches(spark, SF_SMALL)).persist()
    accs = []
    for _ in range(2):
        f = M.fit_game_outcome(games, FEATURES_6, num_trees=10)
        accs.append(M.accuracy_frame(f.predictions, f.label).collect()[0].accuracy)
        train_days = f.train.select("game_date").distinct()
        test_days = f.test.select("game_date").distinct()
        assert train_days.intersect(test_days).count() == 0
        assert f.cached.storageLevel.useMemory or f.cached.storageLevel.useDisk
        M.release(f)
        assert not f.cached.is_cached
    assert accs[0] == accs[1]
    games.unpersist()


def test_assembler_skip_drops_null_rows(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    assert M.assemble(df, ["a", "b"]).count() == 1


def test_split_flag_is_per_key(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"))
    sides = df.select("k", M.split_flag(F.col("k")).alias("s")).distinct()
    assert sides.groupBy("k").count().where("count > 1").count() == 0


def test_counted_rows_give_a_forest_of_bootstraps(spark):
    import numpy as np

    kind = {"ml_attr": {"type": "nominal", "num_vals": 4}}
    rows = [(float(a), float(b), float((a + b) % 3)) for a in range(4) for b in range(4) for _ in range(1 + 10 * a + b)]
    rows += [(1.0, 1.0, 0.0)] * 5  # a minority label
    plain = spark.createDataFrame(rows, "a double, b double, label double").select(
        F.col("a").alias("a", metadata=kind), F.col("b").alias("b", metadata=kind), "label").repartition(3)
    counted = M.counted(plain, ["a", "b"]).persist()
    assert counted.count() == 17 and counted.agg(F.sum("n")).first()[0] == len(rows)
    trees = M.train_rf_counted(counted, "label", 4, num_trees=6)
    again = M.train_rf_counted(counted.repartition(5), "label", 4, num_trees=6)
    text = lambda models: [m.toDebugString.split("\n", 1)[1] for m in models]
    assert text(trees) == text(again) and len(set(text(trees))) > 1  # each tree has its own draws, by the row and not by its place
    assert all(m.numClasses == 4 for m in trees) and "in {" in text(trees)[0]  # teams stay categories
    scored = M.vote(trees, counted)
    votes = {tuple(r.features): r.prediction for r in scored.collect()}
    for features, prediction in votes.items():  # the first class of the largest sum
        point = counted.where("n > 0").first().features.__class__(features)
        assert prediction == np.argmax(sum(m.predictProbability(point).toArray() for m in trees))
    got = M.accuracy_counted(scored, "label").first()
    hits = sum(votes[a, b] == label for a, b, label in rows)
    assert got.n_test == len(rows) and got.accuracy == hits / len(rows)
    assert M.accuracy_counted(scored.where("false"), "label").first() == (0, None)
    counted.unpersist()


def test_multiclass_fit_does_not_grow_with_the_rows(spark, monkeypatch):
    from mound.plans import queries_model as Q

    fitted = []
    train = M.train_rf_counted
    monkeypatch.setattr(M, "train_rf_counted", lambda rows, *a, **k: fitted.append(rows) or train(rows, *a, **k | {"num_trees": 2}))
    out = Q.q_rf_multiclass(spark, SF_SMALL).first()
    rows = fitted[0]
    assert rows.count() == rows.select("features", "label").distinct().count()
    assert rows.agg(F.sum("n")).first()[0] + out.n_test == pitches(spark, SF_SMALL).where("pitch_number is not null").count()
