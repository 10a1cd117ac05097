import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mound.dictionaries import TEAM_INDEX
from mound.functions import clean as C
from mound.functions import encode as E
from mound.plans import model as M


def test_unknown_team_rules(spark):
    df = spark.createDataFrame([("NYY",), ("XXX",), (None,)], "t string")
    out = df.select(E.lookup("t", TEAM_INDEX, "zero").alias("z"), E.lookup("t", TEAM_INDEX, "null").alias("n")).collect()
    assert [(r.z, r.n) for r in out] == [(15, 15), (0, None), (0, None)]
    with pytest.raises(Exception, match="unknown code"):
        df.select(E.lookup("t", TEAM_INDEX, "error")).collect()


def test_dictionary_of_any_size(spark):
    for size in (10, 2500):
        for values in (range(size), [f"name {i}" for i in range(size)]):
            mapping = {f"c{i}": v for i, v in enumerate(values)}
            df = spark.createDataFrame([(f"c{i}",) for i in range(size)] + [("zz",), (None,)], "t string")
            out = E.encode(df, "t", mapping, suffix="_code")
            assert dict(out.dtypes)["t_code"] == ("int" if isinstance(values, range) else "string")
            assert {r.t: r.t_code for r in out.collect()} == mapping | {"zz": None, None: None}
    numbers = {i: i * 10 for i in range(100)}
    assert {r.id: r.x for r in spark.range(120).withColumn("x", E.lookup("id", numbers)).collect()} == {
        i: numbers.get(i) for i in range(120)}


def test_matchup(spark):
    df = spark.createDataFrame([("NYY", "BOS"), ("NYY", "XXX")], "home_team string, away_team string")
    assert [r.m for r in df.select(E.matchup().alias("m")).collect()] == ["13:15", "0:15"]


def test_translate_list_paths_agree_and_keep_order(spark):
    df = spark.createDataFrame([("a,b,zz",), ("b",), (None,), ("zz,a",)], "s string")
    mapping = {"a": "Alpha", "b": "Beta"}
    dim = spark.createDataFrame(list(mapping.items()), "code string, name string")
    lit = [r.o for r in E.translate_list(df, "s", mapping, "o").orderBy("s").collect()]
    joined = [r.o for r in E.translate_list(df, "s", dim, "o").orderBy("s").collect()]
    assert lit == joined == [None, "Alpha, Beta, zz", "Beta", "zz, Alpha"]


def test_load_dictionary_last_duplicate_wins(spark):
    df = spark.createDataFrame([("a", "first", 1), ("a", "second", 2), ("b", "x", 1)], "code string, name string, seq int")
    d = {r.code: r.name for r in E.load_dictionary(df, order="seq").collect()}
    assert d == {"a": "second", "b": "x"}


def test_dense_index_equals_dense_rank(spark):
    df = spark.range(0, 5000).select((F.col("id") % 997).cast("string").alias("v")).union(
        spark.createDataFrame([(None,)], "v string"))
    ours = {r["value"]: r["index"] for r in E.dense_index(df.repartition(7), "v").collect()}
    ref = {r.v: r.i for r in df.where("v is not null").distinct().select(
        "v", (F.dense_rank().over(Window.orderBy("v")) - 1).alias("i")).collect()}
    assert ours == ref


def test_team_index_ties_by_label(spark):
    df = spark.createDataFrame([("B", "x"), ("A", "x"), ("C", "x"), ("C", "x")], "home_team string, away_team string")
    idx = {r.home_team: r.home_team_index for r in M.index_teams(df).collect()}
    assert idx == {"C": 0.0, "A": 1.0, "B": 2.0}


def test_pitch_result_branches(spark):
    rows = [(None, "ball"), ("walk", None), ("single", "hit_into_play"), ("strikeout", "foul_tip"),
            ("strikeout", "called_strike"), ("walk", "hit_into_play"), ("field_error", "hit_into_play"),
            (None, None)]
    df = spark.createDataFrame(rows, "events string, description string")
    out = [r.r for r in df.select(C.pitch_result().alias("r")).collect()]
    assert out == ["ball", "walk", "single", "foul_tip", "called_strike", "walk", "hit_into_play", None]


def test_fill_defaults_after_encoding(spark):
    from mound import dictionaries as D

    df = spark.createDataFrame([(None, None), (1.0, "Strategic")], "on_1b double, if_fielding_alignment string")
    df = E.encode(df, "if_fielding_alignment", D.IF_ALIGNMENT_INDEX)
    out = C.fill_defaults(df, D.NULL_DEFAULTS).collect()
    assert [(r.on_1b, r.if_fielding_alignment) for r in out] == [(0.0, 0), (1.0, 2)]


def test_drop_ignores_absent_and_guard(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.drop_columns(df, ["a", "nope"]).columns == ["b"]
    with pytest.raises(ValueError, match="missing"):
        C.select_columns(df, ["a", "zzz"])


def test_calendar(spark):
    df = spark.createDataFrame([("2023-04-02",), ("bad",)], "d string")
    out = df.select(C.string_to_date("d").alias("x")).select(
        C.day_of_week("x").alias("w"), C.date_key("x").alias("k")).collect()
    assert (out[0].w, out[0].k) == (1, 20230402) and out[1].w is None


def test_translate_list_randomized_against_spec(spark):
    import random

    rnd = random.Random(11)
    codes = ["a", "b", "c", "d", ""]
    mapping = {"a": "Alpha", "b": "Beta", "c": "Gamma"}
    rows = [(i, None if rnd.random() < 0.05 else ",".join(rnd.choice(codes) for _ in range(rnd.randint(1, 6))))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id int, s string")

    def spec(s):
        return None if s is None else ", ".join(mapping.get(t, t) for t in s.split(","))

    want = {i: spec(s) for i, s in rows}
    dim = spark.createDataFrame(list(mapping.items()), "code string, name string")
    lit = {r.id: r.o for r in E.translate_list(df, "s", mapping, "o").collect()}
    joined = {r.id: r.o for r in E.translate_list(df, "s", dim, "o").collect()}
    assert lit == want and joined == want


def test_dense_index_unicode_matches_sorted(spark):
    import random

    rnd = random.Random(5)
    alphabet = "abcXYZ09_ éü€漢字🙂"
    vals = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 4))) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in vals], "v string").repartition(6)
    got = {r["value"]: r["index"] for r in E.dense_index(df, "v").collect()}
    want = {v: i for i, v in enumerate(sorted(set(vals)))}
    assert got == want


@pytest.mark.parametrize("size", [10, 40, 2000])
def test_numeric_columns_meet_whole_keys(spark, size):
    mapping = {i: i + 100 for i in range(size)}
    for kind in ("smallint", "int", "bigint", "float", "double", "string", "decimal(10,2)"):
        df = spark.range(size + 3).select(F.col("id").cast(kind).alias("x"))
        assert [r.v for r in df.select(E.lookup("x", mapping).alias("v")).collect()] == [i + 100 for i in range(size)] + [None] * 3


def test_keys_of_mixed_spelling(spark):
    df = spark.createDataFrame([(1.0, "1."), (0.5, "x"), (-0.0, "0"), (float("nan"), "NaN"), (1e300, " 1"), (None, None), (2.5, "true")], "d double, t string")
    texts, numbers = {"1.": 1, "0": 0, "x": 7}, {0.5: "half", 1: "one"}
    pick = lambda c, m: [r.v for r in df.select(E.lookup(c, m).alias("v")).collect()]
    assert pick("d", texts) == [1, None, 0, None, None, None, None]
    assert pick("t", texts) == [1, 7, 0, None, None, None, None]
    assert pick("d", numbers) == ["one", "half", None, None, None, None, None]
    assert pick("t", numbers) == ["one", None, None, None, "one", None, None]
    assert pick("d", {}) == [None] * 7 and pick("t", {True: 1}) == [None] * 6 + [1]
    with pytest.raises(TypeError):
        E.lookup("t", {"a": 1, "b": "x"})


def test_large_dictionary_plans_quickly(spark):
    import time

    mapping = {f"c{i}": i for i in range(20_000)}
    began = time.time()
    df = spark.range(1000).select(E.lookup(F.concat(F.lit("c"), F.col("id").cast("string")), mapping).alias("v"))
    df._jdf.queryExecution().executedPlan()
    assert time.time() - began < 5
    assert df.agg(F.sum("v")).first()[0] == 499_500


def test_translation_with_a_large_dictionary(spark):
    df = spark.createDataFrame([("a,b,zz",), ("b",), (None,), ("zz,a",)], "s string")
    dim = spark.createDataFrame([("a", "Alpha"), ("b", "Beta")], "code string, name string")
    small = sorted(map(str, E.translate_list(df, "s", dim, "o").collect()))
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert small == sorted(map(str, E.translate_list(df, "s", dim, "o").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
