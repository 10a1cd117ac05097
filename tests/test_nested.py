"""Nested games and wide profiles against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mound.operators import nested as N
from mound.operators import profile as PR
from mound.operators import subsets as L

COLS = "game_date string, home_team string, away_team string, game_pk long, pitch_number int, pitcher long, events string, description string"


def rows_of(seed, hot):
    rng = random.Random(seed)
    small = [(f"d{rng.randint(0, 9)}", rng.choice(["A", "B", None]), "C", rng.randint(1, 3), rng.randint(1, 9), rng.choice([7, 8, None]),
              rng.choice([None, "out"]), "x") for _ in range(200)]
    return small + [("d5", "H", "C", 9, i % 700, 1, None, str(i)) for i in range(hot)]


def key_order(v):
    return tuple((x is not None, x if x is not None else 0) for x in v)


@pytest.mark.parametrize("chunk", [1, 7, 50, 10_000])
def test_games_in_chunks(spark, chunk):
    """A hot game lies in several tasks and chunks; every pitch is there once, in order."""
    rows = rows_of(1, 3000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = N.game_pitches(spark.createDataFrame(rows, COLS).repartition(9), chunk=chunk).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    games = {}
    for r in rows:
        games.setdefault(r[:3], []).append(r[3:])
    found = {}
    for r in got:
        assert r.n_pitches == len(r.pitches) <= chunk
        found.setdefault((r.game_date, r.home_team, r.away_team), []).append(r)
    assert set(found) == set(games)
    for key, chunks in found.items():
        chunks.sort(key=lambda r: r.chunk_no)
        assert [r.chunk_no for r in chunks] == list(range(1, len(chunks) + 1))
        flat = [tuple(p) for r in chunks for p in r.pitches]
        assert flat == sorted(games[key], key=key_order)
        at = 1
        for r in chunks:
            assert r.first_pitch == at
            at += r.n_pitches
    assert len(found["d5", "H", "C"]) >= math.ceil(3000 / chunk)


def test_no_pitches(spark):
    assert N.game_pitches(spark.createDataFrame([], COLS)).count() == 0


def test_correlations_of_many_columns(spark):
    rng = np.random.default_rng(2)
    p, n = 30, 500
    x = rng.normal(size=(n, p)) @ rng.normal(size=(p, p)) + 1e6 * rng.normal(size=p)
    gone = rng.random((n, p)) < 0.2
    gone[:, 3] = True
    gone[:, 4] = np.arange(n) > 0  # one value
    x[:, 5] = 7.0  # does not vary
    names = [f"c{i}" for i in range(p - 2)] + ["a", "n.m"]
    data = [tuple(None if g else float(v) for v, g in zip(xs, gs, strict=True)) for xs, gs in zip(x, gone, strict=True)]
    df = spark.createDataFrame(data, ", ".join(f"`{c}` double" for c in names)).repartition(7)
    got = {(r.col_a, r.col_b): r.r for r in PR.correlations(df, names).collect()}
    assert len(got) == p * (p - 1) // 2
    for i in range(p):
        for j in range(i + 1, p):
            both = ~gone[:, i] & ~gone[:, j]
            r = got[names[i], names[j]]
            if both.sum() < 2:
                assert r is None
            elif 5 in (i, j):
                assert math.isnan(r)
            else:
                assert abs(r - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-7
    small = df.select(F.col("c0"), F.col("c1"), F.when(F.col("c0") > F.lit(float(x[0, 0])), float("nan")).otherwise(F.col("c2")).alias("c2"))
    odd = {(r.col_a, r.col_b): r.r for r in PR.correlations(small, ["c0", "c1", "c2"]).collect()}
    assert math.isnan(odd["c0", "c2"]) and math.isnan(odd["c1", "c2"]) and abs(odd["c0", "c1"] - got["c0", "c1"]) < 1e-9
    assert [r.r for r in PR.correlations(df.limit(0), names[:3]).collect()] == [None] * 3
    assert PR.correlations(df, names[:1]).count() == 0


def test_sketches_merge(spark):
    df = spark.range(30_000).select((F.col("id") % 5).cast("int").alias("season"), (F.col("id") % 9000).alias("a"),
                                    F.concat(F.lit("x"), F.col("id") % 50).alias("b"), F.lit(None).cast("string").alias("c"), (F.col("id") / 4).alias("d"))
    sketches = PR.distinct_sketches(df, ["a", "b", "c", "d"], "season")
    assert sketches.count() == 20
    for lo, hi in ((0, 4), (1, 2), (3, 3)):
        exact = {r.column_name: r.n_distinct for r in PR.distinct_counts(df.where(F.col("season").between(lo, hi)), ["a", "b", "c", "d"]).collect()}
        for r in PR.estimate_distinct(sketches, "season", lo, hi).collect():
            assert abs(r.n_estimate - exact[r.column_name]) <= 0.05 * exact[r.column_name]


def test_random_subset(spark, monkeypatch):
    rows = [(i, f"r{i % 300}") for i in range(2000)] + [(None, None)] * 3 + [(5, "same")] * 500
    df = spark.createDataFrame(rows, "a long, b string")
    first = sorted(map(str, L.random_subset(df, 700, seed=1).collect()))
    assert len(first) == 700 and first == sorted(map(str, L.random_subset(df.repartition(13), 700, seed=1).collect()))
    assert first != sorted(map(str, L.random_subset(df, 700, seed=2).collect()))
    assert L.random_subset(df, 0).count() == 0 and L.random_subset(df, 10**6).count() == len(rows)
    monkeypatch.setattr(L, "_SETTLE", 2)  # equal rows beyond what is sorted
    assert first == sorted(map(str, L.random_subset(df, 700, seed=1).collect()))
    equal = spark.createDataFrame([(1, "x")] * 50, "a long, b string")
    assert L.random_subset(equal, 20).count() == 20
