import numpy as np

from conftest import pitch
from mound.dictionaries import PARK_FENCES
from mound.operators import parks as PK
from mound.operators import profile as PR
from mound.operators import subsets as L


def test_fence_segments_cover_fair_territory():
    rows = PK.fence_rows(PARK_FENCES)
    assert rows[0][3] == -45.0 and abs(rows[-1][4] - 45.0) < 1e-9
    assert all(abs(a[4] - b[3]) < 1e-9 for a, b in zip(rows, rows[1:]))
    assert [r[5] for r in rows] == [329.0, 374.0, 409.0, 381.0, 387.0, 369.0, 330.0]


def test_fence_check(spark):
    fences = PK.fence_frame(spark, PARK_FENCES)
    balls = spark.createDataFrame(
        [("PHI", -44.0, 330.0), ("PHI", -44.0, 300.0), ("PHI", 0.0, 420.0), ("PHI", 60.0, 500.0), ("NYY", 0.0, 500.0)],
        "park string, spray_angle double, distance_ft double")
    out = [(r.park, r.spray_angle, r.segment, r.over_fence) for r in
           PK.fence_check(balls, fences).orderBy("park", "spray_angle", "distance_ft").collect()]
    assert out == [("NYY", 0.0, None, None), ("PHI", -44.0, "Left-Field Foul Pole", False),
                   ("PHI", -44.0, "Left-Field Foul Pole", True), ("PHI", 0.0, "Monty's Angle", True),
                   ("PHI", 60.0, None, None)]


def test_pitcher_stats(make_pitches):
    p = make_pitches([
        pitch("2023-04-01", 1, 1, "NYY", "BOS", "Top", "strikeout", "called_strike", "S", pitcher=7),
        pitch("2023-04-01", 1, 2, "NYY", "BOS", "Top", None, "ball", "B", pitcher=7),
        pitch("2023-04-01", 1, 3, "NYY", "BOS", "Top", "walk", "ball", "B", pitcher=7),
    ])
    r = PR.pitcher_stats(p, keys=("pitcher",)).collect()[0]
    assert (r.pitches, r.strikeouts, r.strikes, r.balls, r.walks, r.plate_appearances) == (3, 1, 1, 2, 1, 2)
    assert r.balls_per_pa == 1.0


def test_correlations_match_numpy(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=200)
    b = a * 0.5 + rng.normal(size=200)
    c = rng.normal(size=200)
    rows = [(float(x), float(y), None if i % 10 == 0 else float(z)) for i, (x, y, z) in enumerate(zip(a, b, c))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.r for r in PR.correlations(df, ["a", "b", "c"]).collect()}
    mask = np.array([i % 10 != 0 for i in range(200)])
    assert abs(got[("a", "b")] - np.corrcoef(a, b)[0, 1]) < 1e-9
    assert abs(got[("a", "c")] - np.corrcoef(a[mask], c[mask])[0, 1]) < 1e-9


def test_distinct_counts(spark):
    df = spark.createDataFrame([("x", 1), ("y", 1), (None, 2)], "s string, n int")
    got = {r.column_name: r.n_distinct for r in PR.distinct_counts(df, ["s", "n"]).collect()}
    assert got == {"s": 2, "n": 2}
    approx = {r.column_name: r.n_distinct for r in PR.distinct_counts(df, ["s", "n"], approx=True).collect()}
    assert approx == got


def test_preview_total_order(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b"), (1, "b")], "k int, v string")
    assert [tuple(r) for r in L.preview(df, ["k", "v"], 3).collect()] == [(1, "a"), (1, "b"), (2, "b")]
