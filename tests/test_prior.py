"""Point-in-time features and walk-forward folds against plain Python."""

import random

from conftest import pitch
from pyspark.sql import functions as F

from mound.operators import prior as P
from mound.plans import model as M


def log(seed=1, days=12):
    rng = random.Random(seed)
    rows, pk = [], 0
    for d in range(days):
        for _ in range(rng.randint(0, 4)):
            home, away = rng.sample("ABC", 2)
            pk += 1
            hs, as_ = rng.choice([None, 1, 2, 5]), rng.choice([0, 2, 3])
            for n in range(rng.randint(1, 6)):
                rows.append(pitch(f"2024-04-{d + 1:02d}", pk, n, home, away, rng.choice(["Top", "Bot"]), rng.choice(["strikeout", None]),
                                  speed=rng.choice([None, 80.0, 92.5]), hs=hs, as_=as_, pitcher=rng.choice([1, 2, 3, None])))
    return rows


def plain(rows):
    cols = ("date", "pk", "n", "pitcher", "home", "away", "half", "events")
    rows = [dict(zip(cols, r[:8], strict=True)) | {"speed": r[11], "hs": r[15], "as": r[16]} for r in rows]
    games = {}
    for r in rows:
        games.setdefault((r["date"], r["home"], r["away"]), []).append(r)
    top = lambda g, f: max((r[f] for r in g if r[f] is not None), default=None)
    scores = {k: (top(g, "hs"), top(g, "as")) for k, g in games.items()}
    out = {}
    for (day, home, away), g in games.items():
        row = []
        for team, half in ((home, "Top"), (away, "Bot")):
            earlier = [(scores[k] if k[1] == team else scores[k][::-1]) for k in games if team in k[1:] and k[0] < day]
            scored = [s for s in earlier if None not in s]
            row += [len(earlier), sum(a > b for a, b in scored), sum(a for a, _ in scored) / len(scored) if scored else None,
                    sum(b for _, b in scored) / len(scored) if scored else None]
            mine = sorted((r for r in g if r["half"] == half), key=lambda r: (r["n"], r["pitcher"] is not None, r["pitcher"] or 0))
            starter = mine[0]["pitcher"] if mine else None
            thrown = [r for r in rows if starter is not None and r["pitcher"] == starter and r["date"] < day]
            speeds = [r["speed"] for r in thrown if r["speed"] is not None]
            row += [starter, len(thrown), sum(r["events"] == "strikeout" for r in thrown), sum(speeds) / len(speeds) if speeds else None]
        out[day, home, away] = row
    return out


def test_prior_features(spark, make_pitches):
    rows = log()
    got = {}
    for r in P.prior_game_features(make_pitches(rows)).collect():
        got[r.game_date, r.home_team, r.away_team] = [r[f] for side in ("home", "away") for f in (
            f"{side}_games_before", f"{side}_wins_before", f"{side}_avg_runs_for", f"{side}_avg_runs_against", f"{side}_starter",
            f"{side}_starter_pitches", f"{side}_starter_strikeouts", f"{side}_starter_avg_speed")]
    assert got == plain(rows)


def test_no_feature_sees_its_own_day(spark, make_pitches):
    rows = log(2)
    last = max(r[0] for r in rows)
    changed = [(*r[:8], *r[8:11], None, r[12], r[13], r[14], 99, 0) if r[0] == last else r for r in rows]
    features = lambda rs: {(r.game_date, r.home_team, r.away_team): [r[f] for f in P.PRIOR_FEATURES] for r in
                           P.prior_game_features(make_pitches(rs)).collect()}
    assert features(rows) == features(changed)


def test_as_of(spark):
    left = spark.createDataFrame([("a", 3, 1), ("a", 3, 2), ("a", 9, 3), ("b", 1, 4), (None, 5, 5), ("a", None, 6), ("a", 1, 7)], "k string, t int, id int")
    right = spark.createDataFrame([("a", 1, 10, None), ("a", 3, 30, 3.0), ("a", 8, None, 8.0), ("c", 0, 1, 1.0)], "k string, t int, v int, w double")
    got = {r.id: (r.v, r.w) for r in P.as_of(left, right, "k", "t", ["v", "w"]).collect()}
    assert got == {1: (10, None), 2: (10, None), 3: (None, 8.0), 4: (None, None), 5: (None, None), 6: (None, None), 7: (None, None)}


def test_walk_forward(spark):
    rng = random.Random(3)
    rows = [(2020 + i % 4, x, rng.choice([0.0, 1.0, None]) if i % 9 == 0 else 0.5, int(x > 0.5)) for i in range(400) for x in [rng.random()]]
    df = spark.createDataFrame(rows + [(2019, 0.2, 0.1, 0)] * 3, "season int, x double, y double, home_win int")
    out = {r.test_season: r for r in M.walk_forward(df, ["x", "y"], num_trees=5).collect()}
    whole = [r for r in rows if r[2] is not None]
    assert sorted(out) == [2020, 2021, 2022, 2023]
    assert out[2020].accuracy is None and out[2020].train_rows == 3  # one label only
    for s in (2021, 2022, 2023):
        train = [r for r in whole if r[0] < s]
        assert (out[s].train_rows, out[s].train_positives) == (len(train) + 3, sum(r[3] for r in train))
        assert out[s].test_rows == sum(r[0] == s for r in whole) and out[s].accuracy > 0.9
    facts = M.fold_facts(df.dropna(subset=["x", "y"]))
    assert {r.test_season: r.test_positives for r in facts.collect()} == {s: out[s].test_positives for s in out}
    assert df.where(F.col("season") == 1).count() == 0


def test_pitchers_are_asked_for_once(spark, make_pitches, monkeypatch):
    written, asked = {}, []
    write, as_of = P.write_through, P.as_of
    monkeypatch.setattr(P, "write_through", lambda df, name: written.update({name: df}) or write(df, name))
    monkeypatch.setattr(P, "as_of", lambda left, right, key, *rest: asked.append(key) or as_of(left, right, key, *rest))
    P.prior_game_features(make_pitches(log(3))).collect()
    assert sorted(asked) == ["away_team", "home_team", "pitcher"]  # one pass over the pitchers for both sides
    assert "pitcher-days" not in written  # nor is a table of all pitchers' days written to be read again


def test_pitches_without_a_day_or_a_pitcher(spark, make_pitches):
    rows = [pitch(day, 1, n, "A", "B", "Top", pitcher=p) for day, n, p in (
        (None, 1, 5), (None, 2, 5), ("2024-04-01", 1, 5), ("2024-04-01", 2, 5), ("2024-04-02", 1, None), ("2024-04-03", 1, 5))]
    got = {r.game_date: (r.home_starter, r.home_starter_pitches) for r in P.prior_game_features(make_pitches(rows)).collect()}
    assert got == {None: (5, 0), "2024-04-01": (5, 0), "2024-04-02": (None, 0), "2024-04-03": (5, 4)}  # those without a day count with the first day


def test_running_totals_are_those_of_the_day(spark):
    days = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 2, 4.0), ("a", 3, None), ("b", None, 1.0), ("b", None, 2.0), ("b", 2, 8.0)], "k string, t int, v double")
    got = sorted((r.k, r.t, r.v) for r in P.running_totals(days, "k", "t", ["v"]).fillna(0, ["t"]).collect())
    assert got == [("a", 1, 1.0), ("a", 2, 7.0), ("a", 2, 7.0), ("a", 3, 7.0), ("b", 0, 3.0), ("b", 0, 3.0), ("b", 2, 11.0)]


def test_folds_at_once_score_as_one_by_one(spark, monkeypatch):
    import threading

    rng = random.Random(5)
    rows = [(2020 + i % 5, x, rng.random(), int(x + rng.random() > 1)) for i in range(600) for x in [rng.random()]]
    df = spark.createDataFrame(rows, "season int, x double, y double, home_win int").coalesce(2)
    fit, met = M.train_rf, threading.Barrier(2, timeout=60)
    alone = {r.test_season: r.accuracy for r in M.walk_forward(df, ["x", "y"], num_trees=5, at_once=1).collect()}
    monkeypatch.setattr(M, "train_rf", lambda *a, **k: met.wait() is None or fit(*a, **k))  # each waits for another
    assert {r.test_season: r.accuracy for r in M.walk_forward(df, ["x", "y"], num_trees=5, at_once=2).collect()} == alone
    assert sorted(alone) == [2021, 2022, 2023, 2024] and None not in alone.values()
