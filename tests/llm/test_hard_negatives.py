import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mound.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def brute(rows, anchor, positives=5, negatives=5, least=80):
    good = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        good.append((i, ints, label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out = []
    for i, v, label in sorted(set(r for r in good if anchor(r[0]))):
        others = [(-dot(v, w), j, m) for j, w, m in good if len(w) == len(v)]
        for s, j, _ in sorted((s, j, m) for s, j, m in others if m == label and j != i)[:positives]:
            fits = sorted((t, k) for t, k, m in others if m != label and least * -s <= 100 * -t <= 100 * -s)[:negatives]
            out += [(i, j, n, k, -s, -t) for n, (t, k) in enumerate(fits, 1)]
    return sorted(out)


def rows_of(seed, n=300, d=8, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(d)] for _ in range(4)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        out.append((i, [x + 0.4 * rng.gauss(0, spread) for x in c], rng.randint(0, 3)))
    return out + [(n + i, out[7][1], rng.randint(0, 3)) for i in range(40)]  # many equal scores


def mined(spark, rows, modulus=10, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % modulus == 0, **more).collect())


@pytest.mark.parametrize("spread", [0.01, 1.0, 3000.0])
def test_against_brute_force(spark, spread):
    """From narrow fields to scores of more than 32 bits."""
    rows = rows_of(1, spread=spread)
    got = mined(spark, rows)
    assert got and got == brute(rows, lambda i: i % 10 == 0)


def test_many_strips_and_blocks_give_the_same(spark):
    rows = rows_of(2)
    assert mined(spark, rows, strip=40, block=7) == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    rows = rows_of(3, 60) + [(1000, None, 1), (1010, [1.0] * 7 + [None], 1), (1020, [NAN] * 8, 1), (1030, [INF] * 8, 1), (None, [1.0] * 8, 1),
                             (1040, [1.0] * 8, None), (1050, [0.0] * 8, 2), (1060, [], 1), (1070, [], 2), (1080, [1.0, 2.0], 1), (1081, [1.0, 2.0], 1),
                             (1082, [1.0, 1.9], 2), (10, [0.1] * 8, 3), (10, [0.1] * 8, 3), (20, [0.2] * 8, 0)]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 10 == 0)
    assert {r[0] for r in got} >= {1080}
    # a vector whose scores leave 64 bits takes no part
    assert mined(spark, rows + [(1090, [1e30] * 8, 1)]) == got


def test_empty_and_extra_columns(spark):
    assert mined(spark, []) == []
    rows = rows_of(4, 50)
    df = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], SCHEMA + ", strip int, v string")
    got = sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % 10 == 0).collect())
    assert got == brute(rows, lambda i: i % 10 == 0)


def test_packed_scores():
    rng = np.random.default_rng(5)
    for most in (1, 200, 70_000, 2**30):
        rows, anchors = rng.integers(-most, most + 1, (37, 5)), rng.integers(-most, most + 1, (6, 5))
        packed = H.Packed(rows, int(anchors.min()), int(anchors.max()))
        assert (packed.scores(anchors).astype(object) == anchors.astype(object) @ rows.T.astype(object)).all()
        assert packed.fields >= 2
