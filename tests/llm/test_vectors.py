import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mound.llm import cross_polytope as C
from mound.llm import vptree as V
from mound.llm.vectors import dots

SMALL = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")
ODD = [None, [], [0.0, 0.0], [1.0, None], [NAN, 1.0], [INF, 1.0]]


def unit(rng, d=16):
    v = [rng.gauss(0, 1) for _ in range(d)]
    n = math.sqrt(sum(x * x for x in v))
    return [x / n for x in v]


def near_copies(seed, groups=12, d=16):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = unit(rng, d)
        for _ in range(rng.randint(1, 8)):
            scale, noise = rng.choice([1.0, 1.0, 3.0]), rng.choice([0.0, 0.05, 0.1, 0.25])
            out.append([scale * (x + noise * rng.gauss(0, 1) / math.sqrt(d) * 2) for x in base])
    rng.shuffle(out)
    return out


def plain_links(rows):
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    cos = lambda a, b: len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.9
    links = {i: [j for j in good if j != i and i in good and cos(good[i], good[j])] for i, _ in rows}
    component = {}
    for i in sorted(links):
        if i not in component:
            stack = [i]
            while stack:
                x = stack.pop()
                if x not in component:
                    component[x] = i
                    stack += links[x]
    return {i: (len(links[i]), component[i]) for i in links}


def test_links_match_brute_force(spark):
    vectors = near_copies(1) + ODD + [[1.0, 0.0], [2.0, 0.0], [1e-30, 0.0], [3e38, 0.0]] + [[0.5] * 16] * 30
    rows = list(enumerate(vectors))
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumn("t", F.lit(1)).withColumn("n", F.lit(2))
    got = {r.vec_id: (r.n_links, r.component_id) for r in C.near_vectors(df).collect()}
    assert got == plain_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in C.near_vectors(df).collect())


def test_split_buckets(spark):
    """Buckets of many blocks count each link once."""
    rng = random.Random(2)
    base = unit(rng)
    vectors = [[x + 0.03 * rng.gauss(0, 1) for x in base] for _ in range(60)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "t long, vector array<double>").select(
        F.unhex(F.md5(F.col("t").cast("string"))).alias("t"), "vector", F.lit(1).cast("long").alias("n"))
    links = {bytes(r.t): r.links for r in C.linked_vectors(df, 60, block=7).groupBy("t").agg(F.sum("links").alias("links")).collect()}
    assert len(links) == 60 and set(links.values()) == {59}


@pytest.mark.parametrize("count, functions", [(10_000, 2), (1_000_000, 3), (100_000_000, 4)])
def test_recall_does_not_fall_with_the_number_of_vectors(spark, count, functions):
    """Pairs just above the cosine bound are found, with the functions that so many vectors get."""
    random = np.random.default_rng(8)
    a, b = random.standard_normal((2, 200, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9005 * a + math.sqrt(1 - 0.9005**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate([*a, *b])], "t long, vector array<double>").select(
        F.unhex(F.md5(F.col("t").cast("string"))).alias("t"), "vector", F.lit(1).cast("long").alias("n"))
    links = C.linked_vectors(df, count).groupBy("t").agg(F.sum("links").alias("links")).collect()
    assert len(links) == 400 and {r.links for r in links} == {1}
    assert C.function_count(count, 64) == functions


def test_near_vectors_edges(spark):
    assert C.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(None, [1.0, 0.0], 0), (4, [1.0, 0.0], 0), (4, [1.0, 0.01], 0), (None, None, 0)], SCHEMA)
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in C.near_vectors(df).collect())
    assert got == [("4", 2, "4", True)] * 2 + [("None", 0, "None", True), ("None", 2, "4", False)]


def test_recall_of_links(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in C.near_vectors(spark.read.parquet(f"{SMALL}/embeddings.parquet")).collect()}
    assert got == plain_links(rows)


def plain_nearest(rows, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if i % 20 == 0:
            found = sorted((-float(dots(v, w)), j) for j, w in good if j != i and len(w) == len(v))
            out[i] = [(r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return out


def as_lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_factor_one_is_exact(spark):
    rows = [(i, v) for i, v in enumerate(near_copies(3, 60) + [[0.25] * 16] * 70 + ODD + [[1.0, 2.0], [2.0, 1.0]])]
    rows = [(20 * i if i % 3 == 0 else 20 * i + 1, v) for i, v in rows] + [(None, [1.0] * 16)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumn("dim", F.lit("x"))
    got = as_lists(V.nearest(df, F.col("vec_id") % 20 == 0, k=5, relax=1.0, shard=60, block=20))
    want = {q: found for q, found in plain_nearest(rows, 5).items() if found}
    assert got == want
    assert V.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_with_the_production_factor(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    x = np.array([v for _, v in rows], np.float32).astype(float)
    ids = np.array([i for i, _ in rows])
    got = as_lists(V.nearest(df, F.col("vec_id") % 20 == 0, shard=512))
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        want = set(ids[np.argsort(-s, kind="stable")[:20]].tolist())
        hits += len(want & {j for _, j, _ in got[int(ids[q])]})
        total += 20
    assert hits >= 0.9 * total, hits / total


@pytest.mark.parametrize("relax", [1.0, V.RELAX])
def test_many_entries_of_one_score(spark, relax):
    """Ties go to smaller ids, however many entries share the k-th score."""
    rng = random.Random(6)
    others = [(i, [0.5, *[rng.uniform(-0.3, 0.3) for _ in range(6)], 0.0]) for i in range(1, 401)]
    rng.shuffle(others)
    rows = [(0, [1.0] + [0.0] * 7, 0), *[(i, v, 0) for i, v in others], (900, [0.75] + [0.0] * 7, 0)]
    got = V.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, relax=relax).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [900, *range(1, 20)] and all(r.score == 0.5 for r in got[1:])
