import random

import numpy as np
import pytest
from docs_fixture import make_docs  # noqa: F401
from pyspark.sql import functions as F

from mound.llm import probminhash as M
from mound.llm.components import components


def plain_jaccard(a, b):
    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 0.0


def plain_components(texts):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            a, b = texts[i] or "", texts[j] or ""
            if (a.split() and a == b) or plain_jaccard(a, b) >= 0.8:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", "  \n", "one", "ONE", "a b c d", "a b c d", "a b c e", "x " * 3000]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(20, 200))]
        if rng.random() < 0.5:
            base += passage
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            near = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            base = near if rng.random() < 0.3 else base
            texts.append(" ".join(near))
    rng.shuffle(texts)
    return texts


def test_components_match_brute_force(spark, make_docs):
    texts = corpus()
    got = {r.doc_id: r for r in M.near_duplicates(make_docs(list(enumerate(texts)))).collect()}
    want = plain_components(texts)
    assert [got[i].component_id for i in range(len(texts))] == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())
    kept = {r.doc_id for r in M.deduplicate(make_docs(list(enumerate(texts)))).collect()}
    assert kept == {i for i, c in enumerate(want) if c == i}


def test_crowded_bucket(spark, make_docs, monkeypatch):
    """Texts that share a bucket but not a class are all decided, over several rounds."""
    rng = random.Random(3)
    texts = [" ".join(f"g{g}x{i}" if i != 7 or k == 0 else f"k{k}" for i in range(60)) for g in range(12) for k in range(3)]
    rng.shuffle(texts)
    docs = make_docs(list(enumerate(texts)))
    bands = docs.select(M.text_key(F.col("text")).alias("t"), F.array(F.lit(1).cast("long")).alias("bands"))
    links = M.linked_texts(bands, docs.select(M.text_key(F.col("text")).alias("t"), "text"))
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).collect()
    assert len({r.root for r in roots}) == 12 and len(roots) == 36


def test_bridge_beside_a_large_group(spark, make_docs):
    """A text that left its bucket with a hub is still compared with those of other components."""
    base = [f"b{i}" for i in range(204)]
    bridge = base[:-16] + [f"t{i}" for i in range(16)]
    edge = [f"u{i}" for i in range(16)] + bridge[16:]
    texts = [" ".join(w) for w in (edge, bridge, *([*base, f"g{k}"] for k in range(300)), [f"o{i}" for i in range(50)])]
    assert plain_jaccard(texts[0], texts[1]) >= 0.8 <= plain_jaccard(texts[1], texts[2]) and plain_jaccard(texts[0], texts[2]) < 0.8
    docs = make_docs(list(enumerate(texts)))
    bands = docs.select(M.text_key(F.col("text")).alias("t"), F.array(F.lit(1).cast("long")).alias("bands"))
    links = M.linked_texts(bands, docs.select(M.text_key(F.col("text")).alias("t"), "text"))
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).collect()
    assert len({r.root for r in roots}) == 1 and len(roots) == 302


def test_texts_of_several_components_meet(spark):
    """Texts of one bucket and different components meet in a group that compares them, however the bucket is cut into blocks."""
    rng = random.Random(4)
    root = {t: rng.choice([0, 0, 0, 1, 2]) for t in range(40)}
    buckets = [(key, t) for key in range(3) for t in root if rng.random() < 0.8] + [(9, t) for t in root if root[t] == 0]
    held = {k: [t for key, t in buckets if key == k] for k, _ in buckets}
    want = {(k, a, b) for k, ts in held.items() for a in ts for b in ts if a < b and root[a] != root[b]}
    rows = spark.createDataFrame([(k, t, 10) for k, t in buckets], "key long, t long, n long")
    for block in (3, 500):
        groups = {}
        for r in M.across_components(rows, spark.createDataFrame(list(root.items()), "vertex long, root long"), block).collect():
            groups.setdefault((r.key, r.i, r.j), []).append(r)
        met = [(k[0], min(a.t, b.t), max(a.t, b.t)) for k, rs in groups.items() for a in rs if a.hub for b in rs
               if b.other and a.root != b.root and (b.main or b.t > a.t)]
        assert len(met) == len(want) and set(met) == want


@pytest.mark.parametrize("block, first", [(4, 1), (4, 4), (1000, 1), (1000, 10**9)])
def test_links_join_what_buckets_hold(spark, make_docs, block, first):
    """Components of the links are those of all similar pairs that share a bucket, for any blocks and any order of buckets."""
    rng = random.Random(block + first)
    words = [f"v{i}" for i in range(60)]
    texts = []
    for _ in range(9):
        base = [rng.choice(words) for _ in range(60)]
        for _ in range(rng.randint(2, 9)):
            near = list(base)
            near[rng.randrange(60)] = f"n{len(texts)}"
            base = near if rng.random() < 0.5 else base
            texts.append(" ".join(near))
    texts += ["k k k k k k", "k k k k k", "one two"]
    keys = [sorted(rng.sample(range(6), 2)) for _ in texts]
    docs = make_docs(list(enumerate(texts)))
    bands = spark.createDataFrame([(t, k) for t, k in zip(texts, keys)], "text string, bands array<long>")
    bands = bands.select(M.text_key(F.col("text")).alias("t"), "bands")
    links = M.linked_texts(bands, docs.union(docs).select(M.text_key(F.col("text")).alias("t"), "text"), block=block, first=first)
    names = {bytes(r.t): i for i, r in enumerate(bands.select("t").collect())}
    root = list(range(len(texts)))

    def find(i):
        return i if root[i] == i else find(root[i])
    pairs = [(names[bytes(r.a)], names[bytes(r.b)]) for r in links.collect()]
    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = [find(i) for i in range(len(texts))]
    root[:] = range(len(texts))
    for a in range(len(texts)):
        for b in range(a):
            if set(keys[a]) & set(keys[b]) and plain_jaccard(texts[a], texts[b]) >= 0.8:
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert got == [find(i) for i in range(len(texts))]


def test_signature_estimates_probability_jaccard():
    a = "p q r s t u v w x y z " * 3 + " ".join(f"a{i}" for i in range(40))
    b = "p q r s t u v w x y z " + " ".join(f"a{i}" for i in range(50))
    owner, h, n = M.weighted_shingles([a, b])
    wa, wb = ({k: 1 + np.log(c) for k, c in zip(h[owner == i], n[owner == i], strict=True)} for i in (0, 1))
    exact = sum(1 / sum(max(wa.get(j, 0) / wa[i], wb.get(j, 0) / wb[i]) for j in {*wa, *wb}) for i in wa if i in wb)
    s = M.signatures([a, b], slots=4000)
    assert np.mean(s[0] == s[1]) == pytest.approx(exact, abs=0.03)
    assert (M.signatures([a, "", b], slots=4000)[[0, 2]] == s).all()  # a text's signature is its own


def test_repeats_in_one_text_only():
    """Pairs of set Jaccard 0.8, twenty of whose common shingles stand 500 times in one text only, share a band."""
    for n in range(40):
        line = " ".join(f"p{n}x{i}" for i in range(20))
        rest = [f"c{n}x{i}" for i in range(184)]
        a = " ".join([line] * 500 + rest)
        b = " ".join([line, line, *rest[:-12], *(f"d{n}x{i}" for i in range(12))])
        assert 0.8 <= plain_jaccard(a, b) < 0.9
        x, y = M.all_band_keys([a, b])
        assert len(np.intersect1d(x, y)), n
        x, y = (M.band_keys(M.signatures([t], equal=True))[0].view(np.int64) for t in (a, b))
        assert set(x.tolist()) <= set(M.all_band_keys([a])[0].tolist()) and set(y.tolist()) <= set(M.all_band_keys([b])[0].tolist())


def test_edges(spark, make_docs):
    assert M.near_duplicates(make_docs([(1, "x")]).limit(0)).count() == 0
    docs = make_docs([(None, "same text"), (5, "same text"), (5, "same text"), (5, "other"), (None, None), (None, "alone")])
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in M.near_duplicates(docs).collect())
    assert got == [("5", "5", True)] * 3 + [("None", "5", False)] + [("None", "None", True)] * 2
    assert M.deduplicate(docs).count() == 5
    extra = make_docs([(1, "b c"), (2, "b c")]).withColumn("t", F.lit(3)).withColumn("kept", F.lit("k")).withColumn("key", F.lit(1))
    assert [(r.doc_id, r.t, r.kept) for r in M.deduplicate(extra).collect()] == [(1, 3, "k")]


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(3, 3), (200, 201), (201, 200)]
    got = {r.vertex: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 60)} | {200: 200, 201: 200}
