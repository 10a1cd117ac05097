import hashlib
import random

import numpy as np
from docs_fixture import make_docs  # noqa: F401
from pyspark.sql import functions as F

from mound.llm import bwt_dedup as B


def brute(docs, least=50):
    """(n_bytes, n_removed, n_spans, kept) of each document; docs: (id, text)."""
    raw = [(np.inf if i is None else i, (t or "").encode()) for i, t in docs]
    first = {}
    for i, b in raw:
        for p in range(len(b) - least + 1):
            w = b[p:p + least]
            first[w] = min(first.get(w, np.inf), i)
    out = []
    for i, b in raw:
        gone = [False] * len(b)
        for p in range(len(b) - least + 1):
            if first[b[p:p + least]] < i:
                gone[p:p + least] = [True] * least
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    words = ["the", "of", "ñandú", "naïve", "x", "reading", "über", "漢字", "zebra", "walk"]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(8, 40))) for _ in range(8)]
    texts = [None, "", "a" * 49, "a" * 50, "a" * 400, "b" * 120 + "a" * 60, "ab" * 100]
    for _ in range(n):
        bits = []
        for _ in range(rng.randint(1, 6)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            bits.append(rng.choice([p, p[a:], p[:a], " ".join(rng.choice(words) for _ in range(rng.randint(1, 25)))]))
        texts.append(rng.choice([" ", "", "\n"]).join(bits))
    texts += texts[10:20]
    rng.shuffle(texts)
    return list(enumerate(texts))


def run(df, **kw):
    rows = B.remove_repeats(df, **kw).collect()
    return [(r.row.doc_id, (r.cut.n_bytes, r.cut.n_removed, r.cut.n_spans, bytes(r.cut.kept))) for r in rows]


def test_matches_brute_force_over_many_blocks(spark, make_docs):
    docs = corpus()
    assert dict(run(make_docs(docs).repartition(5), block=1500)) == dict(zip([i for i, _ in docs], brute(docs), strict=True))
    assert sum(b[1] for b in brute(docs)) > 1000


def test_one_block_and_other_lengths(spark, make_docs):
    docs = corpus(2, 30)
    for least in (40, 64):
        want = dict(zip([i for i, _ in docs], brute(docs, least), strict=True))
        assert dict(run(make_docs(docs), least=least)) == want


def test_hot_anchors_taken_apart(spark, make_docs):
    docs = corpus(3)
    want = dict(zip([i for i, _ in docs], brute(docs), strict=True))
    for most in (0, 3, 20):
        assert dict(run(make_docs(docs).repartition(5), block=1500, most=most)) == want


def test_windows_of_a_hot_anchor_spread_over_the_parts(spark, make_docs):
    rng = random.Random(5)
    own = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    line = "this line of forty bytes is everywhere.."
    texts = [own(60) + line + own(60) for _ in range(300)]
    docs = list(enumerate(texts + [t[30:] for t in texts[:40]]))
    parts, most = 8, 50
    blocks = B.pack_blocks(make_docs(docs).selectExpr("doc_id id", "text", "'' carried"), 4000).cache()
    shared = B.shared_anchors(blocks, parts, 50, most).cache()
    rows = {r.block: r.shared for r in shared.collect()}
    assert any(r.hot for rs in rows.values() for r in rs)
    strings = {}
    for r in blocks.collect():
        for part, _, _, _, known, _ in B.Block.unpack(r.docs, 50)[0].stretches(parts, rows.get(r.block, [])):
            strings.setdefault(part, set()).update(known)
    sizes = [len(strings.get(p, ())) for p in range(parts)]
    assert sum(sizes) > 3000 and max(sizes) < 1.5 * sum(sizes) / parts
    assert dict(run(make_docs(docs), block=4000, most=most)) == dict(zip([i for i, _ in docs], brute(docs), strict=True))


def test_edges(spark, make_docs):
    assert B.digest(make_docs([(1, "x")]).limit(0)).count() == 0
    text = "some passage that is clearly longer than fifty bytes, is it not?"
    docs = [(None, text), (3, text), (3, text + "!"), (2, "no"), (None, None), (9, "x" + text + "y" * 60 + text)]
    key = lambda x: (str(x[0]), x[1])
    assert sorted(run(make_docs(docs)), key=key) == sorted(zip([i for i, _ in docs], brute(docs), strict=True), key=key)
    none = {r.n_removed: r for r in B.digest(make_docs([(1, None)])).collect()}[0]
    assert none.kept_sha256 == hashlib.sha256(b"").hexdigest() and none.n_bytes == 0


def test_carried_columns(spark, make_docs):
    df = make_docs([(1, "a"), (2, "b")]).withColumn("block", F.lit("k")).withColumn("kept", F.lit(2.5)).withColumn("n", F.lit(None).cast("int"))
    rows = B.remove_repeats(df).orderBy("row.doc_id").collect()
    assert [(r.row.doc_id, r.row.block, r.row.kept, r.row.n, r.row.lang, bytes(r.cut.kept)) for r in rows] == [
        (1, "k", 2.5, None, "en", b"a"), (2, "k", 2.5, None, "en", b"b")]


def test_intervals_match_common_prefixes():
    rng = random.Random(7)
    text = np.array([rng.choice([1, 2, 3, 0]) for _ in range(500)] + [2] * 60, np.int16)
    for least in (1, 2, 7, 30):
        order, interval = B.equal_windows(text, least)
        s = [tuple([*text[p:p + least].tolist(), *[0] * (least - len(text[p:p + least]))]) for p in order]
        assert s == sorted(s)
        for j in range(1, len(s)):
            if max(order[j], order[j - 1]) + least <= len(text):
                assert (interval[j] == interval[j - 1]) == (s[j] == s[j - 1])


def test_extension_begins_at_the_ranks_of_the_doubling(monkeypatch):
    rng = random.Random(8)
    text = np.array(([rng.choice([1, 2, 3]) for _ in range(300)] + [0]) * 3, np.int16)
    _, rank, ranked = B.suffix_order(text, 50)
    assert ranked == 32
    prefix = lambda p: tuple(text[p:p + 32])
    places = range(len(text) - 32)
    assert {(rank[p] == rank[q], prefix(p) == prefix(q)) for p in places for q in (0, 7, 301, 308, 602)} == {(True, True), (False, False)}
    # 18 rounds are left of 49: the numbers of intervals are summed up once a round, and once at the end
    sums = []
    summed = np.cumsum
    monkeypatch.setattr(B.np, "cumsum", lambda x, *a, **k: sums.append(1) or summed(x, *a, **k))
    B.equal_windows(text, 50)
    assert len(sums) <= 4 + 18 + 1


def test_kept_as_text_is_cut_at_whole_characters(spark, make_docs):
    docs = [(1, "漢" * 30 + "x"), (2, "é漢" + "漢" * 29 + "字"), (3, None)]
    rows = {r.row.doc_id: r.cut for r in B.remove_repeats(make_docs(docs), as_text=True).collect()}
    binary = {r.row.doc_id: r.cut for r in B.remove_repeats(make_docs(docs)).collect()}
    assert all(rows[k].kept == bytes(binary[k].kept).decode("utf-8", "ignore") and rows[k].n_removed == binary[k].n_removed for k in binary)
    assert rows[2].n_removed > 0 and rows[3].kept == ""
