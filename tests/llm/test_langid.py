import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from docs_fixture import make_docs  # noqa: F401
from mound.llm import langid as L

SF_SMALL = "/root/testdata/sf0.001"


def plain_grams(text):
    out, prev = ["   "], False
    for c in text.lower():
        if c.isalpha():
            out.append(c)
        elif prev:
            out.append(" ")
        prev = c.isalpha()
    s = "".join(out)
    return [s[i - 3:i + 1] for i in range(3, len(s))]


def unpack(gram):
    return "".join(chr((int(gram) >> 16 * k) & 0xFFFF) for k in (3, 2, 1, 0))


def test_grams():
    texts = ["", "Ab, c!", "É--x", "123", "漢字 a𝄞b", "...lead"]
    grams, owner = L.grams_of(texts)
    for i, t in enumerate(texts):
        assert [unpack(g) for g in grams[owner == i]] == plain_grams(t), t


def plain_kn(texts):
    """Textbook interpolated Kneser-Ney over dictionaries."""
    counts = {4: Counter(g for t in texts for g in plain_grams(t))}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    disc, total, types = {}, defaultdict(Counter), defaultdict(Counter)
    for k, c in counts.items():
        disc[k] = L._discount(np.array(list(c.values())))
        for g, n in c.items():
            total[k][g[:-1]] += n
            types[k][g[:-1]] += 1

    def p(g, alphabet):
        k = len(g)
        if not k:
            return 1 / alphabet
        lower, h = p(g[1:], alphabet), g[:-1]
        if not total[k][h]:
            return lower
        return max(counts[k][g] - disc[k], 0) / total[k][h] + disc[k] * types[k][h] / total[k][h] * lower
    return p, set(counts[1])


def test_model_is_kneser_ney():
    rng = random.Random(1)
    data = {"a": ["".join(rng.choice("abc de") for _ in range(60)) for _ in range(20)],
            "b": ["".join(rng.choice("xyzab  e") for _ in range(60)) for _ in range(15)]}
    rows = [(lang, int(np.uint64(g).view(np.int64)), n) for lang, texts in data.items()
            for g, n in zip(*np.unique(L.grams_of(texts)[0], return_counts=True), strict=True)]
    model = L.build_model(pd.DataFrame(rows, columns=["lang", "gram", "n"]))
    plain = {lang: plain_kn(texts) for lang, texts in data.items()}
    alphabet = len(set.union(*[letters for _, letters in plain.values()])) + 1
    text = "abc dea xyz qq bad"
    grams, _ = L.grams_of([text])
    logs = model.log_probabilities(grams)
    for row, g in zip(logs, plain_grams(text), strict=True):
        for j, lang in enumerate(model.langs):
            assert row[j] == pytest.approx(math.log(plain[lang][0](g, alphabet)), abs=1e-4)
    sums = [sum(plain["a"][0]("abc"[:3] + c, alphabet) for c in "abcdexyz ") for _ in (0,)]
    assert sums[0] < 1 + 1e-9


def test_accuracy_on_held_out(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = L.fit(docs.filter(~L.held_out(F.col("doc_id"))))
    rows = docs.select("lang", "text", "doc_id", L.held_out(F.col("doc_id")).alias("h"), L.predict(F.col("text"), model, spark).alias("p")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.h and r.lang]
    assert sum(r.lang == r.p.lang_pred for r in held) >= 0.97 * len(held)
    assert not any(r.p.rejected for r in rows) and all(0 <= r.p.score <= 1 for r in rows)


def test_rejects_strange_text(spark, make_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = L.fit(docs)
    rng = random.Random(2)
    strange = "".join(rng.choice("qxzjkvwŋœøłžđ ") for _ in range(400))
    texts = [None, "", "12 34 ...", strange, "漢字" * 100, "Zx"]
    got = make_docs(list(enumerate(texts))).select("text", L.predict(F.col("text"), model, spark).alias("p")).collect()
    assert [(r.p.lang_pred == "und", r.p.rejected) for r in got] == [(True, True)] * 3 + [(False, True), (False, True), (False, False)]


def test_edges(spark, make_docs):
    none = make_docs([(1, "abc", None), (2, None, "en")])
    assert L.fit(none) is None
    assert none.select(L.predict(F.col("text"), None, spark).alias("p")).collect()[0].p.lang_pred == "und"
    one = L.fit(make_docs([(1, "only one language here " * 4, "en")] * 3))
    r = make_docs([(1, "one language")]).select(L.predict(F.col("text"), one, spark).alias("p")).collect()[0].p
    assert r.lang_pred == "en" and not r.rejected


def test_model_bound(spark, make_docs):
    counts = L.gram_counts(make_docs([(i, f"word{chr(97 + i)} common common", "en") for i in range(20)]))
    kept = L._bounded(counts, 30)
    assert 0 < kept.count() <= 30
    assert kept.agg(F.min("n")).collect()[0][0] >= 2


def test_every_gram_is_kept(spark, make_docs):
    """A small language beside one of more than 600,000 grams of its own is still learned."""
    rng = random.Random(5)
    hot = [(i, "".join(map(chr, rng.choices(range(0x4E00, 0x9F00), k=1000))), "zh") for i in range(700)]
    small = "wolkig"  # every gram once
    model = L.fit(make_docs([*hot, (900, small, "de")]).repartition(4))
    assert model.langs == ["de", "zh"]
    got = make_docs([(1, small), (2, hot[3][1])]).select("doc_id", L.predict(F.col("text"), model, spark).alias("p")).collect()
    assert {r.doc_id: (r.p.lang_pred, r.p.rejected) for r in got} == {1: ("de", False), 2: ("zh", False)}


def test_shipped_model_is_the_model_in_memory(spark, make_docs):
    rng = random.Random(6)
    docs = [(i, "".join(rng.choices("abcdé \ud7a0漢" if i % 3 else "xyzab  e", k=300)), "a" if i % 3 else "b") for i in range(40)]
    counts = L.gram_counts(make_docs(docs))
    plain, shipped = L.build_model(counts.toPandas()), L.shipped_model(counts, part_grams=100)
    assert shipped.parts > 1 and shipped.langs == plain.langs and shipped.floor == pytest.approx(plain.floor)
    grams, _ = L.grams_of([t for _, t, _ in docs[:5]] + ["unseen qq ab漢漢漢x", "zzz"])
    assert shipped.log_probabilities(grams) == pytest.approx(plain.log_probabilities(grams), abs=1e-4)


def test_rejection_is_calibrated_on_every_text(spark, make_docs):
    """More texts than fit a sample of 20,000: a language's bound is the mean over all long enough texts of the others."""
    rng = random.Random(7)
    docs = [(i, "".join(rng.choices("abcd e" if i % 3 else "xyzab ", k=rng.choice((20, 45, 70)))), "a" if i % 3 else "b") for i in range(30_000)]
    model = L.fit(make_docs(docs).repartition(4))
    for j, lang in enumerate(model.langs):
        ce, n = model.cross_entropies([t for _, t, own in docs if own != lang])
        assert model.thresholds[j] == pytest.approx(ce[n >= L.LEAST_CHARS, j].mean(), rel=1e-6)
