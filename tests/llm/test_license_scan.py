import random
import re

from pyspark.sql import functions as F

from docs_fixture import make_docs  # noqa: F401
from mound.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    starts, labels = [], set()
    for phrase, label in L.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def test_base_matches_brute_force(spark, make_docs):
    rng = random.Random(2)
    bits = ["under", "the", "MIT", "license", "License,", "apache", "version", "2", "cc", "by", "nc", "Under the MIT License.",
            "CC-BY-NC", "CC BY NC 4.0", "Apache License, Version 2.0", "é", "łé", "\x7f", "İ", "x_y"]
    texts = [None, "", "cc by nc cc by nc", "xcc by nc", "cc by ncé"]
    texts += [rng.choice([" ", "-", "\n\n"]).join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    texts.append("under the mit license " * 20_000)
    docs = make_docs(list(enumerate(texts)))
    for r in docs.select("text", L.scan_licenses(F.col("text")).alias("r")).collect():
        assert (r.r.n_words, r.r.n_base, r.r.first_word, r.r.last_word, r.r.base_labels) == brute(r.text), r.text
        assert set(filter(None, r.r.base_labels.split(","))) <= set(r.r.labels.split(",")) and 0 <= r.r.score <= 1
    assert docs.limit(0).select(L.scan_licenses(F.col("text"))).count() == 0


def test_expressions():
    f = frozenset
    assert L.choices("MIT OR Apache-2.0") == {f(["mit"]), f(["apache-2"])}
    assert L.choices("MIT OR Apache-2.0 AND ISC") == {f(["mit"]), f(["apache-2", "isc"])}
    assert L.choices("(MIT OR Apache-2.0) AND ISC") == {f(["mit", "isc"]), f(["apache-2", "isc"])}
    assert L.choices("GPL-2.0-only WITH Classpath-exception-2.0 AND MIT") == {f(["gpl-2 with classpath-exception-2.0", "mit"])}
    assert L.choices("MIT AND") == {f(["mit"])} == L.choices("MIT and some words") - {f(["mit", "some"])} | {f(["mit"])}
    assert L.choices("") == set() == L.choices(") MIT")
    assert L.to_postfix("a or b and c with d".split()) == "a b c d with and or".split()


def test_tag(spark, make_docs):
    r = make_docs([(1, "# SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND ISC\nprose")]).select(
        L.scan_licenses(F.col("text")).alias("r")).collect()[0].r
    assert r.labels == "gpl-2,isc,mit" and r.choices == ["gpl-2 and isc", "isc and mit"] and r.n_base == 0


def test_tags_of_prose(spark, make_docs):
    want = {
        "# é License: GPL-2.0-or-later\nMIT": ("gpl-2", ["gpl-2"]),
        "Licensed under MIT OR Apache-2.0.": ("apache-2,mit", ["apache-2", "mit"]),
        "é licensed  under the (MIT or Foo-1.0) and ISC, at will": ("foo-1.0,isc,mit", ["foo-1.0 and isc", "isc and mit"]),
        "license : GPL-2.0-only WITH Classpath-exception-2.0 AND MIT": ("gpl-2,mit", ["gpl-2 with classpath-exception-2.0 and mit"]),
        "License: MIT and some words; LICENSE: ISC": ("isc,mit", ["isc", "mit"]),
        "Licensed under some terms. License: see the file. A license MIT": ("", []),
        "license: " * 3000: ("", []),
    }
    docs = make_docs(list(enumerate(want)))
    for r in docs.select("text", L.scan_licenses(F.col("text")).alias("r")).collect():
        assert (r.r.labels, r.r.choices) == want[r.text], r.text


def test_many_clauses_and_notices():
    import time

    automaton = L._automaton(tuple(L.BASE_PHRASES.items()))
    began = time.time()
    clauses = " and ".join(f"(lic{i}a1 or lic{i}b1)" for i in range(1000))
    row = L._scan(f"SPDX-License-Identifier: {clauses}", automaton)
    assert len(row[7]) == 1 and "lic999b1" in row[5].split(",") and len(row[5].split(",")) == 2000
    assert len(L.choices("(a or b) and (c or d) and (e or f)")) == 8
    same = L.choices(" and ".join(["(mit or isc)"] * 40))
    assert len(same) == 3
    text = "x under the mit license y " * 400_000  # 10 MB
    row = L._scan(text, automaton)
    assert row[:4] == (2_400_000, 400_000, 1, 399_999 * 6 + 1)
    assert time.time() - began < 20
