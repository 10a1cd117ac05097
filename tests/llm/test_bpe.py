import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docs_fixture import make_docs  # noqa: F401
from mound.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")


def fuzz(n=400):
    rng = random.Random(9)
    bits = [" ", "  ", "\n", "\t", " ", " ", "\x85", "\x1c", "the", "The", "tion", "'s", "'ll", "'", "12", "3", "é", "é", "漢", "😀", "###",
            "<|endoftext|>", "<|endo", "ñdoo", "x", ".", ", ", "a" * 50, "​", "ſ", "²", "﻿", "qz"]
    return [None, "", " ", "<|endoftext|>", " <|endoftext|> ", "plain words here", *[
        "".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(n)], "long word " * 30_000]


def test_matches_the_library(spark, make_docs):
    texts = fuzz()
    docs = make_docs(list(enumerate(texts)))
    name = B.publish_lexicon(docs, PATH, words=500)
    rows = docs.select("text", B.encode_decode(F.col("text"), PATH, name).alias("r")).collect()
    library = Tokenizer.from_file(PATH)
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.r.ids), "<u4").tolist() == ids, r.text[:80]
        assert r.r.decoded == library.decode(ids, skip_special_tokens=False)


def test_empty_table(spark, make_docs):
    docs = make_docs([(1, None)]).limit(0)
    name = B.publish_lexicon(docs, PATH)
    assert docs.select(B.encode_decode(F.col("text"), PATH, name)).count() == 0
    one = make_docs([(1, "some words")])
    assert bytes(one.select(B.encode_decode(F.col("text"), PATH, name).alias("r")).collect()[0].r.ids) == np.array(
        Tokenizer.from_file(PATH).encode("some words").ids, "<u4").tobytes()


def test_transducer_is_minimal_and_exact(tmp_path):
    rng = random.Random(4)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 6))) for _ in range(300)})
    (tmp_path / "t").write_bytes(B.Transducer.compile([(w, [i, i + 1]) for i, w in enumerate(words)]))
    t = B.Transducer(str(tmp_path / "t"))
    assert t.lookup(words).tolist() == list(range(len(words)))
    assert (t.lookup([w + b"!" for w in words] + [b"abcabcabc"]) == -1).all()
    # as many states as there are distinct right languages
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    right = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes}
    assert len(t.final) == len(right)


def test_counts(spark, make_docs):
    got = {r.word: r.n for r in B.word_counts(make_docs([(1, "a b. a"), (2, "a"), (3, None)])).collect()}
    assert got == {"a": 2, " b": 1, ".": 1, " a": 1}


def test_memo_overflow(monkeypatch, tmp_path):
    monkeypatch.setattr(B, "MEMO_WORDS", 3)
    (tmp_path / "t").write_bytes(B.Transducer.compile([]))
    enc = B.Encoder(B.Vocabulary(PATH), B.Transducer(str(tmp_path / "t")))
    library = Tokenizer.from_file(PATH)
    for text in fuzz(60)[1:]:
        assert enc.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_merging_together_equals_one_by_one():
    v = B.Vocabulary(PATH)
    rng = random.Random(6)
    words = ["".join(rng.choice(" aeionrstéñ.!0") for _ in range(rng.randint(0, 60))).encode() for _ in range(500)] + [b"", b"a" * 39, b"a" * 5000]
    ids, counts = v.merge_all(words)
    ends = np.cumsum(counts)
    assert all(ids[e - n:e].tolist() == v.merge(w) for w, n, e in zip(words, counts, ends, strict=True))
    assert len(v.merge_all([])[0]) == 0


def test_uneven_white_space():
    import random
    import re

    pattern = re.compile(r"\s | \s|^\s|\s$")
    rng = random.Random(9)
    for _ in range(5000):
        text = "".join(rng.choice("ab \n\t\x85\x1c　 c") for _ in range(rng.randint(1, 6)))
        assert B.uneven(text) == bool(pattern.search(text)), repr(text)
