from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docs_fixture import make_docs  # noqa: F401
from mound.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(pieces, lengths, capacity):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for d, s, n, q, o in pieces:
        assert n > 0
        by_doc[d].append((s, n))
        by_seq[q].append((o, n))
    for d, n in enumerate(lengths):
        at = 0
        for s, m in sorted(by_doc[d]):
            assert s == at
            at += m
        assert at == n
    fill = {}
    for q, parts in by_seq.items():
        at = 0
        for o, m in sorted(parts):
            assert o == at
            at += m
        assert at <= capacity
        fill[q] = at
    assert P.padding(fill, capacity) == 0
    assert sorted(fill) == list(range(len(fill)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=120))
def test_every_token_once_without_padding(lengths):
    check(P.pack(np.array(lengths, np.int64), 64), lengths, 64)


def test_bins_hold_a_fixed_count():
    bins, gaps = P._deal(np.array([33, 40, 64, 20, 22, 31, 32, 16]), 64)
    assert list(P.classes(np.array([64, 33, 32, 22, 21, 16]), 64)) == [1, 1, 2, 2, 3, 4]
    assert (gaps >= 0).all()
    by_class = defaultdict(list)
    for b, n in zip(bins, [33, 40, 64, 20, 22, 31, 32, 16], strict=True):
        if b >= 0:
            by_class[int(b)].append(n)
    assert all(len(v) == 64 // v[0] for v in by_class.values())


def test_ids_match_the_library(spark, make_docs):
    texts = [None, "", "Hello World", "don't <|endoftext|> x<|startoftext|>y", "é É ÀB́ İstanbul ΣΑΣ", "a b\x85c　d\x1ce﻿f g​h",
             "12 3.5 ### token=abc", "  lead\n\ntrail  ", "word " * 9000, "漢字かな 한국어", "́start é"] * 2
    docs = make_docs(list(enumerate(texts)))
    library = Tokenizer.from_file(PATH)
    rows = P.pack_documents(docs, PATH).collect()
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.start, bytes(r.ids), r.doc_tokens))
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert b"".join(x for _, x, _ in sorted(got[i])) == np.array(ids, "<u4").tobytes(), t
        assert all(n == len(ids) for *_, n in got[i])
    fill = defaultdict(int)
    for r in rows:
        fill[r.sequence_id] += r.length
    assert P.padding(fill) == 0
    assert P.digest(P.pack_documents(docs.limit(0), PATH)).count() == 0
    null_ids = make_docs([(None, "a b"), (None, "c")])
    assert {r.doc_tokens for r in P.pack_documents(null_ids, PATH).collect()} == {2, 3}


@pytest.mark.parametrize("n", [1, 7])
def test_memo_overflow(monkeypatch, n):
    monkeypatch.setattr(P, "MEMO_CHUNKS", n)
    enc, library = P.ChunkEncoder(PATH, 2), Tokenizer.from_file(PATH)
    for text in ["one two three", "two four", "", "five six seven eight nine ten"]:
        ids, totals = enc.encode([text, "", text])
        want = library.encode(text, add_special_tokens=False).ids + [2]
        assert ids.tolist() == want + [2] + want and totals.tolist() == [len(want), 1, len(want)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aZ1.'\"<|>~ \n\t") + [chr(c) for c in (*range(0xA0, 0x250), 0x301, 0x3A3)]), max_size=12), max_size=6))
def test_latin_words_match_the_library(texts):
    """Every Latin letter, beside marks, other letters and odd spaces."""
    ids, totals = ENCODER.encode(texts)
    want = [LIBRARY.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and totals.tolist() == list(map(len, want))


ENCODER, LIBRARY = P.ChunkEncoder(PATH, 2), Tokenizer.from_file(PATH)


def test_words_of_a_latin_text_are_remembered_without_their_chunks():
    texts = ["One, two. (Three) one! TWO; don't \u00c9t\u00e9,", "three? one/two \x1cone", "", "one \u6f22,two <|endoftext|>,one", "a\tb\nc"]
    encoder = P.ChunkEncoder(PATH, 2)
    ids, lengths = encoder.encode(texts[:3])
    assert set(encoder.known) <= set(encoder.pieces.findall(" ".join(texts[:3]).lower()))
    more, more_lengths = encoder.encode(texts)
    library = Tokenizer.from_file(PATH)
    want = [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert more.tolist() == sum(want, []) and more_lengths.tolist() == list(map(len, want))
    assert ids.tolist() == sum(want[:3], []) and lengths.tolist() == list(map(len, want[:3]))
