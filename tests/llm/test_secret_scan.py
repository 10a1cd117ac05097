import hashlib
import random
import re

from docs_fixture import make_docs  # noqa: F401
from mound.llm import secret_scan as S

HEX = "0123456789abcdef" * 3
KEY = "AKIA" + "Z9" * 8


def brute(text, rules=S.RULES):
    spans = []
    for k, r in enumerate(rules):
        for m in re.finditer(r.regex, text or "", re.ASCII):
            if len(m[r.group]) >= r.least:
                spans.append((m.start(), k, m.end()))
    return sorted(spans)


def texts():
    rng = random.Random(5)
    bits = ["pass", "password", "PassWord", "passwd", "secret", "token", "api_key", "APIKEY", "=", " : ", '"', "'", " ", "é", "𝄞",
            "abcdefgh", "Ab1+/_.=-x", "short", HEX, HEX[:31], KEY, "AKIA12", "\n", "ghp_" + "a" * 40, "xoxb-1234567890ab",
            "-----BEGIN RSA PRIVATE KEY-----", "eyJabc.eyJdefghijklmnopqrstu.vwxyz0123456789_-0123456789"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    return [None, "", "x", "token=" + "q" * 8 + " token=short", *made, " ".join(["secret: hunter2hunter2"] * 1500)]


def test_matches_brute_force_and_redacts(spark, make_docs):
    docs = make_docs(list(enumerate(texts())))
    for r in S.scan(docs).collect():
        assert [tuple(s) for s in r.secret_spans] == brute(r.text), r.text
    from pyspark.sql import functions as F
    red = S.scan(docs).withColumn("red", S.redact(F.coalesce("text", F.lit("")), F.col("secret_spans"))).collect()
    for r in red:
        text, covered = r.text or "", set()
        for a, _, b in brute(text):
            covered.update(range(a, b))
        # adjacent spans form one run
        out, i, runs = "", 0, []
        for a, _, b in brute(text):
            if runs and a <= runs[-1][1]:
                runs[-1][1] = max(b, runs[-1][1])
            else:
                runs.append([a, b])
        for a, b in runs:
            out += text[i:a] + "[SECRET]"
            i = b
        assert r.red == out + text[i:]


def test_edge_tables(spark, make_docs):
    assert S.digest(make_docs([]).limit(0)).count() == 0
    docs = make_docs([(None, "token=abcdefghij"), (None, None), (3, "token=abcdefghij"), (3, "token=abcdefghij"), (3, "plain")])
    got = sorted((r.doc_id is not None, r.n_assign) for r in S.digest(docs).collect())
    assert all(r.n_access == 0 == r.n_hex for r in S.digest(docs).collect())
    assert got == [(False, 0), (False, 1), (True, 0), (True, 1), (True, 1)]
    empty = next(r for r in S.digest(docs).collect() if r.n_assign == 0)
    assert empty.base_sha256 == hashlib.sha256(b"").hexdigest() and empty.spans == ""


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "token=abcdefghij", 5, "k", [1])], "doc_id long, text string, key int, rules string, doc array<int>")
    row = S.scan(df).collect()[0]
    assert (row.key, row.rules, row.doc) == (5, "k", [1]) and len(row.secret_spans) == 1


def test_queries_are_necessary():
    for r in S.RULES:
        q = S.trigram_query(r.regex)
        for t in texts():
            for m in re.finditer(r.regex, t or ""):
                if q:
                    assert any(need <= S.trigrams(m[0].lower()) for need in q)
    assert S.trigram_query("[0-9a-f]+") is None and S.trigram_query("abc|x") is None
    assert set(S.trigram_query("abcd|xyz")) == {frozenset({"abc", "bcd"}), frozenset({"xyz"})}
