import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from mound.llm import warc as W

SCHEMA = "page_id long, url string, html string"


def want(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if p is not None and (h or "").encode() == data] if len(data) >= 100 else []
        least = min(same, default=None)
        revisit = least is not None and len([r for r in rows if (r[2] or "").encode() == data]) > 1 and page != least
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", least if revisit else None, True))
    return sorted(out, key=str)


def got(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in W.read_back(W.write(df, **more), df).collect()), key=str)


def pages(n=120, seed=1):
    rng = random.Random(seed)
    hosts = ["a.example.com", "b.example.com", "Example.org:8080", "user@x.y.z"]
    texts = ["<p>" + "é" * k for k in (0, 20, 48, 49, 400)] + ["", None, "x" * 99, "x" * 100, "\r\n\r\nWARC/1.1\r\n", "y" * 300_000]
    rows = [(i * 3 - 50, f"http://{rng.choice(hosts)}/{rng.randint(0, 9)}?q={rng.randint(0, 3)}#f", rng.choice(texts)) for i in range(n)]
    odd = [None, "", "no host", "http://", "mailto:a@b", "http://a.example.com/a b\r\nX: y", "//h/é\x00\x7f"]
    return rows + [(1000 + i, u, t) for i, u in enumerate(odd) for t in ("z" * 150,)] + [(None, "http://n/", "n" * 200), (None, "http://n/", "x" * 100)]


def test_round_trip(spark):
    rows = pages()
    assert got(spark, rows) == want(rows)


def test_small_parts_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(W, "PART_BYTES", 100_000)
    rows = pages(300, 2)
    rows += [rows[5]] * 30  # a row repeated
    df = spark.createDataFrame(rows, SCHEMA)
    archive = W.write(df)
    assert len(archive.first) > 3
    assert sorted((tuple(r) for r in W.read_back(archive, df).collect()), key=str) == want(rows)


def test_index_blocks(tmp_path, monkeypatch):
    """Bisection over blocks and parts finds what a scan of all lines finds."""
    import pandas as pd

    monkeypatch.setattr(W, "LINES", 3)
    rng = random.Random(4)
    places = sorted(f"{rng.choice(['com,a', 'com,ab', 'com,a,b', 'org'])}){rng.choice('/?')}{rng.randint(0, 4)} {rng.randint(0, 3):017}" for _ in range(200))
    parts = []
    for cut in (places[:70], places[70:71], places[71:]):
        if parts and cut[0] == last:  # equal places lie in one part
            continue
        last = cut[-1]
        frame = pd.DataFrame({"place": cut, "page_id": range(len(cut)), "url": cut, "payload": [p.encode() for p in cut], "digest": ["d"] * len(cut),
                              "size": [len(p) for p in cut], "refers_to": [None] * len(cut), "refers_url": [None] * len(cut)})
        parts += [(r["first"], r["directory"], cut) for r in next(W._write_part(iter([frame[:5], frame[5:]]), str(tmp_path))).to_dict("records")]
    index = W._Index(W.Archive(str(tmp_path), tuple(p[0] for p in parts), tuple(p[1] for p in parts)))
    there = [x for p in parts for x in p[2]]
    for prefix in {*there, *(p[:k] for p in there for k in (1, 5, 7, 9)), "", "a", "zzz", "com,aa"}:
        found = [W.parse(m)[1].decode() for m in index.records(list(index.captures(prefix)))]
        assert sorted(found) == [p for p in there if p.startswith(prefix)]


def test_lookup_of_a_site_with_payloads(spark):
    rows = [(1, "http://a.example.com/x", "one"), (2, "https://b.example.com/", "two"), (3, "http://a.example.com/x", "three"), (4, "http://example.org/", "four")]
    archive = W.write(spark.createDataFrame(rows, SCHEMA))
    site = lambda s: sorted(bytes(r.payload) for r in W.lookup(archive, spark.createDataFrame([(s,)], "p string"), 1, payloads=True).collect())
    assert site("com,example,") == [b"one", b"three", b"two"]
    assert site("com,example,a)/x ") == [b"one", b"three"]
    assert site("net,") == []


def test_archives_are_plain_warc(spark):
    """Each file is a sequence of gzip members, one record each."""
    rows = [(1, "http://a/", "p" * 200), (2, "http://b/", "p" * 200)]
    archive = W.write(spark.createDataFrame(rows, SCHEMA))
    system, path = W._open(archive.folder)
    files = [f for f in system.get_file_info(W.fs.FileSelector(path)) if f.path.endswith(".warc.gz")]
    data, kinds = b"".join(system.open_input_stream(f.path, compression=None).read() for f in files), []
    while data:
        member = zlib.decompressobj(wbits=31)
        text = member.decompress(data)
        data = member.unused_data
        kinds.append(text.split(b"\r\n")[1])
    assert kinds == [b"WARC-Type: warcinfo", b"WARC-Type: response", b"WARC-Type: revisit"]


@pytest.mark.parametrize("url, key", [("https://u:p@WWW.Example.com:81/A?b#c", "com,example,www:81)/A?b"), (None, ""), ("x y", "x%20y"), ("//h", "h)")])
def test_keys(spark, url, key):
    assert spark.createDataFrame([(url,)], "u string").select(W.url_key(F.col("u"))).collect()[0][0] == key


def test_empty_and_extra_columns(spark):
    assert got(spark, []) == []
    df = spark.createDataFrame([(1, "http://a/", "t" * 120, "x", 5)], SCHEMA + ", place string, digest int")
    assert [r.page_id for r in W.read_back(W.write(df), df).collect()] == [1]
