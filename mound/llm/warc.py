"""WARC archives with a two-level capture index.

Pages are sorted over the cluster by their reversed-host key
(``com,example,www)/path``) and id.  The task of each range writes its pages
as WARC records, a gzip member each, and at the same time the index of them:
sorted lines in compressed blocks of ``LINES``, and a sparse directory with
one entry for each block.  Records with the payload of an earlier page
(smallest id) are revisits that refer to it.

A lookup of a prefix of keys finds the parts whose ranges hold it (the first
keys of at most ``MOST_PARTS`` parts), searches the part's directory by
bisection, reads the block's range of the index, searches its lines by
bisection, and reads the ranges of the records, neighbours together.
Requests are sorted over the cluster too, so a task reads a part's directory
and each block once.

Files lie under the shared checkpoint folder, written through pyarrow's file
systems (local or shared disks, HDFS, object stores).  A task's files have
names of their own, and only the rows of tasks that succeeded name them; so a
task that runs again, or twice, leaves no trace in what is read.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mound.session import scratch_path, write_through

#: Bytes of payload in a part, about, and the most parts there are (then parts grow).
PART_BYTES, MOST_PARTS = 32_000_000, 8192
#: Lines in a block of the index; bytes after which another archive begins.
LINES, ARCHIVE_BYTES = 1000, 1_000_000_000
#: Payloads of fewer bytes are never revisits.
LEAST_REVISIT = 100
#: Records no further apart are read together, up to so many bytes; records parsed at a time.
GAP, READ_BYTES, SLICE = 65_536, 4_000_000, 500
DATE = "2000-01-01T00:00:00Z"
LEVEL = 6
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URL = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]+)?([^#]*)"


def url_key(url: Column) -> Column:
    """Reversed host, port, then path and query; without scheme, user and fragment.  Null is empty; what has no host stays as it is."""
    clean = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7F]", "%20")
    host = F.lower(F.regexp_extract(clean, _URL, 1))
    reversed_host = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(host != "", F.concat(reversed_host, F.regexp_extract(clean, _URL, 2), F.lit(")"), F.regexp_extract(clean, _URL, 3))).otherwise(clean)


def place(url: Column, page_id: Column) -> Column:
    """What the index is sorted by: key, blank, and the id in digits that sort like it (null last)."""
    number = F.lpad(F.hex(page_id.cast("long").bitwiseXOR(F.lit(-2**63).cast("long"))), 16, "0")
    return F.concat(url_key(url), F.lit(" "), F.coalesce(F.concat(F.lit("0"), number), F.lit("1" + "0" * 16)))


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def _header(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: int | None, refers_url: str | None) -> bytes:
    """A response record, or a revisit where ``refers_to`` is given, as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    line = lambda u: re.sub(r"[\x00-\x20\x7F]", "%20", u)
    name = f"null-{uuid.uuid4()}" if page_id is None else page_id
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:x-page:{name}>"), ("WARC-Date", DATE),
              ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    if url is not None:
        fields.append(("WARC-Target-URI", line(url)))
    if refers_to is not None:
        fields += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", f"<urn:x-page:{refers_to}>"), ("WARC-Refers-To-Date", DATE)]
        if refers_url is not None:
            fields.append(("WARC-Refers-To-Target-URI", line(refers_url)))
    packer = zlib.compressobj(LEVEL, wbits=31)
    return packer.compress(_header(fields) + body + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields in lower case, payload behind the HTTP header) of a record."""
    data = zlib.decompress(member, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    size = int(fields["content-length"])
    if not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"not a WARC record: {head[:80]!r}")
    return fields, rest[:size].partition(b"\r\n\r\n")[2]


class _Out:
    """A file that is written from front to back."""

    def __init__(self, folder: str, kind: str) -> None:
        self.name = f"{uuid.uuid4().hex}.{kind}"
        system, path = _open(folder)
        system.create_dir(path, recursive=True)
        self.stream, self.size = system.open_output_stream(f"{path}/{self.name}", compression=None), 0

    def put(self, data: bytes) -> int:
        """Where the data begin."""
        at = self.size
        self.stream.write(data)
        self.size += len(data)
        return at


def _write_part(batches: Iterator[pd.DataFrame], folder: str) -> Iterator[pd.DataFrame]:
    """Archives, index and directory of one range of sorted pages."""
    archive = index = None
    lines: list[str] = []
    directory: list[str] = []
    first, n = None, 0

    def end_block() -> None:
        block = zlib.compress("\n".join(lines).encode(), LEVEL)
        directory.append(f"{lines[0].rsplit(' ', 5)[0]}\t{index.put(block)}\t{len(block)}")
        lines.clear()

    for batch in batches:
        for row in batch.itertuples(index=False):
            if archive is None or archive.size >= ARCHIVE_BYTES:
                if archive is not None:
                    archive.stream.close()
                archive = _Out(folder, "warc.gz")
                info = _header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("Content-Length", "0")])
                archive.put(zlib.compress(info + b"\r\n\r\n", LEVEL, wbits=31))
            index = index or _Out(folder, "cdx")
            page, refers = (None if pd.isna(x) else int(x) for x in (row.page_id, row.refers_to))
            data = record(page, row.url, None if row.payload is None else bytes(row.payload), row.digest, row.size, refers, row.refers_url)
            kind = "response" if refers is None else "revisit"
            lines.append(f"{row.place} {kind} {row.digest} {len(data)} {archive.put(data)} {archive.name}")
            first, n = first or row.place, n + 1
            if len(lines) == LINES:
                end_block()
    if n:
        if lines:
            end_block()
        sparse = _Out(folder, "dir")
        sparse.put("\n".join([index.name, *directory]).encode())
        for out in (archive, index, sparse):
            out.stream.close()
        yield pd.DataFrame({"first": [first], "directory": [sparse.name], "n": [n]})


@dataclass(frozen=True)
class Archive:
    """A folder of archives, and the first key and directory of each part of its index."""

    folder: str
    first: tuple[str, ...]
    directory: tuple[str, ...]


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> Archive:
    """Write a WARC record for each page, and the capture index.

    The payload is the html in UTF-8 (null: empty).  Of records with equal
    payloads of at least ``LEAST_REVISIT`` bytes, those with the smallest id
    are responses and others revisits; a null id is larger than all others
    and is never referred to.  Repeated rows are records each.  Null urls
    have an empty key and no target; other columns are ignored.  A task holds
    a batch of pages, a block of lines and its part's directory.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), place(F.col(url_col), F.col(id_col)).alias("place"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("size"))
    light = write_through(base.select("page_id", "url", "digest", "size"), "warc-digests")
    total = light.agg(F.sum("size")).collect()[0][0] or 0
    copies = light.filter(F.col("size") >= LEAST_REVISIT).groupBy("digest").agg(
        F.count("*").alias("n"), F.min(F.struct(F.col("page_id").isNull(), "page_id", "url")).alias("least"))
    copies = write_through(copies.filter("n > 1 and least.page_id is not null").select(
        "digest", F.col("least.page_id").alias("refers_to"), F.col("least.url").alias("refers_url")), "warc-copies")
    marked = base.join(copies, "digest", "left")
    own = F.col("refers_to").isNull() | F.col("page_id").eqNullSafe(F.col("refers_to"))
    marked = marked.select("place", "page_id", "url", F.when(own, F.col("payload")).alias("payload"), "digest", "size",
                           F.when(~own, F.col("refers_to")).alias("refers_to"), F.when(~own, F.col("refers_url")).alias("refers_url"))
    folder = scratch_path(spark, "warc")
    parts = max(1, min(MOST_PARTS, math.ceil(total / PART_BYTES)))
    laid = marked.repartitionByRange(parts, "place").sortWithinPartitions("place")
    written = write_through(laid.mapInPandas(lambda b: _write_part(b, folder), "first string, directory string, n long"), "warc-parts")
    found = sorted((r["first"].encode(), r["first"], r["directory"]) for r in written.collect())  # MOST_PARTS rows at most
    return Archive(folder, tuple(f for _, f, _ in found), tuple(d for *_, d in found))


class _Index:
    """What a task has open of the index: a part's directory and one block."""

    def __init__(self, archive: Archive) -> None:
        self.archive = archive
        self.system, self.path = _open(archive.folder)
        self.first = [f.encode() for f in archive.first]
        self.part = self.block = None

    def _range(self, name: str, at: int, size: int) -> bytes:
        with self.system.open_input_file(f"{self.path}/{name}") as file:
            return file.read_at(size, at)

    def _load_part(self, part: int) -> None:
        if part != self.part:
            with self.system.open_input_stream(f"{self.path}/{self.archive.directory[part]}", compression=None) as file:
                self.name, *entries = file.read().decode().split("\n")
            self.part, self.block = part, None
            self.entries = [e.rsplit("\t", 2) for e in entries]
            self.heads = [e[0].encode() for e in self.entries]

    def _load_block(self, block: int) -> None:
        if block != self.block:
            _, at, size = self.entries[block]
            self.lines = [x.rsplit(" ", 5) for x in zlib.decompress(self._range(self.name, int(at), int(size))).decode().split("\n")]
            self.places = [x[0].encode() for x in self.lines]
            self.block = block

    def captures(self, prefix: str) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of every record whose place begins with ``prefix``."""
        wanted = prefix.encode()
        begins = lambda x: x.startswith(wanted)
        part = max(0, bisect_left(self.first, wanted) - 1)
        while part < len(self.first) and (self.first[part] <= wanted or begins(self.first[part])):
            self._load_part(part)
            block = max(0, bisect_left(self.heads, wanted) - 1)
            while block < len(self.heads) and (self.heads[block] <= wanted or begins(self.heads[block])):
                self._load_block(block)
                for k in range(bisect_left(self.places, wanted), len(self.places)):
                    if not begins(self.places[k]):
                        break
                    _, _, _, size, at, file = self.lines[k]
                    yield file, int(at), int(size)
                block += 1
            part += 1

    def records(self, captures: list[tuple[str, int, int]]) -> Iterator[bytes]:
        """The records' members; those that lie near one another are read together."""
        captures = sorted(captures)
        a = 0
        while a < len(captures):
            file, begin, size = captures[a]
            b, end = a + 1, begin + size
            while b < len(captures) and captures[b][0] == file and captures[b][1] <= end + GAP and captures[b][1] + captures[b][2] - begin <= READ_BYTES:
                end = max(end, captures[b][1] + captures[b][2])
                b += 1
            data = self._range(file, begin, end - begin)
            for _, at, size in captures[a:b]:
                yield data[at - begin:at - begin + size]
            a = b


RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, intact boolean"


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:x-page:").removesuffix(">")
    return None if number.startswith("null-") else int(number)


def _parsed(members: Iterator[bytes], payloads: bool) -> pd.DataFrame:
    rows = []
    for member in members:
        fields, payload = parse(member)
        stated = fields["warc-payload-digest"].removeprefix("sha256:")
        revisit = fields["warc-type"] == "revisit"
        digest = stated if revisit else hashlib.sha256(payload).hexdigest()
        rows.append((_page(fields["warc-record-id"]), fields.get("warc-target-uri"), fields["warc-type"], None if revisit else len(payload), digest,
                     _page(fields["warc-refers-to"]) if revisit else None, digest == stated, *[None if revisit else payload] * payloads))
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORD.split(", ")] + ["payload"] * payloads)
    return frame.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})


def lookup(archive: Archive, prefixes: DataFrame, tasks: int, payloads: bool = False) -> DataFrame:
    """The records whose places begin with a prefix (one string column; distinct, none null).

    A whole ``place`` finds one capture, a key and a blank all captures of an
    url, a reversed host a whole site.  A record is returned for each prefix
    that finds it.  ``intact``: whether the payload has the digest stated.
    """
    column = prefixes.columns[0]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _Index(archive)
        held: list[tuple[str, int, int]] = []
        size = 0
        for batch in batches:
            for prefix in batch[column]:
                for capture in index.captures(prefix):
                    held.append(capture)
                    size += capture[2]
                    if len(held) >= SLICE or size >= READ_BYTES:
                        yield _parsed(index.records(held), payloads)
                        held, size = [], 0
        if held:
            yield _parsed(index.records(held), payloads)

    laid = prefixes.repartitionByRange(tasks, column).sortWithinPartitions(column)
    return laid.mapInPandas(find, RECORD + ", payload binary" * payloads)


def read_back(archive: Archive, pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, intact) of the records of the given pages.

    Every page is looked up in the index; a revisit has the length of the
    response that it refers to.
    """
    wanted = pages.select(place(F.col(url_col), F.col(id_col)).alias("place")).distinct()
    found = write_through(lookup(archive, wanted, max(1, len(archive.first))), "warc-read")
    responses = found.filter("record_type = 'response' and page_id is not null").groupBy(
        F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("referred_bytes"))
    out = found.join(responses, ["refers_to", "payload_digest"], "left")
    return out.select("page_id", F.coalesce("payload_bytes", "referred_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "intact")


def oracle_sql() -> str:
    """DuckDB twin: what the records must say."""
    return """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha256(coalesce(html, '')) AS d FROM pages),
    f AS (SELECT d, min(page_id) AS least FROM p WHERE n >= 100 GROUP BY d)
    SELECT page_id, n AS payload_bytes, p.d AS payload_digest, CASE WHEN least IS NULL OR least IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN least IS DISTINCT FROM page_id THEN least END AS refers_to, TRUE AS intact
    FROM p LEFT JOIN f ON f.d = p.d"""
