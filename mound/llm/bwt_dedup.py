"""Removal of repeated passages, found through Burrows-Wheeler transforms.

A byte goes if it is covered by a string of ``LEAST`` bytes that also starts
in a document of smaller id; strings never cross documents.

1. Documents are packed into blocks of about ``BLOCK`` bytes, one row each.
2. Every string of ``LEAST`` bytes (a window) has an anchor: the smallest hash
   of the grams of ``GRAM`` bytes in it.  Equal windows have equal anchors.
   Each block sends its distinct anchors, 32 bits each, to the parts that
   their hashes name; a part answers with the anchors that two documents hold.
   Only windows with such an anchor can be repeated.
3. Neighbouring windows of one anchor form a stretch of text.  Each block
   sends its distinct stretches, with the smallest document id that holds
   them, to the anchor's part: equal windows meet there, whatever block they
   are in, and a stretch that very many documents share comes once a block.
   An anchor of more than ``HOT`` distinct stretches (a short line in very many
   surroundings) does not fill its part: its windows go one by one, each to the
   part that its own hash names, where equal ones meet as well.
4. A part builds the suffix order and Burrows-Wheeler transform of its
   distinct stretches and, from the intervals that its doubling ranks give,
   expands intervals breadth-first by backward extension: the intervals of
   common prefix l give those of l + 1.  It stops at ``LEAST``: what still lies in one interval are equal windows, and each
   learns the smallest id among them.
5. The answers return to the blocks, which cut the texts.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mound.llm.memory import lean, lean_group
from mound.session import write_through

LEAST = 50
#: Times travel as JSON to the microsecond.
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
GRAM = 24
#: Bytes of text in a block, and for each part, about.
BLOCK = 4_000_000
#: Positions hashed at a time.
CHUNK = 1 << 15
#: An anchor's distinct stretches, counted by block, that go to one part; about 5 MB.
HOT = 1 << 16

_U = np.uint64
_LAST = np.iinfo(np.int64).max


def _squeeze(value) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(value, 5))


def _unsqueeze(data: bytes):
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(bytes(data)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0x9E3779B97F4A7C15)
    return x ^ (x >> _U(29))


def anchors(raw: np.ndarray, least: int = LEAST, gram: int = GRAM) -> np.ndarray:
    """For each window of ``least`` bytes: the smallest hash of its grams (``gram`` a multiple of 8)."""
    b = raw.astype(np.uint64)
    two = b[:-1] | b[1:] << _U(8)
    four = two[:-2] | two[2:] << _U(16)
    eight = four[:-4] | four[4:] << _U(32)
    n = len(raw) - gram + 1
    h = _mix(eight[:n] + _U(gram))
    for at in range(8, gram, 8):
        h = _mix(h ^ eight[at:at + n])
    h = h * _U(0xD6E8FEB86659FD93)
    width, span = least - gram + 1, 1
    while span * 2 <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    return np.minimum(h[:len(h) - (width - span)], h[width - span:]) if span < width else h


def fingerprints(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: int) -> np.ndarray:
    """A hash of each stretch (8 bytes or longer): of its length, its first words of 8 bytes, and its last one."""
    eight = np.ndarray((max(0, len(raw) - 7),), np.uint64, raw, strides=(1,))
    h = (ends - starts).astype(np.uint64)
    for k in range(words):
        h = _mix(h ^ eight[np.minimum(starts + 8 * k, ends - 8)])
    return h * _U(0xD6E8FEB86659FD93) >> _U(8)


class Block:
    """Documents end to end, with their stretches: runs of windows of one anchor."""

    def __init__(self, ids: list[int | None], sizes: np.ndarray, raw: bytes, least: int):
        self.ids, self.sizes, self.least = ids, sizes, least
        self.order = np.array([_LAST if i is None else i for i in ids], np.int64)
        self.raw, self.bytes = raw, np.frombuffer(raw, np.uint8)
        self.ends = np.cumsum(sizes)
        whole = np.ones(len(raw) + 1, bool)  # whether a window starts here
        for back in range(1, least):
            at = self.ends - back
            whole[np.maximum(at, self.ends - sizes)[sizes > 0]] &= False
        whole[len(raw):] = False
        starts, counts, values = [], [], []
        for a in range(0, max(0, len(raw) - least + 1), CHUNK):
            b = min(a + CHUNK, len(raw) - least + 1)
            value, ok = anchors(self.bytes[a:b + least - 1], least), whole[a:b]
            new = ok.copy()
            new[1:] &= (value[1:] != value[:-1]) | ~ok[:-1]
            first = np.flatnonzero(new)
            # a run ends where the next begins or where no window starts
            stop = np.flatnonzero(~ok)
            after = np.append(first[1:], b - a)
            nearest = np.append(stop, b - a)[np.searchsorted(stop, first)]
            starts.append(first + a)
            counts.append(np.minimum(after, nearest) - first)
            values.append(value[first])
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.starts, self.counts, self.values = join(starts, np.int64), join(counts, np.int64), join(values, np.uint64)
        self.docs = np.searchsorted(self.ends, self.starts, "right")

    @staticmethod
    def unpack(data: bytes, least: int) -> tuple[Block, list]:
        ids, sizes, raw, carried = _unsqueeze(data)
        return Block(ids, sizes, raw, least), carried

    def anchor_codes(self, parts: int) -> np.ndarray:
        """Each run's anchor as part << 32 | code."""
        return ((self.values % _U(parts)) << _U(32) | self.values >> _U(32)).astype(np.int64)

    def distinct(self, order: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """For each anchor (runs in ``order``, anchors from ``heads``) its distinct stretches; up to three runs count as they are."""
        sizes = np.diff(np.append(heads, len(order)))
        some = np.flatnonzero(sizes > 3)
        if not len(some):
            return sizes
        group = np.repeat(some, sizes[some])
        runs = order[_places(sizes, some)]
        ends = self.starts[runs] + self.counts[runs] + self.least - 1
        mark = fingerprints(self.bytes, self.starts[runs], ends, 2 + self.least // 5)
        by = np.lexsort((mark, group))
        new = np.concatenate([[True], (mark[by][1:] != mark[by][:-1]) | (group[by][1:] != group[by][:-1])])
        out = sizes.copy()
        out[some] = np.bincount(group[by], new, len(sizes)).astype(np.int64)[some]
        return out

    def stretches(self, parts: int, shared) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, dict[bytes, int], np.ndarray]]:
        """By part: starts, windows and documents of the runs whose anchor is shared, their distinct strings, and each run's string.

        Runs of a hot anchor are taken apart: one run a window, by the window's own hash."""
        part = (self.values % _U(parts)).astype(np.int64)
        code = (self.values >> _U(32)).astype(np.uint32)
        by_part = np.argsort(part, kind="stable")
        part = part[by_part]
        taken, apart = {}, []
        for row in shared:
            codes, hot = (np.frombuffer(row[c], np.uint32) for c in ("codes", "hot"))
            runs = by_part[np.searchsorted(part, row["part"]):np.searchsorted(part, row["part"], "right")]
            at = np.minimum(np.searchsorted(codes, code[runs]), len(codes) - 1)
            runs = runs[codes[at] == code[runs]]
            if len(hot):
                often = np.isin(code[runs], hot)
                apart.append(runs[often])
                runs = runs[~often]
            taken[row["part"]] = runs
        windows, home = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if apart:
            runs = np.concatenate(apart)
            windows = _places_of(self.starts[runs], self.counts[runs])
            home = np.concatenate([fingerprints(self.bytes, w, w + self.least, (self.least + 7) // 8) % _U(parts) for w in np.split(
                windows, range(CHUNK, len(windows), CHUNK))]).astype(np.int64)
            by_home = np.argsort(home, kind="stable")
            windows, home = windows[by_home], home[by_home]
        raw, tail = self.raw, self.least - 1
        for p in sorted({*taken, *np.unique(home).tolist()}):
            runs = taken.get(p, np.zeros(0, np.int64))
            single = windows[np.searchsorted(home, p):np.searchsorted(home, p, "right")]
            starts = np.concatenate([self.starts[runs], single])
            counts = np.concatenate([self.counts[runs], np.ones(len(single), np.int64)])
            docs = np.searchsorted(self.ends, starts, "right")
            known: dict[bytes, int] = {}
            which = np.fromiter((known.setdefault(raw[s:s + n + tail], len(known)) for s, n in zip(
                starts.tolist(), counts.tolist(), strict=True)), np.int64, len(starts))
            yield p, starts, counts, docs, known, which


# -- suffix order, transform, intervals -------------------------------------

def _sorted_places(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places by key (of ``bits`` bits), and the keys in that order; sorts key and place as one number where they fit."""
    width = max(1, (len(key) - 1).bit_length())
    if bits + width <= 63:
        both = np.sort(key << width | np.arange(len(key)))
        return both & ((1 << width) - 1), both >> width
    order = np.argsort(key, kind="stable")
    return order, key[order]


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions of ``text`` (symbols 0 to 256) by the ``depth`` or more symbols from there, zeros behind its end.

    With each position's rank by its first symbols, and their number, below ``depth``, of the last doubling but one."""
    n, known = len(text), 4
    padded = np.concatenate([text.astype(np.int64), np.zeros(known, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(known):
        key = key << 9 | padded[k:k + n]
    bits, width = 9 * known, n.bit_length()
    rank, ranked = text, 1
    while True:
        order, s = _sorted_places(key, bits)
        if known >= depth:
            return order, rank, ranked
        rank, ranked = np.empty(n, np.int64), known
        rank[order] = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])])
        key = rank << width
        key[:max(0, n - known)] |= rank[known:] + 1
        known, bits = 2 * known, 2 * width


def equal_windows(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order, and for each place in it the number of its interval of common prefix ``least``.

    Backward extension: the places whose suffixes follow symbol c within an
    interval of common prefix l form, moved one step back through the
    transform, an interval of l + 1.  So place j starts a new interval of
    l + 1 exactly if it and place j - 1 have different first symbols, or come
    from different intervals of l.  The ranks that the suffix order was doubled
    from already give the intervals of their length, with which extension
    begins.  Places that already start an interval are settled (their common
    prefix with the place before is known) and leave the queue; expansion ends
    at ``least`` or when the queue is empty.
    """
    n = len(text)
    order, rank, ranked = suffix_order(text, least)
    kind = np.int32 if n < 2**31 else np.int64
    place = np.empty(n, kind)
    place[order] = np.arange(n, dtype=kind)
    # where each place comes from: the last-to-first step, read backwards
    came = np.empty(n, kind)
    came[place[order - 1]] = np.arange(n, dtype=kind)
    starts = np.zeros(n, bool)
    if n:
        starts[0] = True
    rank = rank[order]
    starts[1:] |= rank[1:] != rank[:-1]
    queue = np.flatnonzero(~starts).astype(kind)
    here, before = came[queue], came[queue - 1]
    # places whose two origins are neighbours need no interval numbers: the second origin starts an interval or not
    close = here == before + 1
    near, near_here = queue[close], here[close]
    queue, here, before = queue[~close], here[~close], before[~close]
    for _ in range(ranked, least):
        if not len(queue) and not len(near):
            break
        near_split = starts[near_here]
        if len(queue):
            interval = np.cumsum(starts, dtype=kind)
            split = interval[here] != interval[before]
            starts[queue[split]] = True
            queue, here, before = queue[~split], here[~split], before[~split]
        starts[near[near_split]] = True
        near, near_here = near[~near_split], near_here[~near_split]
    return order, np.cumsum(starts) - 1


def smallest_holders(strings: list[bytes], holders: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of each string, the smallest holder of a string with an equal window.

    In runs: each string's number of runs, and the runs' windows and holders end to end."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    # one zero behind each string: no window with it equals one without
    raw = np.frombuffer(b"\0".join([*strings, b""]), np.uint8)
    text = raw.astype(np.int16) + 1
    ends = np.cumsum(sizes + 1)
    text[ends - 1] = 0
    owner = np.repeat(np.arange(len(strings)), sizes + 1)
    window = ends[owner] - 1 - np.arange(len(text)) >= least
    order, interval = equal_windows(text, least)
    holder = np.where(window, holders[owner], _LAST)
    heads = np.flatnonzero(np.concatenate([[True], interval[1:] != interval[:-1]]))
    low = np.minimum.reduceat(holder[order], heads)
    found = np.empty(len(text), np.int64)
    found[order] = low[interval]
    found, owner = found[window], owner[window]
    heads = np.flatnonzero(np.concatenate([[True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])]))
    return np.bincount(owner[heads], minlength=len(strings)), np.diff(np.append(heads, len(found))), found[heads]


def _places_of(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places from each start on, as many as its count, after one another."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


def _places(pieces: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places of the pieces of chosen strings, strings after one another, where all strings' pieces lie end to end."""
    return _places_of((np.cumsum(pieces) - pieces)[which], pieces[which])


# -- on Spark ---------------------------------------------------------------

def pack_blocks(docs: DataFrame, block: int) -> DataFrame:
    """(block, size, docs): documents (id, text, carried) in blocks of about ``block`` bytes."""
    @lean
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, carried, size = [], [], [], 0

        def flush() -> pd.DataFrame:
            nonlocal number, size
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            out = pd.DataFrame({"block": [number], "size": [int(sizes.sum())], "docs": [_squeeze((list(ids), sizes, b"".join(texts), list(carried)))]})
            ids.clear(), texts.clear(), carried.clear()
            number, size = number + 1, 0
            return out

        for batch in batches:
            for i, t, c in zip(batch["id"], batch["text"], batch["carried"], strict=True):
                ids.append(None if pd.isna(i) else int(i))
                texts.append((t or "").encode("utf-8", "surrogatepass"))
                carried.append(c)
                size += len(texts[-1])
                if size >= block:
                    yield flush()
        if ids:
            yield flush()

    # ids as text: a column of longs with nulls would reach pandas as floats
    return docs.select(F.col("id").cast("string").alias("id"), "text", "carried").mapInPandas(run, "block long, size long, docs binary")


def shared_anchors(blocks: DataFrame, parts: int, least: int, most: int = HOT) -> DataFrame:
    """(block, shared): for each block its anchors that two documents hold, as (part, sorted codes, those that are hot)."""
    @lean
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, data in zip(batch["block"], batch["docs"], strict=True):
                block, _ = Block.unpack(data, least)
                if not len(block.values):
                    continue
                # by part, then code; the runs of an anchor stay in the order of their documents
                order, both = _sorted_places(block.anchor_codes(parts), 32 + parts.bit_length())
                docs = block.docs[order]
                heads = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
                several = docs[heads] != docs[np.append(heads[1:], len(docs)) - 1]
                part, code = both[heads] >> 32, (both[heads] & 0xFFFFFFFF).astype(np.uint32)
                strings = block.distinct(order, heads).astype(np.uint32)
                cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                rows = []
                for a, c, s, n in zip(cuts, np.split(code, cuts[1:]), np.split(several, cuts[1:]), np.split(strings, cuts[1:]), strict=True):
                    more = np.flatnonzero(n > 1).astype(np.uint32)
                    rows.append((int(part[a]), number, c.tobytes(), np.packbits(s).tobytes(), np.concatenate([more, n[more]]).tobytes()))
                yield pd.DataFrame(rows, columns=["part", "block", "codes", "several", "strings"])

    @lean_group
    def answer(group: pd.DataFrame) -> pd.DataFrame:
        codes = [np.frombuffer(c, np.uint32) for c in group["codes"]]
        own = np.concatenate(codes)
        several = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=len(c)) for s, c in zip(group["several"], codes, strict=True)])
        order = np.argsort(own, kind="stable")
        ranked = own[order]
        heads = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        number = np.cumsum(heads) - 1
        often = np.bincount(number) + np.bincount(number, several[order])
        shared = np.empty(len(own), bool)
        shared[order] = (often > 1)[number]
        strings, at = np.ones(len(own), np.int64), 0
        for c, n in zip(codes, group["strings"], strict=True):
            more, counts = np.frombuffer(n, np.uint32).reshape(2, -1)
            strings[at + more.astype(np.int64)] = counts
            at += len(c)
        hot = ranked[heads][np.bincount(number, strings[order]) > most]
        out, at = [], 0
        for block, c in zip(group["block"], codes, strict=True):
            use = np.unique(c[shared[at:at + len(c)]])
            at += len(c)
            if len(use):
                out.append((int(block), int(group["part"].iloc[0]), use.tobytes(), np.intersect1d(use, hot, True).tobytes()))
        return pd.DataFrame(out, columns=["block", "part", "codes", "hot"]).astype({"block": "int64", "part": "int32"})

    sent = blocks.select("block", "docs").mapInPandas(send, "part int, block long, codes binary, several binary, strings binary")
    found = sent.groupBy("part").applyInPandas(answer, "block long, part int, codes binary, hot binary")
    return found.groupBy("block").agg(F.collect_list(F.struct("part", "codes", "hot")).alias("shared"))


def holders(blocks: DataFrame, shared: DataFrame, parts: int, least: int) -> DataFrame:
    """(block, answers): for each block and part, the smallest holder of each window of its stretches, in runs."""
    @lean
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, data, rows in zip(batch["block"], batch["docs"], batch["shared"], strict=True):
                block, _ = Block.unpack(data, least)
                out = []
                for part, _, _, docs, known, which in block.stretches(parts, rows):
                    low = np.full(len(known), _LAST)
                    np.minimum.at(low, which, block.order[docs])
                    out.append((part, number, _squeeze((list(known), low))))
                yield pd.DataFrame(out, columns=["part", "block", "stretches"]).astype({"part": "int32", "block": "int64"})

    @lean_group
    def answer(group: pd.DataFrame) -> pd.DataFrame:
        sent = [_unsqueeze(s) for s in group["stretches"]]
        known: dict[bytes, int] = {}
        places = [np.fromiter((known.setdefault(s, len(known)) for s in strings), np.int64, len(strings)) for strings, _ in sent]
        low = np.full(len(known), _LAST)
        for place, (_, own) in zip(places, sent, strict=True):
            np.minimum.at(low, place, own)
        if known:
            pieces, windows, values = smallest_holders(list(known), low, least)
        else:
            pieces = windows = values = np.zeros(0, np.int64)
        out = []
        for block, place in zip(group["block"], places, strict=True):
            take = _places(pieces, place)
            out.append((int(block), int(group["part"].iloc[0]), _squeeze((pieces[place].astype(np.int32), windows[take].astype(np.int32), values[take]))))
        return pd.DataFrame(out, columns=["block", "part", "answer"])

    sent = blocks.select("block", "docs").join(shared, "block").mapInPandas(send, "part int, block long, stretches binary")
    found = sent.groupBy("part").applyInPandas(answer, "block long, part int, answer binary")
    return found.groupBy("block").agg(F.collect_list(F.struct("part", "answer")).alias("answers"))


def _removed(block: Block, shared, answers, parts: int) -> np.ndarray:
    """Which bytes of a block go."""
    edge = np.zeros(len(block.raw) + 1, np.int64)
    replies = {r["part"]: _unsqueeze(r["answer"]) for r in answers}
    for part, starts, _, docs, _, which in block.stretches(parts, shared):
        if not len(starts):
            continue
        pieces, lengths, values = (a.astype(np.int64) for a in replies[part])
        # each run's pieces, as windows from its start
        take = _places(pieces, which)
        size = lengths[take]
        done = np.cumsum(size) - size
        run = np.repeat(np.arange(len(starts)), pieces[which])
        first = np.cumsum(pieces[which]) - pieces[which]
        start = starts[run] + done - done[first][run]
        go = values[take] < block.order[docs][run]
        np.add.at(edge, start[go], 1)
        np.add.at(edge, start[go] + size[go] + block.least - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                   block: int = BLOCK, most: int = HOT, as_text: bool = False) -> DataFrame:
    """Every row of ``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs) and ``kept`` (the bytes that stay) in a struct column ``cut``, beside the
    row's columns in a struct column ``row`` (without the text).

    Null and empty texts have no bytes.  Null ids count as larger than all
    others; rows of equal ids remove nothing from one another.  An empty table
    gives no rows.  Texts are UTF-8 bytes, so a character may be cut.  With
    ``as_text``, ``kept`` is a string and a character of which a part is cut goes
    whole: decoded where it is cut, without a further Python worker a task.
    """
    others = [c for c in docs.columns if c != text_col]
    kind = T.StructType([f for f in docs.schema.fields if f.name != text_col])
    carried = F.to_json(F.struct(*[F.col(f"`{c}`") for c in others]), {"ignoreNullFields": "true"} | _EXACT)
    packed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), carried.alias("carried"))
    blocks = write_through(pack_blocks(packed, block), "text-blocks")
    total = blocks.agg(F.sum("size")).collect()[0][0] or 0
    parts = max(1, math.ceil(total / block))
    shared = write_through(shared_anchors(blocks, parts, least, most), "shared-anchors")
    answers = write_through(holders(blocks, shared, parts, least), "holders")

    @lean
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data, rows, replies in zip(batch["docs"], batch["shared"], batch["answers"], strict=True):
                own, others = Block.unpack(data, least)
                gone = _removed(own, rows, replies, parts) if rows is not None and replies is not None else np.zeros(len(own.raw), bool)
                out = []
                for size, end, c in zip(own.sizes.tolist(), own.ends.tolist(), others, strict=True):
                    mine = gone[end - size:end]
                    spans = int((mine[1:] & ~mine[:-1]).sum()) + int(size > 0 and mine[0])
                    kept = own.bytes[end - size:end][~mine].tobytes()
                    out.append((c, size, int(mine.sum()), spans, kept.decode("utf-8", "ignore") if as_text else kept))
                yield pd.DataFrame(out, columns=["carried", "n_bytes", "n_removed", "n_spans", "kept"])

    whole = blocks.select("block", "docs").join(shared, "block", "left").join(answers, "block", "left")
    done = whole.mapInPandas(cut, "carried string, n_bytes long, n_removed long, n_spans long, kept " + ("string" if as_text else "binary"))
    return done.select(F.from_json("carried", kind, _EXACT).alias("row"), F.struct("n_bytes", "n_removed", "n_spans", "kept").alias("cut"))


def digest(docs: DataFrame) -> DataFrame:
    found = remove_repeats(docs.select("doc_id", "text"))
    return found.select("row.doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256).alias("kept_sha256"))
