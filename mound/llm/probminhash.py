"""Near-duplicate texts by ProbMinHash signatures, banding and verification.

Shingles are five consecutive words (lower-cased, cut at white space); a
shorter text is one shingle.  A shingle's weight is 1 + ln(its count).  Each
distinct shingle is a Poisson process of that rate: its arrivals, drawn from
a hash of the shingle, fall on random signature slots, and a slot keeps the
shingle of its earliest arrival.  A process ends once its next arrival is
later than every slot's.  Two texts agree in a slot with the probability
Jaccard similarity of their weighted shingles.  A shingle repeated in one text
only lowers that, so a text of repeated shingles also has the bands of equal
weights; without repeats the two are the same.

Equal texts are one class from the start, so a group of copies is one row.
``ROWS`` slots make a band; texts that share a band's key meet in its bucket,
and buckets of the same texts are one.  No pair becomes a row: texts are
compared inside the groups to which buckets are dealt, on arrays of shingle
hashes that are written once, and a group returns a spanning forest of its
links.

First, one bucket in ``FIRST`` is compared, a large one in blocks of bounded
rows and shingles.  The links found are joined to components.  In the buckets
that still hold texts of several components, those outside the largest one are
then compared with all texts of other components, block by block.  After that,
any two texts of one bucket are in one component or were compared.

A link is judged on the sets of shingles themselves: Jaccard similarity of at
least ``SIMILARITY``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mound.llm.batches import slices
from mound.llm.components import components
from mound.llm.memory import lean, lean_group
from mound.session import write_through

WORDS, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8^5)^32 = 3e-6: by the bands of equal weights,
#: whose agreement is the sets' Jaccard similarity, however often shingles repeat.
BANDS, ROWS = 32, 5
#: Texts of a slice, at most.
SLICE = 256
#: Texts and shingles of a bucket on each side of a group, about.
BLOCK, BLOCK_SHINGLES = 4096, 1_000_000
#: Shingles of the groups that are compared in one call, about.
TOGETHER = 1_500_000
#: One bucket in so many is compared first.
FIRST = 8
#: Longer words, in bytes, are hashed one by one.
LONG_WORD = 256

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(raw: bytes, ends: np.ndarray) -> np.ndarray:
    """A hash of each word; word k ends before ``ends[k]``, one byte before the next word starts.

    All words take eight bytes further per step; those of more than ``LONG_WORD`` bytes go by xxhash."""
    starts = np.concatenate([[0], ends[:-1] + 1])
    left = ends - starts
    out = left.astype(np.uint64)
    eights = np.lib.stride_tricks.as_strided(np.frombuffer(raw + bytes(8), np.uint8), (len(raw) + 1, 8), (1, 1))
    live = np.flatnonzero((left > 0) & (left <= LONG_WORD))
    at, left = starts[live], left[live]
    while len(live):
        block = eights[at].view("<u8").ravel()
        block &= _LOW_BYTES[np.minimum(left, 8)]
        out[live] = mix(out[live] ^ block)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    long = np.flatnonzero(ends - starts > LONG_WORD)
    if len(long):
        import xxhash

        out[long] = [xxhash.xxh64_intdigest(raw[starts[k]:ends[k]]) for k in long]
    return out


#: Masks of the lowest 0 to 8 bytes.
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def shingle_hashes(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, repeats included, and each one's text."""
    cut = [t.lower().split() for t in texts]
    counts = np.fromiter(map(len, cut), np.int64, len(cut))
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    raw = " ".join([" ".join(c) for c in cut if c]).encode("utf-8", "surrogatepass") + b" "
    hashes = word_hashes(raw, np.flatnonzero(np.frombuffer(raw, np.uint8) == 0x20))
    owner = np.repeat(np.arange(len(texts)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(total)  # words from here to the text's end
    first = np.arange(total) == np.repeat(np.cumsum(counts) - counts, counts)
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    out = np.zeros(total, np.uint64)
    for k in range(words):
        out = mix(out ^ np.where(left > k, padded[k:k + total], _U(k)))
    use = (left >= words) | (first & (left < words))
    return out[use], owner[use]


def weighted_shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each of up to ``SLICE`` texts: text, hash of 56 bits, count."""
    hashes, owner = shingle_hashes(texts, words)
    both = np.sort(owner.astype(np.uint64) << _U(56) | hashes >> _U(8))
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    starts = np.flatnonzero(new)
    first = both[starts]
    return (first >> _U(56)).astype(np.int64), first & _U((1 << 56) - 1), np.diff(np.append(starts, len(both)))


def signatures(texts: list[str], slots: int = BANDS * ROWS, words: int = WORDS, equal: bool = False) -> np.ndarray:
    """(texts x slots) ProbMinHash signatures, by ``equal`` weights or those of the counts; rows of texts without a word are all zero."""
    owner, shingle, count = weighted_shingles(texts, words)
    first = np.full(len(texts) * slots, np.inf)
    signature = np.zeros(len(texts) * slots, np.uint64)
    rate = np.ones(len(count)) if equal else 1 + np.log(count)
    seed = mix(shingle)
    at = np.zeros(len(shingle))
    live, arrival = np.arange(len(shingle)), 0
    events: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(live):
        several = max(1, min(64, 2048 // len(live)))  # arrivals of each process in this round
        number = _U(1) + np.arange(arrival, arrival + several, dtype=np.uint64)
        arrival += several
        random = mix(seed[live][:, None] + number * _U(0x9E3779B97F4A7C15))
        gap = -np.log(((random >> _U(11)).astype(np.float64) + 0.5) / 2**53) / rate[live][:, None]
        time = at[live][:, None] + np.cumsum(gap, axis=1)
        slot = (mix(random ^ _U(0xD6E8FEB86659FD93)) % _U(slots)).astype(np.int64) + owner[live][:, None] * slots
        np.minimum.at(first, slot.ravel(), time.ravel())
        hit = time <= first[slot]
        events.append((slot[hit], time[hit], np.broadcast_to(shingle[live][:, None], slot.shape)[hit]))
        at[live] = time[:, -1]
        last = first.reshape(len(texts), slots).max(axis=1)
        live = live[at[live] < last[owner[live]]]
    for slot, time, value in events:
        won = time == first[slot]
        signature[slot[won]] = value[won]
    return signature.reshape(len(texts), slots)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(texts x bands) keys; equal keys of one band mean equal rows."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2])
    for k in range(rows):
        key = mix(key ^ parts[:, :, k])
    return key


def all_band_keys(texts: list[str]) -> list[np.ndarray]:
    """Each text's distinct band keys, by weights of counts and by equal weights."""
    owner, _, count = weighted_shingles(texts)
    weighted = band_keys(signatures(texts)).view(np.int64)
    out = list(weighted)
    repeats = np.unique(owner[count > 1]).tolist()
    if repeats:
        equal = band_keys(signatures([texts[k] for k in repeats], equal=True)).view(np.int64)
        for k, keys in zip(repeats, equal, strict=True):
            out[k] = np.union1d(weighted[k], keys)
    return out


def bands_of(text: Column) -> Column:
    """Band keys of each text; none for a text without a word."""
    @F.pandas_udf("array<long>")
    @lean
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            all_texts = [t or "" for t in batch]
            for some in slices(list(map(len, all_texts)), SLICE):
                texts = all_texts[some]
                out += [k if t.strip() else [] for k, t in zip(all_band_keys(texts), texts, strict=True)]
            yield pd.Series(out)

    return run(text)


def text_key(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text))


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(t, shingles, n) for (t, text): the sorted distinct shingle hashes as little-endian 64-bit numbers, and their count."""
    @lean
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in slices(batch["text"].map(len).tolist(), SLICE):
                some = batch.iloc[at]
                owner, shingle, _ = weighted_shingles(list(some["text"]))
                counts = np.bincount(owner, minlength=len(some))
                sets = np.split(shingle.astype("<u8"), np.cumsum(counts)[:-1])
                yield pd.DataFrame({"t": some["t"].to_numpy(), "shingles": [x.tobytes() for x in sets], "n": counts})

    return texts.mapInPandas(run, "t binary, shingles binary, n long")


def _group_links(t: np.ndarray, root: np.ndarray, sets: list[np.ndarray], hub: np.ndarray, other: np.ndarray, main: np.ndarray,
                 similarity: float) -> list[tuple[int, int]]:
    """Links (places) that join all similar pairs of a hub and another row of one group: at most one less than its rows.

    A pair counts if its roots differ and the other is ``main`` or has the larger key."""
    place = np.argsort([len(x) for x in sets], kind="stable")
    sizes = np.array([len(x) for x in sets])[place]
    number = np.unique(np.concatenate([sets[k] for k in place]), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    order = np.unique(t, return_inverse=True)[1][place]
    component = np.unique(root, return_inverse=True)[1][place]
    hub, other, main = hub[place], other[place], main[place]
    mark = np.zeros(len(number), bool)
    links = []
    for h in np.flatnonzero(hub):
        low, high = np.searchsorted(sizes, [sizes[h] * similarity - 1, sizes[h] / similarity + 1])
        some = low + np.flatnonzero(other[low:high] & (component[low:high] != component[h]) & (main[low:high] | (order[low:high] > order[h])))
        if not len(some):
            continue
        mark[number[starts[h]:ends[h]]] = True
        if 2 * len(some) > high - low:  # neighbouring sets as they lie
            both = np.add.reduceat(mark[number[starts[low]:ends[high - 1]]], starts[low:high] - starts[low], dtype=np.int64)[some - low]
        else:
            begin = np.cumsum(sizes[some]) - sizes[some]
            flat = np.arange(sizes[some].sum()) + np.repeat(starts[some] - begin, sizes[some])
            both = np.add.reduceat(mark[number[flat]], begin, dtype=np.int64)
        mark[number[starts[h]:ends[h]]] = False
        near = some[both / (sizes[h] + sizes[some] - both) >= similarity]
        for c, k in zip(*np.unique(component[near], return_index=True), strict=True):
            links.append((place[h], place[near[k]]))
            component[component == c] = component[h]
    return links


def _links(rows: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """The links of some groups (key, i, j) of rows (t, root, shingles, hub, other, main)."""
    place = np.lexsort((rows["j"].to_numpy(), rows["i"].to_numpy(), rows["key"].to_numpy()))
    key, i, j, t, root, hub, other, main = (rows[c].to_numpy()[place] for c in ("key", "i", "j", "t", "root", "hub", "other", "main"))
    sets = [np.frombuffer(x, "<u8") for x in rows["shingles"].to_numpy()[place]]
    heads = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
    found = []
    for at, to in zip(heads.tolist(), [*heads[1:].tolist(), len(t)], strict=True):
        group = slice(at, to)
        if to - at > 1:
            found += [(t[at + a], t[at + b]) for a, b in _group_links(t[group], root[group], sets[group], hub[group], other[group], main[group], similarity)]
    return pd.DataFrame({"a": [a for a, _ in found], "b": [b for _, b in found]})


def compared(dealt: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) within the groups (key, i, j) of ``dealt``: (key, i, j, t, n, root, hub, other, main)."""
    shingles = dealt.agg(F.sum("n")).collect()[0][0] or 0
    # many groups to a call: about TOGETHER shingles, of all rows that are dealt
    call = F.pmod(F.xxhash64("key", "i", "j"), F.lit(max(1, -(-shingles // TOGETHER))))
    rows = dealt.drop("n").join(sets.select("t", "shingles"), "t")
    return rows.groupBy(call.alias("call")).applyInPandas(lean_group(lambda g: _links(g, similarity)), "a binary, b binary")


def blocks_of(rows: Column, shingles: Column, block: int) -> Column:
    """Into how many blocks a side is cut: by its rows and by its shingles."""
    return F.greatest(F.lit(1), F.ceil(rows / block), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def across_components(rows: DataFrame, roots: DataFrame, block: int) -> DataFrame:
    """The groups in which all texts of one bucket but of different components meet; rows (key, t, n), roots (vertex, root).

    One of two such texts is not in the bucket's largest component, so only such texts are dealt against all others."""
    held = rows.join(roots.select(F.col("vertex").alias("t"), "root"), "t", "left").withColumn("root", F.coalesce("root", "t"))
    sizes = held.groupBy("key", "root").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    sizes = sizes.groupBy("key").agg(F.max(F.struct("rows", "root", "shingles")).alias("top"), F.sum("rows").alias("rows"),
                                     F.sum("shingles").alias("shingles"), F.count("*").alias("several")).filter("several > 1")
    sizes = sizes.select("key", F.col("top.root").alias("largest"), blocks_of(F.col("rows"), F.col("shingles"), block).alias("down"),
                         blocks_of(F.col("rows") - F.col("top.rows"), F.col("shingles") - F.col("top.shingles"), block).alias("across"))
    held = held.join(sizes, "key").withColumn("main", F.col("root") == F.col("largest"))
    part = lambda n: F.pmod(F.xxhash64("t", "key"), F.col(n)).cast("int")
    every = lambda n: F.transform(F.sequence(F.lit(0), F.col(n) - 1), lambda k: k.cast("int"))
    as_other = F.transform(every("across"), lambda i: F.struct(i.alias("i"), part("down").alias("j"), F.lit(False).alias("hub")))
    as_hub = F.transform(every("down"), lambda j: F.struct(part("across").alias("i"), j.alias("j"), F.lit(True).alias("hub")))
    at = F.explode(F.when(F.col("main"), as_other).otherwise(F.concat(as_other, as_hub)))
    return held.select("key", "t", "n", "root", "main", at.alias("at")).select(
        "key", "at.i", "at.j", "t", "n", "root", "at.hub", (~F.col("at.hub")).alias("other"), "main")


def linked_texts(bands: DataFrame, texts: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK, first: int = FIRST) -> DataFrame:
    """Links (a, b) that join all near-duplicate texts which share a band's key.

    ``bands`` has (t, bands), each text key once; ``texts`` has (t, text) and may repeat a key.  Of the buckets,
    one in ``first`` is compared before the others.
    """
    entries = bands.select("t", F.explode("bands").alias("key"))
    # buckets of the same texts are one
    buckets = entries.groupBy("key").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("t")).alias("x"),
                                         F.sum(F.xxhash64("t", F.lit(1)).cast("decimal(38,0)")).alias("s")).filter("size > 1")
    buckets = buckets.groupBy("size", "x", "s").agg(F.min("key").alias("key")).select("key")
    entries = write_through(entries.join(buckets, "key"), "entries")
    # copies go before the shuffle, so that a task gets a text once from each map task, at most
    once = texts.groupBy("t").agg(F.first("text").alias("text"))
    sets = write_through(shingle_sets(once.join(entries.select("t").distinct(), "t", "left_semi")), "shingle-sets")
    entries = entries.join(sets.select("t", "n"), "t")
    sizes = entries.groupBy("key").agg(blocks_of(F.count("*"), F.sum("n"), block).alias("blocks"))
    entries = write_through(entries.join(sizes, "key"), "sized-entries")

    early = F.pmod(F.xxhash64("key"), F.lit(first)) == 0
    within = entries.filter(early).select("key", F.pmod(F.xxhash64("t", "key"), F.col("blocks")).cast("int").alias("i"), F.lit(0).alias("j"), "t", "n",
                                          F.col("t").alias("root"), F.lit(True).alias("hub"), F.lit(True).alias("other"), F.lit(False).alias("main"))
    links = write_through(compared(within, sets, similarity), "links")
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "early-components")
    left = entries.filter(~early | (F.col("blocks") > 1)).select("key", "t", "n")
    dealt = write_through(across_components(left, roots, block), "dealt")
    stars = roots.filter("root <> vertex").select(F.col("root").alias("a"), F.col("vertex").alias("b"))
    return stars.union(write_through(compared(dealt, sets, similarity), "late-links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, t, component_id, kept) for every row of ``docs``.

    ``component_id`` is the smallest id among the rows that equal texts and
    links join; ``kept`` says that the row's id is that one.  Texts without a
    word (null, empty, white space) link with nothing: each such row is its
    own class.  Null ids count as larger than all others; rows of null id are
    kept only if their class has no other.  Rows that repeat an id with the
    same text are the same document and share its fate.  Other columns are
    ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    signed = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text).alias("t"), bands_of(text).alias("bands"))
    signed = write_through(signed, "signatures")
    unique = signed.filter(F.size("bands") > 0).groupBy("t").agg(F.first("bands").alias("bands"))
    # the texts are read again where links are verified: only of those that share a bucket
    links = linked_texts(unique, docs.select(text_key(text).alias("t"), text.alias("text")), similarity)
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "text-components")
    classes = signed.select("doc_id", "t", (F.size("bands") > 0).alias("worded")).join(
        roots.select(F.col("vertex").alias("t"), "root"), "t", "left")
    classes = classes.withColumn("root", F.when(F.col("worded"), F.coalesce("root", "t")))
    least = classes.filter("worded").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = classes.join(least, "root", "left")
    component = F.when(F.col("worded"), F.col("least")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "t", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose document stays: one id of each class of near duplicates, all columns as they are."""
    found = near_duplicates(docs, id_col, text_col, similarity)
    gone = found.filter("not kept").select(F.col("doc_id").alias("gone"), F.col("t").alias("gone_t")).distinct()
    # rows travel in a struct, so that no column's name matters
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"),
                       text_key(F.coalesce(F.col(text_col), F.lit(""))).alias("t"))
    kept = rows.join(gone, F.col("id").eqNullSafe(F.col("gone")) & (F.col("t") == F.col("gone_t")), "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
