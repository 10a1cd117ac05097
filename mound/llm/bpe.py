"""Byte-level BPE encoding and decoding with a transducer lexicon.

Frequent words of the corpus are counted on Spark; the ``LEXICON_WORDS`` most
frequent ones (a fixed bound, whatever the corpus) are merged once and
compiled into a minimal acyclic transducer: words that end alike share states,
and the outputs along a word's path sum to its number, which leads to its ids.
The automaton is written to the shared folder, shipped as a Spark file and
memory-mapped by every Python worker, so workers of a machine share its pages.

A worker cuts a text into words, looks the distinct new words of a batch up in
the automaton, all words one byte further per step, and merges the words that
it does not hold exactly, pair by pair in rank order.  Texts are never cut off.
"""

from __future__ import annotations

import heapq
import json
import struct
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mound.llm.memory import lean
from mound.session import scratch_path, write_through

#: Words in the lexicon, and the longest of them in bytes.
LEXICON_WORDS, LEXICON_BYTES = 65_536, 40
#: Distinct words whose ids a worker remembers; distinct words counted before a partial count is emitted.
MEMO_WORDS, COUNT_WORDS = 150_000, 150_000
NO_RANK = np.iinfo(np.int64).max
ENCODED = "ids binary, decoded string"

_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: White space besides the space itself.
_WHITE = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]


# -- the tokenizer's file ---------------------------------------------------

def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters for themselves, the other bytes from U+0100 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Byte ids, merge ranks, token bytes and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        vocab = data["model"]["vocab"]
        letters = _byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.byte_ids = [vocab[c] for c in letters]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        self.ranks = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        keys = np.array([a << 32 | b for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        found = np.array(list(self.ranks.values()), np.int64)[order]
        self.pair_keys, self.pair_ranks, self.pair_ids = keys[order], found[:, 0].copy(), found[:, 1].copy()
        single = np.array(self.byte_ids, np.int64)
        self.byte_pairs = self.rank_pairs(np.repeat(single, 256), np.tile(single, 256))  # of first byte * 256 + second
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        by_id = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items() if token not in self.special}
        by_id |= {i: token.encode() for token, i in self.special.items()}
        sizes = [len(by_id.get(i, b"")) for i in range(max(by_id) + 1)]
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(len(sizes))), np.uint8)

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word: the pair of lowest rank is merged, leftmost first, until none is left (a heap of pairs)."""
        ids = [self.byte_ids[b] for b in word]
        n, ranks = len(ids), self.ranks
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r[0], i, ids[i], ids[i + 1], r[1]) for i in range(n - 1) if (r := ranks.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = merged, -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y >= 0 and (r := ranks.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (r[0], x, ids[x], ids[y], r[1]))
        return [i for i in ids if i >= 0]

    def rank_pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of pairs; ``NO_RANK`` where they do not merge."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_ranks[at], NO_RANK), self.pair_ids[at]

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` for many words at once: ids end to end, and each word's number of ids.

        All words take one step together: each merges its own pair of lowest
        rank.  Words that have none left leave.  Long words go one by one.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        short = np.flatnonzero((sizes > 0) & (sizes <= LEXICON_BYTES))
        raw = np.frombuffer(b"".join([words[i] for i in short]), np.uint8)
        token = np.array(self.byte_ids, np.int64)[raw]
        word = np.repeat(short, sizes[short])
        done_word, done_token = [], []
        for i in np.flatnonzero(sizes > LEXICON_BYTES):
            ids = self.merge(words[i])
            done_token.append(np.array(ids, np.int64))
            done_word.append(np.full(len(ids), i))
        rank, merged = np.full(len(token), NO_RANK), np.zeros(len(token), np.int64)
        inner = np.flatnonzero(word[1:] == word[:-1])
        pair = raw[inner].astype(np.int64) << 8 | raw[inner + 1]
        rank[inner], merged[inner] = (of[pair] for of in self.byte_pairs)
        while len(token):
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            count = np.diff(np.append(heads, len(word)))
            low = np.minimum.reduceat(rank, heads)
            go = low < NO_RANK
            if not go.all():
                stay = np.repeat(go, count)
                done_word.append(word[~stay])
                done_token.append(token[~stay])
                token, word, rank, merged = token[stay], word[stay], rank[stay], merged[stay]
                count, low = count[go], low[go]
                if not len(token):
                    break
            hits = np.flatnonzero(rank == np.repeat(low, count))
            hits = hits[np.concatenate([[True], word[hits[1:]] != word[hits[:-1]]])]  # leftmost of each word
            token[hits] = merged[hits]
            keep = np.ones(len(token), bool)
            keep[hits + 1] = False
            token, word, rank, merged = token[keep], word[keep], rank[keep], merged[keep]
            at = hits - np.arange(len(hits))
            touched = np.zeros(len(token), bool)
            touched[at] = True
            touched[at[at > 0] - 1] = True
            anew = np.flatnonzero(touched)
            rank[anew] = NO_RANK
            anew = anew[anew + 1 < len(token)]
            anew = anew[word[anew] == word[anew + 1]]
            rank[anew], merged[anew] = self.rank_pairs(token[anew], token[anew + 1])
        if not done_word:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        owner, ids = np.concatenate(done_word), np.concatenate(done_token)
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ids, end to end."""
        sizes = self.sizes[ids]
        total = int(sizes.sum())
        return self.flat[np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)]


# -- the transducer ---------------------------------------------------------

class Transducer:
    """A minimal acyclic transducer in flat arrays, read from a memory-mapped file.

    ``arcs`` holds state * 256 + byte, sorted; ``targets`` and ``outputs`` go
    with it.  The sum of outputs along an accepted word is its number; its ids
    are ``ids[starts[n]:starts[n + 1]]``.
    """

    PARTS = (("arcs", np.int64), ("targets", np.int32), ("outputs", np.int32), ("final", np.uint8),
             ("starts", np.int64), ("ids", np.uint32))

    def __init__(self, path: str):
        with open(path, "rb") as f:
            sizes = struct.unpack("<6q", f.read(48))
        at = 48
        for (name, kind), n in zip(self.PARTS, sizes, strict=True):
            setattr(self, name, np.memmap(path, kind, "r", at, (n,)).view(np.ndarray) if n else np.zeros(0, kind))
            at += -(-n * np.dtype(kind).itemsize // 8) * 8

    @staticmethod
    def compile(words: Iterable[tuple[bytes, list[int]]]) -> bytes:
        """File contents for sorted, distinct words with their ids.

        Built incrementally: what of the previous word the next one does not
        share can no longer change, so its states are replaced by equal ones
        that exist, last first.
        """
        nodes: list[tuple[dict[int, int], bool]] = []
        known: dict[tuple, int] = {}
        path: list[list] = [[{}, False]]  # open states: children, final
        last = b""

        def close(down_to: int) -> None:
            while len(path) > down_to + 1:
                children, final = path.pop()
                key = (final, tuple(children.items()))
                if key not in known:
                    known[key] = len(nodes)
                    nodes.append((children, final))
                path[-1][0][last[len(path) - 1]] = known[key]

        all_ids: list[list[int]] = []
        for word, ids in words:
            same = next((i for i, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))  # noqa: B905
            close(same)
            for _ in word[same:]:
                path.append([{}, False])
            path[-1][1] = True
            last = word
            all_ids.append(ids)
        close(0)
        nodes.append((path[0][0], path[0][1]))
        root = len(nodes) - 1
        below = []  # words accepted from a state; children come before their parents
        for children, final in nodes:
            below.append(int(final) + sum(below[c] for c in children.values()))
        number = lambda s: root - s  # noqa: E731  the root is state 0
        arcs = []
        for state, (children, final) in enumerate(nodes):
            passed = int(final)
            for byte, child in sorted(children.items()):
                arcs.append((number(state) * 256 + byte, number(child), passed))
                passed += below[child]
        arcs.sort()
        lengths = np.array([0, *map(len, all_ids)], np.int64)
        parts = [[a for a, _, _ in arcs], [t for _, t, _ in arcs], [o for _, _, o in arcs],
                 [int(nodes[root - s][1]) for s in range(len(nodes))], np.cumsum(lengths), [i for ids in all_ids for i in ids]]
        made = [np.asarray(p, kind) for p, (_, kind) in zip(parts, Transducer.PARTS, strict=True)]
        out = struct.pack("<6q", *map(len, made))
        for part in made:
            raw = part.tobytes()
            out += raw + b"\0" * (-len(raw) % 8)
        return out

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for words that are not held."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        live = np.flatnonzero(lengths <= LEXICON_BYTES) if len(self.arcs) else np.zeros(0, np.int64)
        found = np.full(len(words), -1)
        step = 0
        while len(live):
            done = live[lengths[live] == step]
            ok = done[self.final[state[done]] == 1]
            found[ok] = total[ok]
            live = live[lengths[live] > step]
            if not len(live):
                break
            key = state[live] * 256 + flat[starts[live] + step]
            at = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            hit = self.arcs[at] == key
            live, at = live[hit], at[hit]
            state[live] = self.targets[at]
            total[live] += self.outputs[at]
            step += 1
        return found


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Pieces of ``flat``, end to end."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


# -- encoding ---------------------------------------------------------------

class Encoder:
    def __init__(self, vocabulary: Vocabulary, lexicon: Transducer):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self.clear()

    def clear(self) -> None:
        self.chunks: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words end to end, and each one's number of ids: from the lexicon, else merged."""
        lexicon = self.lexicon
        number = lexicon.lookup(words)
        missed = np.flatnonzero(number < 0)
        ids, counts = self.vocabulary.merge_all([words[i] for i in missed])
        flat = np.concatenate([lexicon.ids, ids])
        starts, lengths = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        held = np.flatnonzero(number >= 0)
        starts[held], lengths[held] = lexicon.starts[number[held]], np.diff(lexicon.starts)[number[held]]
        starts[missed], lengths[missed] = len(lexicon.ids) + np.cumsum(counts) - counts, counts
        return _gather(flat, starts, lengths), lengths

    def learn(self, chunks: list[str]) -> None:
        """Remember the ids of chunks (strings at whose ends a word boundary lies)."""
        special = self.vocabulary.special
        cut = [[chunk] if chunk in special else _WORDS.findall(chunk) for chunk in chunks]
        words = list(set(chain.from_iterable(cut)).difference(special))
        of = {w: i for i, w in enumerate([*words, *special])}
        ids, lengths = self.word_ids([w.encode("utf-8", "surrogatepass") for w in words])
        ids, lengths = np.concatenate([ids, list(special.values())]).astype(np.uint32), np.concatenate([lengths, np.ones(len(special), np.int64)])
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        which = np.fromiter(map(of.__getitem__, chain.from_iterable(cut)), np.int64, int(counts.sum()))
        flat = _gather(ids, (np.cumsum(lengths) - lengths)[which], lengths[which])
        ends = np.concatenate([[0], np.cumsum(lengths[which])])[np.cumsum(counts)]
        used = int(self.starts[-1])
        if used + len(flat) > len(self.ids):
            self.ids = np.resize(self.ids, max(2 * len(self.ids), used + len(flat)))
        self.ids[used:used + len(flat)] = flat
        self.chunks.update(zip(chunks, range(len(self.starts) - 1, len(self.starts) - 1 + len(chunks)), strict=True))
        self.starts = np.concatenate([self.starts, used + ends])

    def cut(self, text: str) -> list[str]:
        """Chunks whose ids, end to end, are the text's."""
        if self.special and "<" in text and self.special.search(text):
            return [c for part in self.special.split(text) for c in ([part] if part in self.vocabulary.special else self.cut(part))]
        return chunks_of(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and each text's number of ids."""
        if len(self.chunks) > MEMO_WORDS:
            self.clear()
        cut = [self.cut(t) for t in texts]
        new = list(set().union(*cut).difference(self.chunks))
        if new:
            self.learn(new)
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        order = np.fromiter(map(self.chunks.__getitem__, chain.from_iterable(cut)), np.int64, int(counts.sum()))
        lengths = np.diff(self.starts)[order]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        last = np.cumsum(counts)
        ids = self.ids[np.repeat(self.starts[order] - ends[:-1], lengths) + np.arange(int(ends[-1]))]
        return ids, ends[last] - ends[last - counts]


def uneven(text: str) -> bool:
    """Whether white space stands at an end of the text, or a space beside other white space: it is then not cut at spaces."""
    return (text[0].isspace() or text[-1].isspace() or "  " in text
            or any(w in text and (w + " " in text or " " + w in text) for w in _WHITE))


def chunks_of(text: str) -> list[str]:
    """The text cut before single spaces between other characters, where a word
    always ends; a text with other runs of white space is cut into words."""
    if not text:
        return []
    if uneven(text):
        return _WORDS.findall(text)
    first, *rest = text.split(" ")
    return [first, *[" " + c for c in rest]]


# -- on Spark ---------------------------------------------------------------

def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): how often each word of the pre-tokenizer stands in all texts."""
    @lean
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunks: Counter[str] = Counter()

        def words() -> pd.DataFrame:
            out: Counter[str] = Counter()
            for chunk, n in chunks.items():
                for word in _WORDS.findall(chunk):
                    out[word] += n
            chunks.clear()
            return pd.DataFrame({"word": list(out), "n": list(out.values())})

        for batch in batches:
            for text in batch["text"]:
                chunks.update(chunks_of(text or ""))
                if len(chunks) > COUNT_WORDS:
                    yield words()
        if chunks:
            yield words()

    counted = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def publish_lexicon(docs: DataFrame, tokenizer_path: str, text_col: str = "text", words: int = LEXICON_WORDS) -> str:
    """Count words, compile the lexicon, write it to the shared folder and ship it; its file name."""
    spark = docs.sparkSession
    counts = write_through(word_counts(docs, text_col).filter(F.octet_length("word") <= LEXICON_BYTES), "word-counts")
    # the least count at which no more than the wanted words remain, from the counts of counts
    sizes = counts.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.count("*").alias("words")).collect()
    held, least = 0, 1
    for row in sorted(sizes, reverse=True):
        held += row["words"]
        if held > words:
            least = row["n"] + 1
            break
    frequent = counts.filter(F.col("n") >= least).select("word").limit(words)
    vocabulary = _vocabulary(tokenizer_path)
    held = sorted(r["word"].encode("utf-8", "surrogatepass") for r in frequent.collect())
    data = Transducer.compile((w, vocabulary.merge(w)) for w in held)
    return _ship(spark, data)


def _ship(spark: SparkSession, data: bytes) -> str:
    sc = spark.sparkContext
    path = scratch_path(spark, "lexicon")
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data))
    out.close()
    sc.addFile(path)
    return path.rsplit("/", 1)[1]


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def _encoder(tokenizer_path: str, lexicon: str) -> Encoder:
    return Encoder(_vocabulary(tokenizer_path), Transducer(SparkFiles.get(lexicon)))


def encode_decode(text: Column, tokenizer_path: str, lexicon: str) -> Column:
    """Struct of ``ids`` (little-endian unsigned 32-bit) and ``decoded`` (the text read back from the ids).

    Null counts as empty: no ids, an empty text.  Special tokens' strings in a
    text become their ids and come back as their strings.
    """
    @F.pandas_udf(ENCODED)
    @lean
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer_path, lexicon)
        vocabulary = encoder.vocabulary
        for batch in batches:
            all_ids, all_texts = [], []
            for at in range(0, len(batch), 256):
                ids, counts = encoder.encode([t or "" for t in batch.iloc[at:at + 256]])
                raw, sizes = vocabulary.decode(ids), np.concatenate([[0], np.cumsum(vocabulary.sizes[ids])])
                ends = np.cumsum(counts)
                little = ids.astype("<u4")
                for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
                    all_ids.append(little[a:b].tobytes())
                    all_texts.append(raw[sizes[a]:sizes[b]].tobytes().decode("utf-8", "replace"))
            yield pd.DataFrame({"ids": all_ids, "decoded": all_texts})
        encoder.clear()

    return run(text)
