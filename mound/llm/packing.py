"""Harmonic packing of token sequences.

A document of n tokens is cut into whole sequences of ``capacity`` tokens and
one remainder.  Remainders are dealt into reciprocal-capacity classes: class k
holds lengths in (C / (k + 1), C / k], and a bin of class k takes exactly k
documents, which always fit.  A worker fills the bins of each class on its
own, over the documents of its partition, in bounded runs of documents; no
row is shuffled.

Bins of k documents leave gaps.  Of each run, the shortest remainders, those
of classes too fine to keep, and the ones left over from a class's last bin
are not dealt into bins: laid end to end they form a stream that is cut freely
to fill the gaps exactly.  What the gaps do not take forms whole sequences,
and the rest, shorter than C, is cut into powers of two, which need no
padding.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mound.llm.memory import lean

CAPACITY = 4096
#: Remainders under CAPACITY / CLASSES go to the stream.
CLASSES = 16
#: Documents and tokens that a worker packs in one run.
RUN_DOCS, RUN_TOKENS = 2048, 2_000_000
#: Distinct words and chunks whose ids a worker remembers.
MEMO_CHUNKS = 400_000
#: Chunks that go through the tokenizer together.
JOINED = 500
PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


#: Characters at which ``str.split`` cuts but tokenizers see no white space.
_CONTROLS = re.compile("[\x1c-\x1f]")


# -- token ids --------------------------------------------------------------

#: Latin letters behind ASCII that composition leaves as they are and whose lower case is one of them
#: (so without the dotted capital I), as ranges of a character class.
_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_LATIN = re.compile(f"[\x00-\x7f{_LETTERS}]*")


def latin_pieces(rules: dict) -> re.Pattern | None:
    """The words into which a tokenizer cuts lower-cased text of ASCII and ``_LETTERS``; None if its rules are of another kind.

    On such text, composition changes nothing and the classes of letters and digits are plain ranges.
    """
    normal = rules.get("normalizer") or {}
    cutter = rules.get("pre_tokenizer") or {}
    kinds = [n["type"] for n in normal.get("normalizers", ())]
    steps = cutter.get("pretokenizers", [])
    if (kinds != ["NFC", "Replace", "Lowercase"] or normal["normalizers"][1]["pattern"] != {"Regex": r"\s+"}
            or normal["normalizers"][1]["content"] != " " or [p["type"] for p in steps] != ["Split", "ByteLevel"]
            or (steps[0]["behavior"], steps[0]["invert"]) != ("Removed", True)
            or steps[1]["use_regex"] or steps[1]["add_prefix_space"] or "(" in steps[0]["pattern"].get("Regex", "(")):
        return None
    return re.compile(steps[0]["pattern"]["Regex"].replace(r"\p{L}", "a-zA-Z" + _LETTERS).replace(r"\p{N}", "0-9"), re.ASCII)


class ChunkEncoder:
    """Ids of whole texts through a tokenizer that never joins across white space.

    A text is cut at white space; each distinct chunk is encoded once by the
    tokenizer and remembered.  That is exact for a tokenizer whose normaliser
    and splitter treat white space as a hard boundary and drop it.  A Latin
    text without a special token is cut into its words at once, and the
    words' ids are remembered: there are far fewer of them than of chunks,
    which are words with their punctuation.  A Latin chunk of another text is
    put together from its words' ids.  Words go through the tokenizer many at a
    time, and the mark of a word's end, which its last id bears, tells their
    ids apart.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.end_id = end_id
        self.mark = "<|endoftext|>"
        self.mark_id = self.tokenizer.token_to_id(self.mark)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.special = re.compile("|".join(map(re.escape, [self.mark, *added])))
        self.hint = min(set.intersection(*map(set, [self.mark, *added])), default="")  # a character of every special token
        rules = json.loads(self.tokenizer.to_str())
        suffix = rules["model"].get("end_of_word_suffix")
        self.pieces = latin_pieces(rules) if suffix else None
        vocabulary = rules["model"]["vocab"] if self.pieces else {}
        self.ends = np.zeros(1 + max(vocabulary.values(), default=0), bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks end to end, and each one's number of ids.

        Many chunks go through the tokenizer as one text, with a special token
        between them, at which it cuts before anything else."""
        texts = [self.mark.join(chunks[a:a + JOINED]) for a in range(0, len(chunks), JOINED)]
        ids = np.concatenate([np.append(np.array(e.ids, np.int64), self.mark_id)
                              for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        marks = np.flatnonzero(ids == self.mark_id)
        return ids[ids != self.mark_id], np.diff(marks, prepend=-1) - 1

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``_ids`` for words that the tokenizer leaves whole and that hold no special token."""
        texts = [" ".join(words[a:a + JOINED]) for a in range(0, len(words), JOINED)]
        ids = np.concatenate([np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        lengths = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        return (ids, lengths) if len(lengths) == len(words) and lengths.sum() == len(ids) else self._ids(words)

    def _keep(self, chunks: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        used = int(self.starts[-1])
        if used + len(flat) > len(self.ids):
            self.ids = np.resize(self.ids, max(2 * len(self.ids), used + len(flat)))
        self.ids[used:used + len(flat)] = flat
        self.known.update(zip(chunks, range(len(self.starts) - 1, len(self.starts) - 1 + len(chunks)), strict=True))
        self.starts = np.concatenate([self.starts, used + np.cumsum(lengths)])

    def _known_ids(self, groups: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known chunks end to end, and each group's number of ids."""
        counts = np.fromiter(map(len, groups), np.int64, len(groups))
        order = np.fromiter(map(self.known.__getitem__, chain.from_iterable(groups)), np.int64, int(counts.sum()))
        lengths = np.diff(self.starts)[order]
        of_group = np.add.reduceat(np.append(lengths, 0), np.minimum(np.cumsum(counts) - counts, len(lengths))) * (counts > 0)
        source = np.repeat(self.starts[order] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
        return self.ids[source], of_group

    def _words(self, text: str) -> list[str] | None:
        """The words of a Latin text without a special token; None for another text."""
        if not self.pieces or not (text.isascii() or _LATIN.fullmatch(text)):
            return None
        text = text.lower()
        return None if self.hint in text and self.special.search(text) else self.pieces.findall(text)

    def learn(self, chunks: list[str]) -> None:
        odd, plain, made = [], [], {}
        pieces, hint = self.pieces, self.hint
        for c in chunks:
            if hint in c and self.special.search(c.lower() if pieces else c):
                odd.append(c)
            elif pieces and (c.isascii() or _LATIN.fullmatch(c)):
                made[c] = pieces.findall(c.lower())
            else:
                plain.append(c)
        words = list(set(chain.from_iterable(made.values())).difference(self.known))
        if words:
            self._keep(words, *self._word_ids(words))
        if plain:
            self._keep(plain, *self._ids(plain))
        more = [self.tokenizer.encode(c, add_special_tokens=False).ids for c in odd]
        if more:
            self._keep(odd, np.concatenate([np.array(ids, np.int64) for ids in more]), np.fromiter(map(len, more), np.int64, len(more)))
        made = {c: ws for c, ws in made.items() if c not in self.known}  # but for those that are words themselves
        if made:
            self._keep(list(made), *self._known_ids(list(made.values())))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, each text's closed by ``end_id``, and each text's number of ids."""
        if len(self.known) > MEMO_CHUNKS:
            self.clear()
        words, chunks, cut = set(), set(), []
        for t in texts:
            own = self._words(t)
            if own is not None:
                words.update(own)
            else:
                own = t.split() if not _CONTROLS.search(t) else t.split(" ")
                chunks.update(own)
            cut.append(own)
        new = list(words.difference(self.known))
        if new:
            self._keep(new, *self._word_ids(new))
        new = list(chunks.difference(self.known))
        if new:
            self.learn(new)
        flat, of_text = self._known_ids(cut)
        # an end mark behind each text's ids
        totals = of_text + 1
        out = np.full(int(totals.sum()), self.end_id, np.uint32)
        out[np.arange(len(flat)) + np.repeat(np.arange(len(texts)), of_text)] = flat
        return out, totals


@lru_cache(maxsize=2)
def _encoder(path: str, end_id: int) -> ChunkEncoder:
    return ChunkEncoder(path, end_id)


# -- packing of one run -----------------------------------------------------

def classes(lengths: np.ndarray, capacity: int) -> np.ndarray:
    return capacity // lengths


def _deal(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Harmonic bins for ``lengths``: each one's bin (-1: left over), and the gap of each bin."""
    cls = classes(lengths, capacity)
    order = np.argsort(cls, kind="stable")
    sorted_cls = cls[order]
    first = np.searchsorted(sorted_cls, sorted_cls, "left")
    size = np.searchsorted(sorted_cls, sorted_cls, "right") - first
    rank = np.arange(len(order)) - first
    full = rank < size // sorted_cls * sorted_cls
    opens = full & (rank % sorted_cls == 0)
    bins = np.full(len(lengths), -1)
    bins[order] = np.where(full, np.cumsum(opens) - 1, -1)
    filled = np.bincount(bins[bins >= 0], lengths[bins >= 0], int(opens.sum())).astype(np.int64)
    return bins, capacity - filled


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) for documents of ``lengths`` >= 1.

    Every token is in one piece, sequences are gapless from 0 and number from
    0, and each is full or a power of two long.
    """
    lengths = np.asarray(lengths, np.int64)
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    for doc in np.flatnonzero(lengths >= capacity):
        for start in range(0, int(lengths[doc]) // capacity * capacity, capacity):
            pieces.append((int(doc), start, capacity, sequence, 0))
            sequence += 1
    rest = lengths % capacity
    docs = np.flatnonzero(rest)
    docs = docs[np.argsort(rest[docs], kind="stable")]
    size = rest[docs]
    if not len(docs):
        return pieces
    # the shortest remainders form the stream: as few as fill the gaps that the others leave
    low, high = int(np.searchsorted(size, capacity // CLASSES, "left")), len(docs)
    while low < high:
        m = (low + high) // 2
        bins, gaps = _deal(size[m:], capacity)
        enough = size[:m].sum() + size[m:][bins < 0].sum() >= gaps.sum()
        low, high = (low, m) if enough else (m + 1, high)
    bins, gaps = _deal(size[low:], capacity)
    dealt = np.flatnonzero(bins >= 0)
    for b, members in enumerate(np.split(dealt[np.argsort(bins[dealt], kind="stable")],
                                         np.cumsum(np.bincount(bins[dealt], minlength=len(gaps)))[:-1]) if len(gaps) else ()):
        at = 0
        for i in members:
            doc = int(docs[low + i])
            n = int(size[low + i])
            pieces.append((doc, int(lengths[doc] - n), n, sequence + b, at))
            at += n
    stream = np.concatenate([docs[:low], docs[low:][bins < 0]])
    left = int(rest[stream].sum())
    spaces = [(sequence + b, int(capacity - gap), int(gap)) for b, gap in enumerate(gaps) if gap]
    sequence += len(gaps)
    left -= int(gaps.sum())
    while left > 0:
        space = capacity if left >= capacity else 1 << (left.bit_length() - 1)
        spaces.append((sequence, 0, space))
        sequence += 1
        left -= space
    which = 0
    target, at, room = spaces[0] if spaces else (0, 0, 0)
    for doc in map(int, stream):
        start, todo = int(lengths[doc] - rest[doc]), int(rest[doc])
        while todo:
            if not room:
                which += 1
                target, at, room = spaces[which]
            n = min(todo, room)
            pieces.append((doc, start, n, target, at))
            start, todo, at, room = start + n, todo - n, at + n, room - n
    return pieces


# -- on Spark ---------------------------------------------------------------

def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece (``PIECE``): its ids (little-endian unsigned 32-bit), place in
    the document and place in the sequence.

    Null and empty texts consist of the end id alone.  Null ids stay null;
    rows that repeat an id are packed one by one.  Other columns are ignored.
    An empty table gives no pieces.  Sequence ids are unique over the table:
    the partition number in the upper bits, a count in the lower 40.
    """
    @lean
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer_path, end_id)
        base = TaskContext.get().partitionId() << 40
        ids: list = []
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0

        def flush() -> pd.DataFrame:
            nonlocal base, held
            flat, lengths = np.concatenate(parts), np.concatenate(sizes)
            begins = np.cumsum(lengths) - lengths
            pieces = pack(lengths, capacity)
            out = pd.DataFrame({
                "doc_id": pd.array([ids[d] for d, *_ in pieces], "Int64"),
                "start": [s for _, s, *_ in pieces], "length": [n for _, _, n, *_ in pieces],
                "ids": [flat[begins[d] + s:begins[d] + s + n].astype("<u4").tobytes() for d, s, n, *_ in pieces],
                "doc_tokens": [int(lengths[d]) for d, *_ in pieces],
                "sequence_id": [base + q for *_, q, _ in pieces], "offset": [o for *_, o in pieces]})
            base += 1 + max((q for *_, q, _ in pieces), default=-1)
            ids.clear(), parts.clear(), sizes.clear()
            held = 0
            return out

        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                flat, lengths = encoder.encode([t or "" for t in part["text"]])
                ids.extend(None if pd.isna(i) else int(i) for i in part["id"])
                parts.append(flat)
                sizes.append(lengths)
                held += len(flat)
                if len(ids) >= RUN_DOCS or held >= RUN_TOKENS:
                    yield flush()
        if ids:
            yield flush()
        encoder.clear()  # the next partition's stage may be another

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return chosen.mapInPandas(run, PIECE)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def padding(lengths: dict[int, int], capacity: int = CAPACITY) -> int:
    """Padding tokens of sequences with the given filled lengths."""
    return sum(0 if n & (n - 1) == 0 else capacity - n for n in lengths.values())


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
