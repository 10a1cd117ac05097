"""Language identification by interpolated Kneser-Ney character models.

Texts are lower-cased; runs of non-letters become one space.  Spark counts
all character 4-grams of all training texts per language, and keeps every one.
Kneser-Ney statistics (absolute discounts from the counts of counts,
continuation counts below the highest order) give, for every gram seen in any
language, its interpolated log probability in each language; unseen grams back
off through the contexts' weights.  Spark computes both over the whole table
of counts and writes them, sorted, to the shared folder; the files are shipped
to the executors and memory-mapped by every Python worker, so workers of a
machine share their pages and the driver holds no gram.

A text goes to the language of lowest cross-entropy per character.  It is
rejected when even that is no better than what texts of the other languages
get from the model on average (over all training texts: a mean of cross-
entropies is a weighted sum over the grams counted, so each gram is looked up
once), so that a language no model has learned goes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mound.llm.batches import slices
from mound.llm.memory import lean
from mound.session import scratch_path, write_through

ORDER = 4
#: Grams of each order in a part of the model, about.
PART_GRAMS = 200_000
#: Shorter texts are never rejected for their cross-entropy, nor calibrate its bound.
LEAST_CHARS = 40
#: Texts whose grams are in memory together, at most, and grams whose probabilities are.
SLICE, GRAMS = 64, 1 << 16
PREDICTED = "lang_pred string, score double, cross_entropy double, chars long, rejected boolean"

_SPACE, _OTHER = 0x20, 0xFFFF
_LETTER = np.array([chr(c).isalpha() for c in range(0x10000)])
_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hash(grams: np.ndarray) -> np.ndarray:
    """A 64-bit hash, one to one, so that equal hashes mean equal grams."""
    h = grams.astype(np.uint64) * _MIX
    return h ^ (h >> np.uint64(32))


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts end to end, each text behind ORDER - 1 spaces of its own, and each symbol's text."""
    parts = [t.lower().encode("utf-32-le", "surrogatepass") for t in texts]
    gap = ("\0" * (ORDER - 1)).encode("utf-32-le")
    codes = np.frombuffer(gap.join([b"", *parts]), np.uint32)
    sizes = np.fromiter((len(p) // 4 for p in parts), np.int64, len(parts)) + ORDER - 1
    owner = np.repeat(np.arange(len(texts)), sizes)
    padding = np.arange(len(codes)) - (np.cumsum(sizes) - sizes)[owner] < ORDER - 1
    low = np.minimum(codes, _OTHER)
    letter = _LETTER[low]
    wide = np.flatnonzero(codes >= _OTHER)
    if len(wide):
        values, back = np.unique(codes[wide], return_inverse=True)
        letter[wide] = np.array([chr(v).isalpha() for v in values])[back]
    before = np.concatenate([[False], letter[:-1]])
    keep = letter | padding | before
    return np.where(letter, low, _SPACE).astype(np.uint64)[keep], np.where(padding, -1, owner)[keep]


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All 4-grams (16 bits a symbol) that end in a text's own symbols, and each one's text."""
    sym, owner = symbols(texts)
    if not len(sym):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    gram = sym[ORDER - 1:].copy()
    for back in range(1, ORDER):
        gram |= sym[ORDER - 1 - back:len(sym) - back] << np.uint64(16 * back)
    own = owner[ORDER - 1:] >= 0
    return gram[own], owner[ORDER - 1:][own]


def _merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts and of their shares."""
    keys, counts, shares = (np.concatenate(x) for x in zip(*parts, strict=True))
    values, back = np.unique(keys, return_inverse=True)
    return values, np.bincount(back, counts, len(values)).astype(np.int64), np.bincount(back, shares, len(values))


def gram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n, share) over all texts with a language.

    ``share`` sums what the gram's places are of each text of ``LEAST_CHARS``
    symbols or more, so a language's shares add up to its number of such texts."""
    @lean
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}

        def out(lang: str) -> pd.DataFrame:
            keys, counts, shares = _merged(held.pop(lang))
            return pd.DataFrame({"lang": lang, "gram": keys.view(np.int64), "n": counts, "share": shares})

        for batch in batches:
            for lang, part in batch.groupby("lang"):
                texts = [t or "" for t in part["text"]]
                for some in slices(list(map(len, texts)), SLICE):
                    grams, owner = grams_of(texts[some])
                    sizes = np.bincount(owner, minlength=1)
                    share = np.where(sizes >= LEAST_CHARS, 1 / np.maximum(sizes, 1), 0.0)
                    held.setdefault(lang, []).append(_merged([(grams, np.ones(len(grams), np.int64), share[owner])]))
                    if sum(len(k) for k, _, _ in held[lang]) > 500_000:
                        held[lang] = [_merged(held[lang])]
                        if len(held[lang][0][0]) > 400_000:
                            yield out(lang)
        for lang in list(held):
            yield out(lang)

    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang is not null")
    return (rows.mapInPandas(count, "lang string, gram long, n long, share double")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("share").alias("share")))


@dataclass
class Model:
    """Per order k: sorted gram hashes with log probabilities, sorted context hashes with log back-off weights."""

    langs: list[str]
    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    floor: float
    thresholds: np.ndarray | None = None

    def look_up(self, kind: str, order: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of "logs" (by gram) or "weights" (by context) of the keys, and which keys have one."""
        table, values = (self.grams, self.logs) if kind == "logs" else (self.contexts, self.weights)
        rows, hit = _find(table[order - 1], gram_hash(keys))
        return values[order - 1][rows], hit

    def log_probabilities(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """(grams x languages) log probabilities."""
        if order == 0:
            return np.full((len(grams), len(self.langs)), self.floor, np.float32)
        own = grams & np.uint64((1 << 16 * order) - 1) if order < 4 else grams
        out, hit = self.look_up("logs", order, own)
        miss = np.flatnonzero(~hit)
        if len(miss):
            weight, hit = self.look_up("weights", order, own[miss] >> np.uint64(16))
            weight = np.where(hit[:, None], weight, np.float32(0))
            out[miss] = weight + self.log_probabilities(grams[miss], order - 1)
        return out

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages) mean negative log probability per symbol, and each text's number of symbols.

        Texts of no symbol have zeros."""
        grams, owner = grams_of(texts)
        n = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), np.int64)
        total = np.zeros((len(texts), len(self.langs)))
        if len(owner):
            for at in range(0, len(grams), GRAMS):
                mine = owner[at:at + GRAMS]
                starts = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
                logs = self.log_probabilities(grams[at:at + GRAMS])
                total[mine[starts]] += np.add.reduceat(logs, starts, axis=0, dtype=np.float64)
        return -total / np.maximum(n, 1)[:, None], n


@dataclass
class ShippedModel(Model):
    """The tables lie in shipped files, in ``parts`` parts by the key's remainder, each sorted by key."""

    files: tuple[str, ...] = ()
    parts: int = 1

    def look_up(self, kind: str, order: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tables = _opened(self.files, len(self.langs))
        keys = keys.view(np.int64)
        out, hit = np.zeros((len(keys), len(self.langs)), np.float32), np.zeros(len(keys), bool)
        part = np.mod(keys, self.parts) if self.parts > 1 else np.zeros(len(keys), np.int64)
        by_part = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[by_part], np.arange(self.parts + 1))
        for p in np.flatnonzero(np.diff(edges)).tolist():
            if (kind, order, p) in tables:
                mine = by_part[edges[p]:edges[p + 1]]
                table, values = tables[kind, order, p]
                rows, found = _find(table, keys[mine])
                out[mine], hit[mine] = values[rows], found
        return out, hit


KINDS = ("logs", "weights")
#: Behind each part in a file: as long as a key, so that all parts stay aligned.
_END = "--------"


@lru_cache(maxsize=2)
def _opened(files: tuple[str, ...], langs: int) -> dict[tuple[str, int, int], tuple[np.ndarray, np.ndarray]]:
    """The memory-mapped keys and values of each (kind, order, part)."""
    out = {}
    for name in files:
        data = np.memmap(SparkFiles.get(name), np.uint8, "r").view(np.ndarray)
        at = 0
        while at < len(data):
            kind, order, part, n = data[at:at + 32].view(np.int64).tolist()
            values = at + 32 + 8 * n
            out[KINDS[kind], order, part] = data[at + 32:values].view(np.int64), data[values:values + 4 * n * langs].view(np.float32).reshape(n, langs)
            at = values + -(-4 * n * langs // 8) * 8 + len(_END)
    return out


def _packed(group: pd.DataFrame) -> pd.DataFrame:
    """One part as bytes: kind, order, part, number of keys, sorted keys, values, filled up to a multiple of 8."""
    group = group.sort_values("key")
    head = np.array([*(int(group[c].iloc[0]) for c in ("kind", "order", "part")), len(group)], np.int64)
    values = np.array(group["value"].tolist(), np.float32).tobytes()
    data = head.tobytes() + group["key"].to_numpy(np.int64).tobytes() + values + bytes(-len(values) % 8)
    return pd.DataFrame({"data": [data]})


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def _discount(counts: np.ndarray) -> float:
    return _discount_of(int((counts == 1).sum()), int((counts == 2).sum()))


def _discount_of(once: int, twice: int) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


def build_model(counts: pd.DataFrame) -> Model:
    """Interpolated Kneser-Ney models from (lang, gram, n), in memory; ``shipped_model`` computes the same on Spark."""
    langs = sorted(counts["lang"].unique())
    per_order: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ORDER)]
    for lang in langs:
        own = counts[counts["lang"] == lang]
        keys, n = own["gram"].to_numpy(np.int64).view(np.uint64), own["n"].to_numpy(np.int64)
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        per_order[ORDER - 1].append((keys, n))
        for k in range(ORDER - 1, 0, -1):
            keys, n = np.unique(keys & np.uint64((1 << 16 * k) - 1), return_counts=True)
            per_order[k - 1].append((keys, n))
    alphabet = len(np.unique(np.concatenate([k for k, _ in per_order[0]]))) + 1
    model = Model(langs, [], [], [], [], -math.log(alphabet))
    for k in range(1, ORDER + 1):
        union = np.unique(np.concatenate([keys for keys, _ in per_order[k - 1]]))
        contexts = np.unique(union >> np.uint64(16))
        shares, weights = np.zeros((len(union), len(langs))), np.ones((len(contexts), len(langs)))
        for j, (keys, n) in enumerate(per_order[k - 1]):
            d = _discount(n)
            place = np.searchsorted(contexts, keys >> np.uint64(16))
            total = np.bincount(place, n, len(contexts))
            types = np.bincount(place, minlength=len(contexts))
            shares[np.searchsorted(union, keys), j] = np.maximum(n - d, 0) / total[place]
            seen = total > 0
            weights[seen, j] = d * types[seen] / total[seen]
        lower = np.exp(model.log_probabilities(union, k - 1).astype(np.float64))
        logs = np.log(shares + weights[np.searchsorted(contexts, union >> np.uint64(16))] * lower)
        for keys, values, table, rows in ((union, logs, model.grams, model.logs), (contexts, np.log(weights), model.contexts, model.weights)):
            h = gram_hash(keys)
            order = np.argsort(h)
            table.append(h[order])
            rows.append(values[order].astype(np.float32))
    return model


def _tables(counts: DataFrame, langs: list[str]) -> tuple[DataFrame, float]:
    """(kind, order, key, value) of all orders from (lang, gram, n), values by language, and the log probability of an unseen symbol."""
    low = lambda k: F.col("gram").bitwiseAND(F.lit((1 << 16 * k) - 1))
    per_order = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        per_order[k] = write_through(per_order[k + 1].groupBy("lang", low(k).alias("gram")).agg(F.count("*").alias("n")), f"grams-{k}")
    floor = -math.log(per_order[1].select("gram").distinct().count() + 1)

    def by_lang(value: Column, default: float) -> Column:
        return F.array(*[F.coalesce(F.max(F.when(F.col("lang") == lang, value)), F.lit(default)) for lang in langs])

    out, lower = [], None
    for k in range(1, ORDER + 1):
        own = per_order[k].withColumn("context", F.shiftrightunsigned("gram", 16))
        seen = own.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect()
        d = F.create_map(*[F.lit(x) for r in seen for x in (r["lang"], _discount_of(r["once"], r["twice"]))])[F.col("lang")]
        stats = own.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
        weights = write_through(stats.groupBy("context").agg(by_lang(d * F.col("types") / F.col("total"), 1.0).alias("weight")), f"weights-{k}")
        shares = own.join(stats, ["lang", "context"]).groupBy("gram", "context").agg(
            by_lang(F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("total"), 0.0).alias("share"))
        if lower is None:
            backed = shares.withColumn("lower", F.array_repeat(F.lit(math.exp(floor)), len(langs)))
        else:
            backed = shares.withColumn("suffix", low(k - 1)).join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("lower")), "suffix")
        behind = F.zip_with("weight", "lower", lambda w, p: w * p)
        lower = write_through(backed.join(weights, "context").select("gram", F.zip_with("share", behind, lambda x, y: x + y).alias("p")), f"probabilities-{k}")
        for kind, table in enumerate((lower.toDF("key", "value"), weights.select("context", "weight").toDF("key", "value"))):
            out.append(table.select(F.lit(kind).alias("kind"), F.lit(k).alias("order"), "key", F.transform("value", lambda x: F.log(x).cast("float")).alias("value")))
    return reduce(DataFrame.union, out), floor


def shipped_model(counts: DataFrame, part_grams: int = PART_GRAMS) -> ShippedModel | None:
    """The model of every gram in (lang, gram, n), computed on Spark and shipped in files; None without a gram."""
    spark = counts.sparkSession
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not langs:
        return None
    tables, floor = _tables(counts, langs)
    parts = math.ceil(counts.select("gram").distinct().count() / part_grams) | 1  # odd, so that all bits of a gram take part
    packed = tables.withColumn("part", F.pmod("key", F.lit(parts))).groupBy("kind", "order", "part").applyInPandas(_packed, "data binary")
    path = scratch_path(spark, "language-model")
    packed.select(F.col("data").cast("string").alias("value")).write.option("lineSep", _END).text(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    files = [f.getPath() for f in found if f.getPath().getName().startswith("part-") and f.getLen()]
    for f in files:
        spark.sparkContext.addFile(f.toString())
    return ShippedModel(langs, [], [], [], [], floor, files=tuple(f.getName() for f in files), parts=parts)


def _bounded(counts: DataFrame, most: int) -> DataFrame:
    """The grams of the highest counts, at most ``most``: cut at a count, found from the counts of counts."""
    sizes = sorted(((r["n"], r["grams"]) for r in counts.groupBy(F.least("n", F.lit(10_000)).alias("n")).agg(F.count("*").alias("grams")).collect()), reverse=True)
    held, least = 0, 1
    for n, grams in sizes:
        held += grams
        if held > most:
            least = n + 1
            break
    return counts.filter(F.col("n") >= least).limit(most)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int | None = None) -> Model | None:
    """Count over all of ``docs``, build the model, calibrate rejection on all of its texts; None without a text in a language.

    The bound of a language is the mean of its model's cross-entropies over
    the texts of the others, taken from the counted grams and their shares.
    Every gram is kept, unless a caller asks for the ``most`` frequent ones only."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang is not null and text is not null")
    counts = write_through(gram_counts(rows), "grams")
    model = shipped_model(counts if most is None else _bounded(counts, most))
    if model is None:
        return None
    shared = rows.sparkSession.sparkContext.broadcast(model)
    langs = model.langs

    @lean
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(len(langs)), np.zeros(len(langs))
        for batch in batches:
            for at in range(0, len(batch), GRAMS):
                some = batch.iloc[at:at + GRAMS]
                share = some["share"].to_numpy()[:, None] * (some["lang"].to_numpy()[:, None] != np.array(langs))
                total -= (share * shared.value.log_probabilities(some["gram"].to_numpy(np.int64).view(np.uint64))).sum(axis=0)
                n += share.sum(axis=0)
        yield pd.DataFrame({"j": range(len(langs)), "total": total, "n": n})

    alien = {r["j"]: r["total"] / r["n"] for r in counts.filter("share > 0").mapInPandas(measure, "j int, total double, n double")
             .groupBy("j").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect() if r["n"] > 0}
    model.thresholds = np.array([alien.get(j, -model.floor) for j in range(len(langs))])
    return model


def predict(text: Column, model: Model | None, spark) -> Column:
    """Struct of ``PREDICTED`` for each text.

    Null texts and texts without a letter: ``und``, score 0, rejected.  Ties
    go to the language that sorts first.  The score is the best language's
    share of exp(-cross-entropy); without a model every text is ``und``.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(PREDICTED)
    @lean
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        names = [c.split()[0] for c in PREDICTED.split(", ")]
        for batch in batches:
            rows = []
            all_texts = [t or "" for t in batch]
            for some in slices(list(map(len, all_texts)), SLICE):
                texts = all_texts[some]
                if model is None:
                    rows += [("und", 0.0, 0.0, 0, True)] * len(texts)
                    continue
                ce, n = model.cross_entropies(texts)
                best = ce.argmin(axis=1)
                low = ce[np.arange(len(texts)), best]
                score = 1 / np.exp(low[:, None] - ce).sum(axis=1)
                strange = (n >= LEAST_CHARS) & (low >= model.thresholds[best])
                rows += [(model.langs[b], s, c, k, r) if k else ("und", 0.0, 0.0, 0, True) for b, s, c, k, r in zip(
                    best.tolist(), score.tolist(), low.tolist(), n.tolist(), strange.tolist(), strict=True)]
            yield pd.DataFrame(rows, columns=names)

    return run(text)


def held_out(id_column: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4 (a null id counts as an empty text)."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))), F.lit(4)) == 2
