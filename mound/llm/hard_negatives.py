"""Hard negatives by Kronecker-packed integer products.

Vectors become integers, floor(256 x) per component.  A score is the integer
inner product of an anchor and a row.  Several rows share one machine word:
each row's component, biased to be non-negative, has a field of its own, wide
enough for the largest possible sum of products.  A word times a component of
the anchor (biased too) is then the products of all its rows at once, and the
sums of such words over the components hold all their scores, which come out
of their fields exactly once the biases are taken off.  Fields of up to 32
bits are packed in 64-bit words; larger values in Python's integers of any
width, eight rows to an integer.

Rows lie in strips by a hash of their id, anchors in blocks.  A strip and a
block of anchors meet in one task, twice: first for each anchor's positives
(only rows of the anchor's label are compared), then for the negatives within
the window that each positive's score opens.  A task returns, per anchor and
window, no more than the wanted number of rows; Spark ranks what the strips
return.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mound.session import write_through

#: A component x becomes floor(SCALE * x).
SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: The least share of a positive's score that a negative has, in percent.
LEAST_PERCENT = 80
#: Rows of a strip: at most about, and at least about where more strips would not occupy more cores.
STRIP, SMALL_STRIP = 131_072, 4096
#: Anchors of a block, about.
BLOCK = 16_384
#: Anchors and rows whose scores are held at once.
TILE_ANCHORS, TILE_ROWS = 32, 8192
#: Rows packed in one of Python's integers, where 64 bits do not hold two.
WIDE_FIELDS = 8


def quantised(vector: Column) -> Column:
    """floor(SCALE * x) of each component as integers; null where the vector takes no part."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(doubles, lambda x: F.floor(F.lit(float(SCALE)) * x).cast("double"))
    square = F.aggregate(F.transform(doubles, lambda x: (F.abs(x) * SCALE + 1) * (F.abs(x) * SCALE + 1)), F.lit(0.0), lambda s, x: s + x)
    fits = F.coalesce(vector.isNotNull() & finite & (square < float(2**62)), F.lit(False))
    return F.when(fits, F.transform(whole, lambda x: x.cast("int")))


class Packed:
    """Rows (n x d, integers) packed for products with anchors of the given range of components."""

    def __init__(self, rows: np.ndarray, low: int, high: int) -> None:
        self.n, self.d = rows.shape
        self.low, self.bias = low, -int(rows.min(initial=0))
        biased = rows + self.bias
        most = self.d * (high - low) * int(biased.max(initial=0))
        self.bits = max(1, most.bit_length())
        self.fields = 64 // self.bits if self.bits <= 32 else WIDE_FIELDS
        kind = np.uint64 if self.bits <= 32 else object
        words = -(-self.n // self.fields)
        padded = np.zeros((self.d, words * self.fields), kind)
        padded[:, :self.n] = biased.T.astype(kind)
        padded = padded.reshape(self.d, words, self.fields)
        self.words = padded[:, :, 0].copy()
        for f in range(1, self.fields):
            self.words |= padded[:, :, f] << kind(f * self.bits) if kind is np.uint64 else padded[:, :, f] * (1 << f * self.bits)
        #: What the biases add to a row's field, apart from the anchor's own part.
        self.added = rows.sum(axis=1) * -low - self.d * low * self.bias

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """(anchors x rows) inner products, as 64-bit integers."""
        kind = self.words.dtype
        biased = (anchors - self.low).astype(kind)
        total = np.zeros((len(anchors), self.words.shape[1]), kind)
        for k in range(self.d):
            total += biased[:, k, None] * self.words[k]
        mask = kind.type((1 << self.bits) - 1) if kind != object else (1 << self.bits) - 1
        taken = self.added if kind != object else self.added.astype(object)
        if kind != object:
            out = np.empty((len(anchors), total.shape[1], self.fields), np.int64)
            for f in range(self.fields):
                out[:, :, f] = ((total >> np.uint64(f * self.bits)) & mask).astype(np.int64)
            return out.reshape(len(anchors), -1)[:, :self.n] - taken - (anchors.sum(axis=1) * self.bias)[:, None]
        wide = np.stack([(total >> f * self.bits) & mask for f in range(self.fields)], axis=2).reshape(len(anchors), -1)[:, :self.n]
        return (wide - taken - anchors.astype(object).sum(axis=1)[:, None] * self.bias).astype(np.int64)


def _best(group: np.ndarray, score: np.ndarray, vec_id: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` entries of each group: higher scores first, ties by smaller id."""
    order = np.lexsort((vec_id, -score, group))
    g = group[order]
    heads = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, int)
    rank = np.arange(len(g)) - np.repeat(heads, np.diff(np.append(heads, len(g))))
    return order[rank < most]


class _Side:
    """Rows of one group as arrays."""

    def __init__(self, frame: pd.DataFrame) -> None:
        self.dim = int(frame["dim"].iloc[0])
        self.id = frame["vec_id"].to_numpy(np.int64)
        self.label = frame["label"].to_numpy(np.int64)
        self.v = np.frombuffer(b"".join(frame["v"]), np.int32).reshape(len(frame), self.dim).astype(np.int64)


def _tiles(n: int, size: int) -> Iterator[slice]:
    return (slice(at, at + size) for at in range(0, n, size))


def _positives(anchors: pd.DataFrame, rows: pd.DataFrame, most: int) -> pd.DataFrame:
    """(anchor, vec_id, score): the strip's first rows of each anchor's label."""
    a, r = _Side(anchors), _Side(rows)
    low, high = int(a.v.min(initial=0)), int(a.v.max(initial=0))
    found = []
    for label in np.unique(a.label):
        mine, theirs = np.flatnonzero(a.label == label), np.flatnonzero(r.label == label)
        for s in _tiles(len(theirs), TILE_ROWS):
            packed = Packed(r.v[theirs[s]], low, high)
            for t in _tiles(len(mine), TILE_ANCHORS):
                score = packed.scores(a.v[mine[t]])
                other = a.id[mine[t]][:, None] != r.id[theirs[s]]
                floor = np.where(other, score, np.iinfo(np.int64).min)
                kth = max(0, floor.shape[1] - most)
                least = np.partition(floor, kth, axis=1)[:, kth]
                i, j = np.nonzero(other & (score >= least[:, None]))
                kept = _best(i, score[i, j], r.id[theirs[s]][j], most)
                found.append((mine[t][i[kept]], r.id[theirs[s]][j[kept]], score[i[kept], j[kept]]))
    place, vec_id, score = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    kept = _best(place, score, vec_id, most)
    return pd.DataFrame({"anchor": anchors["anchor"].to_numpy()[place[kept]], "vec_id": vec_id[kept], "score": score[kept]})


def _negatives(anchors: pd.DataFrame, rows: pd.DataFrame, most: int, least: int) -> pd.DataFrame:
    """(anchor, positive, vec_id, score): the strip's first rows of another label within each distinct positive score's window."""
    a, r = _Side(anchors), _Side(rows)
    low, high = int(a.v.min(initial=0)), int(a.v.max(initial=0))
    scores = [np.unique(np.asarray(p, np.int64)) for p in anchors["positives"]]
    window = np.array([(-(-least * int(p[0]) // 100), int(p[-1])) for p in scores], np.int64)
    count = np.array([len(p) for p in scores])
    value = np.zeros((len(scores), int(count.max(initial=1))), np.int64)
    for i, p in enumerate(scores):
        value[i, :len(p)] = p
    found = []
    for s in _tiles(len(r.id), TILE_ROWS):
        packed = Packed(r.v[s], low, high)
        for t in _tiles(len(a.id), TILE_ANCHORS):
            score = packed.scores(a.v[t])
            i, j = np.nonzero((score >= window[t, :1]) & (score <= window[t, 1:]) & (a.label[t][:, None] != r.label[s]))
            here, place, vec_id = score[i, j], i + t.start, r.id[s][j]
            for p in range(value.shape[1]):
                positive = value[place, p]
                # ceil(least * positive / 100), without a product that leaves 64 bits
                bound = positive // 100 * least - (-(positive % 100 * least) // 100)
                inside = np.flatnonzero((p < count[place]) & (here <= positive) & (here >= bound))
                kept = inside[_best(place[inside], here[inside], vec_id[inside], most)]
                found.append((place[kept], value[place[kept], p], vec_id[kept], here[kept]))
    place, positive, vec_id, score = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 4
    window_of = np.unique(np.stack([place, positive], axis=1), axis=0, return_inverse=True)[1].ravel()
    kept = _best(window_of, score, vec_id, most)
    return pd.DataFrame({"anchor": anchors["anchor"].to_numpy()[place[kept]], "positive": positive[kept], "vec_id": vec_id[kept], "score": score[kept]})


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST_PERCENT, strip: int = STRIP, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each row that ``is_anchor`` holds of, its first ``positives`` other
    rows of the same label; for each of these, the first ``negatives`` rows of
    another label whose score lies between ``least`` percent of the positive's
    and the positive's.  Higher scores come first, ties by the smaller id.

    Rows with a null id, label or vector, or any null or non-finite component
    take no part, nor do vectors so long that a score could leave 64 bits (the
    integers' squares sum to about 2^62).  An anchor meets vectors of its own
    length only.  Rows that share the anchor's id are not its positives.  Rows
    that repeat an anchor (id, label and vector) are one anchor; other
    repeated rows count each.  Other columns are ignored; an empty table gives
    no rows.
    """
    spark = rows.sparkSession
    vector = F.col(vector_col)
    data = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                       quantised(vector).alias("q"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    data = data.filter("vec_id is not null and label is not null and q is not null").withColumn("dim", F.size("q"))

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            v = [np.asarray(q, np.int32).tobytes() for q in batch["q"]]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "dim": batch["dim"], "asks": batch["asks"], "v": v})

    data = write_through(data.mapInPandas(coded, "vec_id long, label long, dim int, asks boolean, v binary"), "hard-rows")
    asked = data.filter("asks").select("vec_id", "label", "dim", "v").distinct()
    asked = write_through(asked.withColumn("anchor", F.struct("vec_id", F.xxhash64("label", "dim", "v").alias("h"))), "hard-anchors")
    n, m = data.count(), asked.count()
    strips = max(1, math.ceil(n / strip), min(math.ceil(n / SMALL_STRIP), 2 * spark.sparkContext.defaultParallelism))
    blocks = max(1, math.ceil(m / block))
    keys = ("dim", "strip", "block")
    laid = (data.withColumn("strip", F.pmod(F.xxhash64("vec_id"), F.lit(strips)).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))).select(*keys, "vec_id", "label", "v").groupBy(*keys)

    def grid(anchors: DataFrame) -> DataFrame:
        block_of = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
        return anchors.withColumn("block", block_of).withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1)))).groupBy(*keys)

    def near(a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(r):
            return pd.DataFrame({"vec_id": [], "h": [], "positive_id": [], "score": []}).astype("int64")
        out = _positives(a.assign(anchor=np.arange(len(a))), r, positives)
        return pd.DataFrame({"vec_id": a["vec_id"].to_numpy()[out["anchor"]], "h": a["h"].to_numpy()[out["anchor"]],
                             "positive_id": out["vec_id"], "score": out["score"]})

    def far(a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(r):
            return pd.DataFrame({"vec_id": [], "h": [], "positive_score": [], "negative_id": [], "score": []}).astype("int64")
        out = _negatives(a.assign(anchor=np.arange(len(a))), r, negatives, least)
        return pd.DataFrame({"vec_id": a["vec_id"].to_numpy()[out["anchor"]], "h": a["h"].to_numpy()[out["anchor"]],
                             "positive_score": out["positive"], "negative_id": out["vec_id"], "score": out["score"]})

    flat = asked.select("dim", "vec_id", "label", "v", F.col("anchor.h").alias("h"))
    met = grid(flat).cogroup(laid).applyInPandas(near, "vec_id long, h long, positive_id long, score long")
    first = Window.partitionBy("vec_id", "h").orderBy(F.desc("score"), "positive_id")
    chosen = write_through(met.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= positives), "hard-positives")
    held = flat.join(chosen.groupBy("vec_id", "h").agg(F.collect_list("score").alias("positives")), ["vec_id", "h"])
    held = write_through(held, "hard-windows")
    met = grid(held).cogroup(laid).applyInPandas(far, "vec_id long, h long, positive_score long, negative_id long, score long")
    first = Window.partitionBy("vec_id", "h", "positive_score").orderBy(F.desc("score"), "negative_id")
    ranked = met.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= negatives)
    out = chosen.select("vec_id", "h", "positive_id", F.col("score").alias("positive_score")).join(ranked, ["vec_id", "h", "positive_score"])
    return out.select(F.col("vec_id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"))


def relabelled(rows: DataFrame, classes: int = 10, id_col: str = "vec_id", label_col: str = "label") -> DataFrame:
    """Every seventh row's label moved on by one, so that each class holds rows unlike the rest."""
    moved = (F.col(label_col) + 1) % classes
    return rows.withColumn(label_col, F.when(F.col(id_col) % 7 == 0, moved).otherwise(F.col(label_col)))


def oracle_sql() -> str:
    """DuckDB twin: all inner products of anchors and rows."""
    return """WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
    p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT p.anchor_id, positive_id,
      row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
      other_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
    QUALIFY rank <= 5"""
