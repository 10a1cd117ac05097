"""Near-duplicate embeddings by cross-polytope hashing.

A hash function rotates a vector by three rounds of random signs and a fast
Hadamard transform and returns the signed axis nearest to it.  A table's
bucket is the combination of a few functions; as many as keep random buckets
small at the given number of vectors.  More functions, or dimensions, part
similar vectors more often, so the number of tables follows from both: as many
as keep the probability that a pair at the cosine bound meets in none below
``MISS``, whatever the size of the input.  A vector enters, in each table, the
bucket of its own hash and the ``PROBES`` buckets that it missed most closely.

Equal vectors are one class from the start.  All pairs that meet in a bucket
are compared there, in blocks of matrix products; buckets of more than
``BLOCK`` classes are split into blocks that meet pairwise, so no group grows
beyond two blocks.  A pair that meets in several buckets counts in the first
of them, which its members' bucket lists name; so the tasks emit only one
number of links and one edge per vector and bucket, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mound.llm.components import components
from mound.llm.vectors import dots, matrix, usable
from mound.session import write_through

COSINE = 0.9
#: Tables, at least, and probes in each.
TABLES, PROBES = 8, 3
#: A pair at the cosine bound meets in no table with this probability, at most.
MISS = 1e-5
#: Random pairs, and tables, on which the probability of not meeting in a table is measured.
TRIAL_PAIRS, TRIAL_TABLES = 2048, 8
BLOCK = 2000
#: Entries of buckets that are compared in one call, about.
TOGETHER = 20_000
SEED = 1


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the normalised Hadamard matrix; the length of a row is a power of two."""
    n, step = x.shape[1], 1
    while step < n:
        x = x.reshape(len(x), -1, 2, step)
        x = np.concatenate([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=-1).reshape(-1, n)
        step *= 2
    return x / math.sqrt(n)


def _axes(x: np.ndarray, table: int, function: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest signed axes of each rotated row, nearest first, and how far each falls behind the first."""
    for r in range(3):
        signs = np.random.default_rng([SEED, table, function, r, x.shape[1]]).choice([-1.0, 1.0], x.shape[1])
        x = hadamard(x * signs)
    order = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :most]
    value = np.take_along_axis(x, order, 1)
    return order + np.where(value > 0, 0, x.shape[1]), np.abs(value[:, :1]) - np.abs(value)


def buckets(x: np.ndarray, functions: int, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """(rows x tables * (1 + probes)) bucket numbers, distinct between tables and dimensions."""
    size = 1 << max(0, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), size))
    padded[:, :x.shape[1]] = x
    out = []
    for table in range(tables):
        found = [_axes(padded, table, k, probes + 1) for k in range(functions)]
        weights = [(2 * size) ** k for k in range(functions)]
        own = sum(axes[:, 0].astype(np.int64) * w for (axes, _), w in zip(found, weights, strict=True))
        others = np.concatenate([own[:, None] + (axes[:, 1:] - axes[:, :1]) * w for (axes, _), w in zip(found, weights, strict=True)], axis=1)
        behind = np.concatenate([b[:, 1:] for _, b in found], axis=1)
        near = np.argsort(behind, axis=1, kind="stable")[:, :probes]
        codes = np.concatenate([own[:, None], np.take_along_axis(others, near, 1)], axis=1)
        out.append((codes * tables + table) * 4096 + x.shape[1] % 4096)
    return np.concatenate(out, axis=1)


def function_count(count: int, dimension: int) -> int:
    """Functions of a table for so many vectors."""
    size = 2 << max(0, (dimension - 1).bit_length())
    return max(1, round(math.log(max(count, 2)) / math.log(size) - 0.25))


@lru_cache(maxsize=64)
def table_count(functions: int, dimension: int, cosine: float = COSINE, miss: float = MISS) -> int:
    """Tables by which a pair of the given cosine meets in none with probability ``miss``, at most.

    Tables are independent; how often one parts a pair is measured on random pairs, with three standard errors added."""
    random = np.random.default_rng([SEED, functions, dimension])
    a, b = random.standard_normal((2, TRIAL_PAIRS, dimension))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
    x = buckets(a, functions, TRIAL_TABLES).reshape(TRIAL_PAIRS, TRIAL_TABLES, -1)
    y = buckets(cosine * a + math.sqrt(max(0.0, 1 - cosine * cosine)) * b, functions, TRIAL_TABLES).reshape(x.shape)
    trials = TRIAL_PAIRS * TRIAL_TABLES
    parted = 1 - (x[:, :, :, None] == y[:, :, None, :]).any(axis=(2, 3)).mean()
    parted += 3 * math.sqrt(max(parted * (1 - parted), 1 / trials) / trials)
    return max(TABLES, math.ceil(math.log(miss) / math.log(min(parted, 0.9999))))


def _pairs(group: np.ndarray, x: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places of one group that may be similar; rows of a group are neighbours.

    Small groups together, by the distance between places; large ones by blocks of matrix products."""
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(heads, len(group)))
    left = np.repeat(sizes, sizes) - (np.arange(len(group)) - np.repeat(heads, sizes))  # places to the group's end
    small = np.repeat(sizes <= 64, sizes)
    for apart in range(1, int(sizes[sizes <= 64].max(initial=1))):
        a = np.flatnonzero(small & (left > apart))
        for at in range(0, len(a), 8192):
            p = a[at:at + 8192]
            near = np.einsum("ij,ij->i", x[p], x[p + apart]) >= cosine - 1e-9
            yield p[near], p[near] + apart
    for head, size in zip(heads[sizes > 64].tolist(), sizes[sizes > 64].tolist(), strict=True):
        own = x[head:head + size]
        for at in range(0, size, 256):
            a, b = np.nonzero(own[at:at + 256] @ own.T >= cosine - 1e-9)
            a += at
            yield head + a[a < b], head + b[a < b]


def _compare(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links in some groups (a bucket, or two blocks of one): per vector and group, its links that count here and an edge."""
    place = np.lexsort((rows["j"].to_numpy(), rows["i"].to_numpy(), rows["bucket"].to_numpy()))
    bucket, i, j, part, weight = (rows[c].to_numpy()[place] for c in ("bucket", "i", "j", "part", "n"))
    t = rows["t"].to_numpy()[place]
    links, root = np.zeros(len(t), np.int64), np.arange(len(t))
    size = rows["unit"].map(len).to_numpy()[place]
    found = []
    for length in np.unique(size):  # a bucket holds vectors of one length
        at = np.flatnonzero(size == length)
        x = matrix(rows["unit"].iloc[place[at]])
        codes = np.array([np.asarray(c, np.int64) for c in rows["codes"].iloc[place[at]]])
        group = np.cumsum(np.concatenate([[True], (bucket[at][1:] != bucket[at][:-1]) | (i[at][1:] != i[at][:-1]) | (j[at][1:] != j[at][:-1])]))
        for a, b in _pairs(group, x, cosine):
            for s in range(0, len(a), 4096):
                p, q = a[s:s + 4096], b[s:s + 4096]
                p, q = (z[(part[at[p]] != part[at[q]]) | (i[at[p]] == j[at[p]])] for z in (p, q))
                sure = dots(x[p], x[q]) >= cosine
                p, q = p[sure], q[sure]
                common = (codes[p][:, :, None] == codes[q][:, None, :]).any(axis=2)
                first = np.where(common, codes[p], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max) == bucket[at[p]]
                p, q = at[p], at[q]
                np.add.at(links, p[first], weight[q[first]])
                np.add.at(links, q[first], weight[p[first]])
                found.append((p, q))
    p, q = (np.concatenate(z) for z in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2
    while True:  # smallest reachable place, by repeated minima
        low = np.minimum(root[p], root[q])
        before = root.copy()
        np.minimum.at(root, p, low)
        np.minimum.at(root, q, low)
        root = root[root]
        if (root == before).all():
            break
    some = (root != np.arange(len(t))) | (links > 0)
    return pd.DataFrame({"t": t[some], "links": links[some], "root": t[root[some]]})


def linked_vectors(classes: DataFrame, count: int, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(t, links, root) by group, for classes (t, vector, n): links counts the other classes' rows."""
    dimensions = [r["d"] for r in classes.select(F.size("vector").alias("d")).distinct().collect()]
    plans = {d: (f, table_count(f, d, cosine)) for d in dimensions for f in [function_count(count, d)]}

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["vector"].map(len)):
                for at in range(0, len(part), 2048):
                    some = part.iloc[at:at + 2048]
                    x = matrix(some["vector"])
                    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
                    x /= np.sqrt(dots(x, x))[:, None]
                    yield pd.DataFrame({"t": some["t"], "n": some["n"], "unit": list(x), "codes": list(buckets(x, *plans[x.shape[1]]))})

    rows = write_through(classes.mapInPandas(hashed, "t binary, n long, unit array<double>, codes array<long>"), "hashed")
    entries = rows.select("t", F.explode(F.array_distinct("codes")).alias("bucket"))
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    sizes = write_through(sizes.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")), "bucket-sizes")
    dealt = (entries.join(sizes, "bucket")
             .withColumn("part", F.pmod(F.xxhash64("t", "bucket"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("t", "bucket", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")))
    # many groups to a call: about TOGETHER of the rows dealt, of which a bucket of several blocks has one a block for each entry
    calls = max(1, math.ceil((sizes.agg(F.sum(F.col("size") * F.col("blocks"))).first()[0] or 0) / TOGETHER))
    return (dealt.join(rows, "t").groupBy(F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(calls)).alias("call"))
            .applyInPandas(lambda g: _compare(g, cosine), "t binary, links long, root binary"))


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Vectors that are null, zero or hold null or non-finite components link
    with nothing, as do vectors of different lengths.  Rows of one id are
    separate vectors; null ids count as larger than all others, and a row
    alone is its own component (null for a null id).  Other columns are
    ignored; an empty table gives no rows.
    """
    vector = F.col(vector_col)
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.when(usable(vector), F.transform(
        vector, lambda x: x.cast("double") + F.lit(0.0))).alias("vector"))
    rows = rows.withColumn("t", F.unhex(F.md5(F.col("vector").cast("string"))))
    valid = rows.filter("vector is not null")
    classes = write_through(valid.groupBy("t").agg(F.first("vector").alias("vector"), F.count("*").alias("n"), F.min("vec_id").alias("least")), "vector-classes")
    found = write_through(linked_vectors(classes.select("t", "vector", "n"), classes.count(), cosine), "vector-links")
    roots = components(found.select(F.col("t").alias("u"), F.col("root").alias("v")), "vector-components")
    linked = (classes.select("t", "n", "least")
              .join(found.groupBy("t").agg(F.sum("links").alias("links")), "t", "left")
              .join(roots.select(F.col("vertex").alias("t"), "root"), "t", "left")
              .select("t", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "t").alias("root"), "least"))
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    out = rows.select("vec_id", "t").join(linked.select("t", "n_links", "root"), "t", "left").join(smallest, "root", "left")
    component = F.when(F.col("root").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
