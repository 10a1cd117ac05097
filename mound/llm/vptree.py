"""Nearest neighbours by inner product: a vantage-point tree per shard.

Appending sqrt(M^2 - |x|^2), with M the shard's largest norm, to each vector
x and 0 to a query turns the largest inner product into the smallest
Euclidean distance, for which the triangle inequality holds.  A tree splits a
shard's vectors by their distance from a vantage point; a child is skipped if
the least distance that the triangle inequality allows in it, times
``relax``, exceeds the distance of the worst neighbour so far.  A factor of
one is the exact search; larger ones skip more.

Every row is in the tree of its shard.  Blocks of queries meet each shard's
tree in a task; the shards' answers are ranked by Spark.  Equal vectors of a
shard are one entry with its smallest ids: more than ``k + 1`` of them can't
be among a query's k nearest.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mound.llm.vectors import dots, matrix, usable
from mound.session import write_through

#: Vectors in a shard, queries in a block, vectors in a leaf: all about.
SHARD, QUERIES, LEAF = 4096, 512, 64
NEAREST = 20
RELAX = 1.3
#: Entries kept beyond the wanted ones until scores are exact; more of one score are fetched then.
SPARE = 12


@dataclass
class Tree:
    """Nodes in arrays.  ``order`` lists entries by leaf; an inner node has a vantage point,
    two children, and the least and greatest distance of each child's entries from it."""

    points: np.ndarray  # in leaf order
    ids: list[np.ndarray]  # smallest ids of each entry, ascending
    most: float  # M squared
    vantage: np.ndarray
    child: np.ndarray  # (nodes x 2), -1 in leaves
    near: np.ndarray  # (nodes x 2)
    far: np.ndarray
    span: np.ndarray  # (nodes x 2): the entries below a node


def build(vectors: np.ndarray, ids: np.ndarray, k: int = NEAREST, leaf: int = LEAF) -> Tree:
    order = np.argsort(ids, kind="stable")
    unique, back = np.unique(vectors[order], axis=0, return_inverse=True)
    by_entry = np.argsort(back.ravel(), kind="stable")
    of = np.split(ids[order][by_entry], np.cumsum(np.bincount(back.ravel()))[:-1])
    norms = (unique * unique).sum(axis=1)
    most = float(norms.max())
    full = np.hstack([unique, np.sqrt(np.maximum(most - norms, 0))[:, None]])
    nodes: list[list] = []
    place = np.arange(len(full))

    def grow(a: int, b: int) -> int:
        me = len(nodes)
        nodes.append([full[place[a]], [-1, -1], [0.0, 0.0], [0.0, 0.0], [a, b]])
        if b - a > leaf:
            own = place[a:b]
            # the vantage point: the entry farthest from the middle of the node's entries
            point = full[own[((full[own] - full[own].mean(axis=0)) ** 2).sum(axis=1).argmax()]]
            distance = np.sqrt(((full[own] - point) ** 2).sum(axis=1))
            inward = np.argsort(distance, kind="stable")
            place[a:b], distance = own[inward], distance[inward]
            half = (b - a) // 2
            nodes[me][0] = point
            nodes[me][2:4] = [distance[0], distance[half]], [distance[half - 1], distance[-1]]
            nodes[me][1] = [grow(a, a + half), grow(a + half, b)]
        return me

    grow(0, len(full))
    return Tree(unique[place], [of[i][:k + 1] for i in place], most, *(np.array([n[f] for n in nodes]) for f in range(5)))


def search(tree: Tree, queries: np.ndarray, keep: int, relax: float = RELAX) -> np.ndarray:
    """(queries x keep) entries found nearest, best first; -1 where there are no more."""
    keep = min(keep, len(tree.points))
    best = np.full((len(queries), keep), -np.inf)
    which = np.full((len(queries), keep), -1)
    squares = (queries * queries).sum(axis=1) + tree.most
    wide = np.hstack([queries, np.zeros((len(queries), 1))])
    slack = 1e-9 * squares

    def skips(node: int, side: int, q: np.ndarray, distance: np.ndarray) -> np.ndarray:
        least = np.maximum(0, np.maximum(tree.near[node, side] - distance, distance - tree.far[node, side]))
        return (least * relax) ** 2 > squares[q] - 2 * best[q, -1] + slack[q]

    def visit(node: int, q: np.ndarray) -> None:
        if not len(q):
            return
        if tree.child[node, 0] < 0:
            a, b = tree.span[node]
            scores = np.hstack([best[q], queries[q] @ tree.points[a:b].T])
            entries = np.hstack([which[q], np.broadcast_to(np.arange(a, b), (len(q), b - a))])
            top = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
            scores, entries = np.take_along_axis(scores, top, 1), np.take_along_axis(entries, top, 1)
            order = np.argsort(-scores, axis=1, kind="stable")
            best[q], which[q] = np.take_along_axis(scores, order, 1), np.take_along_axis(entries, order, 1)
            return
        distance = np.sqrt(np.maximum(0, ((wide[q] - tree.vantage[node]) ** 2).sum(axis=1)))
        inner = distance < (tree.far[node, 0] + tree.near[node, 1]) / 2
        left, right = tree.child[node]
        visit(left, q[inner & ~skips(node, 0, q, distance)])
        visit(right, q[~skips(node, 1, q, distance)])
        visit(left, q[~inner & ~skips(node, 0, q, distance)])

    visit(0, np.arange(len(queries)))
    return which


def answers(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, k: int, relax: float) -> pd.DataFrame:
    """(query_id, vec_id, score): each query's k best of the shard, scores exact, ties to smaller ids.

    The search keeps somewhat more than k entries.  Where even the last of
    them scores like the k-th, more may: all entries of the shard that do
    are then taken, and the smallest ids of them stay."""
    found = search(tree, queries, k + 1 + SPARE, relax)
    scores = dots(queries[:, None, :], tree.points[found])
    out = []
    for row, (me, entries, values) in enumerate(zip(query_ids.tolist(), found.tolist(), scores.tolist(), strict=True)):
        mine = sorted((-s, i) for e, s in zip(entries, values, strict=True) if e >= 0 for i in tree.ids[e].tolist() if i != me)
        if len(entries) < len(tree.points) and len(mine) >= k:
            least = -mine[k - 1][0]
            if min(values) >= least - 1e-9 * max(1.0, abs(least)):
                every = dots(queries[row], tree.points)
                mine = sorted((-s, i) for e in np.flatnonzero(every >= least).tolist() for s in [float(every[e])]
                              for i in tree.ids[e].tolist() if i != me)
        out += [(me, i, -s) for s, i in mine[:k]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def nearest(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = NEAREST, relax: float = RELAX, shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` holds of, its k nearest others found.

    Vectors null, zero or with null or non-finite components, and rows of
    null id, take no part; a query meets only vectors of its own length.
    Ranks start at 1, ties go to the smaller id; a query with fewer others
    has them all.  Rows that share an id are one another's own.  Other
    columns are ignored; an empty table gives no rows.
    """
    query = F.coalesce(is_query, F.lit(False))
    data = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vector_col, lambda x: x.cast("double")).alias("vector"),
                       query.alias("asks")).filter(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    data = data.withColumn("dim", F.size("vector"))
    total = data.agg(F.count("*"), F.sum(F.col("asks").cast("long"))).collect()[0]
    shards, blocks = max(1, math.ceil((total[0] or 0) / shard)), max(1, math.ceil((total[1] or 0) / block))

    def plant(group: pd.DataFrame) -> pd.DataFrame:
        tree = build(matrix(group["vector"]), group["vec_id"].to_numpy(np.int64), k)
        return pd.DataFrame({"dim": group["dim"].iloc[:1], "shard": group["shard"].iloc[:1], "tree": [pickle.dumps(tree)]})

    trees = (data.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
             .groupBy("dim", "shard").applyInPandas(plant, "dim int, shard int, tree binary"))
    trees = write_through(trees, "vp-trees")
    asked = data.filter("asks").withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    met = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def ask(tree: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        if not len(tree) or not len(group):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return answers(pickle.loads(tree["tree"].iloc[0]), group["vec_id"].to_numpy(np.int64), matrix(group["vector"]), k, relax)

    keys = ("dim", "shard", "block")
    found = met.groupBy(*keys).cogroup(asked.select(*keys, "vec_id", "vector").groupBy(*keys)).applyInPandas(
        ask, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
