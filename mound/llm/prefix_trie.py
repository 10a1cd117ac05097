"""Prefix trie of conversations: balanced parentheses per shard, shared spines merged.

Every sequence of turns is a path, a turn known by a 16-byte fingerprint of
its role and text.  Paths are sorted over the cluster; a shard is a run of
neighbours, so nearly all nodes lie within one shard and only the two paths
at its edges, its spines, may go on in others.

A shard's trie is one string of balanced parentheses, a pair for each node in
preorder.  Blocks of the string know the least and greatest excess of opening
over closing ones; ``findclose`` skips blocks by them and delimits a subtree.
The leaves of a subtree are the pairs "()" up to its end, counted by rank;
members, and what their shared prefixes save, are differences of cumulative
arrays over preorder, and the smallest member a range minimum.

Nodes off the spines are complete.  The spines, with what the complete
subtrees below each of their nodes hold, are sorted and put in shards again,
until one shard is left, which completes all.  The number of spines falls
by the size of a shard in each round.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mound.session import write_through

#: Paths in a shard, at most, and in the last one.
SHARD = 2048
#: A shard also ends at so many turns, once it has this least number of paths.
SHARD_TURNS, LEAST_PATHS = 200_000, 16
#: Parentheses in a block.
BLOCK = 64
#: Ids in a piece of the list of a node's members.
PIECE = 1000
#: Own quantities of a node: members ending in it or below complete children, the smallest of them, complete
#: children, and below these leaves and savings.
CONVS, LEAST, CHILDREN, LEAVES, SAVED = range(5)
NOBODY = np.iinfo(np.int64).max


class Parentheses:
    """Balanced parentheses (1 opens) with blocks of least and greatest excess."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits
        self.opens = np.flatnonzero(bits)
        self.excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        blocks = -(-len(bits) // BLOCK)
        wide = np.full(blocks * BLOCK, np.iinfo(np.int64).max // 2)
        wide[:len(bits)] = self.excess
        self.rows = wide.reshape(blocks, BLOCK)
        low = self.rows.min(axis=1)
        wide[len(bits):] = -1
        high = self.rows.max(axis=1)
        wide[len(bits):] = np.iinfo(np.int64).max // 2
        self.levels = [(low, high)]  # each level holds pairs of the one below
        while len(low) > 1:
            if len(low) % 2:
                low, high = np.append(low, np.iinfo(np.int64).max // 2), np.append(high, -1)
            low, high = low.reshape(-1, 2).min(axis=1), high.reshape(-1, 2).max(axis=1)
            self.levels.append((low, high))

    def _holds(self, level: int, block: np.ndarray, value: np.ndarray) -> np.ndarray:
        low, high = self.levels[level]
        inside = np.minimum(block, len(low) - 1)
        return (block < len(low)) & (low[inside] <= value) & (value <= high[inside])

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Places of the parentheses that close those at ``opens``."""
        value = self.excess[opens] - 1
        close = np.full(len(opens), -1)
        for at in range(0, len(opens), 16_384):  # within the own block
            p = opens[at:at + 16_384]
            match = (self.rows[p // BLOCK] == value[at:at + 16_384, None]) & (np.arange(BLOCK) > (p % BLOCK)[:, None])
            close[at:at + 16_384] = np.where(match.any(axis=1), p // BLOCK * BLOCK + match.argmax(axis=1), -1)
        left = np.flatnonzero(close < 0)
        block, level = opens[left] // BLOCK, np.zeros(len(left), int)
        up = np.ones(len(left), bool)
        while up.any():  # up until a right neighbour's range holds the value
            for k in np.unique(level[up]):
                here = np.flatnonzero(up & (level == k))
                found = (block[here] % 2 == 0) & self._holds(k, block[here] + 1, value[left[here]])
                block[here] = np.where(found, block[here] + 1, block[here] // 2)
                level[here] += np.where(found, 0, 1)
                up[here] = ~found
        for k in range(int(level.max(initial=0)), 0, -1):  # down to the first block that holds it
            here = np.flatnonzero(level == k)
            first = block[here] * 2
            block[here] = np.where(self._holds(k - 1, first, value[left[here]]), first, first + 1)
            level[here] -= 1
        for at in range(0, len(left), 16_384):
            b = block[at:at + 16_384]
            close[left[at:at + 16_384]] = b * BLOCK + (self.rows[b] == value[left[at:at + 16_384], None]).argmax(axis=1)
        return close

    def pairs_before(self) -> np.ndarray:
        """Rank: the number of "()" that open before each place, and in all."""
        pair = np.zeros(len(self.bits), np.int64)
        pair[:-1] = (self.bits[:-1] == 1) & (self.bits[1:] == 0)
        return np.concatenate([[0], np.cumsum(pair)])


def _running(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, x.dtype), np.cumsum(x)])


def _range_min(x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Minimum of x[begin:end] for each of many non-empty ranges, by a table of powers of two."""
    out = np.empty(len(begin), x.dtype)
    power = np.floor(np.log2(end - begin)).astype(int)
    table, k = x, 0
    while True:
        here = np.flatnonzero(power == k)
        out[here] = np.minimum(table[begin[here]], table[end[here] - (1 << k)])
        if k >= power.max(initial=0):
            return out
        table, k = np.minimum(table[:-(1 << k)], table[1 << k:]), k + 1


@dataclass
class Item:
    """A path, its turns' sizes, and own quantities of its last nodes (n x 5)."""

    path: bytes
    sizes: np.ndarray
    own: np.ndarray
    ends: bool = True  # whether a conversation ends here (else it is a spine)


def _keys(path: bytes) -> list[bytes]:
    """The key of each prefix."""
    out, running = [], hashlib.md5(usedforsecurity=False)
    out.append(running.digest())
    for at in range(0, len(path), 16):
        running.update(path[at:at + 16])
        out.append(running.digest())
    return out


COLUMNS = ("kind int, shard string, conv_id long, depth long, parent_conv_id long, up long, n_convs long, n_children long, n_leaves long, "
           "saved_tokens long, ends_sha256 string, key binary, path binary, sizes array<long>, own array<long>, ids string")
NODE, SPINE, UP, MEMBERS = range(4)
_NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def _frame(kind: int, **columns) -> pd.DataFrame:
    """Rows of one kind; the columns not given are null."""
    n = len(next(iter(columns.values())))
    columns |= {"kind": np.full(n, kind, np.int32)}
    given = {c: v if isinstance(v, (np.ndarray, pd.Series)) else pd.Series(v, dtype=object) for c, v in columns.items()}
    nothing = pd.Series([None] * n, dtype=object)
    return pd.DataFrame({c: given.get(c, nothing) for c in _NAMES})


def close_shard(items: list[Item], name: str, first: bool, last: bool) -> list[pd.DataFrame]:
    """Complete nodes, spines, the spines' keys, and members that end in spine nodes, of one shard.

    ``first``: the items are conversations; ``last``: there is no other shard."""
    depth_of = np.array([len(i.path) // 16 for i in items])
    begin = np.concatenate([[0], np.cumsum(depth_of)])
    prints = np.frombuffer(b"".join(i.path for i in items), np.uint64).reshape(-1, 2)
    size = np.concatenate([i.sizes for i in items]) if len(prints) else np.zeros(0, np.int64)
    lcp = np.zeros(len(items), np.int64)
    lcp[0] = -1
    same, k = np.arange(1, len(items)), 0
    while True:
        same = same[np.minimum(depth_of[same - 1], depth_of[same]) > k]
        same = same[(prints[begin[same - 1] + k] == prints[begin[same] + k]).all(axis=1)]
        if not len(same):
            break
        k += 1
        lcp[same] = k
    # nodes in preorder: each item opens those below what it shares with the one before
    new = depth_of - lcp
    end = np.cumsum(new) - 1
    n = int(end[-1]) + 1
    head = end - new + 1
    depth = np.arange(n) - np.repeat(head, new) + np.repeat(lcp + 1, new)
    own_turn = np.repeat(begin[:-1], new) + depth - 1
    weight = np.zeros(n, np.int64)
    weight[1:] = size[own_turn[1:]]
    closes = np.append(0, depth_of[:-1] - lcp[1:])
    bits = np.repeat(np.tile([0, 1], len(items)).astype(np.int8), np.stack([closes, new], axis=1).ravel())
    tree = Parentheses(np.concatenate([bits, np.zeros(depth_of[-1] + 1, np.int8)]))
    close = tree.findclose(tree.opens)
    after = np.arange(n) + (close - tree.opens + 1) // 2  # the first node behind a subtree

    by_depth = np.sort(depth * n + np.arange(n))

    def latest(d: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """The last node of depth d up to a place: the ancestor on the path there."""
        return by_depth[np.searchsorted(by_depth, d * n + upto, "right") - 1] % n

    parent = np.append(-1, latest(depth[1:] - 1, np.arange(n - 1)))
    counts = np.array([len(i.own) for i in items])
    own_rows = np.concatenate([i.own for i in items])
    back = np.repeat(np.cumsum(counts), counts) - 1 - np.arange(len(own_rows))
    at = latest(np.repeat(depth_of, counts) - back, np.repeat(end, counts))
    own = np.zeros((n, 5), np.int64)
    own[:, LEAST] = NOBODY
    for q in (CONVS, CHILDREN, LEAVES, SAVED):
        np.add.at(own[:, q], at, own_rows[:, q])
    np.minimum.at(own[:, LEAST], at, own_rows[:, LEAST])

    total = _running(own[:, CONVS])
    n_convs = total[after] - total[:-1]
    least = _range_min(own[:, LEAST], np.arange(n), after)
    children = own[:, CHILDREN] + np.bincount(parent[1:], minlength=n)
    rank = tree.pairs_before()
    below = _running(own[:, LEAVES] - ((close == tree.opens + 1) & (own[:, CHILDREN] > 0)))
    leaves = rank[close] - rank[tree.opens] + below[after] - below[:-1]

    left, right = np.zeros(n, bool), np.zeros(n, bool)
    if not last:
        left[:new[0]] = True
        right[(np.arange(n) <= end[-1]) & (end[-1] < after)] = True
    spine = left | right
    gain = _running(np.where(spine, 0, (n_convs - 1) * weight) + own[:, SAVED])
    saved = gain[after] - gain[:-1]

    out = []
    done = np.flatnonzero(~spine)
    on_spine = np.append(False, spine[parent[1:]])
    up = np.where(on_spine, np.where(parent >= 0, depth[parent] * 2 + ~left[parent], 0), 0)
    of = np.repeat(np.arange(len(items)), new)
    sha, key = np.full(n, None, object), np.full(n, None, object)
    if first:
        sha[:] = hashlib.sha256(b"").hexdigest()
        ids = own_rows[:, LEAST].astype("U20")
        heads = np.flatnonzero(np.append(True, end[1:] != end[:-1]))
        pieces = []
        for a, b in zip(heads.tolist(), np.append(heads[1:], len(end)).tolist(), strict=True):
            if not spine[end[a]]:
                sha[end[a]] = hashlib.sha256(",".join(ids[a:b].tolist()).encode()).hexdigest()
            else:
                at_key = _keys(items[a].path)[-1]
                pieces += [(at_key, int(own_rows[p, LEAST]), ",".join(ids[p:min(b, p + PIECE)].tolist())) for p in range(a, b, PIECE)]
        if pieces:
            k, c, i = zip(*pieces, strict=True)
            out.append(_frame(MEMBERS, key=list(k), conv_id=np.array(c, np.int64), ids=list(i)))
    else:
        keys = [_keys(i.path) for i in items]
        key[:] = [keys[i][d] for i, d in zip(of.tolist(), depth.tolist(), strict=True)]
    if len(done):
        known = (parent >= 0) & ~on_spine
        mother = pd.Series(least[parent][done], dtype="Int64").where(pd.Series(known[done]))
        above = pd.Series(up[done], dtype="Int64").where(pd.Series(on_spine[done]))
        out.append(_frame(NODE, shard=[name] * len(done), conv_id=least[done], depth=depth[done], parent_conv_id=mother, up=above, n_convs=n_convs[done],
                          n_children=children[done], n_leaves=leaves[done], saved_tokens=saved[done], ends_sha256=list(sha[done]), key=list(key[done])))
    if spine.any():
        held = own.copy()
        below_spine = np.flatnonzero(~spine & on_spine)
        to = parent[below_spine]
        for q, x in ((CONVS, n_convs), (CHILDREN, np.ones(n, np.int64)), (LEAVES, leaves), (SAVED, saved)):
            np.add.at(held[:, q], to, x[below_spine])
        np.minimum.at(held[:, LEAST], to, least[below_spine])
        sides = [(items[0], np.flatnonzero(left)), (items[-1], np.flatnonzero(right & ~left))]
        sides = [(i, nodes) for i, nodes in sides if len(nodes)]
        out.append(_frame(SPINE, shard=[name] * len(sides), path=[i.path for i, _ in sides], sizes=[i.sizes for i, _ in sides],
                          own=[held[nodes].ravel() for _, nodes in sides]))
        for side, (item, nodes) in enumerate(sides):
            prefix = _keys(item.path)
            out.append(_frame(UP, shard=[name] * len(nodes), up=depth[nodes] * 2 + side, key=[prefix[d] for d in depth[nodes].tolist()]))
    return out


def _shards(batches: Iterator[pd.DataFrame], level: int, shard: int, last: bool) -> Iterator[pd.DataFrame]:
    held: list[Item] = []
    turns, made = 0, 0
    task = TaskContext.get().partitionId()

    def close() -> Iterator[pd.DataFrame]:
        nonlocal turns, made
        yield from close_shard(held, f"{level}-{task}-{made}", level == 0, last)
        held.clear()
        turns, made = 0, made + 1

    for batch in batches:
        for path, sizes, own in zip(batch["path"], batch["sizes"], batch["own"], strict=True):
            sizes = np.asarray(sizes, np.int64)
            held.append(Item(bytes(path), sizes, np.asarray(own, np.int64).reshape(-1, 5)))
            turns += len(sizes)
            if not last and (len(held) >= shard or (turns >= SHARD_TURNS and len(held) >= LEAST_PATHS)):
                yield from close()
    if held:
        yield from close()


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the pieces of each key, in order; one state at a time is held."""
    now, state = None, None
    for batch in batches:
        done = []
        for key, ids in zip(batch["key"], batch["ids"], strict=True):
            key = bytes(key)
            if key != now:
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield pd.DataFrame(done, columns=["key", "ends"])
    if now is not None:
        yield pd.DataFrame([(now, state.hexdigest())], columns=["key", "ends"])


def trie(paths: DataFrame, shard: int = SHARD) -> DataFrame:
    """The nodes of the trie of ``paths`` (conv_id long, turns array<struct<print: binary, size: long>>).

    A ``print`` is a turn's fingerprint of 16 bytes, which settles its
    ``size``.  One row per distinct prefix, the empty one included: conv_id
    (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256.  Ids are distinct and
    not null; a table without rows has no nodes.
    """
    own = F.array(F.lit(1).cast("long"), F.col("conv_id"), *[F.lit(0).cast("long")] * 3)
    # fingerprints in hexadecimal have one width, so the order of their text is that of the paths
    hexed = F.array_join(F.transform("turns", lambda t: F.hex(t["print"])), "")
    items = write_through(paths.select(F.unhex(hexed).alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"),
                                       own.alias("own"), F.col("conv_id").alias("tie")), "trie-paths")
    level, count, tables = 0, items.count(), []
    while True:
        last = level > 0 and count <= max(shard, LEAST_PATHS)
        # equal paths may lie in several partitions: their members' ids, or shards, part them
        laid = items.coalesce(1) if last else items.repartitionByRange(max(1, math.ceil(count / shard)), "path", "tie")
        closed = laid.sortWithinPartitions("path", "tie").select("path", "sizes", "own").mapInPandas(
            lambda b, level=level, last=last: _shards(b, level, shard, last), COLUMNS)
        tables.append(write_through(closed, f"trie-level{level}"))
        items = tables[-1].filter(F.col("kind") == SPINE).select("path", "sizes", "own", F.xxhash64("shard").alias("tie"))
        if last:
            break
        level, count = level + 1, items.count()

    everything = tables[0]
    for table in tables[1:]:
        everything = everything.union(table)
    nodes = everything.filter(F.col("kind") == NODE)
    # spine nodes have keys; the others' members and, but for children of spines, parents are settled
    least = nodes.filter("key is not null").select("key", F.col("conv_id").alias("mother"))
    mothers = everything.filter(F.col("kind") == UP).select("shard", "up", "key").join(least, "key").select("shard", "up", "mother")
    pieces = tables[0].filter(F.col("kind") == MEMBERS).select("key", "conv_id", "ids")
    ends = pieces.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ids").mapInPandas(_hashed, "key binary, ends string")
    spines = nodes.filter("key is not null").join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)))
    columns = ["shard", "up", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = nodes.filter("key is null").select(*columns).unionByName(spines.select(*columns))
    out = found.join(mothers, ["shard", "up"], "left")
    return out.select("conv_id", "depth", F.coalesce("parent_conv_id", "mother").alias("parent_conv_id"), *columns[5:])


def turn_paths(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns) of each conversation: its turns' fingerprints and UTF-8 sizes of their texts.

    Rows are ordered by turn (nulls first), ties by fingerprint.  Null roles
    and texts count as empty; rows of a null conversation id are left out;
    repeated rows are repeated turns; other columns are ignored.  A task holds
    the fingerprints of one conversation at a time, not its texts.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    fingerprint = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    one = F.struct(F.col(turn_col).alias("turn"), fingerprint.alias("print"), F.octet_length(text).cast("long").alias("size"))
    listed = rows.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), one.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(F.unhex(t["print"]).alias("print"), t["size"].alias("size"))).alias("turns"))


def kept_turns(conv: Column) -> Column:
    """How many turns a rebuilt conversation takes from the first of its five."""
    return (F.crc32(conv.cast("string").cast("binary")) % 9).cast("int")


def rebuilt(paths: DataFrame) -> DataFrame:
    """Each conversation c with the first turns of conversation c - c % 5 (none if absent) in place of its own."""
    paths = write_through(paths, "trie-turns")
    base = paths.select(F.col("conv_id").alias("base"), F.col("turns").alias("theirs"))
    joined = paths.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(base, "base", "left")
    h = kept_turns(F.col("conv_id"))
    none = F.array().cast(dict(paths.dtypes)["turns"])
    turns = F.concat(F.slice(F.coalesce("theirs", none), F.lit(1), h), F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1))))
    return joined.select("conv_id", turns.alias("turns"))


def oracle_sql() -> str:
    """DuckDB twin: every prefix as a row."""
    return """WITH t AS (SELECT conv_id, turn, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS p,
        octet_length(encode(coalesce(text, '')))::BIGINT AS s FROM conversations WHERE conv_id IS NOT NULL),
    o AS (SELECT conv_id, list({p: p, s: s} ORDER BY turn NULLS FIRST, p) AS turns FROM t GROUP BY conv_id),
    crc_table AS (SELECT n, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n::BIGINT) AS v
      FROM range(256) r(n)),
    crc_list AS (SELECT list(v ORDER BY n) AS v FROM crc_table),
    h AS (SELECT conv_id, turns, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
        lambda c, b: xor(c // 256, v[xor(c, b) % 256 + 1]), 4294967295::BIGINT), 4294967295) % 9 AS h FROM o, crc_list),
    c AS (SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:h.h], h.turns[h.h + 1:]) AS turns
      FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 5),
    e AS (SELECT conv_id, len(turns) AS n, d, md5(array_to_string(list_transform(turns[1:d], lambda x: x.p), '')) AS k,
        md5(array_to_string(list_transform(turns[1:d - 1], lambda x: x.p), '')) AS up, CASE WHEN d = 0 THEN 0 ELSE turns[d].s END AS s
      FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM c)),
    n AS (SELECT k, any_value(CASE WHEN d > 0 THEN up END) AS up, min(conv_id) AS conv_id, any_value(d)::BIGINT AS depth, count(*) AS n_convs, any_value(s) AS s,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM e GROUP BY k),
    m AS (SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM n c WHERE c.up = n.k) AS n_children FROM n LEFT JOIN n p ON p.k = n.up),
    a AS (SELECT DISTINCT top.k, low.k AS below FROM e top JOIN e low ON top.conv_id = low.conv_id AND top.d <= low.d),
    g AS (SELECT a.k, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((b.n_convs - 1) * b.s)::BIGINT AS saved_tokens
      FROM a JOIN m b ON b.k = a.below GROUP BY a.k)
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM m JOIN g USING (k)"""
