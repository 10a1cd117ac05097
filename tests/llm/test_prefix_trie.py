import hashlib
import random
import zlib

import numpy as np
import pytest

from mound.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(paths):
    """{conv_id: [(print, size), ...]} -> sorted rows."""
    members = {}
    for conv, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    memo = {}
    for p in sorted(members, key=len, reverse=True):
        below = [memo[c] for c in children.get(p, [])]
        leaves = sum(b[0] for b in below) or 1
        saved = sum(b[1] for b in below) + ((len(members[p]) - 1) * p[-1][1] if p else 0)
        memo[p] = (leaves, saved)
    out = []
    for p, m in members.items():
        ends = sorted(c for c in m if len(paths[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *memo[p],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def turn(x):
    return hashlib.md5(str(x).encode()).digest(), len(str(x))


def built(spark, paths, **more):
    rows = [(c, [{"print": p, "size": s} for p, s in t]) for c, t in paths.items()]
    df = spark.createDataFrame(rows, "conv_id long, turns array<struct<print: binary, size: long>>")
    return sorted((tuple(r) for r in P.trie(df, **more).collect()), key=str)


def random_paths(seed, n=150):
    rng = random.Random(seed)
    return {rng.choice([c, -c]): [turn(rng.randint(0, 2) * 10 ** rng.randint(0, 3)) for _ in range(rng.choice([0, 1, 2, 5, 9]))] for c in range(n)}


@pytest.mark.parametrize("shard", [3, 7, 2048])
def test_against_brute_force(spark, shard):
    """Many shards and levels, or one."""
    paths = random_paths(shard)
    assert built(spark, paths, shard=shard) == brute(paths)


def test_copies_over_many_shards(spark):
    """One path a third of all conversations, one path a prefix of others, a very long one."""
    same = [turn(1), turn(2), turn(3)]
    paths = random_paths(1, 60) | {1000 + i: same for i in range(60)} | {2000: same[:1], 2001: same[:2]}
    paths |= {3000: same + [turn(i) for i in range(3000)], 3001: same + [turn(i) for i in range(2990)]}
    assert built(spark, paths, shard=5) == brute(paths)


def test_findclose():
    rng = random.Random(2)
    for n in (1, 2, 40, 3000):
        bits, depth, left = [1], 1, n - 1
        while depth:
            opens = left and (depth == 1 or rng.random() < 0.5)
            bits.append(1 if opens else 0)
            depth += 1 if opens else -1
            left -= 1 if opens else 0
        stack, want = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        tree = P.Parentheses(np.array(bits, np.int8))
        assert dict(zip(tree.opens.tolist(), tree.findclose(tree.opens).tolist(), strict=True)) == want
    deep = P.Parentheses(np.array([1] * 5000 + [0] * 5000, np.int8))
    assert (deep.findclose(deep.opens) == 9999 - np.arange(5000)).all()


def conversations():
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "x" * 50_000 if c == 7 else "y"])) for c in range(40)
            for t in rng.sample([None, 0, 1, 2, 3, 5], rng.randint(1, 6)) if c != 15]
    return rows + [(None, 0, "user", "z"), (3, 9, "user", "r"), (3, 9, "user", "r"), (-4, 0, "user", "n")]


def test_rebuilt_conversations(spark):
    rows = conversations()
    own = {}
    for c in {r[0] for r in rows} - {None}:
        mine = [(t is not None, t or 0, hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest(), len((text or "").encode()))
                for cc, t, role, text in rows if cc == c]
        own[c] = [(p, s) for *_, p, s in sorted(mine)]
    want = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        want[c] = own.get(base, [])[:h] + turns[h:]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", path int, key string")
    got = sorted((tuple(r) for r in P.trie(P.rebuilt(P.turn_paths(df)), shard=6).collect()), key=str)
    assert got == brute(want)
    assert any(not t for t in want.values())  # turnless ones end in the root


def test_empty(spark):
    assert P.trie(P.rebuilt(P.turn_paths(spark.createDataFrame([], SCHEMA)))).count() == 0
