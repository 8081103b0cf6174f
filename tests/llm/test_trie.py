import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, share=False):
    """Rows (conv_id, turn, role, text): the nodes, from a dictionary of whole
    prefixes. Ties of turn are in the order of the rows."""
    turns = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        turns[c].append((role or "", text or ""))
    if share:
        plain = dict(turns)
        for c in plain:
            h = zlib.crc32(str(c).encode()) % 9
            turns[c] = plain.get(c - c % 5, [])[:h] + plain[c][h:] if c % 5 else plain[c]
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, own in sorted(turns.items()):
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
            if d:
                children[tuple(own[: d - 1])].add(tuple(own[:d]))
        ends[tuple(own)].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = sum(saved[b] for b in below) + ((len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
    return [
        (m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(children[node]), leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
        for node, m in members.items()
    ]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: (r[1], r[0]))


def want(rows, share=False):
    return sorted(brute(rows, share), key=lambda r: (r[1], r[0]))


def made(seed, n=160):
    """Conversations that share first turns, whole or in part."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        if c % 17 == 3:
            continue  # bases that are absent, too
        size = int(rng.integers(1, 12))
        rows += [(c, int(3 * t - 5), "user" if t % 2 else None, f"{'é' * int(rng.integers(3))}{int(rng.integers(2 if t < 4 else 5))}") for t in range(size)]
    return [rows[k] for k in rng.permutation(len(rows))]


@pytest.mark.parametrize("share", [False, True])
def test_against_brute_force(spark, share):
    rows = made(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert got(trie.prefix_trie(df, share)) == want(rows, share)


def test_many_small_shards_and_runs(spark):
    rows = made(2, 60)
    rows += [(1000 + k, t, "user", str(min(t, 40 + k))) for k in range(4) for t in range(50 + 3 * k)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(trie.prefix_trie(df, shard_rows=30, band=3)) == want(rows)
    assert got(trie.prefix_trie(df, share=True, shard_rows=30, band=7)) == want(rows, share=True)


def test_hot_groups(spark):
    """One long conversation, and one that a third of all are copies of."""
    rows = [(5, t, "user", f"x{t % 7}") for t in range(9000)]
    rows += [(100 + 5 * c, t, "user", f"hot {t}") for c in range(1500) for t in range(2)]
    rows += [(20_000 + c, 0, "user", f"x{c % 3}") for c in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert got(trie.prefix_trie(df)) == want(rows)


def test_edges(spark):
    rows = [
        (10, None, None, None), (10, 0, "user", "a"), (15, 0, None, ""), (15, None, "", None), (20, 1, "user", "a"), (20, 1, "user", "a"),
        (None, 0, "user", "a"), (25, 7, "us", "era"), (30, 7, "user", "a"), (35, 2, "x" * 5000, "é" * 70_000), (35, 3, "漢", "😀"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("pos", "t1", "d1", "p1", "part", "depth", "shard", "bytes", "row", "at", "n", "h", "base")})
    assert got(trie.prefix_trie(df)) == want(rows)
    assert got(trie.prefix_trie(df, share=True)) == want(rows, share=True)
    assert trie.prefix_trie(df.where("false")).collect() == []
    # rebuilt without turns: none of its own after the first h, and no base
    alone = [(c, 0, "user", "a") for c in (6, 7, 8, 9)]
    assert got(trie.prefix_trie(spark.createDataFrame(alone, SCHEMA), share=True)) == want(alone, share=True)
    texts = trie.with_texts(trie.prefix_trie(df), df).where("conv_id = 35").orderBy("depth").select("role", "text").collect()
    assert [tuple(r) for r in texts] == [r[2:] for r in rows[-2:]]


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 2**63, (n, 2)).astype(np.uint64), axis=0)
        table = trie.PerfectHash(keys)
        slots = table.slots(keys)
        assert sorted(slots.tolist()) == list(range(len(keys)))
        others = rng.integers(0, 2**63, (500, 2)).astype(np.uint64)
        assert (table.slots(others) == -1).all()
