"""Conversation prefix trie: a node for every distinct sequence of first turns.

A conversation's prefix has as digest the 128-bit sum of hashes of (depth,
turn), so digests are running sums of any ordered pieces: turns are sorted in
ranges, tasks add up their own range, and only the conversations that cross a
range's end - at most one a range - pass their sum on. A turn is the SHA-256 of
role and text (its first half), so texts are read once and never shuffled. An
aggregate by digest gives the nodes; it verifies that all members of a node have
one depth, one parent digest and one last turn, hence one sequence of turns.

Subtrees are summed in shards: runs of up to ``BAND`` turns of a conversation,
dealt by conversation. A shard enumerates its distinct digests and gives them
slots by a minimal perfect hash (levels of bit arrays; a key's slot is the rank
of its bit), each verified against the digest kept at its slot. Counts are
scattered into flat arrays by slot, and added into the parents' slots in depth
order. A node's own count lies in one shard only, that of its smallest member,
where all its ancestors have slots too; so the sum of a node's slots over all
shards is its subtree's, whatever part of the conversations shares a first turn.
Runs below a conversation's first one are summed before, and enter where the
run above them ends.

The conversations that end at a node are hashed in the order of their numbers:
sorted ranges become pieces of text, which are hashed in order, node by node.

Null role or text is empty. Turns are ordered by ``turn``, null first; equal
ones by their SHA-256. Repeated rows are turns of their own. Rows without conv_id
are no conversation and take no part. Conversations without turns are members
of the root alone. No conversations give no nodes. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import M64, gathered, mix64, ready, saved

#: Turns of one conversation in one shard, at most; also the depths that one
#: shard goes through.
BAND = 4096
#: Rows of a shard, on average.
SHARD_ROWS = 1 << 16
#: Ids of one piece of text that is hashed.
PIECE_IDS = 4096
ROWS = 4096
#: Bits a key in the levels of the perfect hash.
GAMMA = 2
#: First turns that a conversation takes from another one, at most, plus one.
SHARED = 9
GROUP = 5

ORDERED = "conv_id long, pos long, t1 long, t2 long, bytes long"
PREFIXES = "conv_id long, depth long, bytes long, t1 long, t2 long, d1 long, d2 long, p1 long, p2 long"


def _turn_hash(frame: pa.RecordBatch) -> tuple[np.ndarray, list[int]]:
    """The first half of the SHA-256 of the role's length, role and text, as
    two numbers; and the texts' bytes."""
    roles, texts = (frame.column(k).cast(pa.binary()).fill_null(b"").to_pylist() for k in ("role", "text"))
    raw = b"".join(hashlib.sha256(len(r).to_bytes(8, "little") + r + t).digest()[:16] for r, t in zip(roles, texts, strict=True))
    return np.frombuffer(raw, np.int64).reshape(-1, 2), [len(t) for t in texts]


def _digests(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        half, size = _turn_hash(frame)
        yield pa.RecordBatch.from_arrays([frame.column("conv_id"), frame.column("turn"), pa.array(half[:, 0]), pa.array(half[:, 1]), pa.array(size, pa.int64())], names=["conv_id", "turn", "t1", "t2", "bytes"])


def turn_digests(turns: DataFrame) -> DataFrame:
    """conv_id, turn, (t1, t2) the digest of role and text, bytes of the text."""
    ready(turns.sparkSession)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.where("conv_id is not null").mapInArrow(_digests, "conv_id long, turn long, t1 long, t2 long, bytes long")


def _columns(frame: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [frame.column(k).to_numpy(zero_copy_only=False) for k in names]


def running(conv: np.ndarray, values: np.ndarray, last: int | None, before: np.ndarray) -> np.ndarray:
    """Running sums (mod 2^64) of the lines of ``values`` within each run of
    equal conv; the first run goes on from ``before`` if it is that of last."""
    total = np.cumsum(values, axis=0, dtype=np.uint64)
    new = np.concatenate(([True], conv[1:] != conv[:-1]))
    start = np.flatnonzero(new)
    base = np.vstack((np.zeros((1, values.shape[1]), np.uint64), total))[start]
    if len(conv) and last is not None and conv[0] == last:
        base[0] = base[0] - before
    return total - np.repeat(base, np.diff(np.concatenate((start, [len(conv)]))), axis=0)


def _ranked(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position within the task's part of each conversation, from 1."""
    part, last, before = TaskContext.get().partitionId(), None, np.zeros(1, np.uint64)
    for frame in gathered(frames, ROWS):
        (conv,) = _columns(frame, "conv_id")
        at = running(conv, np.ones((len(conv), 1), np.uint64), last, before)
        last, before = conv[-1], at[-1]
        yield frame.append_column("part", pa.array(np.full(len(conv), part, np.int32))).append_column("at", pa.array(at[:, 0].view(np.int64)))


def _crossing(rows: DataFrame) -> DataFrame:
    """(conv_id, part) of the conversations that lie in several parts: at most
    one ends and one begins at each part's border."""
    parts = rows.groupBy("conv_id", "part").agg(F.max("at").alias("n"))
    return parts.withColumn("several", F.count("*").over(Window.partitionBy("conv_id"))).where("several > 1")


def in_order(digests: DataFrame) -> DataFrame:
    """ORDERED: the position of every turn in its conversation, from 1."""
    order = ["conv_id", F.asc_nulls_first("turn"), "t1", "t2"]
    rows = digests.withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, "row").sortWithinPartitions(*order, "row").select("conv_id", "t1", "t2", "bytes")
    rows = saved(rows.mapInArrow(_ranked, "conv_id long, t1 long, t2 long, bytes long, part int, at long"), "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = _crossing(rows).select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # at most two rows a part, as said above
    rows = rows.join(F.broadcast(starts), ["conv_id", "part"], "left")
    return rows.select("conv_id", (F.col("at") + F.coalesce("start", F.lit(0))).alias("pos"), "t1", "t2", "bytes")


def rebuilt(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation with the first turns of another one: c takes the
    first h of c - c % GROUP (h = crc32 of c % SHARED; all if there are fewer)
    and goes on with its own turns after its first h. Returns the turns and the
    conversations' ids."""
    ordered = saved(ordered, "ordered")
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    ids = ordered.select("conv_id").distinct().withColumns({"base": base, "h": F.crc32(F.col("conv_id").cast("string")) % SHARED})
    heads = ordered.where((F.col("conv_id") % GROUP == 0) & (F.col("pos") < SHARED)).withColumnRenamed("conv_id", "base")
    others = ids.where("conv_id != base and h > 0")
    first = others.join(heads, "base").where("pos <= h").select("conv_id", "pos", "t1", "t2", "bytes")
    taken = others.join(heads.groupBy("base").agg(F.max("pos").alias("n")), "base", "left")
    taken = taken.select("conv_id", "h", F.least(F.coalesce("n", F.lit(0)), "h").alias("taken"))
    kept = ordered.join(taken, "conv_id", "left").where("h is null or pos > h")
    kept = kept.select("conv_id", (F.col("pos") - F.coalesce(F.col("h") - F.col("taken"), F.lit(0))).alias("pos"), "t1", "t2", "bytes")
    return saved(kept.union(first), "rebuilt"), saved(ids.select("conv_id"), "conversations")


def place_hash(depth: np.ndarray, t1: np.ndarray, t2: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of (depth, turn)."""
    out = np.empty((len(depth), 2), np.uint64)
    for k, (a, b) in enumerate(((t1, t2), (t2, t1))):
        x = mix64(depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1))
        out[:, k] = mix64(mix64(x ^ a.view(np.uint64)) + b.view(np.uint64))
    return out


def _summed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, last, before = TaskContext.get().partitionId(), None, np.zeros(2, np.uint64)
    for frame in gathered(frames, ROWS):
        conv, depth, t1, t2 = _columns(frame, "conv_id", "pos", "t1", "t2")
        d = running(conv, place_hash(depth, t1, t2), last, before)
        last, before = conv[-1], d[-1]
        yield pa.RecordBatch.from_arrays([*(frame.column(k) for k in ("conv_id", "pos", "t1", "t2", "bytes")), pa.array(np.full(len(conv), part, np.int32)), *(pa.array(d[:, k].view(np.int64)) for k in (0, 1))], names=["conv_id", "pos", "t1", "t2", "bytes", "part", "d1", "d2"])


def _shifted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds what the parts before held, and the parent's digest."""
    for frame in frames:
        depth, t1, t2, *sums = _columns(frame, "pos", "t1", "t2", "d1", "d2", "s1", "s2")
        d = np.column_stack(sums[:2]).view(np.uint64) + np.column_stack(sums[2:]).view(np.uint64)
        p = d - place_hash(depth, t1, t2)
        yield pa.RecordBatch.from_arrays([*(frame.column(k) for k in ("conv_id", "pos", "bytes", "t1", "t2")), *(pa.array(x[:, k].copy().view(np.int64)) for x in (d, p) for k in (0, 1))], names=PREFIXES.replace(",", "").split()[::2])


def prefixes(ordered: DataFrame) -> DataFrame:
    """PREFIXES: the digests of each conversation's prefix and of its parent."""
    spark = ordered.sparkSession
    rows = saved(ordered.repartitionByRange("conv_id", "pos").sortWithinPartitions("conv_id", "pos").mapInArrow(_summed, "conv_id long, pos long, t1 long, t2 long, bytes long, part int, d1 long, d2 long"), "prefixes")
    # the last sums of conversations in several parts: at most two rows a part
    ends = rows.groupBy("conv_id", "part").agg(F.max(F.struct("pos", "d1", "d2")).alias("end"))
    ends = ends.withColumn("several", F.count("*").over(Window.partitionBy("conv_id"))).where("several > 1")
    starts, held = [], {}
    for r in ends.orderBy("conv_id", "part").select("conv_id", "part", "end.d1", "end.d2").collect():
        start = held.get(r["conv_id"], np.zeros(2, np.uint64))
        starts.append((r["conv_id"], r["part"], *start.view(np.int64).tolist()))
        held = {r["conv_id"]: start + np.array([r["d1"], r["d2"]], np.int64).view(np.uint64)}
    starts = spark.createDataFrame(starts, "conv_id long, part int, s1 long, s2 long")
    rows = rows.join(F.broadcast(starts), ["conv_id", "part"], "left").fillna(0, ["s1", "s2"])
    return rows.select("conv_id", "pos", "bytes", "t1", "t2", "d1", "d2", "s1", "s2").mapInArrow(_shifted, PREFIXES)


class PerfectHash:
    """Slots 0 .. n - 1 for n distinct keys of two 64-bit numbers."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.n, left, base = len(keys), np.arange(len(keys)), 0
        while len(left):
            size = GAMMA * len(left) + 1
            bit = self._bit(keys[left], len(self.levels), size)
            alone = np.bincount(bit, minlength=size) == 1
            self.levels.append((alone, np.cumsum(alone) - alone, base))
            base += int(alone.sum())
            left = left[~alone[bit]]
        self.keys = np.zeros_like(keys)
        self.keys[self._slots(keys)] = keys
        if not np.array_equal(self.keys[self._slots(keys)], keys):
            raise RuntimeError("two keys of a shard share a slot")

    @staticmethod
    def _bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = mix64(keys[:, 0] + np.uint64(level * 0x9E3779B97F4A7C15 & M64)) ^ keys[:, 1]
        return (mix64(x + np.uint64(level)) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(keys), -1), np.arange(len(keys))
        for level, (alone, rank, base) in enumerate(self.levels):
            bit = self._bit(keys[open_], level, len(alone))
            hit = alone[bit]
            out[open_[hit]] = base + rank[bit[hit]]
            open_ = open_[~hit]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Verified slots; -1 for keys that are not in the table."""
        out = self._slots(keys)
        found = np.flatnonzero(out >= 0)
        out[found[(self.keys[out[found]] != keys[found]).any(axis=1)]] = -1
        return out


def _accumulated(band: int):
    """Subtree sums of one shard's nodes: d1, d2, n_leaves, saved_tokens. A run's
    first node has no parent here: its sum enters the run above by itself."""

    def run(group: pa.Table) -> pa.Table:
        depth, leaves, saved_, *halves = (group.column(k).to_numpy() for k in ("depth", "leaves", "saved", "d1", "d2", "p1", "p2"))
        own, parent = (np.column_stack(halves[k : k + 2]).view(np.uint64) for k in (0, 2))
        _, first = np.unique(own, axis=0, return_index=True)
        table = PerfectHash(own[first])
        slot = table.slots(own)
        counts = np.zeros((table.n, 2), np.int64)
        np.add.at(counts, slot, np.column_stack((leaves, saved_)))
        up, level = np.full(table.n, -1), np.zeros(table.n, np.int64)
        up[slot], level[slot] = np.where((depth - 1) % band, table.slots(parent), -1), depth
        order = np.argsort(-level, kind="stable")
        for nodes in np.split(order, np.flatnonzero(np.diff(level[order])) + 1):
            inner = nodes[up[nodes] >= 0]
            np.add.at(counts, up[inner], counts[inner])
        keys = table.keys.view(np.int64)
        return pa.table([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(counts[:, 0]), pa.array(counts[:, 1])], names=["d1", "d2", "n_leaves", "saved_tokens"])

    return run


def subtree_sums(rows: DataFrame, shard_rows: int = SHARD_ROWS, band: int = BAND) -> DataFrame:
    """rows: PREFIXES with the counts leaves and saved of each row's own node
    (in one of its rows only). d1, d2, n_leaves, saved_tokens of each node."""
    run = F.floor((F.col("depth") - 1) / band)
    # what the runs below a conversation's first one hold, and all below them
    totals = rows.where(F.col("depth") > band).groupBy("conv_id", run.alias("run")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    below = Window.partitionBy("conv_id").orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, 0)
    totals = totals.select("conv_id", (F.col("run") * band).cast("long").alias("depth"), F.sum("leaves").over(below).alias("more_leaves"), F.sum("saved").over(below).alias("more_saved"))
    rows = rows.join(totals, ["conv_id", "depth"], "left")
    n = rows.count()
    shard = F.pmod(F.xxhash64(F.col("conv_id") - F.col("conv_id") % GROUP, run), F.lit(max(1, -(-n // shard_rows)))).cast("int")
    rows = rows.select(shard.alias("shard"), "depth", "d1", "d2", "p1", "p2", *((F.col(k) + F.coalesce(f"more_{k}", F.lit(0))).alias(k) for k in ("leaves", "saved")))
    parts = rows.groupBy("shard").applyInArrow(_accumulated(band), "d1 long, d2 long, n_leaves long, saved_tokens long")
    return parts.groupBy("d1", "d2").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def _pieces(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (d1, d2, conv_id): comma-joined ids of each node, in pieces."""
    part, number = TaskContext.get().partitionId(), 0
    for frame in gathered(frames, PIECE_IDS):
        d1, d2, conv = _columns(frame, "d1", "d2", "conv_id")
        new = np.flatnonzero(np.concatenate(([True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]))))
        ends = np.concatenate((new[1:], [len(conv)]))
        text = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(new.tolist(), ends.tolist(), strict=True)]
        places = np.arange(number, number + len(new))
        number += len(new)
        yield pa.RecordBatch.from_arrays([pa.array(d1[new]), pa.array(d2[new]), pa.array(np.full(len(new), part, np.int32)), pa.array(places), pa.array(text)], names=["d1", "d2", "part", "piece", "ids"])


def _hashed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces: the SHA-256 of each node's, joined by commas. A node's
    pieces go through one hash state, whatever the batch that they arrive in."""
    node, state, done = None, None, []
    for frame in frames:
        done = []
        for d1, d2, ids in zip(*(frame.column(k).to_pylist() for k in ("d1", "d2", "ids")), strict=True):
            if (d1, d2) != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (d1, d2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _nodes(done)
    if node is not None:
        yield _nodes([(*node, state.hexdigest())])


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["d1", "d2", "ends_sha256"])


def ends_hashes(ends: DataFrame) -> DataFrame:
    """ends: (d1, d2, conv_id). d1, d2, ends_sha256 of each node with ends."""
    pieces = ends.repartitionByRange("d1", "d2", "conv_id").sortWithinPartitions("d1", "d2", "conv_id").mapInArrow(_pieces, "d1 long, d2 long, part int, piece long, ids string")
    pieces = pieces.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "part", "piece")
    return pieces.mapInArrow(_hashed, "d1 long, d2 long, ends_sha256 string")


def nodes(ordered: DataFrame, conversations: DataFrame, shard_rows: int = SHARD_ROWS, band: int = BAND) -> DataFrame:
    """The trie of the turns (ORDERED) of the conversations (conv_id, also those
    without turns): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, and (t1, t2), the digest of the node's
    last turn (root: null)."""
    rows = saved(prefixes(ordered), "prefix-digests")
    key = ["d1", "d2"]
    same = [F.min(c).alias(c) for c in ("depth", "t1", "t2", "bytes", "p1", "p2")]
    differ = F.lit(False)
    for c in ("depth", "t1", "t2", "p1", "p2"):
        differ = differ | (F.min(c) != F.max(c))
    table = rows.groupBy(*key).agg(*same, F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), differ.alias("differ"))
    table = saved(table, "trie-nodes")
    if not table.where("differ").isEmpty():
        raise RuntimeError("two prefixes share a 128-bit digest")
    children = table.groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count("*").alias("n_children"))
    table = saved(table.join(children, key, "left").fillna(0, ["n_children"]), "trie-children")

    own = table.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    counted = rows.select("conv_id", "depth", *key, "p1", "p2").join(own, ["conv_id", "depth"], "left").fillna(0, ["leaves", "saved"])
    sums = saved(subtree_sums(saved(counted, "trie-counts"), shard_rows, band), "trie-sums")
    length = rows.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    hashes = ends_hashes(rows.select("conv_id", "depth", *key).join(length, ["conv_id", "depth"]).select(*key, "conv_id"))
    parents = table.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))

    empty = hashlib.sha256().hexdigest()
    schema = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, t1 long, t2 long"
    first, n = conversations.agg(F.min("conv_id"), F.count("*")).first()
    if not n:
        return conversations.sparkSession.createDataFrame([], schema)
    at_top, leaves, tokens = table.agg(F.count_if(F.col("depth") == 1), F.count_if(F.col("n_children") == 0), F.sum((F.col("n_convs") - 1) * F.col("bytes"))).first()
    none = conversations.join(length, "conv_id", "left_anti").select(F.lit(0).cast("long").alias("d1"), F.lit(0).cast("long").alias("d2"), "conv_id")
    turnless = ends_hashes(none).first()
    # a root without children is the only leaf
    root = (first, 0, None, n, at_top, leaves or 1, tokens or 0, turnless["ends_sha256"] if turnless else empty, None, None)
    found = table.join(sums, key).join(hashes, key, "left").join(parents, ["p1", "p2"], "left").select(
        "conv_id", "depth", F.when(F.col("depth") == 1, F.lit(first).cast("long")).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"), "t1", "t2",
    )
    return conversations.sparkSession.createDataFrame([root], schema).union(found)


def prefix_trie(turns: DataFrame, share: bool = False, shard_rows: int = SHARD_ROWS, band: int = BAND) -> DataFrame:
    """The trie of the conversations as they are or, with ``share``, rebuilt
    with the first turns of others (see ``rebuilt``)."""
    ordered = in_order(turn_digests(turns))
    if share:
        ordered, ids = rebuilt(ordered)
    else:
        ordered = saved(ordered, "ordered")
        ids = ordered.select("conv_id").distinct()
    return nodes(ordered, ids, shard_rows, band)


def _named(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        half, _ = _turn_hash(frame)
        yield pa.RecordBatch.from_arrays([pa.array(half[:, 0]), pa.array(half[:, 1]), frame.column("role").fill_null(""), frame.column("text").fill_null("")], names=["t1", "t2", "role", "text"])


def with_texts(trie: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes with role and text of their last turn (root: null)."""
    known = turns.select(F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    known = known.mapInArrow(_named, "t1 long, t2 long, role string, text string").dropDuplicates(["t1", "t2"])
    return trie.join(known, ["t1", "t2"], "left")
