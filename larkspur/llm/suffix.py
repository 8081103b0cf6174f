"""Suffix-array deduplication: every byte that is covered by a string of
``length`` bytes which also starts elsewhere, in any document, is removed.

1. Anchors. Of the grams in each window of ``length`` bytes, the one of least
   hash is the window's anchor. Equal windows have equal anchors, so a window
   can only repeat if its anchor does. A document has one row for each run of
   windows with one anchor (about 2 in 300 bytes): the anchor's hash, and the
   hash of all bytes of the run's windows (its context).
2. A context that occurs twice is a repeat as a whole, whatever number of times
   it occurs: that is an aggregate by (anchor, context). Only contexts that
   share an anchor with another context, and those that repeat in themselves,
   need their bytes compared.
3. Shards. Those contexts' bytes are dealt to shards of bounded size by their
   anchor, so equal windows meet (long contexts in runs of windows); each shard gets a suffix array by
   Larsson-Sadakane refinement (sort by rank at distance h, groups of one are
   done, h doubles) and common prefixes by Kasai's recurrence, run in step over
   many stretches of the text. Neighbours with ``length`` common bytes repeat.
4. Across shards. An anchor whose contexts hold more bytes than half a shard has
   several shards. Their distinct windows, as 128-bit keys in sorted runs, are dealt out
   by key range and the runs are merged in pairs by binary search; a key that
   two shards have is a repeat. A window of any frequency is one key of each
   shard, so hot passages stay small.

Null and empty texts have no bytes. Repeated rows are documents like any other,
so their texts of ``length`` bytes or more are removed. An input column may
have any name; those of the caller's documents are carried as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm.common import M64, batches, merged, mix64, ready, saved, spread, words64

LENGTH = 400
#: Bytes of a gram; a window has length - gram + 1 of them.
GRAM = 100
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Bytes of contexts of one suffix array, about.
SHARD_BYTES = 1 << 19
#: Bytes of a document that are searched for anchors at once.
PART_BYTES = 1 << 20
#: Keys that one task merges.
MERGED_KEYS = 250_000
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** k and base ** -k modulo 2 ** 64 for k < n."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = (n >> 16) + 1 << 16
        both = [np.full(size, np.uint64(x)) for x in (base, pow(base, -1, 1 << 64))]
        for x in both:
            x[0] = 1
            np.cumprod(x, out=x)
        _powers[base] = tuple(both)
    up, down = _powers[base]
    return up[:n], down[:n]


class Sums:
    """Hashes of any stretches of some bytes, from sums of byte times power."""

    def __init__(self, data: np.ndarray, base: int):
        up, self.down = powers(base, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def all(self, size: int) -> np.ndarray:
        """The hash of the stretch of one size at each start."""
        n = len(self.sums) - size
        return mix64((self.sums[size:] - self.sums[:n]) * self.down[:n])

    def some(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return mix64((self.sums[start + size] - self.sums[start]) * self.down[start] ^ size.astype(np.uint64))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours, from running minima of blocks."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    rows = -(-len(x) // w)
    full = np.full(rows * w, np.uint64(M64))
    full[: len(x)] = x
    full = full.reshape(rows, w)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def anchors(data: np.ndarray, at: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: the document's number, the first
    window's start, windows, anchor hash, context hash, and whether the
    anchor occurs in the context twice."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return {"doc": none, "start": none, "windows": none, "anchor": none.view(np.uint64), "context": none.view(np.uint64), "again": none.astype(bool)}
    w = length - gram + 1
    hashes = Sums(data, BASES[0]).all(gram)
    least = sliding_min(hashes, w)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(least)]
    inside = at[doc + 1] - np.arange(len(least)) >= length
    head = np.ones(len(least), bool)
    head[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | ~inside[:-1]
    head &= inside
    start = np.flatnonzero(head)
    stop = np.flatnonzero(inside & np.concatenate((head[1:] | ~inside[1:], [True]))) + 1
    run = np.cumsum(head) - 1
    anchor, n_windows = least[start], stop - start
    # two equal windows of one run mean an anchor that begins a window and a later one that ends a window
    begins = np.flatnonzero(inside & (hashes[: len(least)] == least))
    closes = np.flatnonzero(inside & (hashes[w - 1 :] == least))
    earliest, latest = np.full(len(start), len(data)), np.full(len(start), -1)
    earliest[run[begins[::-1]]] = begins[::-1]
    latest[run[closes]] = closes + w - 1
    context = Sums(data, BASES[1]).some(start, n_windows + length - 1)
    return {"doc": doc[start], "start": start - at[doc[start]], "windows": n_windows, "anchor": anchor, "context": context, "again": earliest < latest}


def _anchor_rows(length: int, gram: int):
    def parts(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """A very long document comes in parts, each with all bytes of the
        windows that start in it."""
        if len(at) > 2:
            yield 0, data, at
        else:
            for lo in range(0, len(data), PART_BYTES):
                part = data[lo : lo + PART_BYTES + length - 1]
                yield lo, part, np.array([0, len(part)])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for rows, data, at in batches(frame):
                for lo, part, ends in parts(data, at):
                    x = anchors(part, ends, length, gram)
                    doc = pa.array(x["doc"])
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("key_id").take(doc), rows.column("key_hash").take(doc), pa.array(x["start"] + lo), pa.array(x["windows"].astype(np.int32)), pa.array(x["anchor"].view(np.int64)), pa.array(x["context"].view(np.int64)), pa.array(x["again"])],
                        names=["key_id", "key_hash", "start", "windows", "anchor", "context", "again"],
                    )

    return run


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of small numbers (below 512) and its inverse."""
    n = len(symbols)
    wide = np.zeros(n + 7, np.int64)
    wide[:n] = symbols
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = key << 9 | wide[k : k + n]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    heads = np.flatnonzero(head)
    rank = np.empty(n, np.int64)
    rank[order] = heads[np.cumsum(head) - 1]
    alone = head & np.concatenate((head[1:], [True]))
    slots, h = np.flatnonzero(~alone), 7
    while len(slots):
        active = order[slots]
        ahead = active + h
        key = rank[active] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        sort = np.argsort(key, kind="stable")
        active, key = active[sort], key[sort]
        order[slots] = active
        head = np.concatenate(([True], key[1:] != key[:-1]))
        rank[active] = slots[head][np.cumsum(head) - 1]
        slots = slots[~(head & np.concatenate((head[1:], [True])))]
        h *= 2
    return order, rank


def common_prefixes(data: np.ndarray, ends: np.ndarray, order: np.ndarray, rank: np.ndarray, most: int, lane: int = 256) -> np.ndarray:
    """For each position the bytes, up to ``most``, that its suffix has in
    common with the one sorted before it, up to the ends of their segments.
    The next position has at least one less (Kasai)."""
    n = len(data)
    view = words64(np.concatenate((data, np.zeros(most + 16, np.uint8))))
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    at = np.arange(0, n, lane)
    common = np.zeros(len(at), np.int64)
    for _ in range(lane):
        at, common = (at[:-1], common[:-1]) if len(at) and at[-1] >= n else (at, common)
        if not len(at):
            break
        other = before[at]
        limit = np.where(other < 0, 0, np.minimum(np.minimum(ends[at] - at, ends[np.maximum(other, 0)] - other), most))
        common = np.minimum(np.maximum(common - 1, 0), limit)
        left = np.flatnonzero(common < limit)
        while len(left):
            diff = view[at[left] + common[left]] ^ view[other[left] + common[left]]
            lowest = diff & (~diff + np.uint64(1))
            same = np.where(diff == 0, 8, np.bitwise_count(lowest - np.uint64(1)) >> 3)
            common[left] = np.minimum(common[left] + same, limit[left])
            left = left[(same == 8) & (common[left] < limit[left])]
        out[at] = common
        at = at + 1
    return out


def shard_repeats(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """data: segments, each followed by one byte that separates it; ends: the
    end of the segment that each position is in. Which positions start a
    string of ``length`` bytes that repeats among the segments, and the first
    sorted position of each distinct such string."""
    own = np.arange(len(data))
    order, rank = suffix_array(np.where(ends == own, 0, data.astype(np.int64) + 1))
    common = common_prefixes(data, ends, order, rank, length)
    again = common >= length
    before = np.full(len(data), -1, np.int64)
    before[order[1:]] = order[:-1]
    repeated = again.copy()
    repeated[before[again]] = True
    return repeated, np.flatnonzero((ends - own >= length) & ~again)


PIECES = "shard long, hot boolean, key_id long, key_hash long, start long, piece binary"


def _pieces(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each context to be compared, with its shard."""
    for frame in frames:
        for rows, data, at in batches(frame):
            lists = rows.column("compare")
            flat = np.asarray(lists.flatten()).reshape(-1, 4)
            doc = np.repeat(np.arange(rows.num_rows), np.asarray(pa.compute.list_value_length(lists).fill_null(0)) // 4)
            start, size = at[doc] + flat[:, 0], flat[:, 1] - flat[:, 0]
            raw = data[spread(start, size)].tobytes()
            ends = np.cumsum(size)
            piece = [raw[a:b] for a, b in zip((ends - size).tolist(), ends.tolist(), strict=True)]
            doc = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[:, 2]), pa.array(flat[:, 3] > 0), rows.column("key_id").take(doc), rows.column("key_hash").take(doc), pa.array(flat[:, 0]), pa.array(piece, pa.binary())],
                names=["shard", "hot", "key_id", "key_hash", "start", "piece"],
            )


KEYS = "bucket int, key_id long, key_hash long, runs array<long>, ids array<long>, hashes array<long>, doc array<int>, position array<long>, keys binary, checks binary"
HITS = "key_id long, key_hash long, runs array<long>"


_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table([pa.array(list(c), _TYPES[k]) for c, k in zip(columns, kinds, strict=True)], names=list(names))


def covered(owner: np.ndarray, position: np.ndarray, length: int) -> list[tuple[int, list[int]]]:
    """To each owner the runs (start, end, flat) that strings of ``length``
    bytes at its positions cover; positions are sorted within an owner, whose
    positions stand together."""
    if not len(owner):
        return []
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (position[1:] != position[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(owner)) - 1
    who, flat = owner[first], np.stack((position[first], position[last] + length), axis=1)
    cut = np.flatnonzero(np.diff(who, prepend=who[0] - 1))
    return [(int(who[a]), flat[a:b].ravel().tolist()) for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(who)], strict=True)]


def _shard(length: int, buckets: int):
    """One shard's repeats, a row of bucket -1 for each context that has any,
    and, of a shard of a hot anchor, its sorted keys by key range."""

    def run(rows: pa.Table) -> pa.Table:
        pieces, ids, hashes = (rows.column(k).to_pylist() for k in ("piece", "key_id", "key_hash"))
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        stops = np.cumsum(size + 1) - 1
        of = np.repeat(np.arange(len(size)), size + 1)
        text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        repeated, first = shard_repeats(text, stops[of], length)
        start = rows.column("start").to_numpy() - (stops - size)
        own = lambda k: (ids[k], hashes[k])
        p = np.flatnonzero(repeated)
        table = [(-1, *own(k), runs, None, None, None, None, None, None) for k, runs in covered(of[p], start[of[p]] + p, length)]
        if rows.column("hot")[0].as_py() and len(first):
            key, check = (Sums(text, b).some(first, np.full(len(first), length)) for b in BASES)
            sort = np.argsort(key, kind="stable")
            key, check, first = key[sort], check[sort], first[sort]
            d, p = of[first], start[of[first]] + first
            bucket = (key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            cut = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(key)]
            for a, b in zip(cut, cut[1:], strict=False):
                some, back = np.unique(d[a:b], return_inverse=True)
                who = [own(x) for x in some]
                table.append((int(bucket[a]), None, None, None, [w[0] for w in who], [w[1] for w in who], back.astype(np.int32), p[a:b], key[a:b].tobytes(), check[a:b].tobytes()))
        return _table(table, KEYS)

    return run


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], hit: np.ndarray) -> None:
    """Merge sorted runs (key, check, number) in pairs by binary search and
    mark the numbers whose keys two runs have."""
    while len(runs) > 1:
        out = []
        for a, b in zip(runs[::2], runs[1::2], strict=False):
            at = np.searchsorted(a[0], b[0])
            near = np.minimum(at, max(len(a[0]) - 1, 0))
            same = (a[0][near] == b[0]) & (a[1][near] == b[1]) if len(a[0]) else np.zeros(len(b[0]), bool)
            hit[b[2][same]] = True
            hit[a[2][near[same]]] = True
            new = ~same
            place = at[new] + np.arange(int(new.sum()))
            old = np.ones(len(a[0]) + len(place), bool)
            old[place] = False
            pair = []
            for x, y in zip(a, b, strict=True):
                z = np.empty(len(old), x.dtype)
                z[place], z[old] = y[new], x
                pair.append(z)
            out.append(tuple(pair))
        runs = out + ([runs[-1]] if len(runs) % 2 else [])


def _merged_hits(length: int):
    """Runs of the keys of one range that two shards have."""

    def run(table: pa.Table) -> pa.Table:
        rows = {k: table.column(k).to_pylist() for k in ("ids", "hashes", "keys", "checks")} | {k: [np.asarray(x.values) for x in table.column(k)] for k in ("doc", "position")}
        size = [len(x) for x in rows["position"]]
        base = np.cumsum([0, *size])
        runs = [(np.frombuffer(k, np.uint64), np.frombuffer(c, np.uint64), np.arange(a, a + n)) for k, c, a, n in zip(rows["keys"], rows["checks"], base[:-1].tolist(), size, strict=True)]
        hit = np.zeros(base[-1], bool)
        merge_runs(runs, hit)
        out = []
        for k, (ids, hashes, doc, position) in enumerate(zip(rows["ids"], rows["hashes"], rows["doc"], rows["position"], strict=True)):
            mine = hit[base[k] : base[k + 1]]
            doc, position = doc[mine], position[mine]
            sort = np.lexsort((position, doc))
            out += [(ids[d], hashes[d], x) for d, x in covered(doc[sort], position[sort], length)]
        return _table(out, HITS)

    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, int]:
    """key_id, key_hash (id and hash of a text), known (start, end of whole
    contexts that repeat, flat) and compare (start, end, shard, whether it is
    hot, of contexts to be compared byte by byte, flat), of the documents that
    have any; and the key ranges for hot shards."""
    ready(docs.sparkSession)
    keyed = docs.select(F.col(id_col).cast("long").alias("key_id"), F.xxhash64(F.col(text_col)).alias("key_hash"), F.col(text_col).cast("string").alias("text"))
    rows = saved(keyed.where(F.octet_length("text") >= length).mapInArrow(_anchor_rows(length, gram), "key_id long, key_hash long, start long, windows int, anchor long, context long, again boolean"), "anchors")
    often = rows.groupBy("anchor").agg(F.count("*").alias("n"), F.max("again").alias("again")).where("n > 1 or again").select("anchor")
    # a written table on both sides: the join deals an anchor with very many rows to several tasks
    rows = saved(rows.join(saved(often, "often"), "anchor", "left_semi"), "repeated-anchors")
    one = F.struct("key_id", "key_hash", "start", "windows")
    contexts = saved(rows.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.max("again").alias("again"), F.min(one).alias("one")), "contexts")
    # long contexts are cut into runs of windows, whose bytes overlap
    step = max(SHARD_BYTES // 16, length)
    bytes_ = F.col("one.windows") + F.lit(length) * F.ceil(F.col("one.windows") / step)
    several = saved(contexts.groupBy("anchor").agg(F.count("*").alias("n_contexts"), F.sum(bytes_).alias("n_bytes")).where(f"n_contexts > 1 or n_bytes > {SHARD_BYTES // 2}"), "several")
    # an anchor whose contexts hold more than half a shard has shards of its own
    parts = F.ceil(F.coalesce("n_bytes", F.lit(0)) / F.lit(SHARD_BYTES // 2)).cast("int")
    compare = contexts.join(several, "anchor", "left").where("again or n_contexts > 1").withColumn("parts", parts)
    n_bytes, n_hot = compare.agg(F.sum(bytes_), F.sum(F.when(F.col("parts") > 1, F.col("one.windows")))).first()
    shards = max(1, -(-2 * (n_bytes or 0) // SHARD_BYTES))
    cold = F.pmod(F.xxhash64("anchor"), F.lit(shards))
    hot = F.lit(shards) + F.shiftrightunsigned(F.xxhash64("anchor", F.pmod(F.xxhash64("context", "cut"), "parts")), 2)
    start, end = F.col("start").cast("long"), F.col("start") + F.col("windows") + F.lit(length - 1)
    cut = F.explode(F.sequence(F.lit(0), F.floor((F.col("one.windows") - 1) / step).cast("int")))
    compare = compare.select("anchor", "context", "one", "parts", cut.alias("cut"))
    first = F.col("one.start") + F.col("cut") * step
    windows = F.least(F.lit(step), F.col("one.windows") - F.col("cut") * step)
    compare = compare.select("one.key_id", "one.key_hash", first.alias("start"), windows.alias("windows"), F.when(F.col("parts") > 1, hot).otherwise(cold).alias("shard"), (F.col("parts") > 1).cast("long").alias("hot"))
    compare = compare.select("key_id", "key_hash", F.lit(None).cast("array<long>").alias("whole"), F.array(start, end, "shard", "hot").alias("compare"))
    whole = rows.join(contexts.where("n > 1").select("anchor", "context"), ["anchor", "context"], "left_semi").select("key_id", "key_hash", F.array(start, end).alias("whole"), F.lit(None).cast("array<long>").alias("compare"))
    flat = lambda x: F.flatten(F.sort_array(F.collect_set(x)))
    found = whole.union(compare).groupBy("key_id", "key_hash").agg(flat("whole").alias("known"), flat("compare").alias("compare"))
    return found, max(1, -(-(n_hot or 0) // MERGED_KEYS))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The caller's rows as one struct, with the id and hash of their text."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("row_id"), F.xxhash64(F.col(text_col)).alias("row_hash"))


def _meets(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    return left.join(right, F.col("row_id").eqNullSafe(F.col("key_id")) & (F.col("row_hash") == F.col("key_hash")), how).drop("key_id", "key_hash")


def with_removed(docs: DataFrame, finish: Callable, schema: str | T.StructType, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """finish(rows, bytes, offsets, removed intervals of each row) makes the
    result's rows from the documents' rows and what is to be removed."""
    found, buckets = repeats(docs, id_col, text_col, length, gram)
    joined = saved(_meets(_rows(docs, id_col, text_col), found, "left"), "texts-with-repeats")
    text = F.col("row").getField(text_col).cast("string")
    open_ = joined.where(F.size("compare") > 0)
    pieces = open_.select(F.col("row_id").alias("key_id"), F.col("row_hash").alias("key_hash"), "compare", text.alias("text")).mapInArrow(_pieces, PIECES)
    shards = saved(pieces.groupBy("shard").applyInArrow(_shard(length, buckets), KEYS), "suffix-keys")
    far = shards.where("bucket >= 0").groupBy("bucket").applyInArrow(_merged_hits(length), HITS)
    near = shards.where("bucket < 0").select("key_id", "key_hash", "runs")
    hits = far.union(near).groupBy("key_id", "key_hash").agg(F.flatten(F.collect_list("runs")).alias("hits"))
    none = F.lit(None).cast("array<long>")
    settled = joined.where("compare is null or size(compare) = 0").select("row", text.alias("row_text"), "known", none.alias("hits"))
    compared = _meets(open_, hits, "left").select("row", text.alias("row_text"), "known", "hits")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for rows, data, at in batches(frame, "row_text"):
                found = []
                for known, hits in zip(rows.column("known").to_pylist(), rows.column("hits").to_pylist(), strict=True):
                    known, hits = np.array(known or [], np.int64), np.array(hits or [], np.int64)
                    found.append(merged(np.concatenate((known[::2], hits[::2])), np.concatenate((known[1::2], hits[1::2]))))
                yield finish(pa.RecordBatch.from_struct_array(rows.column("row")), data, at, found)

    return settled.union(compared).mapInArrow(run, schema)


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document."""

    def finish(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray, found: list) -> pa.RecordBatch:
        sha, n_removed = [], []
        for a, b, (s, e) in zip(at[:-1].tolist(), at[1:].tolist(), found, strict=True):
            sha.append(hashlib.sha256(b"".join(data[a + x : a + y].tobytes() for x, y in zip([0, *e.tolist()], [*s.tolist(), b - a], strict=True))).hexdigest())
            n_removed.append(int((e - s).sum()))
        columns = [rows.column("doc_id"), pa.array(np.diff(at)), pa.array(n_removed, pa.int64()), pa.array([len(s) for s, _ in found], pa.int64()), pa.array(sha, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return with_removed(rows, finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", length=length, gram=gram)


def whole_words(raw: np.ndarray, start: int, end: int) -> int:
    """Words that lie wholly within raw[start:end], between white space or the
    text's ends."""
    blank = lambda k: k < 0 or k >= len(raw) or bytes(raw[k : k + 1]).isspace()
    n = len(raw[start:end].tobytes().split())
    cut = (not blank(start) and not blank(start - 1)) + (not blank(end - 1) and not blank(end))
    return max(n - cut, 0)


def apart(raw: np.ndarray, start: int, end: int) -> tuple[int, int]:
    """A run without one white space at its edge, if the words beside it would
    otherwise become one."""
    blank = lambda k: bytes(raw[k : k + 1]).isspace()
    if 0 < start < end < len(raw) and not blank(start - 1) and not blank(end):
        if blank(start):
            return start + 1, end
        if blank(end - 1):
            return start, end - 1
    return start, end


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, length: int = LENGTH, gram: int = GRAM, least_words: int = 0) -> DataFrame:
    """The documents with what repeats taken out of their text; a character
    goes if all its bytes go. length_col: a column that holds the number of
    characters, counted anew. least_words: what repeats stays unless it holds
    so many whole words (characters between white space)."""

    def finish(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray, found: list) -> pa.RecordBatch:
        texts, null = [], rows.column(text_col).is_null().to_pylist()
        for a, b, (s, e), no_text in zip(at[:-1].tolist(), at[1:].tolist(), found, null, strict=True):
            raw = data[a:b]
            if least_words:
                long = np.array([whole_words(raw, x, y) >= least_words for x, y in zip(s.tolist(), e.tolist(), strict=True)], bool)
                s, e = s[long], e[long]
                for k in range(len(s)):
                    s[k], e[k] = apart(raw, int(s[k]), int(e[k]))
            inner = (raw & 0xC0) == 0x80
            for k in range(len(s)):  # to where a character starts
                while s[k] < e[k] and inner[s[k]]:
                    s[k] += 1
                while e[k] < len(raw) and e[k] > s[k] and inner[e[k]]:
                    e[k] -= 1
            texts.append(None if no_text else b"".join(raw[x:y].tobytes() for x, y in zip([0, *e.tolist()], [*s.tolist(), len(raw)], strict=True)).decode())
        out = {name: rows.column(name) for name in rows.schema.names}
        out[text_col] = pa.array(texts, pa.string())
        if length_col:
            out[length_col] = pa.array([None if x is None else len(x) for x in texts], rows.schema.field(length_col).type)
        return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return with_removed(docs, finish, docs.schema, id_col, text_col, length, gram)
