"""SimHash near-duplicates with pigeonring filtering.

A fingerprint bit is set if it is set in over half of the hashes of a text's
word shingles. Equal fingerprints become one class (an aggregate, so a group of
copies of any size is one row). The 64 bits are cut into a ring of max_bits + 1
segments. If two fingerprints differ in at most max_bits bits, then from some
segment on every chain of consecutive segments stays within its proportional
share of the budget; so its first segment is equal and its second differs in at
most one bit, that is, one half of the second is equal too. (first segment, half
of the second) are the keys of the candidate buckets. In a bucket, pairs must
pass the chains of all lengths before the full distance is computed.

A bucket's members are not paired outright: from a member, all members linked
to it leave the bucket together, so a dense group costs about its size. Buckets
of more than ``BUCKET`` classes are cut into blocks, and every pair of blocks
is searched, so no task holds a large group and no link is lost.

Null and empty texts have fingerprint zero and are linked like any other.
Repeated documents are copies. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import batches, ready, saved, strings_of, texts_of
from larkspur.llm.graph import components

SEED = 42
SHINGLE = 4
MAX_BITS = 4
#: Classes of a candidate bucket that one task takes at once.
BUCKET = 20_000


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes; none: 0."""
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 14):
        part = hashes[lo : lo + (1 << 14)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    width = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(width)
    hash_ = xxhash.xxh64_intdigest
    starts, stops = (ends - width)[: len(words) - size + 1].tolist(), (ends - 1)[size - 1 :].tolist()
    return np.fromiter((hash_(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None, row_type: str = "bigint") -> DataFrame:
    """doc_id and fp, the fingerprint's 64 bits as a long; with row_col, which
    tells rows apart, also digest, the text's SHA-256 (null is empty), and row."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for rows, data, at in batches(frame):
                texts = strings_of(data, at)
                fp = np.array([fingerprint(shingle_hashes(x, shingle)) for x in texts], np.uint64)
                more = {"digest": pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()), "row": rows.column("row")} if row_col else {}
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(fp.view(np.int64)), *more.values()], names=["doc_id", "fp", *more])

    if not row_col:
        return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")
    ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(row_col).alias("row"))
    return rows.mapInArrow(run, f"doc_id long, fp long, digest string, row {row_type}")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """First bit and width of each segment of the ring."""
    edges = [64 * k // (max_bits + 1) for k in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _bits(at: int, width: int):
    return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1))


def _keyed(classes: DataFrame, max_bits: int) -> DataFrame:
    """A row for each class and bucket: chain start, key, fp, id."""
    ring = segments(max_bits)
    keys = []
    for k, (at, width) in enumerate(ring):
        next_at, next_width = ring[(k + 1) % len(ring)]
        low = next_width // 2
        for half, (a, w) in enumerate(((next_at, low), (next_at + low, next_width - low))):
            packed = F.shiftleft(_bits(at, width), w).bitwiseOR(_bits(a, w))
            keys.append(packed.bitwiseOR(F.lit((2 * k + half) << 56)))
    return classes.select("fp", "id", F.explode(F.array(*keys)).alias("key"))


class Ring:
    """The pigeonring test for pairs of fingerprints."""

    def __init__(self, max_bits: int):
        self.max_bits, self.ring = max_bits, segments(max_bits)

    def linked(self, x: np.ndarray, y: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Which pairs pass all chains from their start and the full check."""
        diff = x ^ y
        ok, total = np.ones(len(diff), bool), np.zeros(len(diff), np.int64)
        m = len(self.ring)
        at = np.array([a for a, _ in self.ring], np.uint64)
        mask = np.array([(1 << w) - 1 for _, w in self.ring], np.uint64)
        for chain in range(1, m + 1):
            k = (start + chain - 1) % m
            total += np.bitwise_count((diff >> at[k]) & mask[k])
            ok &= total * m <= chain * self.max_bits
        return ok & (np.bitwise_count(diff) <= self.max_bits)


def _bucket_links(max_bits: int):
    ring = Ring(max_bits)

    def small(fp: np.ndarray, at: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of buckets of at most 32 members, by distance in the list."""
        left, right = [], []
        size, base = np.diff(at), np.repeat(np.arange(len(at) - 1), np.diff(at))
        place = np.arange(len(fp)) - at[base]
        for gap in range(1, int(size.max(initial=0))):
            x = np.flatnonzero(place + gap < size[base])
            good = ring.linked(fp[x], fp[x + gap], start[base[x]])
            left.append(x[good])
            right.append(x[good] + gap)
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *left]), np.concatenate([none, *right])

    def large(fp: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        left, right, rest = [], [], np.arange(len(fp))
        while len(rest):
            todo, rest = [int(rest[0])], rest[1:]
            while todo and len(rest):
                x = todo.pop()
                hit = ring.linked(fp[rest], np.broadcast_to(fp[x], len(rest)), np.broadcast_to(np.int64(start), len(rest)))
                near, rest = rest[hit], rest[~hit]
                left.append(np.full(len(near), x))
                right.append(near)
                todo += near.tolist()
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *left]), np.concatenate([none, *right])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            start = (frame.column("key").to_numpy() >> 57).astype(np.int64)
            lists = [frame.column(k) for k in ("fps", "ids")]
            at = np.asarray(lists[0].offsets, np.int64)
            fp, ids = np.asarray(lists[0].values).view(np.uint64)[at[0] : at[-1]], np.asarray(lists[1].values)[at[0] : at[-1]]
            at = at - at[0]
            size = np.diff(at)
            few = np.flatnonzero(size <= 32)
            pick = np.flatnonzero(np.repeat(size <= 32, size))
            x, y = small(fp[pick], np.concatenate(([0], np.cumsum(size[few]))), start[few])
            found = [(ids[pick[x]], ids[pick[y]])]
            for k in np.flatnonzero(size > 32):
                x, y = large(fp[at[k] : at[k + 1]], int(start[k]))
                found.append((ids[at[k] + x], ids[at[k] + y]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in (0, 1)], names=["a", "b"])

    return run


def links(classes: DataFrame, max_bits: int, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between ids that connect all classes (fp, id) whose
    distance is at most max_bits; enough for components, not all pairs."""
    keyed = _keyed(classes, max_bits)
    blocks = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / bucket).cast("int").alias("blocks"))
    met = keyed.join(blocks, "key")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, own).alias("x"), F.greatest(k, own).alias("y")))
    one = met.where("blocks = 1").select("key", "fp", "id", F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")).alias("pair"))
    many = met.where("blocks > 1").select("key", "fp", "id", F.explode(pairs).alias("pair"))
    lists = one.union(many).groupBy("key", "pair").agg(F.collect_list("fp").alias("fps"), F.collect_list("id").alias("ids")).where(F.size("fps") > 1)
    return lists.select("key", "fps", "ids").mapInArrow(_bucket_links(max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id
    that is reachable by links), one row per input row."""
    found = saved(fingerprints(docs, shingle, id_col, text_col), "simhash")
    classes = saved(found.groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-classes")
    if max_bits:
        node = components(links(classes.where("id is not null"), max_bits))
        classes = classes.join(node, classes["id"] == node["node"], "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    else:
        classes = classes.withColumnRenamed("id", "component_id")
    # both sides are written tables, so the join deals a fingerprint that very
    # many rows have to several tasks
    return found.join(saved(classes, "simhash-components"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows with a column ``name`` that tells each from all others, and its
    type: the file and place of rows read from Parquet as they are, else a
    number given while the rows are written once."""
    try:
        return docs.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias(name)), "struct<file_path: string, row_index: bigint>"
    except AnalysisException:  # no plain scan of files
        return saved(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), "bigint"


def kept_documents(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates, with its own columns: the
    least by doc_id (none comes last), then by the text's digest; of rows equal
    in both, the first. Groups are of texts, whatever their ids: unrelated texts
    that share an id stay, and copies without an id keep one. Columns may have
    any name and type: rows are told apart by where they stand, chosen in a
    narrow table, and the texts travel once, to meet the chosen places."""
    number = "row"
    while number in {c.lower() for c in docs.columns}:
        number += "_"
    rows, kind = numbered(docs, number)
    found = saved(fingerprints(rows, row_col=number, row_type=kind), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "row"))
    classes = saved(found.groupBy("fp").agg(first.alias("first")), "simhash-classes")
    # a class's node is its fingerprint, since two classes may have the same least id
    node = components(links(classes.select("fp", F.col("fp").alias("id")), MAX_BITS))
    classes = classes.join(node, classes["fp"] == node["node"], "left").select(F.coalesce("component", "fp").alias("group"), "first")
    kept = classes.groupBy("group").agg(F.min("first").alias("first")).select(F.col("first.row").alias(number))
    # most rows are kept, so the chosen places grow with the documents: never a broadcast
    return rows.join(saved(kept, "kept-rows").hint("merge"), number, "left_semi").drop(number)
