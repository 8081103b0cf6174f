"""Token ids as a binary format with a shared zstandard dictionary.

A dataset is one folder. ``meta`` holds the dictionary, its hash and the id
width. ``data`` holds segments in ascending doc_id order: each is a row with
the range of its documents, the hash of the dictionary, an offset index (doc_id,
offset and number of ids of each document) and the documents' ids, each
document compressed by itself, so that reading a short document costs its own
bytes. The rows are written by Spark's Parquet writer: any store that Spark
reaches will do, and an executor that is lost leaves no half-written segment.

The dictionary is trained on the serialized ids of a bounded sample of
documents (``DICTIONARY_ROWS``, least by hash of their id). Documents are
encoded where they lie; only the compressed ids are moved, to tasks that hold a
range of doc_ids each, and positions follow from one count for each range.

Null and empty texts have the end id alone. Documents without doc_id sort
first; rows that repeat a doc_id stand next to each other. Other columns do not
matter.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import batches, least_by_hash, ready, scratch, shuffle_partitions, strings_of, texts_of
from larkspur.llm.pieces import Store, cut

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
#: Documents that the dictionary is trained on, and its bytes.
DICTIONARY_ROWS = 2000
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Bytes of compressed ids in a segment.
SEGMENT_BYTES = 1 << 20


WHITE_SPACE = re.compile(r"\s")


class Encoder:
    """The tokenizers library, asked once for each distinct piece of text: its
    own splitting makes the pieces independent, and many texts share them."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.store = Store(self._pieces)
        self.size = self.tokenizer.get_vocab_size()
        (self.line_feed,) = self.tokenizer.encode("\n", add_special_tokens=False).ids

    def _pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece. Pieces go to the library as lines of one text:
        the splitting pattern never joins a line feed with what is not white
        space, so its id stands between the pieces' ids."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        texts = [x.decode() for x in pieces]
        solid = [k for k, x in enumerate(texts) if not x.isspace() and not WHITE_SPACE.search(x[1:]) and (x[0] == " " or not WHITE_SPACE.match(x))]
        for lo in range(0, len(solid), 4096):
            some = solid[lo : lo + 4096]
            ids = np.array(self.tokenizer.encode("".join(f"{texts[k]}\n" for k in some), add_special_tokens=False).ids, np.int32)
            ends = np.flatnonzero(ids == self.line_feed)
            if len(ends) == len(some):
                for k, a, b in zip(some, [0, *(ends[:-1] + 1).tolist()], ends.tolist(), strict=True):
                    out[k] = ids[a:b]
        for k, x in enumerate(texts):
            if out[k] is None:
                out[k] = np.array(self.tokenizer.encode(x, add_special_tokens=False).ids, np.int32)
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids start (and the end)."""
        data, at, upto = cut([x.decode() for x in texts])
        ids, size = self.store.ids(data, at)
        return ids, np.concatenate(([0], np.cumsum(size)))[upto]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def serialized(ids: np.ndarray, width: int) -> bytes:
    return ids.astype(f"<u{width}").tobytes()


def dictionary(docs: DataFrame, path: str, width: int, rows: int, size: int) -> bytes:
    """A zstandard dictionary for documents' serialized ids; empty if there is
    too little to train on. The sample's doc_ids are picked first, so that at
    most ``rows`` ids and then at most that many texts reach the driver."""
    picked = least_by_hash(docs.where("doc_id is not null").select("doc_id"), rows, "dictionary")
    if not picked:
        return b""
    wanted = docs.sparkSession.createDataFrame(picked, "doc_id long").distinct()
    sample = docs.where("octet_length(text) between 1 and 20000").join(F.broadcast(wanted), "doc_id").select(F.xxhash64("doc_id", F.lit("dictionary")), "doc_id", "text").limit(rows)
    texts = [r["text"].encode() for r in sorted(sample.collect())]
    ids, at = encoder(path).encode(texts)
    samples = [serialized(ids[a:b], width) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    if len(samples) < 64 or sum(map(len, samples)) < 8 * size:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # the library finds nothing that the samples share
        return b""


def _boundaries(docs: DataFrame, ranges: int) -> list[int]:
    """doc_ids that part the documents into about even ranges."""
    found = docs.select(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)], 10_000).alias("p")).first()[0] if ranges > 1 else []
    return sorted(set(found or []))


ENCODED = "part int, doc_id long, n_tokens long, ids binary"


def _encoding(path: str, width: int, shared: bytes, edges: list[int], end_id: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        words = zstandard.ZstdCompressionDict(shared) if shared else None
        if words:
            words.precompute_compress(level=LEVEL)
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=True, write_checksum=False, write_dict_id=False)
        bounds = np.array(edges, np.int64)
        for frame in frames:
            for rows, data, at in batches(frame):
                ids, start = tool.encode(strings_of(data, at))
                n = len(start) - 1
                ended = np.full(len(ids) + n, end_id, np.int64)
                ended[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(start))] = ids
                raw, cuts = serialized(ended, width), (width * (start + np.arange(n + 1))).tolist()
                part = np.searchsorted(bounds, rows.column("doc_id").fill_null(-(1 << 63)).to_numpy(), side="right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), rows.column("doc_id"), pa.array(np.diff(start) + 1), pa.array([pack.compress(raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())],
                    names=["part", "doc_id", "n_tokens", "ids"],
                )

    return run


SEGMENTS = "part int, segment long, first_doc long, last_doc long, start_in_part long, n_tokens long, dictionary_sha256 string, doc_ids binary, offsets binary, counts binary, payload binary"


def _segments(digest: str):
    """Rows of one task, sorted by part and doc_id, packed into segments."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, part, number, before = 0, None, 0, 0

        def row():
            ids = [x[0] for x in held]
            known = [x for x in ids if x is not None]
            offsets = np.cumsum([0, *(len(x[2]) for x in held)])
            counts = np.array([x[1] for x in held], "<u8")
            # a null doc_id is the least long
            return (part, number, known[0] if known else None, known[-1] if known else None, before, int(counts.sum()), digest, np.array([-(1 << 63) if x is None else x for x in ids], "<i8").tobytes(), offsets.astype("<u8").tobytes(), counts.tobytes(), b"".join(x[2] for x in held))

        def batch(rows):
            return pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=NAMES), schema=SCHEMA, preserve_index=False)

        for frame in frames:
            for p, doc, n, raw in zip(*(frame.column(k).to_pylist() for k in ("part", "doc_id", "n_tokens", "ids")), strict=True):
                if held and (p != part or size + len(raw) > SEGMENT_BYTES):
                    yield batch([out := row()])
                    number, before = (number + 1, before + out[5]) if p == part else (0, 0)
                    held, size = [], 0
                part = p
                held.append((doc, n, raw))
                size += len(raw)
        if held:
            yield batch([row()])

    return run


NAMES = [x.split()[0] for x in SEGMENTS.split(", ")]
SCHEMA = pa.schema([(x.split()[0], {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]]) for x in SEGMENTS.split(", ")])


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, ranges: int | None = None, dictionary_rows: int = DICTIONARY_ROWS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all documents and write them as a dataset in ``folder``."""
    spark = docs.sparkSession
    ready(spark)
    path = path or public_tokenizers.path(VOCABULARY)
    width = 2 if encoder(path).size <= 1 << 16 and end_id < 1 << 16 else 4
    texts = texts_of(docs, id_col, text_col)
    shared = dictionary(texts, path, width, dictionary_rows, DICTIONARY_BYTES)
    digest = hashlib.sha256(shared).hexdigest()
    spark.createDataFrame([(bytearray(shared), digest, width)], "dictionary binary, dictionary_sha256 string, width int").coalesce(1).write.parquet(f"{folder}/meta")
    ranges = ranges or shuffle_partitions(spark)
    edges = _boundaries(texts, ranges)
    encoded = texts.mapInArrow(_encoding(path, width, shared, edges, end_id), ENCODED)
    ordered = encoded.repartition(ranges, "part").sortWithinPartitions("part", "doc_id", "n_tokens")
    ordered.mapInArrow(_segments(digest), SEGMENTS).write.parquet(f"{folder}/data")


def _meta(spark: SparkSession, folder: str) -> tuple[bytes, str, int]:
    meta = spark.read.parquet(f"{folder}/meta").first()
    shared = bytes(meta["dictionary"])
    if hashlib.sha256(shared).hexdigest() != meta["dictionary_sha256"]:
        raise ValueError(f"the dictionary in {folder} is not the one that was written")
    return shared, meta["dictionary_sha256"], meta["width"]


def _starts(segments: DataFrame) -> DataFrame:
    """Segments with the number of ids before them: ranges are few (one for
    each task that wrote), so the running sum over them is small."""
    from pyspark.sql import Window

    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return segments.join(F.broadcast(parts.select("part", before.alias("before"))), "part")


def _documents(shared: bytes, digest: str, width: int, wanted: int | None, give):
    """give(doc_ids, starts, counts, ids of each document) makes the rows."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(shared) if shared else None)
        for frame in frames:
            for x in frame.to_pylist():
                if x["dictionary_sha256"] != digest:
                    raise ValueError("a segment was written with another dictionary")
                docs, offsets, counts = (np.frombuffer(x[k], t) for k, t in (("doc_ids", "<i8"), ("offsets", "<u8"), ("counts", "<u8")))
                counts = counts.astype(np.int64)
                start = x["before"] + x["start_in_part"] + np.cumsum(counts) - counts
                which = range(len(docs)) if wanted is None else np.flatnonzero(docs == wanted).tolist()
                ids = [np.frombuffer(unpack.decompress(x["payload"][offsets[k] : offsets[k + 1]], max_output_size=int(width * counts[k])), f"<u{width}") for k in which]
                yield give(pa.array(docs[which] if wanted is not None else docs, mask=(docs[which] if wanted is not None else docs) == -(1 << 63)), start[which], counts[which], ids)

    return run


def _rows(docs: pa.Array, start: np.ndarray, counts: np.ndarray, ids: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([docs, pa.array(start), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], names=["doc_id", "start", "ids"])


def _summary(docs: pa.Array, start: np.ndarray, counts: np.ndarray, ids: list[np.ndarray]) -> pa.RecordBatch:
    crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
    return pa.RecordBatch.from_arrays([docs, pa.array(start), pa.array(np.array(list(map(len, ids)), np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read(spark: SparkSession, folder: str, doc_id: int | None = None) -> DataFrame:
    """doc_id, start and ids of all documents, or of one: then only segments
    whose range has it are read, and only its own bytes are unpacked."""
    ready(spark)
    shared, digest, width = _meta(spark, folder)
    segments = _starts(spark.read.parquet(f"{folder}/data"))
    if doc_id is not None:
        segments = segments.where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    return segments.mapInArrow(_documents(shared, digest, width, doc_id, _rows), "doc_id long, start long, ids array<int>")


def summary(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of what the files hold."""
    ready(spark)
    ready(spark)
    shared, digest, width = _meta(spark, folder)
    return _starts(spark.read.parquet(f"{folder}/data")).mapInArrow(_documents(shared, digest, width, None, _summary), "doc_id long, start long, n_tokens long, ids_crc32 long")


def written(docs: DataFrame, **options) -> DataFrame:
    """Write the documents to a new folder below the shared one and give the
    summary of what is read back."""
    folder = scratch(docs.sparkSession, "tokens")
    write(docs, folder, **options)
    return summary(docs.sparkSession, folder)
