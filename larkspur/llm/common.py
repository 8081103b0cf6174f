"""Helpers shared by the training-data operators: input tables, shared scratch
tables, Arrow text batches and small numpy kernels."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import shared_dir
from larkspur.sources import storage

#: Bytes of text that one numpy step works on; bounds a task's memory.
STEP_BYTES = 1 << 19

#: Rows of one Arrow batch to a Python worker, at most. Spark's own 10,000 rows
#: of long texts fill hundreds of MB on both sides.
ARROW_ROWS = 500

M64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared folder."""
    return f"{shared_dir(spark)}/larkspur-llm/{name}-{uuid.uuid4().hex[:12]}"


#: Scratch tables made since the innermost ``scratch_dropped`` began.
_open: list[list[str]] = []


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives
    lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    if _open:
        _open[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_dropped(spark: SparkSession) -> Iterator[None]:
    """Removes, at the end, what ``saved`` wrote inside; nothing that is still
    to be computed may read it."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            storage.delete(spark, path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def least_by_hash(rows: DataFrame, wanted: int, salt: str) -> list:
    """The ``wanted`` rows least by hash of their doc_id (then by doc_id), the
    same on any partitioning. Rows above the hash under which about twice as
    many lie are left out first, so that tasks send few rows each."""
    n = rows.count()
    hash_ = F.xxhash64("doc_id", F.lit(salt))
    few = rows.where(hash_ / F.lit(2.0**64) + 0.5 <= (2.0 * wanted + 400) / max(n, 1))
    return few.orderBy(hash_, *rows.columns).limit(wanted).collect()


def ready(spark: SparkSession) -> None:
    """Have the session send at most ARROW_ROWS rows of text at once (a smaller
    setting stays), and let Python workers find this package wherever the
    driver was started. Both hold from here on, since a result is computed only
    after the function that returned it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if not 0 < now <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    home, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, home])


def texts_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only (id, text): other columns, whatever their names, stay out."""
    ready(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def batches(batch: pa.RecordBatch, column: str = "text", step: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of at most ``step`` bytes of text (one row at least), each
    with its bytes and its n + 1 byte offsets; null is empty."""
    if not batch.num_rows:
        return
    col = batch.column(column)
    col = col.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = int(np.searchsorted(at, at[lo] + step, side="right")) - 1
        hi = min(max(hi, lo + 1), len(col))
        yield batch.slice(lo, hi - lo), raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def gathered(frames: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``rows``, but for the last."""
    held: list[pa.RecordBatch] = []
    for frame in frames:
        held.append(frame)
        if sum(f.num_rows for f in held) >= rows:
            yield joined(held)
            held = []
    if any(f.num_rows for f in held):
        yield joined(held)


def joined(frames: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(frames).combine_chunks().to_batches()[0]


def code_points(block: int = 0x800) -> Iterator[tuple[int, str]]:
    """All code points but surrogates, as strings of consecutive ones with their
    first. All at once take over 100 MB for a moment, in every worker."""
    for lo in range(0, 0x110000, block):
        if not 0xD800 <= lo < 0xE000:
            yield lo, np.arange(lo, lo + block, dtype="<u4").tobytes().decode("utf-32-le")


def strings_of(data: np.ndarray, at: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def words64(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a little-endian number;
    ``data`` needs eight bytes more than the positions that are used."""
    return np.ndarray((max(len(data) - 7, 0),), "<u8", buffer=data, strides=(1,))


def spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each run of the given length."""
    total = int(lens.sum())
    out = np.arange(total, dtype=np.int64)
    ends = np.cumsum(lens)
    return out + np.repeat(starts - (ends - lens), lens)


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals, sorted; touching intervals join."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate(([True], s[1:] > e[:-1]))
    last = np.concatenate((first[1:], [True]))
    return s[first], e[last]
