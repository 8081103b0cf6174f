"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised; a cosine of at least c is then a distance of at most
sqrt(2 - 2 c). A table's bucket is the floor of a few Gaussian projections
after a random shift, divided by a width; two vectors at the limiting distance
share a projection's cell with a known probability, from which follow the
number of tables that finds such a pair with probability ``RECALL`` (nearer
pairs more likely), and, with the number of vectors of the largest label, the
projections of a table that cost least. Pairs that share a bucket are checked
by their cosine in double precision, each in the first table that has them
together, so counts are exact for the pairs that are found.

Equal vectors of a label are one class, an aggregate. A bucket yields for each
class its number of links and one link to the least class that it reaches
there, never all pairs. Buckets of more than ``BUCKET`` classes are cut into
blocks, and each pair of blocks is one row, so no task holds a hot bucket.

Only equal, non-null labels (and equal lengths) are compared. Vectors that are
null, empty, zero or hold null or non-finite components link with nothing, nor
do those without vec_id. Repeated rows are vectors of their own, linked with
each other. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import ready, saved
from larkspur.llm.graph import components

COSINE = 0.93
RECALL = 0.999
WIDTH = 2.5
SEED = 20
#: Distance at which unrelated vectors lie (orthogonal ones).
FAR = sqrt(2)
#: Pair checks that cost as much as moving a vector to one more table.
MOVE = 500
#: Classes of a bucket that are compared at once.
BUCKET = 1024


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that a projection puts two points into one cell."""
    r = width / distance
    return erf(r / sqrt(2)) - sqrt(2 / pi) / r * (1 - exp(-r * r / 2))


def parameters(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Projections of a table and number of tables for n vectors a label."""
    near, far = collision(sqrt(2 - 2 * cosine)), collision(FAR)
    tables = lambda m: max(1, ceil(log(1 - recall) / log(1 - near**m)))
    m = min(range(2, 33), key=lambda m: tables(m) * (MOVE + n * far**m))
    return m, tables(m)


PREPARED = "vec_id long, label string, dim int, h1 long, h2 long, vec binary, good boolean"


def _prepare(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        ids, labels, vectors = frame.column("vec_id"), frame.column("label"), frame.column("embedding")
        n = frame.num_rows
        at = np.asarray(vectors.offsets, np.int64)
        flat = vectors.values.slice(at[0], at[-1] - at[0])
        null = flat.is_null().to_numpy(zero_copy_only=False)
        value = flat.fill_null(0.0).to_numpy().astype(np.float64) + 0.0  # minus zero is zero
        at = at - at[0]
        bad = null | ~np.isfinite(value)
        total = lambda x: np.concatenate(([0], np.cumsum(x)))[at[1:]] - np.concatenate(([0], np.cumsum(x)))[at[:-1]]
        value[bad] = 0.0
        good = (total(bad) == 0) & (total(value != 0) > 0) & vectors.is_valid().to_numpy(zero_copy_only=False) & labels.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
        raw = [value[a:b].tobytes() if g else b"" for a, b, g in zip(at[:-1].tolist(), at[1:].tolist(), good.tolist(), strict=True)]
        digest = np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=16).digest() for x in raw), np.int64).reshape(n, 2)
        yield pa.RecordBatch.from_arrays([ids, labels, pa.array(np.diff(at).astype(np.int32)), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(raw, pa.binary()), pa.array(good)], names=PREPARED.replace(",", "").split()[::2])


def unit(raw: list[bytes], dim: int) -> np.ndarray:
    """Normalised vectors; scaled first, so that no square over- or underflows."""
    x = np.frombuffer(b"".join(raw), np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cells(x: np.ndarray, m: int, tables: int) -> np.ndarray:
    """A 32-bit hash of each vector's cell in each table."""
    rng = np.random.default_rng([SEED, x.shape[1], m])
    odd = rng.integers(1, 1 << 62, m, np.int64) * 2 + 1
    out = np.empty((len(x), tables), np.int32)
    for t in range(tables):
        project, shift = rng.standard_normal((x.shape[1], m)), rng.uniform(0, WIDTH, m)
        cell = np.floor((x @ project + shift) / WIDTH).astype(np.int64)
        out[:, t] = ((cell * odd).sum(axis=1).view(np.uint64) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _hashed(m: int, tables: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            dims, raw = frame.column("dim").to_numpy(), frame.column("vec").to_pylist()
            out = np.zeros((frame.num_rows, tables), np.int32)
            for dim in np.unique(dims):
                which = np.flatnonzero(dims == dim)
                out[which] = cells(unit([raw[k] for k in which], int(dim)), m, tables)
            names = frame.schema.names
            yield pa.RecordBatch.from_arrays([*frame.columns, pa.array([x.tobytes() for x in out], pa.binary()), pa.array(out.tolist(), pa.list_(pa.int32()))], names=[*names, "cells", "cell"])

    return run


def _bucket_links(cosine: float):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            ids_, links_, roots_ = [], [], []
            for row in frame.to_pylist():
                members = row["members"]
                table, (x, y) = row["table"], (row["pair"]["x"], row["pair"]["y"])
                ids, n = (np.array([v[k] for v in members], np.int64) for k in ("id", "n"))
                block = np.array([v["block"] for v in members])
                u = unit([v["vec"] for v in members], row["dim"])
                cell = np.frombuffer(b"".join(v["cells"] for v in members), np.int32).reshape(len(members), -1)
                a, b = np.flatnonzero(block == x), np.flatnonzero(block == y)
                i, j = np.nonzero(u[a] @ u[b].T >= cosine)
                i, j = a[i], b[j]
                fine = i < j if x == y else np.ones(len(i), bool)
                i, j = i[fine], j[fine]
                fine = ~(cell[i, :table] == cell[j, :table]).any(axis=1)
                i, j = i[fine], j[fine]
                if not len(i):
                    continue
                count = np.bincount(i, n[j], len(ids)) + np.bincount(j, n[i], len(ids))
                root = ids.copy()  # the least id that each reaches in the bucket
                while True:
                    low = np.minimum(root[i], root[j])
                    before = root.copy()
                    np.minimum.at(root, i, low)
                    np.minimum.at(root, j, low)
                    if np.array_equal(before, root):
                        break
                some = np.flatnonzero(count)
                ids_.append(ids[some]), links_.append(count[some].astype(np.int64)), roots_.append(root[some])
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *x])) for x in (ids_, links_, roots_)], names=["id", "links", "root"])

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, bucket: int = BUCKET, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of each vector."""
    ready(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    rows = saved(rows.mapInArrow(_prepare, PREPARED), "vectors")
    same = ["label", "dim", "h1", "h2"]
    one = rows.where("good").groupBy(*same).agg(F.min(F.struct("vec_id", "vec")).alias("one"), F.count("*").alias("n"))
    classes = saved(one.select(*same, F.col("one.vec_id").alias("id"), F.col("one.vec").alias("vec"), "n"), "vector-classes")
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    m, tables = parameters(largest, cosine, recall)
    hashed = classes.select("id", "n", "label", "dim", "vec").mapInArrow(_hashed(m, tables), "id long, n long, label string, dim int, vec binary, cells binary, cell array<int>")
    keyed = saved(hashed.select("id", "n", "label", "dim", "vec", "cells", F.posexplode("cell").alias("table", "cell")), "vector-buckets")
    key = ["label", "dim", "table", "cell"]
    blocks = keyed.groupBy(*key).agg(F.count("*").alias("size")).where("size > 1").select(*key, F.ceil(F.col("size") / bucket).cast("int").alias("blocks"))
    met = keyed.join(blocks, key).withColumn("block", F.pmod(F.xxhash64("id", "vec"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("x"), F.greatest(k, F.col("block")).alias("y")))
    members = met.select(*key, F.struct("id", "n", "vec", "cells", "block").alias("member"), F.explode(pairs).alias("pair"))
    found = members.groupBy(*key, "pair").agg(F.collect_list("member").alias("members")).where(F.size("members") > 1)
    found = saved(found.select("dim", "table", "pair", "members").mapInArrow(_bucket_links(cosine), "id long, links long, root long"), "vector-links")
    count = found.groupBy("id").agg(F.sum("links").alias("links"))
    node = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    classes = classes.select(*same, "id", "n").join(count, "id", "left").join(node.withColumnRenamed("node", "id"), "id", "left")
    classes = classes.select(*same, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    good = rows.where("good").select("vec_id", *same).join(classes, same).select("vec_id", "n_links", "component_id")
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.union(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
