"""Embedding whitening by shifted CholeskyQR.

Vectors are put on an integer grid, x = floor(scale c) + offset, and every
distinct x counts once in the fit: n of them with per-dimension sums S, both
exact. A row is centred exactly, as (n x - S) / n, before anything is
multiplied. The centred rows A are made orthogonal in passes over the data.
Each pass solves the triangular systems of the passes before it, row block by
row block, and sums the Gram matrix of the result; its Cholesky factor is the
next one. The first pass adds a shift to the diagonal, above the rounding of
the sums, so the factor exists for any A; later passes add one only where the
factor fails. What the last Gram matrix still lacks of the identity enters as
its square root, so A'A = R'R for the composed R also if A has no full rank.
The singular values and right vectors of R are those of A: no covariance matrix
is formed, and small variances keep their digits.

Tasks send d rows of d numbers in a pass and the driver holds a d x d matrix,
whatever the number of rows. A vector that a third of all rows hold is one row
of the fit, by an aggregate that combines before its shuffle.

Vectors that are null, empty, or hold null, non-finite or entries beyond 2^53
on the grid take no part; if lengths differ, only those of the most frequent
length do (of equally frequent ones the shortest). Zero vectors are vectors like
any other. Repeated rows and rows without an id are rows of their own in the
result. A component without variance has explained 0 and whitened null. A
deviation that a long cannot hold is null. An empty table gives no rows. Other
columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import gathered, ready, saved

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
#: Rows that one numpy step works on; Gram sums are sums of such blocks.
ROWS = 4096
#: Orthogonalising passes over the data, at most; three do unless variances
#: differ by more than about 10^14.
PASSES = 6
#: Below this part of the largest singular value a component has no variance.
RANK = 1e-10
LARGEST = 1 << 53


@dataclass
class Whitening:
    n: int
    sums: list[int]
    #: d x k unit columns, and their eigenvalues; 0 without variance.
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def _gridded(scale: int, offset: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            vectors = frame.column("embedding")
            at = np.asarray(vectors.offsets, np.int64)
            flat = vectors.values.slice(at[0], at[-1] - at[0])
            at, null = at - at[0], flat.is_null().to_numpy(zero_copy_only=False)
            with np.errstate(all="ignore"):
                x = np.floor(flat.fill_null(0.0).to_numpy() * np.float64(scale)) + offset
                bad = null | ~(np.abs(x) < LARGEST)
            before = np.concatenate(([0], np.cumsum(bad)))
            good = np.flatnonzero((before[at[1:]] == before[at[:-1]]) & (np.diff(at) > 0) & vectors.is_valid().to_numpy(zero_copy_only=False))
            x = np.where(bad, 0, x).astype(np.int64)
            size = np.diff(at)[good]
            keep = np.repeat(at[good] - np.concatenate(([0], np.cumsum(size)))[:-1], size) + np.arange(size.sum())
            rows = pa.LargeListArray.from_arrays(np.concatenate(([0], np.cumsum(size))), pa.array(x[keep])).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([frame.column("vec_id").take(pa.array(good)), pa.array(size.astype(np.int32)), rows], names=["vec_id", "dim", "x"])

    return run


def matrix(frame: pa.RecordBatch) -> np.ndarray:
    """The rows of the list column x, all of one length."""
    x = frame.column("x")
    at = np.asarray(x.offsets, np.int64)
    return np.asarray(x.values)[at[0] : at[-1]].reshape(frame.num_rows, -1)


def scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly; as Python's integers where a long cannot hold it."""
    largest = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums))
    kind = np.int64 if largest < 1 << 62 else object
    return x.astype(kind) * n - np.array(sums, kind)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return scaled(x, n, sums).astype(np.float64) / n


def solved(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """q with q r = a for an upper triangular r, column after column."""
    q = np.empty_like(a)
    for k in range(a.shape[1]):
        q[:, k] = (a[:, k] - q[:, :k] @ r[:k, k]) / r[k, k]
    return q


def _sums(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each task: the sum of every dimension, and as number -1 its rows."""
    n, total = 0, None
    for frame in gathered(frames, ROWS):
        x = matrix(frame)
        kind = np.int64 if int(np.abs(x).max(initial=0)) * len(x) < 1 << 62 else object
        part = [int(s) for s in x.astype(kind).sum(axis=0)]
        total = part if total is None else [a + b for a, b in zip(total, part, strict=True)]
        n += len(x)
    if total is not None:
        numbers = pa.array([Decimal(s) for s in (n, *total)], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int32()), numbers], names=["i", "total"])


def gram(rows: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks x of ``rows`` of of(x)' of(x)."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for frame in gathered(frames, ROWS):
            q = of(matrix(frame))
            total += q.T @ q
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([part] * width, pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "part", "line"])

    def add(group: pa.Table) -> pa.Table:
        """The parts of one line, in one order whatever the order of arrival."""
        group = group.sort_by("part").combine_chunks()
        line = np.asarray(group.column("line").combine_chunks().flatten()).reshape(group.num_rows, -1).sum(axis=0)
        return pa.table({"i": group.column("i").slice(0, 1), "line": pa.array([line.tolist()], pa.list_(pa.float64()))})

    lines = rows.mapInArrow(run, "i int, part int, line array<double>").groupBy("i").applyInArrow(add, "i int, line array<double>").collect()
    out = np.zeros((width, width))
    for line in lines:
        out[line["i"]] = line["line"]
    return (out + out.T) / 2


def factor(g: np.ndarray, n: int, first: bool) -> np.ndarray:
    """The upper Cholesky factor of a Gram matrix of n rows, shifted in the
    first pass and wherever it does not exist otherwise."""
    d = len(g)
    shift = 11 * (min(n, ROWS) * d + d * (d + 1)) * 2.0**-53 * np.trace(g)
    if not first:
        try:
            r = np.linalg.cholesky(g).T
            if r.diagonal().min() ** 2 > shift:
                return r
        except np.linalg.LinAlgError:
            pass
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 100


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """rows: distinct x, all of one length. None if there are none."""
    totals = {r["i"]: int(r["total"]) for r in rows.mapInArrow(_sums, "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("total")).collect()}
    if not totals:
        return None
    n, sums = totals[-1], [totals[i] for i in range(len(totals) - 1)]
    d = len(sums)
    factors: list[np.ndarray] = []

    def orthogonal(x: np.ndarray) -> np.ndarray:
        q = centred(x, n, sums)
        for r in factors:
            q = solved(q, r)
        return q

    left = gram(rows, d, orthogonal)
    if not left.any():  # no variance at all
        k = min(components, d)
        return Whitening(n, sums, np.eye(d)[:, :k], np.zeros(k), 0.0, 0.0)
    before = None
    for p in range(PASSES):
        factors.append(factor(left, n, p == 0))
        left = gram(rows, d, orthogonal)
        if np.abs(left - np.eye(d)).max() < 1e-13 or (before is not None and np.abs(left - before).max() < 1e-13):
            break
        before = left
    r = np.eye(d)
    for f in factors:
        r = f @ r
    values, vectors = np.linalg.eigh(left)
    r = (np.sqrt(np.maximum(values, 0))[:, None] * vectors.T) @ r
    _, sigma, turned = np.linalg.svd(r)
    sigma = np.where(sigma > RANK * sigma[0], sigma, 0.0)
    k = min(components, d)
    shown = turned[:k].T
    shown = shown * np.where(shown[np.abs(shown).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    model = Whitening(n, sums, shown, sigma[:k] ** 2 / n, float((sigma**2).sum() / n), 0.0)
    some = np.flatnonzero(model.eigenvalues)
    weights = model.components[:, some] / np.sqrt(model.eigenvalues[some])

    def checked(x: np.ndarray) -> np.ndarray:
        return np.column_stack((centred(x, n, sums) @ weights, np.ones(len(x))))

    seen = gram(rows, len(some) + 1, checked) / n
    mean = seen[:-1, -1]
    model.identity_error = float(np.abs(seen[:-1, :-1] - np.outer(mean, mean) - np.eye(len(some))).max())
    return model


def _applied(model: Whitening):
    n, k = model.n, len(model.eigenvalues)
    some = model.eigenvalues > 0
    weights = model.components / np.sqrt(np.where(some, model.eigenvalues, 1.0))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in gathered(frames, ROWS):
            x = matrix(frame)
            y = scaled(x, n, model.sums)
            if int(np.abs(y).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
                deviation = (y.astype(np.int64) ** 2).sum(axis=1).tolist()
            else:
                deviation = [s if (s := sum(int(v) ** 2 for v in row)) < 1 << 63 else None for row in y.tolist()]
            w = (y.astype(np.float64) / n) @ weights
            shown = pa.array(w.ravel(), mask=np.tile(~some, len(w)))
            whitened = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * k), shown)
            yield pa.RecordBatch.from_arrays([frame.column("vec_id"), pa.array(deviation, pa.int64()), whitened], names=["vec_id", "deviation", "whitened"])

    return run


def whitened(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[Whitening | None, DataFrame]:
    """The fitted model, and vec_id, deviation and the array whitened of every
    vector that takes part."""
    spark = vectors.sparkSession
    ready(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    rows = saved(rows.mapInArrow(_gridded(scale, offset), "vec_id long, dim int, x array<long>"), "grid")
    common = rows.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    rows = rows.where(F.col("dim") == (common["dim"] if common else 0))
    model = fit(saved(rows.select("x").distinct(), "grid-fit"), components)
    if model is None:
        return None, spark.createDataFrame([], "vec_id long, deviation long, whitened array<double>")
    return model, rows.select("vec_id", "x").mapInArrow(_applied(model), "vec_id long, deviation long, whitened array<double>")


def component_rows(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: vec_id, component (from 1), n,
    deviation, whitened, explained, identity_error."""
    model, rows = whitened(vectors, components)
    explained = [float(e / model.trace) if model.trace else 0.0 for e in model.eigenvalues] if model else []
    share = F.array(*map(F.lit, explained)).cast("array<double>")
    rows = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
