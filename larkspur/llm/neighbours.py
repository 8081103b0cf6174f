"""Nearest neighbours by largest inner product, with an inverted multi-index.

Each half of the vectors is quantised by centroids of its own (k-means on at
most ``SAMPLE_ROWS`` vectors); a pair of centroids is a cell, and every vector
lies in one. A query scores the centroids of each half by their inner product
with its own half - the distance is the negative of it - and traverses pairs of
centroids by the sum of both with a heap, until the cells that it has met hold
enough vectors. Their vectors are reranked by inner product in double precision.

How many vectors are enough is measured: for ``PROBES`` queries the true
neighbours are found by comparing with every row, and the number is the least
with which the traversals meet a share of ``RECALL`` of them. Nothing else bounds
a cell, a candidate list or a query.

Equal vectors are one class. A class has at most k + 1 members in any result,
those of least id, so only these travel with it; queries that are equal are
searched once. Queries are sent in blocks of ``BLOCK_BYTES`` of vectors, a pass
over the index for each; a task keeps the best of each query of the block and
skips cells that none of them traverses. A cell is visited by all pairs whose
sum is not below the last that a traversal took, ties included.

Vectors that are null, empty, zero or hold null or non-finite components take no
part, nor do rows without an id. Only vectors of one length are compared. Repeated
rows (equal id and vector) are one; a query's own row is not its neighbour, but
another vector under the same id is a candidate like any other. Products that
overflow are infinite; those that are no number come last. An empty table
gives no rows. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import gathered, least_by_hash, ready, saved

NEIGHBOURS = 20
QUERY_EVERY = 20
#: Rows that the centroids are fitted on, at most.
SAMPLE_ROWS = 20_000
#: Centroids of a half, at most; fewer while a cell would hold under CELL_ROWS.
CENTROIDS = 256
CELL_ROWS = 64
ROUNDS = 12
#: Queries whose true neighbours set the length of a traversal, and the share
#: of these neighbours that traversals of that length meet.
PROBES = 128
RECALL = 0.97
#: Bytes of query vectors that are sent at once.
BLOCK_BYTES = 8 << 20
#: Rows of one product matrix.
ROWS = 2048
SEED = 11

PREPARED = "vec_id long, dim int, h1 long, h2 long, vec binary"
CELL = ["id", "dim", "cell", "ids", "vec"]
FOUND = "query long, score double, class long, cell int, ids array<long>"


def _prepared(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        vectors = frame.column("embedding")
        at = np.asarray(vectors.offsets, np.int64)
        flat = vectors.values.slice(at[0], at[-1] - at[0])
        at, null = at - at[0], flat.is_null().to_numpy(zero_copy_only=False)
        value = flat.fill_null(0.0).to_numpy().astype(np.float64) + 0.0  # minus zero is zero
        bad = null | ~np.isfinite(value)
        total = lambda x: (s := np.concatenate(([0], np.cumsum(x))))[at[1:]] - s[at[:-1]]
        valid = vectors.is_valid().to_numpy(zero_copy_only=False) & frame.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
        good = np.flatnonzero((total(bad) == 0) & (total(value != 0) > 0) & valid)
        raw = [value[at[k] : at[k + 1]].tobytes() for k in good]
        digest = np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=16).digest() for x in raw), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([frame.column("vec_id").take(pa.array(good)), pa.array(np.diff(at)[good].astype(np.int32)), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(raw, pa.binary())], names=["vec_id", "dim", "h1", "h2", "vec"])


def rows_of(raw: list[bytes]) -> np.ndarray:
    """Vectors of one length as a matrix."""
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)


def by_length(frame: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = frame.column("dim").to_numpy()
    for dim in np.unique(dims):
        yield int(dim), frame.take(pa.array(np.flatnonzero(dims == dim)))


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The number of each row's nearest centroid."""
    out = np.empty(len(x), np.int64)
    with np.errstate(all="ignore"):
        size = (centroids * centroids).sum(axis=1) / 2
        for lo in range(0, len(x), ROWS):
            out[lo : lo + ROWS] = np.argmin(size - x[lo : lo + ROWS] @ centroids.T, axis=1)
    return out


def centroids_of(x: np.ndarray, k: int) -> np.ndarray:
    """k-means of at most k centroids: some of the rows, moved to the means of
    their own rows a few times; one without rows stays where it is."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng([SEED, x.shape[1]])
    c = x[rng.permutation(len(x))[:k]].copy()
    with np.errstate(all="ignore"):
        for _ in range(ROUNDS if len(x) > len(c) else 0):
            own = nearest(x, c)
            n = np.bincount(own, minlength=len(c))
            total = np.zeros_like(c)
            np.add.at(total, own, x)
            c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


class MultiIndex:
    """Centroids of the two halves, by length of the vectors."""

    def __init__(self, sample: list[tuple[int, np.ndarray]], n: int, most: int = CENTROIDS):
        self.halves: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for dim in sorted({d for d, _ in sample}):
            x = np.array([v for d, v in sample if d == dim])
            k = int(max(1, min(most, (n * len(x) / len(sample) / CELL_ROWS) ** 0.5)))
            self.halves[dim] = (centroids_of(x[:, : dim // 2], k), centroids_of(x[:, dim // 2 :], k))

    def of(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """A length that the sample lacks has one cell."""
        return self.halves.get(dim) or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))

    def cells(self, x: np.ndarray) -> np.ndarray:
        left, right = self.of(x.shape[1])
        half = x.shape[1] // 2
        return nearest(x[:, :half], left) * len(right) + nearest(x[:, half:], right)

    def scores(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each query: the inner products with the centroids of its halves."""
        left, right = self.of(q.shape[1])
        half = q.shape[1] // 2
        with np.errstate(all="ignore"):
            return tuple(np.nan_to_num(a @ c.T, nan=-np.inf) for a, c in ((q[:, :half], left), (q[:, half:], right)))


def traversal(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All pairs of the two score lists by falling sum: (sum, i, j). The heap
    holds at most one pair of each i: the next one of its row."""
    rows, cols = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    a, b = left[rows].tolist(), right[cols].tolist()
    rows, cols = rows.tolist(), cols.tolist()
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        low, i, j = heapq.heappop(heap)
        yield -low, rows[i], cols[j]
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))


def _assigned(index: MultiIndex):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in gathered(frames, ROWS):
            for _, part in by_length(frame):
                cell = index.cells(rows_of(part.column("vec").to_pylist()))
                yield part.append_column("cell", pa.array(cell.astype(np.int32)))

    return run


def _stops(index: MultiIndex, sizes: dict[int, np.ndarray], enough: dict[int, int]):
    """The sum of the last pair that each query's traversal takes."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in gathered(frames, ROWS):
            for dim, part in by_length(frame):
                size, width = sizes[dim].tolist(), len(index.of(dim)[1])
                stops = []
                for left, right in zip(*index.scores(rows_of(part.column("vec").to_pylist())), strict=True):
                    met, stop = 0, -np.inf
                    for total, i, j in traversal(left, right):
                        met, stop = met + size[i * width + j], total
                        if met >= enough[dim]:
                            break
                    stops.append(stop)
                yield part.append_column("stop", pa.array(stops, pa.float64()))

    return run


class Best:
    """The k best classes of each query so far: by score, then by least id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.least = np.full((n, k), np.iinfo(np.int64).max)
        self.at = np.full((n, k), -1)
        self.items: list[tuple] = []

    def add(self, base: int, score: np.ndarray, items: list[tuple]) -> None:
        """A line of score for each query from number ``base`` on, a column for
        each item, (class, cell, ids); not a number where they did not meet."""
        k, n = self.k, len(score)
        bar = self.score[base : base + n, -1]
        if score.shape[1] > k:
            bar = np.fmax(bar, -np.partition(-score, k - 1, axis=1)[:, k - 1])
        q, c = np.nonzero(score >= bar[:, None])
        if not len(q):
            return
        used, where = np.unique(c, return_inverse=True)
        first = np.array([items[u][2][0] for u in used.tolist()], np.int64)
        touched = np.unique(q)
        old = base + touched
        row = np.concatenate((np.repeat(touched, k), q))
        both = np.concatenate((self.score[old].ravel(), score[q, c]))
        least = np.concatenate((self.least[old].ravel(), first[where]))
        at = np.concatenate((self.at[old].ravel(), len(self.items) + where))
        order = np.lexsort((least, -both, row))
        size = np.bincount(row, minlength=n)[touched]
        begin = np.concatenate(([0], np.cumsum(size)))[:-1]
        pick = order[(begin[:, None] + np.arange(k)).ravel()]
        self.score[old], self.least[old], self.at[old] = (x[pick].reshape(-1, k) for x in (both, least, at))
        self.items += [items[u] for u in used.tolist()]
        if len(self.items) > 2 * self.at.size + ROWS:
            self._forget()

    def _forget(self) -> None:
        """Leave out the items that no query holds any more."""
        used, back = np.unique(self.at, return_inverse=True)
        none = int(used[0] < 0)
        self.items = [self.items[k] for k in used[none:].tolist()]
        self.at = back.reshape(self.at.shape) - none

    def rows(self) -> Iterator[tuple]:
        for q, c in zip(*(x.tolist() for x in np.nonzero(self.at >= 0)), strict=True):
            yield q, float(self.score[q, c]), *self.items[self.at[q, c]]


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.nan_to_num(q @ x.T, nan=-np.inf, posinf=np.inf, neginf=-np.inf)


def _reranked(queries: list[tuple], index: MultiIndex | None, k: int):
    """queries: (id, dim, vec, stop). Of each task, the k best classes of each
    query among the cells that its traversal took; without an index among all."""
    lengths = {}
    for dim in sorted({q[1] for q in queries}):
        mine = [q for q in queries if q[1] == dim]
        lengths[dim] = (np.array([q[0] for q in mine], np.int64), rows_of([bytes(q[2]) for q in mine]), np.array([q[3] for q in mine]))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dim: Best(len(q[0]), k) for dim, q in lengths.items()}
        scores = {dim: index.scores(q[1]) for dim, q in lengths.items()} if index else {}
        for frame in gathered(frames, ROWS):
            for dim, part in by_length(frame):
                if dim not in lengths:
                    continue
                _, q, stop = lengths[dim]
                x, cell = rows_of(part.column("vec").to_pylist()), part.column("cell").to_numpy()
                items = list(zip(part.column("id").to_pylist(), cell.tolist(), part.column("ids").to_pylist(), strict=True))
                for lo in range(0, len(q), ROWS):
                    hi = min(lo + ROWS, len(q))
                    if index is None:
                        best[dim].add(lo, products(x, q[lo:hi]), items)
                        continue
                    left, right = (s[lo:hi] for s in scores[dim])
                    score = np.full((hi - lo, len(x)), np.nan)
                    for c in np.unique(cell):
                        i, j = divmod(int(c), right.shape[1])
                        which = np.flatnonzero(left[:, i] + right[:, j] >= stop[lo:hi])
                        own = np.flatnonzero(cell == c)
                        if len(which):
                            score[np.ix_(which, own)] = products(x[own], q[lo:hi][which])
                    best[dim].add(lo, score, items)
        found = [(int(lengths[dim][0][r[0]]), *r[1:]) for dim, b in best.items() for r in b.rows()]
        kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
        for lo in range(0, len(found), 10 * ROWS):
            step = found[lo : lo + 10 * ROWS]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in step], kind) for c, kind in enumerate(kinds)], names=["query", "score", "class", "cell", "ids"])

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query: query, place, vec_id, score, class, cell."""
    rows = found.select("query", "score", "class", "cell", F.explode("ids").alias("vec_id"))
    by = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "class")
    return rows.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k).select("query", "place", "vec_id", "score", "class", "cell")


def traversal_lengths(index: MultiIndex, sizes: dict[int, np.ndarray], cells: DataFrame, probes: list, k: int, recall: float) -> dict[int, int]:
    """Of each vector length, how many vectors a traversal must meet so that
    traversals of the probes meet that share of their true neighbours."""
    enough = {dim: int(s.sum()) for dim, s in sizes.items()}
    if not probes:
        return enough
    near = cells.select(*CELL).mapInArrow(_reranked([(r["id"], r["dim"], r["vec"], 0.0) for r in probes], None, k), FOUND)
    truth: dict[int, list[int]] = {}
    for r in _first(near, k).where("class != query").select("query", "cell").collect():
        truth.setdefault(r["query"], []).append(r["cell"])
    needed: dict[int, list[int]] = {}
    for probe in probes:
        left, right = index.scores(rows_of([bytes(probe["vec"])]))
        width, size = right.shape[1], sizes[probe["dim"]]
        cost, met = {}, 0
        for _, i, j in traversal(left[0], right[0]):
            met += int(size[i * width + j])
            cost[i * width + j] = met
        needed.setdefault(probe["dim"], []).extend(cost[c] for c in truth.get(probe["id"], []))
    for dim, costs in needed.items():
        if costs:
            enough[dim] = sorted(costs)[int(np.ceil(recall * len(costs))) - 1]
    return enough


def search(vectors: DataFrame, k: int = NEIGHBOURS, every: int = QUERY_EVERY, recall: float = RECALL, block_bytes: int = BLOCK_BYTES, most_centroids: int = CENTROIDS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each row
    whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    ready(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    rows = saved(rows.mapInArrow(_prepared, PREPARED), "nn-vectors")
    same = ["dim", "h1", "h2"]
    narrow = rows.select(*same, "vec_id").distinct()
    asked = F.col("vec_id") % every == 0
    # by the window's own limit, tasks send at most k + 1 ids of a vector
    low = narrow.withColumn("place", F.row_number().over(Window.partitionBy(*same).orderBy("vec_id"))).where(F.col("place") <= k + 1)
    ids = low.groupBy(*same).agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    one = rows.groupBy(*same).agg(F.max(asked).alias("asked"), F.first("vec").alias("vec"))
    classes = one.join(ids, same).select(F.monotonically_increasing_id().alias("id"), *same, "asked", "ids", "vec")
    classes = saved(classes, "nn-classes")

    n = classes.count()
    sample = least_by_hash(classes.select(F.xxhash64("h1", "h2").alias("doc_id"), "dim", "vec"), SAMPLE_ROWS, "multi-index")
    index = MultiIndex([(r["dim"], np.frombuffer(r["vec"], np.float64)) for r in sample], n, most_centroids)
    cells = classes.select("id", "dim", "asked", "ids", "vec").mapInArrow(_assigned(index), "id long, dim int, asked boolean, ids array<long>, vec binary, cell int")
    cells = saved(cells.repartitionByRange("dim", "cell", "id").sortWithinPartitions("dim", "cell"), "nn-cells")
    sizes: dict[int, np.ndarray] = {}
    for r in cells.groupBy("dim", "cell").agg(F.count("*").alias("n")).collect():
        if r["dim"] not in sizes:
            left, right = index.of(r["dim"])
            sizes[r["dim"]] = np.zeros(len(left) * len(right), np.int64)
        sizes[r["dim"]][r["cell"]] = r["n"]
    queries = cells.where("asked").select("id", "dim", "vec")
    probes = least_by_hash(classes.where("asked").select(F.xxhash64("h1", "h2", F.lit(1)).alias("doc_id"), "id", "dim", "vec"), PROBES, "probes")
    enough = traversal_lengths(index, sizes, cells, probes, k + 1, recall)

    total = queries.agg(F.sum(F.length("vec")).alias("n")).first()["n"] or 0
    blocks = -(-total // block_bytes)
    stops = queries.mapInArrow(_stops(index, sizes, enough), "id long, dim int, vec binary, stop double")
    stops = saved(stops.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(blocks, 1))).cast("int")), "nn-queries")
    found = spark.createDataFrame([], "query long, place int, vec_id long, score double, class long, cell int")
    for b in range(blocks):
        block = [tuple(r) for r in stops.where(F.col("block") == b).select("id", "dim", "vec", "stop").collect()]
        if block:
            found = found.union(saved(_first(cells.select(*CELL).mapInArrow(_reranked(block, index, k + 1), FOUND), k + 1), "nn-found"))
    lists = found.groupBy(F.col("query").alias("id")).agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "class"))).alias("near"))
    lists = lists.join(classes.select("id", *same), "id")
    own = narrow.where(asked).withColumnRenamed("vec_id", "query_id").join(lists, same)
    others = F.filter("near", lambda x: (x["vec_id"] != F.col("query_id")) | (x["class"] != F.col("id")))
    near = own.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "x"))
    return near.select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score")
