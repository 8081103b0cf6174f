"""Byte-level BPE encoding and decoding with padded numpy matrices.

Distinct pieces of a batch are laid out by length class as rows of a padded
matrix. In each round every row merges its leftmost pair of least rank; ranks
come from a hashed pair table, and the merged column is compacted away. Pieces
beyond ``LONG`` bytes merge in the same order with a heap and linked
neighbours, since a round there would move the whole row.

Both steps are narrow: one pass over the documents, no shuffle. Null and empty
texts have no ids. Repeated documents each give a row. Only the id and text
columns are read; other columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from larkspur.llm.common import batches, ready, spread, strings_of, texts_of
from larkspur.llm.pieces import Store, cut

RANKS = "byte_bpe_50k.tiktoken"
#: Bytes beyond which a piece leaves the matrices.
LONG = 256
#: Cells of one matrix; a lookup of pairs takes about 80 bytes for each.
CELLS = 1 << 17
#: Bytes of text of one step: a step takes about a hundred times as much memory.
STEP = 1 << 18
#: Distinct pieces that a worker keeps.
KEPT = 400_000
NONE = np.int32(2**31 - 1)


class Pairs:
    """Open-addressed hash table from a pair of ids to the merged id, which is
    also its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, out = [], [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None:
                    left.append(a), right.append(b), out.append(rank)
        key = np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64)
        self.bits = max(4, int(np.ceil(np.log2(4 * len(key) + 1))))
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.out = np.full(1 << self.bits, NONE, np.int32)
        value, place = np.array(out, np.int32), self._place(key)
        left_ = np.arange(len(key))
        while len(left_):  # each free place takes one key, the others move on
            free = self.keys[place[left_]] == np.uint64(2**64 - 1)
            self.keys[place[left_[free]]] = key[left_[free]]
            own = self.keys[place[left_]] == key[left_]
            self.out[place[left_[own]]] = value[left_[own]]
            left_ = left_[~own]
            place[left_] = (place[left_] + 1) & ((1 << self.bits) - 1)
        self.probes = 1
        self.probes = max((k for k in range(1, 64) if not self._found(key, k)), default=0) + 1

    def _place(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _found(self, key: np.ndarray, probes: int) -> bool:
        self.probes = probes
        return bool((self.get(key >> np.uint64(32), key & np.uint64(2**32 - 1)) != NONE).all())

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """NONE for a pair that doesn't merge or has padding (-1)."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        key = (a.astype(np.uint64) << np.uint64(32)) | (b.astype(np.uint64) & np.uint64(2**32 - 1))
        place = self._place(key)
        out = np.where(self.keys[place] == key, self.out[place], NONE)
        for k in range(1, self.probes):
            there = (place + k) & ((1 << self.bits) - 1)
            out = np.where(self.keys[there] == key, self.out[there], out)
        out[(a < 0) | (b < 0)] = NONE
        return out


class Bpe:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pairs = Pairs(ranks)
        self.byte = np.array([ranks[bytes([k])] for k in range(256)], np.int32)
        tokens = sorted((rank, token) for token, rank in ranks.items())
        size = np.zeros(tokens[-1][0] + 1, np.int64)
        size[[r for r, _ in tokens]] = [len(t) for _, t in tokens]
        self.size, self.at = size, np.cumsum(size) - size
        self.bytes = np.frombuffer(b"".join(t for _, t in tokens), np.uint8)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(pieces)
        rows: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if (rank := self.ranks.get(piece)) is not None:
                out[k] = np.array([rank], np.int32)
            elif len(piece) > LONG:
                out[k] = self.encode_long(piece)
            else:
                rows.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(k)
        for width, which in rows.items():
            step = max(1, CELLS // width)
            for lo in range(0, len(which), step):
                some = which[lo : lo + step]
                for k, ids in zip(some, self._matrix([pieces[k] for k in some], width), strict=True):
                    out[k] = ids
        return out

    def _matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < size[:, None]] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = self.pairs.get(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), width - 1)
        row = np.arange(len(pieces))
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        while len(row):
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), np.int64)
            least = rank[np.arange(len(row)), best] if rank.shape[1] else np.full(len(row), NONE)
            live = least != NONE
            for r, x in zip(row[~live].tolist(), ids[~live], strict=True):
                out[r] = x[x >= 0]
            row, ids, rank, best, least = row[live], ids[live], rank[live], best[live], least[live]
            if not len(row):
                break
            n, w = ids.shape
            here = np.arange(n)
            ids[here, best] = least
            keep = np.ones((n, w), bool)
            keep[here, best + 1] = False
            ids = ids[keep].reshape(n, w - 1)
            keep = np.ones((n, w - 1), bool)
            keep[here, best] = False
            rank = rank[keep].reshape(n, w - 2)
            before, after = np.flatnonzero(best > 0), np.flatnonzero(best < w - 2)
            rank[before, best[before] - 1] = self.pairs.get(ids[before, best[before] - 1], ids[before, best[before]])
            rank[after, best[after]] = self.pairs.get(ids[after, best[after]], ids[after, best[after] + 1])
        return out

    @lru_cache(1 << 16)  # noqa: B019
    def pair(self, a: int, b: int) -> int:
        return int(self.pairs.get(np.array([a]), np.array([b]))[0])

    def encode_long(self, piece: bytes) -> np.ndarray:
        """The same merges, least rank and then leftmost, with a heap."""
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := self.pair(ids[k], ids[k + 1])) != NONE]
        heapq.heapify(heap)
        while heap:
            r, k, a, b = heapq.heappop(heap)
            j = right[k]
            if ids[k] != a or j < 0 or ids[j] != b:
                continue
            ids[k], ids[j] = r, -1
            right[k] = right[j]
            if right[j] >= 0:
                left[right[j]] = k
            for x, y in ((left[k], k), (k, right[k])):
                if x >= 0 and y >= 0 and (r := self.pair(ids[x], ids[y])) != NONE:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and the number of bytes of each id."""
        size = self.size[ids]
        return self.bytes[spread(self.at[ids], size)], size


@lru_cache(2)
def load(path: str) -> Bpe:
    with open(path, "rb") as f:
        return Bpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


@lru_cache(2)
def store(path: str) -> Store:
    return Store(load(path).encode_pieces, KEPT)


def encode_batch(path: str, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All ids; where each text's ids start (and the end); the decoded bytes;
    where each text's bytes start (and the end)."""
    bpe, kept = load(path), store(path)
    data, at, upto = cut([x.decode() for x in texts])
    ids, size = kept.ids(data, at)
    raw, width = bpe.decode(ids)
    if len(raw) != len(data) or not np.array_equal(raw, data):  # two pieces of one hash: each piece on its own
        ids = bpe.encode_pieces([data[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        ids = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        raw, width = bpe.decode(ids)
    starts = np.concatenate(([0], np.cumsum(size)))[upto]
    return ids, starts, raw, np.concatenate(([0], np.cumsum(width)))[starts]


def encoded(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the ids of each whole text."""
    path = path or public_tokenizers.path(RANKS)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for rows, data, at in batches(frame, step=STEP):
                ids, starts, _, _ = encode_batch(path, strings_of(data, at))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the bytes of each row's ids (null: empty)."""
    ready(tokens.sparkSession)
    path = path or public_tokenizers.path(RANKS)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for frame in frames:
            ids = frame.column("ids").to_pylist()
            raw = [bpe.decode(np.array(x or [], np.int64))[0].tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), pa.array(raw, pa.binary())], names=["doc_id", "bytes"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each whole text,
    encoded and decoded in one pass so that the ids are not written between."""
    path = path or public_tokenizers.path(RANKS)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for rows, data, at in batches(frame, step=STEP):
                ids, starts, raw, ends = encode_batch(path, strings_of(data, at))
                ids, raw = ids.astype("<u4").tobytes(), raw.tobytes()
                s, e = (4 * starts).tolist(), ends.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(np.diff(starts), pa.int64()),
                        pa.array([hashlib.sha256(ids[a:b]).hexdigest() for a, b in zip(s, s[1:], strict=False)], pa.string()),
                        pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(e, e[1:], strict=False)], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
