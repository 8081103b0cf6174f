"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are lower-cased (A-Z) and cut into words; a pattern is a window of ten
consecutive words of a benchmark item (a shorter item is one window), its
words joined by one space. Patterns are grouped by length class. Each group
has a shift table over hashed blocks of B bytes: a block that no pattern has
near its end lets the search jump ahead; a shift of zero looks up the hash of
the pattern's first and last bytes (the suffix bucket) and the strings there
are compared byte by byte. Many stretches of the text are searched in step, as
numpy lanes.

The search is a narrow step over the documents: no shuffle. Items come in
blocks of at most ``BLOCK_BYTES`` of text, which bounds what is sent to each
task; with several blocks, the documents found so far are written between the
passes, so any number of items works.

Null and empty texts have no words. Documents and items without words match
nothing. Items without item_id mark words and contaminate like any other; all of
them together count as one item, which has no place in items_sha256. Repeated
documents each give a row; repeated windows count for every
item that has them. Only the id and text columns are read, so other columns,
whatever their names, do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import batches, mix64, ready, runs_of, saved, texts_of, words64

WINDOW = 10
#: Bytes of benchmark text that are sent to the tasks at once.
BLOCK_BYTES = 8 << 20
#: Bytes of text that one lane of the search covers.
LANE = 512
TABLE_BITS = 22
SPACE, BREAK = 32, 10


def _lut() -> np.ndarray:
    """Byte to lower-cased byte; what is not in a word becomes a space."""
    lut = np.arange(256, dtype=np.uint8)
    lut[0x41:0x5B] += 32
    lut[:0x30] = SPACE
    lut[0x3A:0x41] = SPACE
    lut[0x5B:0x61] = SPACE
    lut[0x7B:0x80] = SPACE
    return lut


LUT = _lut()


def normalise(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All documents' words joined by one space, a BREAK before each document
    and at the end; where each word starts; words up to each document."""
    n = len(at) - 1
    size = np.diff(at)
    joined = np.full(len(data) + n + 1, BREAK, np.uint8)
    if len(data):
        joined[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), size)] = LUT[data]
    word = joined > SPACE
    is_break = np.zeros(len(joined), bool)
    is_break[at + np.arange(n + 1)] = True
    after = np.concatenate((word[1:], [False]))
    keep = word | is_break | (after & ~word)
    text = joined[keep]
    word, is_break = word[keep], is_break[keep]
    starts = np.flatnonzero(word & ~np.concatenate(([False], word[:-1])))
    breaks = np.flatnonzero(is_break)
    return text, starts, np.searchsorted(starts, breaks)


def _none_last(item: int | None) -> tuple[bool, int]:
    return item is None, item or 0


class Patterns:
    """Distinct byte strings and the numbers of the items that have each."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW):
        found: dict[bytes, set[int]] = {}
        for item, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            words = LUT[raw].tobytes().split()
            for k in range(max(len(words) - window, 0) + 1) if words else ():
                found.setdefault(b" ".join(words[k : k + window]), set()).add(item)
        self.strings = sorted(found, key=lambda x: (len(x), x))
        self.words = np.array([x.count(b" ") + 1 for x in self.strings], np.int64)
        self.items = [sorted(found[x], key=_none_last) for x in self.strings]
        self.groups = []
        lens = np.array([len(x) for x in self.strings], np.int64)
        edges = [1, 2, 4, 8, 16, 32, 48, 64, 96, 1 << 62]
        for lo, hi in zip(edges, edges[1:], strict=False):
            ids = np.flatnonzero((lens >= lo) & (lens < hi))
            if len(ids):
                self.groups.append(Group(ids, [self.strings[i] for i in ids]))


class Group:
    """Shift table and suffix buckets of strings of one length class."""

    def __init__(self, ids: np.ndarray, strings: list[bytes]):
        self.m = min(map(len, strings))
        self.block = min(8, max(1, self.m // 2))
        size = [len(x) for x in strings]
        self.size = np.array(size, np.int64)
        self.raw = np.frombuffer(b"".join(strings) + bytes(8), np.uint8)
        self.at = np.cumsum([0, *size])[:-1]
        view = words64(self.raw)
        last = self.m - self.block
        self.shift = np.full(1 << TABLE_BITS, min(last + 1, 255), np.uint8)
        for j in range(last + 1):
            np.minimum.at(self.shift, self.hash(view[self.at + j]), np.uint8(min(last - j, 255)))
        key = self.key(view, self.at)
        order = np.argsort(key, kind="stable")
        self.keys, self.ids, self.at, self.size = key[order], ids[order], self.at[order], self.size[order]

    def hash(self, x: np.ndarray) -> np.ndarray:
        mask = np.uint64((1 << 8 * self.block) - 1)
        return ((x & mask) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)

    def key(self, view: np.ndarray, at: np.ndarray) -> np.ndarray:
        mask = np.uint64((1 << 8 * min(self.m, 8)) - 1)
        return mix64((view[at] & mask) * np.uint64(0xC2B2AE3D27D4EB4F) + (view[at + self.m - min(self.m, 8)] & mask))

    def search(self, text: np.ndarray, view: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and string numbers of all occurrences as whole words in
        the first n bytes."""
        last = self.m - self.block
        p = np.arange(0, max(n - self.m + 1, 0), LANE, dtype=np.int64)
        end = np.minimum(p + LANE, n - self.m + 1)
        found = []
        while len(p):
            shift = self.shift[self.hash(view[p + last])]
            hit = shift == 0
            found.append(p[hit])
            p = p + np.maximum(shift, 1)
            live = p < end
            if not live.all():
                p, end = p[live], end[live]
        pos = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        pos = pos[(text[pos - 1] <= SPACE) & (pos > 0)]
        key = self.key(view, pos)
        lo, hi = np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, side="right")
        most = int((hi - lo).max()) if len(pos) else 0
        out = []
        own = words64(self.raw)
        for r in range(most):
            live = np.flatnonzero(lo + r < hi)
            s, at = lo[live] + r, pos[live]
            ok = at + self.size[s] < n
            s, at = s[ok], at[ok]
            ok = text[at + self.size[s]] <= SPACE
            s, at = s[ok], at[ok]
            k = 0
            same, left = np.ones(len(s), bool), np.arange(len(s))
            while len(left):
                rest = self.size[s[left]] - k
                left, rest = left[rest > 0], rest[rest > 0]
                if not len(left):
                    break
                mask = np.where(rest >= 8, np.uint64((1 << 64) - 1), (np.uint64(1) << (np.uint64(8) * np.minimum(rest, 7).astype(np.uint64))) - np.uint64(1))
                equal = ((view[at[left] + k] ^ own[self.at[s[left]] + k]) & mask) == 0
                same[left[~equal]] = False
                left = left[equal]
                k += 8
            out.append((at[same], self.ids[s[same]]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


STATE = "doc_id long, text string, n_words long, runs array<long>, items array<long>"


def _scan(patterns, first: bool):
    """Adds the hit word runs (start, end, start, end, ...) and items of one
    block of the benchmark."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = patterns.value
        for frame in frames:
            for rows, data, at in batches(frame):
                text, word_at, upto = normalise(data, at)
                n_docs = len(at) - 1
                n_words = np.diff(upto)
                n = len(text)
                text = np.concatenate((text, np.zeros(16, np.uint8)))
                view = words64(text)
                hits = [g.search(text, view, n) for g in found.groups]
                pos = np.concatenate([h[0] for h in hits]) if hits else np.zeros(0, np.int64)
                which = np.concatenate([h[1] for h in hits]) if hits else np.zeros(0, np.int64)
                word = np.searchsorted(word_at, pos)
                doc = np.searchsorted(upto, word, side="right") - 1
                old = [[], []] if first else [rows.column("runs").to_pylist(), rows.column("items").to_pylist()]
                runs = [list(x or ()) for x in old[0]] or [[] for _ in range(n_docs)]
                items = [set(x or ()) for x in old[1]] or [set() for _ in range(n_docs)]
                order = np.argsort(doc, kind="stable")
                doc, word, which = doc[order], word[order], which[order]
                cut = np.flatnonzero(np.diff(doc)) + 1
                for a, b in zip([0, *cut], [*cut, len(doc)], strict=True) if len(doc) else ():
                    d = int(doc[a])
                    w = word[a:b] - upto[d]
                    marks = np.zeros(int(n_words[d]) + 1, np.int32)
                    np.add.at(marks, w, 1)
                    np.add.at(marks, w + found.words[which[a:b]], -1)
                    flags = np.cumsum(marks)[:-1] > 0
                    for x, y in zip(runs[d][::2], runs[d][1::2], strict=True):
                        flags[x:y] = True
                    runs[d] = np.stack(runs_of(flags), axis=1).ravel().tolist()
                    for k in np.unique(which[a:b]).tolist():
                        items[d].update(found.items[k])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("text"), pa.array(n_words), pa.array(runs, pa.list_(pa.int64())), pa.array([sorted(x, key=_none_last) for x in items], pa.list_(pa.int64()))],
                    names=["doc_id", "text", "n_words", "runs", "items"],
                )

    return run


def _blocks(items: DataFrame, size: int) -> Iterator[list[tuple[int | None, str]]]:
    """Items in blocks of at most ``size`` bytes (one item
    at least); only one block at a time is on the driver."""
    block, held = [], 0
    for item, text in items.toLocalIterator():
        if block and held + len(text) > size:
            yield block
            block, held = [], 0
        block.append((item, text))
        held += len(text)
    yield block


def occurrences(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, text, n_words, runs (hit word intervals,
    flat), items (ids of the items with windows in the document)."""
    spark = docs.sparkSession
    state = texts_of(docs, id_col, text_col)
    wanted = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    for k, block in enumerate(_blocks(wanted, block_bytes)):
        if k:
            state = saved(state, "decontaminate")
        state = state.mapInArrow(_scan(spark.sparkContext.broadcast(Patterns(block, window)), first=not k), STATE)
    return state


def decontamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""

    def digest(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            runs, items_ = frame.column("runs").to_pylist(), frame.column("items").to_pylist()
            hit = [sum(x[1::2]) - sum(x[::2]) for x in runs]
            sha = [hashlib.sha256(",".join(sorted(str(i) for i in x if i is not None)).encode()).hexdigest() for x in items_]
            yield pa.RecordBatch.from_arrays(
                [frame.column("doc_id"), frame.column("n_words"), pa.array(hit, pa.int64()), pa.array(list(map(len, items_)), pa.int64()), pa.array(sha, pa.string()), pa.array([x > 0 for x in hit], pa.bool_())],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    found = occurrences(docs, items, **options).drop("text")
    return found.mapInArrow(digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their
    own columns; the search runs on each row, so nothing is shuffled."""
    spark = docs.sparkSession
    ready(spark)
    wanted = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    state = docs
    for k, block in enumerate(_blocks(wanted, BLOCK_BYTES)):
        if k:
            state = saved(state, "decontaminate")
        state = state.mapInArrow(_drop_hits(spark.sparkContext.broadcast(Patterns(block))), docs.schema)
    return state


def _drop_hits(patterns):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = patterns.value
        for frame in frames:
            for rows, data, at in batches(frame):
                text, word_at, upto = normalise(data, at)
                n = len(text)
                text = np.concatenate((text, np.zeros(16, np.uint8)))
                view = words64(text)
                keep = np.ones(len(at) - 1, bool)
                for g in found.groups:
                    pos, _ = g.search(text, view, n)
                    keep[np.searchsorted(upto, np.searchsorted(word_at, pos), side="right") - 1] = False
                yield rows.filter(pa.array(keep))

    return run
