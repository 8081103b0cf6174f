"""Texts cut into the pieces that byte-level BPE encodes one by one, and a
bounded store from piece to token ids.

The cut follows the pattern of the public vocabularies (contractions, runs of
letters, of numbers and of other characters with one space before them, white
space), found on whole batches with character classes instead of a regular
expression for each text. Distinct pieces are encoded once and kept by a 64-bit
hash; a caller that decodes the ids sees a collision as different bytes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex

from larkspur.llm.common import code_points, mix64, spread, words64

#: Distinct pieces that a task keeps; beyond them it starts anew.
KEPT = 800_000
WHITE, LETTER, NUMBER, OTHER = range(4)
APOSTROPHE = ord("'")


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point, as the regex library has it."""
    if public_tokenizers.PATTERN != r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""":
        raise ValueError("pieces are cut for another pattern")
    out = np.full(0x110000, OTHER, np.uint8)
    for lo, chars in code_points():
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
            for m in regex.finditer(pattern, chars):
                out[lo + m.start() : lo + m.end()] = kind
    return out


def cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, the byte offset where each piece starts
    (and the end), and the number of pieces up to each text (and the end)."""
    joined = "".join(texts)
    data = np.frombuffer(joined.encode(), np.uint8)
    point = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    n = len(point)
    doc = np.cumsum([0, *map(len, texts)])
    kind = classes()[point]
    new = np.empty(n + 1, bool)
    new[0] = new[n] = True
    new[1:n] = kind[1:] != kind[:-1]
    new[doc] = True
    edge = np.zeros(n + 1, bool)
    edge[doc] = True
    start = new.copy()
    last = np.flatnonzero((kind == WHITE) & new[1:] & ~edge[1:])  # the last of a white run before something else
    start[last] = True
    start[last[point[last] == 32] + 1] = False
    quote = np.flatnonzero((point == APOSTROPHE) & start[:n])
    quote = quote[quote + 1 < n]
    quote = quote[new[quote + 1] & ~edge[quote + 1] & (kind[quote + 1] == LETTER)]
    if len(quote):
        a = point[quote + 1]
        two = np.minimum(quote + 2, n - 1)
        b = np.where((quote + 2 < n) & ~new[quote + 2], point[two], 0)
        pair = lambda x, y: (a == ord(x)) & (b == ord(y))
        one = np.isin(a, [ord(x) for x in "stmd"])
        both = pair("r", "e") | pair("v", "e") | pair("l", "l")
        for size, q in ((2, quote[one]), (3, quote[both])):
            start[q + 1] = False
            rest = q + size
            start[rest[~new[rest]]] = True
    size = 1 + (point >= 0x80).view(np.uint8) + (point >= 0x800).view(np.uint8) + (point >= 0x10000).view(np.uint8)
    at = np.zeros(n + 1, np.int64)
    np.cumsum(size, out=at[1:])
    pieces = np.flatnonzero(start[:n])
    return data, np.append(at[pieces], len(data)), np.searchsorted(pieces, doc)


_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece."""
    view = words64(np.concatenate((data, np.zeros(8, np.uint8))))
    start, size = at[:-1], np.diff(at)
    out = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    left, k = np.arange(len(size)), 0
    while len(left):
        rest = size[left] - k
        word = view[start[left] + k] & _MASK[np.minimum(rest, 8)]
        out[left] = mix64(out[left] ^ word)
        left = left[rest > 8]
        k += 8
    return out


class Grown:
    """An array that is appended to; room is doubled when it runs out."""

    def __init__(self, kind: type):
        self.room, self.size = np.empty(1 << 16, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.size + len(more) > len(self.room):
            room = np.empty(2 * (self.size + len(more)), self.room.dtype)
            room[: self.size] = self.room[: self.size]
            self.room = room
        self.room[self.size : self.size + len(more)] = more
        self.size += len(more)

    def all(self) -> np.ndarray:
        return self.room[: self.size]


class Store:
    """Token ids of distinct pieces. encode: ids of each of some pieces."""

    def __init__(self, encode: Callable[[list[bytes]], list[np.ndarray]], kept: int = KEPT):
        self.encode, self.kept = encode, kept
        self.bits = max(16, kept.bit_length() + 1)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.slot = np.zeros(0, np.int32)
        self.at, self.size, self.pool = Grown(np.int64), Grown(np.int32), Grown(np.int32)
        self.near_key = np.zeros(1 << self.bits, np.uint64)  # direct-mapped, before the sorted keys
        self.near_slot = np.full(1 << self.bits, -1, np.int32)

    def _near(self, key: np.ndarray) -> np.ndarray:
        return (key >> np.uint64(64 - self.bits)).astype(np.int64)

    def _add(self, pieces: list[bytes]) -> np.ndarray:
        new = self.encode(pieces)
        size = np.fromiter(map(len, new), np.int64, len(new))
        slots = self.size.size + np.arange(len(new), dtype=np.int32)
        self.at.add(self.pool.size + np.cumsum(size) - size)
        self.size.add(size)
        self.pool.add(np.concatenate(new))
        return slots

    def ids(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each piece."""
        key = hashes(data, at)
        if len(self.keys) > self.kept:
            self.clear()
        near = self._near(key)
        slot = np.where(self.near_key[near] == key, self.near_slot[near], -1)
        miss = np.flatnonzero(slot < 0)
        if len(miss):
            some, first, back = np.unique(key[miss], return_index=True, return_inverse=True)
            place = np.searchsorted(self.keys, some)
            known = np.zeros(len(some), bool)
            got = np.empty(len(some), np.int32)
            if len(self.keys):
                inside = np.minimum(place, len(self.keys) - 1)
                known = self.keys[inside] == some
                got[known] = self.slot[inside[known]]
            fresh = np.flatnonzero(~known)
            if len(fresh):
                which = miss[first[fresh]]
                got[fresh] = self._add([data[a:b].tobytes() for a, b in zip(at[which].tolist(), at[which + 1].tolist(), strict=True)])
                self.keys, self.slot = np.insert(self.keys, place[fresh], some[fresh]), np.insert(self.slot, place[fresh], got[fresh])
                here = self._near(some[fresh])
                free = np.flatnonzero(self.near_slot[here] < 0)
                _, one = np.unique(here[free], return_index=True)  # of fresh keys for one place, one
                free = free[one]
                self.near_key[here[free]], self.near_slot[here[free]] = some[fresh[free]], got[fresh[free]]
            slot[miss] = got[back]
        size = self.size.all()[slot].astype(np.int64)
        return self.pool.all()[spread(self.at.all()[slot], size)], size
