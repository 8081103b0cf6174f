"""Language identification with interpolated Kneser-Ney character models.

Each language has a model of character n-grams up to ``ORDER`` over letters in
lower case, every other run of characters being one space. Counts come from a
bounded sample of labelled rows (``SAMPLE_ROWS`` a language, the rows least by
hash of their id), gathered by Spark as sums over n-gram hashes. A model keeps
sorted arrays: the hashes of its n-grams, and for each its interpolated
Kneser-Ney log probability; hashes of contexts, and for each its back-off
weight. A text takes the language of least cross-entropy per character. What
one character costs in the sample's held-back rows sets, for each language, the
limit beyond which a text is rejected. A language with fewer than ``LEAST_HELD``
such rows is calibrated on all its sample: its characters are cut into pieces,
each costed by a model of the others, and the spread is at least that of the
other languages.

Scoring is one narrow pass over whole texts: n-grams of a batch are sorted,
each distinct one is looked up once, and costs are summed by document.

Null texts and texts without a letter are ``und`` with score 0 and rejected.
Rows with null labels are not learned from. With nothing to learn from, every
text is ``und``. Ties go to the language that sorts first. Repeated rows each
give a row. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import M64, batches, code_points, mix64, ready, saved, strings_of, texts_of

ORDER = 5
#: Labelled rows of each language that a model is fitted on, at most.
SAMPLE_ROWS = 1500
#: Of those, every so manieth is held back to set the limit of rejection.
HELD_BACK = 5
#: Held-back rows of 50 letters that a limit is set by, at least, and the pieces
#: of a smaller sample.
LEAST_HELD = 5
#: Standard deviations above the mean cost at which a text is rejected.
DEVIATIONS = 8.0
#: Share of the way from the language's own cost to the other languages' cost.
FOREIGN = 0.75
SPACE = 32
#: Bytes of text that are scored at once; each takes some hundred bytes of memory.
STEP = 1 << 18


@lru_cache(1)
def letters() -> np.ndarray:
    """Code point to its lower-cased code point; a space for what is no letter."""
    out = np.full(0x110000, SPACE, np.uint32)
    for _, chars in code_points():
        for m in regex.finditer(r"[\p{L}\p{M}]+", chars):
            for c in m[0]:
                low = c.lower()
                out[ord(c)] = ord(low) if len(low) == 1 else ord(c)
    return out


def letters_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts as the models see them, each text after
    ORDER - 2 zeros and a space; the places of the texts' own characters, and
    the text that each belongs to."""
    joined = [x.decode() for x in texts]
    size = np.fromiter(map(len, joined), np.int64, len(joined))
    point = letters()[np.frombuffer((" " + " ".join(joined) + " ").encode("utf-32-le"), np.uint32)]
    at = np.cumsum([0, *(size + 1)])
    edge = np.zeros(len(point), bool)
    edge[at] = True
    word = point != SPACE
    gap = np.flatnonzero(~word[:-1] & word[1:])  # the last of a run of spaces, kept if no text ends in the run
    texts_to = np.cumsum(edge)
    before = np.flatnonzero(word[:-1] & ~word[1:])
    before = np.concatenate(([0], texts_to[before]))[np.searchsorted(before, gap)]
    keep = word | edge
    keep[gap[texts_to[gap] == before]] = True
    keep[at[-1]] = False
    point, of = point[keep], texts_to[keep] - 1
    first = edge[keep]
    place = np.arange(len(point)) + (ORDER - 2) * (of + 1)
    out = np.zeros(len(point) + (ORDER - 2) * len(texts), np.uint32)
    out[place] = point
    return out, place[~first], of[~first]


def grams(point: np.ndarray) -> np.ndarray:
    """A hash of the ORDER characters that end at each position."""
    out = np.full(len(point), np.uint64(ORDER * 0x9E3779B97F4A7C15 & M64))
    for k in range(ORDER - 1, -1, -1):
        shifted = point if not k else np.concatenate((np.zeros(min(k, len(point)), point.dtype), point[:-k]))
        out = out * np.uint64(0x100000001B3) ^ (shifted.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return mix64(out)


def windows(point: np.ndarray) -> np.ndarray:
    """The ORDER characters that end at each position, as rows."""
    return np.lib.stride_tricks.sliding_window_view(np.concatenate((np.zeros(ORDER - 1, np.uint32), point)), ORDER)


def _counts(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of whole n-grams (order ``ORDER``) of each batch, with their
    characters, so that lower orders follow from the distinct ones."""
    for frame in frames:
        for rows, data, at in batches(frame):
            lang = np.array(rows.column("lang").to_pylist(), object)
            texts = strings_of(data, at)
            for one in sorted(set(lang.tolist())):
                point, place, _ = letters_of([texts[k] for k in np.flatnonzero(lang == one)])
                some, first, n = np.unique(grams(point)[place], return_index=True, return_counts=True)
                chars = windows(point)[place[first]]
                yield pa.RecordBatch.from_arrays([pa.array([one] * len(some)), pa.array([c.tobytes() for c in np.ascontiguousarray(chars)], pa.binary()), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])


@dataclass
class Model:
    """Sorted hashes of n-grams with their natural log probability, by order;
    sorted hashes of contexts with the log of their back-off weight."""

    gram_keys: list[np.ndarray]
    gram_logs: list[np.ndarray]
    context_keys: list[np.ndarray]
    context_logs: list[np.ndarray]
    unseen: float
    mean: float = 0.0
    spread: float = 0.0
    foreign: float = 0.0

    def cost(self, points: np.ndarray) -> np.ndarray:
        """Minus the log probability of the last character of each row of
        ``ORDER`` characters, after the ones before it."""
        out = np.zeros(len(points))
        left = np.arange(len(points))
        for order in range(ORDER, 0, -1):
            key = _row_hash(points[left, ORDER - order :])
            found, at = _look(self.gram_keys[order - 1], key)
            out[left[found]] -= self.gram_logs[order - 1][at[found]]
            left = left[~found]
            if order > 1 and len(left):
                found, at = _look(self.context_keys[order - 1], _row_hash(points[left, ORDER - order : -1]))
                out[left[found]] -= self.context_logs[order - 1][at[found]]
        out[left] -= self.unseen
        return out

    def limit(self, length: np.ndarray) -> np.ndarray:
        """The cost a character beyond which a text of so many characters is
        rejected: well on the way to what other languages cost, and beyond
        what chance explains (short texts vary more)."""
        chance = self.mean + DEVIATIONS * self.spread * np.sqrt(1 + 400 / np.maximum(length, 1))
        return np.maximum(chance, self.mean + FOREIGN * (self.foreign - self.mean))


def _row_hash(rows: np.ndarray) -> np.ndarray:
    out = np.full(len(rows), np.uint64(rows.shape[1] * 0x9E3779B97F4A7C15 & M64))
    for k in range(rows.shape[1]):
        out = out * np.uint64(0x100000001B3) ^ (rows[:, k].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return mix64(out)


def _look(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def _by_rows(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    some, back = np.unique(rows, axis=0, return_inverse=True)
    return some, np.bincount(back.ravel(), n, len(some))


def fit(rows: np.ndarray, n: np.ndarray) -> Model:
    """An interpolated Kneser-Ney model from distinct n-grams of the highest
    order (rows of code points) and their counts. Lower orders count the
    distinct characters seen before an n-gram; each order has one discount,
    n1 / (n1 + 2 n2)."""
    gram_keys: list = [None] * ORDER
    gram_logs: list = [None] * ORDER
    context_keys: list = [None] * ORDER
    context_logs: list = [None] * ORDER
    by_order = {ORDER: (rows, n.astype(float))}
    for order in range(ORDER - 1, 0, -1):
        longer, _ = by_order[order + 1]
        by_order[order] = _by_rows(longer[:, 1:], np.ones(len(longer)))
    alphabet = len(by_order[1][0]) + 1
    unseen = 0.0
    for order in range(1, ORDER + 1):
        grams_, count = by_order[order]
        n1, n2 = (count == 1).sum(), (count == 2).sum()
        discount = min(0.95, max(0.1, n1 / max(n1 + 2 * n2, 1)))
        context, back = np.unique(grams_[:, :-1], axis=0, return_inverse=True) if order > 1 else (np.zeros((1, 0), np.uint32), np.zeros(len(grams_), np.int64))
        back = back.ravel()
        total = np.bincount(back, count, len(context))
        weight = discount * np.bincount(back, minlength=len(context)) / total
        if order == 1:
            lower = np.full(len(grams_), 1 / alphabet)
            unseen = float(np.log(weight[0] / alphabet))
        else:
            found, at = _look(gram_keys[order - 2], _row_hash(grams_[:, 1:]))
            assert found.all()
            lower = np.exp(gram_logs[order - 2][at])
        p = (count - discount) / total[back] + weight[back] * lower
        for keys, logs, hash_, value in ((gram_keys, gram_logs, _row_hash(grams_), p), (context_keys, context_logs, _row_hash(context), weight)):
            sort = np.argsort(hash_)
            keys[order - 1], logs[order - 1] = hash_[sort], np.log(value[sort])
    return Model(gram_keys, gram_logs, context_keys, context_logs, unseen)


def cross_costs(texts: list[bytes], pieces: int = LEAST_HELD) -> np.ndarray:
    """The cost a character of each piece of the texts, in a model of the other
    pieces; none if there are too few characters."""
    point, place, _ = letters_of(texts)
    rows = np.array_split(windows(point)[place], pieces)
    out = []
    for k, piece in enumerate(rows):
        others = np.concatenate([r for j, r in enumerate(rows) if j != k])
        if len(piece) and len(others):
            out.append(float(fit(*np.unique(others, axis=0, return_counts=True)).cost(piece).mean()))
    return np.array(out)


def costs(models: list[Model], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The cost of each text in each model (texts x models), and the number
    of characters that it has (0: no letter)."""
    point, place, doc = letters_of(texts)
    length = np.bincount(doc, minlength=len(texts))
    if not len(place):
        return np.zeros((len(texts), len(models))), length
    # one sort of (hash, position) gives the distinct n-grams, each looked up once
    bits = np.uint64(max(1, int(len(point) - 1).bit_length()))
    packed = np.sort((grams(point)[place] >> bits << bits) | place.astype(np.uint64))
    where = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    gram = packed >> bits
    first = np.concatenate(([True], gram[1:] != gram[:-1]))
    which = np.cumsum(first) - 1
    rows = windows(point)[where[first]]
    of = np.zeros(len(point), np.int64)
    of[place] = doc
    of = of[where]
    out = np.empty((len(texts), len(models)))
    for k, model in enumerate(models):
        out[:, k] = np.bincount(of, model.cost(rows)[which], len(texts))
    return out, length


def learnable(docs: DataFrame, sample_rows: int) -> DataFrame:
    """doc_id, lang and hash of the labelled rows that may be among the
    ``sample_rows`` least by hash of a language: those below the hash under
    which about twice as many rows lie."""
    rows = docs.select("doc_id", "lang", F.xxhash64("doc_id", F.lit("language")).alias("h"))
    share = F.lit(2.0 * sample_rows + 400) / F.col("n")
    languages = rows.groupBy("lang").agg(F.count("*").alias("n"))
    return rows.join(languages, "lang").where(F.col("h") / F.lit(2.0**64) + 0.5 <= share).select("doc_id", "lang", "h")


@dataclass
class Languages:
    names: list[str]
    models: list[Model]


def train(docs: DataFrame, learn: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> Languages:
    """Models of every language that a learnable row has. Collects ids of at
    most about 2 x ``sample_rows`` rows a language, and n-gram counts of at
    most ``sample_rows`` texts a language."""
    ready(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").where("doc_id is not null and text is not null and lang is not null")
    rows = rows if learn is None else rows.where(learn)
    picked: dict[str, set] = {}
    for r in learnable(rows, sample_rows).collect():
        picked.setdefault(r["lang"], set()).add((r["h"], r["doc_id"]))
    chosen = [(doc, int(k % HELD_BACK == HELD_BACK - 1)) for name in sorted(picked) for k, (_, doc) in enumerate(sorted(picked[name])[:sample_rows])]
    if not chosen:
        return Languages([], [])
    sample = saved(rows.join(F.broadcast(docs.sparkSession.createDataFrame(chosen, "doc_id long, held int").distinct()), "doc_id"), "language")
    counted = sample.where("held = 0").select("lang", "text").mapInArrow(_counts, "lang string, gram binary, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    lang = np.array(counted.column("lang").to_pylist(), object)
    points = np.frombuffer(b"".join(counted.column("gram").to_pylist()), np.uint32).reshape(-1, ORDER)
    n = counted.column("n").to_numpy()
    fitted = {name: fit(points[lang == name], n[lang == name]) for name in sorted(set(lang.tolist()))}
    found = Languages([*fitted], [*fitted.values()])
    held = sample.where("held = 1").select("lang", "text").toArrow()
    texts, own = [x.encode() for x in held.column("text").to_pylist()], held.column("lang").to_pylist()
    total, length = costs(found.models, texts) if texts else (np.zeros((0, len(found.models))), np.zeros(0, np.int64))
    for k, (name, model) in enumerate(zip(found.names, found.models, strict=True)):
        mine = np.array([x == name for x in own], bool) & (length >= 50)
        each = total[mine, k] / length[mine]
        if mine.sum() >= LEAST_HELD:
            model.mean, model.spread = float(np.median(each)), float(max(each.std(), 0.02))
        other = np.array([x != name for x in own], bool) & (length >= 50)
        model.foreign = float(np.median(total[other, k] / length[other])) if other.sum() >= LEAST_HELD else 0.0
    few = [(name, model) for name, model in zip(found.names, found.models, strict=True) if not model.spread]
    if few:
        pooled = [model.spread for model in found.models if model.spread]
        small = sample.where(F.col("lang").isin([name for name, _ in few])).select("lang", "text").toArrow()
        for name, model in few:
            mine = small.filter(pa.compute.equal(small.column("lang"), name)).column("text").to_pylist()
            each = cross_costs([x.encode() for x in mine])
            model.mean = float(np.median(each)) if len(each) else -model.unseen
            model.spread = float(max(each.std() if len(each) > 1 else 0, np.median(pooled) if pooled else 0, 0.02))
    return found


def identified(docs: DataFrame, languages: Languages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (the chosen language's share of the length-
    normalised likelihoods), entropy (nats a character), rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(languages)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, models = sent.value.names, sent.value.models
        for frame in frames:
            for rows, data, at in batches(frame, step=STEP):
                _, pred, score, entropy, rejected = judged(names, models, strings_of(data, at))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(pred, pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "entropy", "rejected"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, entropy double, rejected boolean")


def judged(names: list[str], models: list[Model], texts: list[bytes]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    if not models:
        none = np.zeros(len(texts))
        return none.astype(int), ["und"] * len(texts), none, none, np.ones(len(texts), bool)
    total, length = costs(models, texts)
    each = total / np.maximum(length, 1)[:, None]
    best = each.argmin(axis=1)
    entropy = each[np.arange(len(texts)), best]
    likely = np.exp(-np.minimum((each - entropy[:, None]) * np.minimum(length, 40)[:, None], 50))
    score = np.where(length > 0, 1 / likely.sum(axis=1), 0.0)
    limit = np.array([m.limit(length) for m in models])[best, np.arange(len(texts))]
    rejected = (length == 0) | (entropy > limit)
    return best, [names[b] if n else "und" for b, n in zip(best.tolist(), length.tolist(), strict=True)], score, np.where(length > 0, entropy, 0.0), rejected


def kept_documents(docs: DataFrame, languages: Languages) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    sent = docs.sparkSession.sparkContext.broadcast(languages)
    ready(docs.sparkSession)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, models = sent.value.names, sent.value.models
        for frame in frames:
            for rows, data, at in batches(frame, step=STEP):
                yield rows.filter(pa.array(~judged(names, models, strings_of(data, at))[4]))

    return docs.mapInArrow(run, docs.schema)
