"""Quality scores from a sparse rule ensemble.

Statistics of each whole text (shares of letters, capitals, digits, symbols,
repeated words and lines, mean lengths) are computed in one numpy pass. Small
regression trees, each fitted to what the ones before it leave over, give paths
from the root to any node; a path is a rule, a conjunction of a few comparisons
of statistics. A logistic model with a lasso penalty over the rules keeps few of
them. The model becomes a Spark column: the sum of the weights of the rules
that hold, through the logistic function. So scoring is a narrow step.

The trees and weights are fitted on the driver, on the statistics of a bounded
sample of labelled rows (``SAMPLE_ROWS``, least by hash of their doc_id).

Null and empty texts have statistics 0 and a score like any other. Rows with a
null label or doc_id are not learned from; with nothing to learn from, every
score is 0.5. A doc_id with several labels counts with each. Repeated rows each
give a row. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import batches, least_by_hash, texts_of
from larkspur.llm.suffix import BASES, Sums

SAMPLE_ROWS = 10_000
TREES = 40
DEPTH = 3
#: Steps of each statistic at which a tree may split, and rows of a leaf.
STEPS = 24
LEAF_ROWS = 10
#: Weight of the lasso penalty, steps of its descent.
PENALTY = 5e-4
DESCENT = 1500

FEATURES = ["n_words", "word_length", "capital_share", "digit_share", "stop_share", "symbol_share", "bar_share", "shout_share", "other_share", "repeat_share", "distinct_share", "line_words", "distinct_lines"]


def _classes() -> dict[str, np.ndarray]:
    made = {}
    for name, chars in (("capital", range(65, 91)), ("digit", range(48, 58)), ("stop", b".,;:?"), ("symbol", b"#$%&*+=@^_~<>\\/{}[]"), ("bar", b"|"), ("shout", b"!"), ("other", b"\"'()-`")):
        lut = np.zeros(256, np.uint8)
        lut[list(chars)] = 1
        made[name] = lut
    return made


CLASSES = _classes()


def _summed(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(x, dtype=np.int64)))
    return total[at[1:]] - total[at[:-1]]


def _distinct(keys: np.ndarray, doc: np.ndarray, n: int, block: int) -> np.ndarray:
    """Distinct keys of each ``block`` neighbours, summed by document, so that
    a long text doesn't repeat itself just by its length."""
    first = np.searchsorted(doc, np.arange(n))
    part = doc.astype(np.int64) << 40 | (np.arange(len(keys)) - first[doc]) // block
    order = np.lexsort((keys, part))
    k, p = keys[order], part[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (p[1:] != p[:-1])
    return np.bincount(p[new] >> 40, minlength=n)


def statistics(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text."""
    n = len(at) - 1
    size = np.diff(at)
    owner = np.repeat(np.arange(n), size)
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    sums = Sums(data, BASES[1])
    word = data > 32
    starts = np.flatnonzero(word & (edge[:-1] | ~np.concatenate(([False], word[:-1]))))
    ends = np.flatnonzero(word & (edge[1:] | ~np.concatenate((word[1:], [False])))) + 1
    key, doc = sums.some(starts, ends - starts), owner[starts]
    n_words = np.bincount(doc, minlength=n)
    again = np.zeros(len(key), bool)
    again[1:] = (key[1:] == key[:-1]) & (doc[1:] == doc[:-1])
    line = (data == 10) | edge[1:]
    line_end = np.flatnonzero(line)
    line_start = np.concatenate(([0], line_end[:-1] + 1)) if len(line_end) else line_end
    line_start = np.maximum(line_start, at[owner[line_end]]) if len(line_end) else line_end
    n_lines = np.bincount(owner[line_end], minlength=n)
    lines = sums.some(line_start, line_end - line_start + (data[line_end] != 10))
    share = lambda x, of: x / np.maximum(of, 1)
    chars = [share(_summed(CLASSES[c][data], at), size) for c in ("capital", "digit", "stop", "symbol", "bar", "shout", "other")]
    return np.stack(
        [
            n_words,
            share(_summed(word, at), n_words),
            *chars,
            share(np.bincount(doc[again], minlength=n), n_words),
            share(_distinct(key, doc, n, 100), n_words),
            share(n_words, n_lines),
            share(_distinct(lines, owner[line_end], n, 20), n_lines),
        ],
        axis=1,
    ).astype(float)


def _features(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        for rows, data, at in batches(frame):
            x = statistics(data, at)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array(x[:, k]) for k in range(x.shape[1]))], names=["doc_id", *FEATURES])


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return texts_of(docs, id_col, text_col).mapInArrow(_features, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


#: A comparison: the number of a statistic, whether it must be above, a value.
Test = tuple[int, bool, float]


@dataclass(frozen=True)
class Ensemble:
    """Rules with their weights and the intercept."""

    rules: tuple[tuple[tuple[Test, ...], float], ...]
    intercept: float

    def column(self) -> Column:
        """The score as a column over the statistics' columns."""
        total = F.lit(self.intercept)
        for tests, weight in self.rules:
            holds = F.lit(True)
            for k, above, value in tests:
                holds = holds & ((F.col(FEATURES[k]) > value) if above else (F.col(FEATURES[k]) <= value))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _holds(x: np.ndarray, tests: tuple[Test, ...]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, above, value in tests:
        out &= x[:, k] > value if above else x[:, k] <= value
    return out


def _tree(x: np.ndarray, rest: np.ndarray, bins: list[np.ndarray], columns: np.ndarray, depth: int) -> tuple[list[tuple[Test, ...]], np.ndarray]:
    """A least-squares tree over some columns: the paths to its nodes, and its
    value for each row."""
    paths, value = [], np.zeros(len(x))

    def grow(rows: np.ndarray, path: tuple[Test, ...]) -> None:
        value[rows] = rest[rows].mean()
        if path:
            paths.append(path)
        if len(path) >= depth or len(rows) < 2 * LEAF_ROWS:
            return
        total, n, best = rest[rows].sum(), len(rows), (1e-9, None)
        base = total * total / n
        for k in columns:
            for cut in bins[k]:
                low = x[rows, k] <= cut
                a = int(low.sum())
                if a < LEAF_ROWS or n - a < LEAF_ROWS:
                    continue
                s = rest[rows[low]].sum()
                gain = s * s / a + (total - s) ** 2 / (n - a) - base
                if gain > best[0]:
                    best = (gain, (int(k), float(cut), low))
        if best[1] is None:
            return
        k, cut, low = best[1]
        grow(rows[low], (*path, (k, False, cut)))
        grow(rows[~low], (*path, (k, True, cut)))

    grow(np.arange(len(x)), ())
    return paths, value


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = 3) -> Ensemble:
    """Rules from trees, then lasso logistic weights. y: 0 or 1."""
    if not len(y):
        return Ensemble((), 0.0)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    if len(np.unique(y)) < 2:
        return Ensemble((), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    bins = [np.unique(np.quantile(x[:, k], np.linspace(0.01, 0.99, STEPS))) for k in range(x.shape[1])]
    logit = np.full(len(y), np.log(share / (1 - share)))
    rules: dict[tuple[Test, ...], None] = {}
    for _ in range(trees):
        rest = y - 1 / (1 + np.exp(-logit))
        rows = np.sort(rng.permutation(len(y))[: max(2 * LEAF_ROWS, min(len(y), 2000))])
        columns = np.sort(rng.permutation(x.shape[1])[: max(1, (2 * x.shape[1]) // 3)])
        paths, _ = _tree(x[rows], rest[rows], bins, columns, depth)
        rules.update(dict.fromkeys(paths))
        leaves = [p for p in paths if not any(q[: len(p)] == p and q != p for q in paths)]
        for p in leaves:
            hold = _holds(x, p)
            logit[hold] += 2.0 * rest[hold].mean() if hold.any() else 0.0
    found = list(rules)
    if not found:
        return Ensemble((), float(np.log(share / (1 - share))))
    matrix = np.stack([_holds(x, p) for p in found], axis=1).astype(float)
    weight, intercept = np.zeros(len(found)), float(np.log(share / (1 - share)))
    ahead, t = weight.copy(), 1.0
    step = 4.0 / max(np.linalg.eigvalsh(matrix.T @ matrix / len(y))[-1] + 1.0, 1e-9)
    for _ in range(DESCENT):  # accelerated proximal gradient
        p = 1 / (1 + np.exp(-(matrix @ ahead + intercept)))
        moved = ahead - step * (matrix.T @ (p - y) / len(y))
        intercept -= step * float((p - y).mean())
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, weight, t = new + (t - 1) / after * (new - weight), new, after
    kept = np.flatnonzero(np.abs(weight) > 1e-6)
    return Ensemble(tuple((found[k], float(weight[k])) for k in kept), intercept)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None, sample_rows: int = SAMPLE_ROWS, **options) -> Ensemble:
    """Fit on the labelled rows where ``learn`` holds."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).where("doc_id is not null and y is not null")
    known = known if learn is None else known.where(learn)
    sample = least_by_hash(known, sample_rows, "quality")
    wanted = docs.sparkSession.createDataFrame([tuple(r) for r in sample] or [(None, None)], "doc_id long, y double")
    texts = texts_of(docs, "doc_id", "text").join(F.broadcast(wanted.select("doc_id").distinct()), "doc_id")
    rows = with_statistics(texts).join(F.broadcast(wanted), "doc_id").orderBy("doc_id", "y", *FEATURES).toArrow()
    x = np.stack([rows.column(f).to_numpy() for f in FEATURES], axis=1)
    return fit(x, (rows.column("y").to_numpy() >= 0.5).astype(float), **options)


def scored(docs: DataFrame, model: Ensemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted of each document."""
    out = with_statistics(docs, id_col, text_col).select("doc_id", model.column().alias("score"))
    return out.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
