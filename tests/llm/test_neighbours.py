import numpy as np
from pyspark.sql import functions as F

from larkspur.llm import neighbours
from larkspur.llm.common import table
from tests.conftest import SF01

SCHEMA = "vec_id long, embedding array<double>"


def good(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, k=20, every=20):
    """Distinct (vec_id, vector) rows that take part; each query's neighbours."""
    part = sorted({(i, tuple(v)) for i, v in rows if i is not None and good(v)}, key=str)
    out = []
    for i, v in part:
        if i % every == 0:
            near = sorted((-float(np.dot(v, w)), j) for j, w in part if (j, w) != (i, v) and len(w) == len(v))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    return out


def result(df, **options):
    return [tuple(r) for r in neighbours.search(df, **options).collect()]


def recall(got, want):
    found = {(q, j) for q, _, j, _ in got}
    return sum((q, j) in found for q, _, j, _ in want) / len(want)


def same(got, want):
    key = lambda r: (r[0], r[1], r[2], round(r[3], 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12, atol=1e-12, equal_nan=True)


def made(seed, n=1500, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((30, dim))
    return [(k, (centres[k % 30] + 0.3 * rng.standard_normal(dim)).tolist()) for k in range(n)]


def test_exact_when_every_cell_is_traversed(spark):
    rows = made(1, 400)
    rows += [(k, rows[7][1]) for k in range(400, 520)]  # one vector 121 times, six queries among them
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got, want = result(df, recall=1.0, most_centroids=1), brute(rows)
    same(got, want)


def test_recall_and_traversal(spark):
    rows = made(2, 3000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got, want = result(df, k=10), brute(rows, 10)
    assert recall(got, want) >= 0.9
    assert len(got) == len(want)
    scores = {(q, j): s for q, _, j, s in got}
    by_id = dict(rows)
    assert all(abs(s - np.dot(by_id[q], by_id[j])) < 1e-12 for (q, j), s in scores.items())
    for q in {r[0] for r in got}:
        near = [(-s, j) for p, _, j, s in sorted(got) if p == q]
        assert near == sorted(near)


def test_recall_on_the_given_vectors(spark):
    vectors = table(spark, SF01, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    assert recall(result(vectors), brute(rows)) >= 0.9


def test_blocks_of_queries(spark):
    rows = made(3, 600)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    same(result(df, recall=1.0, block_bytes=1000), result(df, recall=1.0))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [2.0, 0.0]), (40, [0.0, 1.0]), (60, None), (7, []), (80, [0.0, -0.0]),
        (9, [1.0, None]), (10, [nan, 1.0]), (100, [inf, 1.0]), (12, [1.0, 0.0, 0.0]), (120, [5.0]), (None, [1.0, 1.0]),
        (140, [1e200, -1e200]), (15, [1e200, 1e200]), (40, [-1.0, 0.5]), (16, [-1.0, -0.0]), (160, [0.5, 2.0, 1.0]), (-20, [3.0, 3.0]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "dim", "h1", "vec", "cell", "query", "score", "class", "place", "block")})
    with np.errstate(all="ignore"):
        want = brute(rows)
    got = result(df, recall=1.0)
    assert recall(got, want) == 1 and len(got) == len(want)
    plain = [r for r in rows if r[0] not in (140, 15)]
    same(result(df.where("vec_id is null or vec_id not in (140, 15)"), recall=1.0), brute(plain))
    assert result(df.where("false")) == []
    assert result(df.where("vec_id = 0")) == []


def test_traversal_is_by_falling_sum():
    rng = np.random.default_rng(4)
    left, right = rng.standard_normal(9), np.round(rng.standard_normal(7))
    pairs = list(neighbours.traversal(left, right))
    assert {p[1:] for p in pairs} == {(i, j) for i in range(9) for j in range(7)} and len(pairs) == 63
    sums = [left[i] + right[j] for _, i, j in pairs]
    assert np.allclose(sums, [p[0] for p in pairs]) and np.all(np.diff([p[0] for p in pairs]) <= 0)


def test_best_keeps_the_best_of_any_order():
    rng = np.random.default_rng(5)
    score = np.round(rng.standard_normal((4, 300)), 1)
    score[rng.random(score.shape) < 0.3] = np.nan
    best = neighbours.Best(6, 5)
    for lo in range(0, 300, 37):
        part = score[:, lo : lo + 37]
        best.add(1, part, [(lo + c, 0, [lo + c]) for c in range(part.shape[1])])
        best._forget()
    got = sorted((q, -s, c) for q, s, c, _, _ in best.rows())
    want = []
    for q in range(4):
        met = sorted((-score[q, c], c) for c in range(300) if not np.isnan(score[q, c]))
        want += [(q + 1, *m) for m in met[:5]]
    assert got == sorted(want)
