import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import embeddings
from larkspur.llm.common import table
from tests.conftest import SF01


def brute(rows, cosine=embeddings.COSINE):
    """rows: (vec_id, vector, label). n_links and component by vector."""
    def good(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [np.array(v, float) / np.abs(np.array(v, float)).max() if i is not None and good(v, la) else None for i, v, la in rows]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    n = len(rows)
    link = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(n):
            if a != b and unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]):
                link[a, b] = unit[a] @ unit[b] >= cosine
    least = [r[0] for r in rows]
    while True:
        new = [min([least[a], *(least[b] for b in np.flatnonzero(link[a]))]) if link[a].any() else least[a] for a in range(n)]
        if new == least:
            break
        least = new
    return sorted(((r[0], int(link[k].sum()), least[k], r[0] is not None and r[0] == least[k]) for k, r in enumerate(rows)), key=str)


def made(seed, n=220, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    rows = []
    for k in range(n):
        v = centres[k % 12] + rng.standard_normal(dim) * rng.choice([0.05, 0.15, 0.3, 2.0])
        rows.append((k, v.tolist(), int(k % 24 >= 12)))
    return rows


@pytest.mark.parametrize("bucket", [1024, 7])
def test_against_brute_force(spark, bucket):
    rows = made(1)
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5), bucket=bucket)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [2.0, 0.0], 0), (4, [1.0, 0.1], 1), (5, [1.0, 0.0], None),
        (6, None, 0), (7, [], 0), (8, [0.0, 0.0], 0), (9, [1.0, None], 0), (10, [nan, 1.0], 0), (11, [inf, 1.0], 0), (12, [1.0, 0.0, 0.0], 0),
        (None, [1.0, 0.0], 0), (13, [1e-200, 1e-201], 0), (14, [1e200, 1e199], 0), (15, [-1.0, -0.0], 0), (16, [1.0, 0.02], 0),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit(1) for c in ("id", "n", "cell", "links", "root", "good", "dim")})
    got = sorted(map(tuple, embeddings.near_duplicates(vectors).collect()), key=str)
    assert got == brute(rows)
    assert embeddings.near_duplicates(vectors.where("false")).count() == 0


def test_recall_on_the_given_vectors(spark):
    vectors = table(spark, SF01, "embeddings")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in vectors.collect()]
    got = sorted(map(tuple, embeddings.near_duplicates(vectors).collect()), key=str)
    want = brute(rows)
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def test_tables_follow_from_the_recall():
    near = embeddings.collision(np.sqrt(2 - 2 * embeddings.COSINE))
    for n in (10, 10**4, 10**7):
        m, tables = embeddings.parameters(n)
        assert 1 - (1 - near**m) ** tables >= embeddings.RECALL
    rng = np.random.default_rng(5)
    a = rng.standard_normal((4000, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal(a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * side
    same = (embeddings.cells(a, 1, 30) == embeddings.cells(b, 1, 30)).mean()
    assert abs(same - near) < 0.03
