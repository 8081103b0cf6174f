import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, components=16):
    """Of (vec_id, vector) rows that all take part: the grid, n, sums,
    eigenvalues and vectors of the covariance, by a dense solution."""
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    a = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(a.T @ a / n)
    return x, n, sums, values[::-1][:components], vectors[:, ::-1][:, :components], values.sum()


def check(got, rows, components=16):
    x, n, sums, values, vectors, trace = brute(rows, components)
    k = len(values)
    assert len(got) == len(rows) * k
    want = ((n * x - sums) / n) @ vectors / np.sqrt(values)
    found = np.array([r["whitened"] for r in got]).reshape(len(rows), k)
    assert [r["vec_id"] for r in got[::k]] == [i for i, _ in rows]
    assert np.abs(np.abs(found) - np.abs(want)).max() < 1e-6
    assert (np.sign(found) * np.sign(want)).std(axis=0).max() < 1e-9  # one sign a component
    assert [r["deviation"] for r in got[::k]] == [int(s) for s in ((n * x - sums) ** 2).sum(axis=1)]
    assert {r["n"] for r in got} == {n}
    assert np.allclose([r["explained"] for r in got[:k]], values / trace, rtol=1e-9)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-4


def result(spark, rows, **options):
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(whitening.component_rows(vectors, **options).collect(), key=lambda r: (r["vec_id"], r["component"]))


@pytest.mark.parametrize(("dim", "n"), [(24, 300), (5, 40)])
def test_against_a_dense_solution(spark, dim, n):
    rng = np.random.default_rng(dim)
    mixed = rng.standard_normal((n, dim)) @ rng.standard_normal((dim, dim))
    rows = [(k, mixed[k % (n - 20)].tolist()) for k in range(n)]  # twenty repeat others
    check(result(spark, rows), rows)


def test_variances_that_differ_by_many_orders(spark):
    rng = np.random.default_rng(3)
    wide = np.round(rng.standard_normal((400, 6)) * [1e9, 1e6, 1e3, 1e2, 10, 1]) * [1, 1, 1, 1, 1, 0.25]
    turned = wide.copy()
    turned[:, 1] += turned[:, 0]  # columns almost alike
    rows = [(k, v.tolist()) for k, v in enumerate(turned)]
    got = result(spark, rows)
    model_values = np.array([r["explained"] for r in got[:6]])
    x, n, sums, *_ = brute(rows)
    fit = np.unique(x, axis=0)
    sigma = np.linalg.svd((n * fit.astype(object) - sums.astype(object)).astype(float) / n, compute_uv=False)
    assert np.allclose(model_values, sigma**2 / (sigma**2).sum(), rtol=1e-4)
    assert got[0]["identity_error"] < 1e-4


def test_no_full_rank(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((50, 3))
    rows = [(k, [*v.tolist(), float(v[0]), 7.0]) for k, v in enumerate(base)]
    got = result(spark, rows)
    by = {c: [r for r in got if r["component"] == c] for c in range(1, 6)}
    assert all(r["whitened"] is None and r["explained"] == 0 for c in (4, 5) for r in by[c])
    assert all(r["whitened"] is not None for c in (1, 2, 3) for r in by[c])
    assert abs(sum(by[c][0]["explained"] for c in by) - 1) < 1e-9 and got[0]["identity_error"] < 1e-4
    seen = np.array([[r["whitened"] for r in by[c]] for c in (1, 2, 3)])
    assert np.abs(np.cov(seen, bias=True) - np.eye(3)).max() < 1e-9


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0]), (2, [0.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [1.0, 2.0, 3.0]), (None, [4.0, -2.5]), (9, [1e300, 1.0]), (10, [-0.3, 5.0]),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("dim", "x", "n", "component", "i", "part", "line")})
    got = whitening.component_rows(vectors).collect()
    part = [(i, v) for i, v in rows if i in (1, 2, 10, None) and v]
    got = sorted(got, key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0, r["component"]))
    assert [r["vec_id"] for r in got] == [i for i in (1, 2, 2, 10, None) for _ in "ab"]
    assert {r["n"] for r in got} == {4}
    x, n, sums, values, vectors_, _ = brute([p for p in part])
    want = {i: abs(((n * v - sums) / n) @ vectors_ / np.sqrt(values)) for (i, _), v in zip(part, x, strict=True)}
    assert all(abs(abs(r["whitened"]) - want[r["vec_id"]][r["component"] - 1]) < 1e-9 for r in got)
    assert whitening.component_rows(vectors.where("false")).collect() == []
    alone = whitening.component_rows(vectors.where("vec_id = 2")).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone] == [(1, 0, None, 0.0, 0.0)] * 4


def test_exact_where_a_long_is_not_enough():
    x = np.array([[1 << 52, -(1 << 52)], [3, 4]], np.int64)
    n, sums = 10**6, [5, 7]
    assert whitening.scaled(x, n, sums).tolist() == [[(1 << 52) * n - 5, -(1 << 52) * n - 7], [3 * n - 5, 4 * n - 7]]
    model = whitening.Whitening(n, sums, np.eye(2), np.ones(2), 2.0, 0.0)
    import pyarrow as pa

    frame = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(x.tolist(), pa.list_(pa.int64()))], names=["vec_id", "x"])
    (out,) = whitening._applied(model)(iter([frame]))
    assert out.column("deviation").to_pylist() == [None, (3 * n - 5) ** 2 + (4 * n - 7) ** 2]


def test_solved_is_a_triangular_solution():
    rng = np.random.default_rng(1)
    r = np.triu(rng.standard_normal((7, 7))) + 5 * np.eye(7)
    a = rng.standard_normal((9, 7))
    assert np.allclose(whitening.solved(a, r) @ r, a)
