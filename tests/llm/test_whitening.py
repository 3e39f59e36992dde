"""Whitening against a covariance formed outright, the solver on hard matrices, the query's contract."""

import math

import numpy as np
import pytest

from ledgerlens.llm import queries, whitening
from samples import SF

HARD = {
    "random": lambda r: r.normal(size=(300, 24)),
    "graded": lambda r: r.normal(size=(300, 20)) * 10.0 ** -np.arange(20),
    "rank 3": lambda r: r.normal(size=(200, 3)) @ r.normal(size=(3, 15)),
    "ties": lambda r: np.concatenate([np.eye(9), -np.eye(9)]),
    "near ties": lambda r: np.concatenate([np.eye(9), -np.eye(9)]) * (1 + 1e-9 * np.arange(9)) @ np.linalg.qr(r.normal(size=(9, 9)))[0],
    "zero columns": lambda r: np.concatenate([np.zeros((50, 2)), r.normal(size=(50, 4)), np.zeros((50, 3))], axis=1),
    "one column": lambda r: r.normal(size=(40, 1)),
    "two rows": lambda r: r.normal(size=(2, 12)),
    "all equal": lambda r: np.ones((30, 6)),
}


@pytest.mark.parametrize("kind", HARD)
def test_solver(kind):
    x = HARD[kind](np.random.default_rng(4))
    x = x - x.mean(axis=0)
    factor = np.zeros((x.shape[1],) * 2)
    r = np.linalg.qr(x, mode="r")
    factor[: len(r)] = r
    squares, vectors, total = whitening.solve(factor, x.shape[1])
    want = np.sort(np.linalg.svd(factor, compute_uv=False))[::-1] ** 2
    big = want > (8 * x.shape[1] * 2**-52) ** 2 * max(want[0], 1e-300)
    assert len(squares) == big.sum() and np.allclose(squares, want[big], rtol=1e-11, atol=1e-20 * want[0]) and math.isclose(total, want.sum(), rel_tol=1e-12, abs_tol=1e-20)
    assert np.abs(vectors.T @ vectors - np.eye(len(squares))).max(initial=0) < 1e-6
    assert np.abs(factor.T @ (factor @ vectors) - vectors * squares).max(initial=0) <= 1e-11 * max(want[0], 1e-300)


def test_bidiagonal_and_singular_values():
    r = np.random.default_rng(8)
    for d in (1, 2, 3, 17, 64):
        a = r.normal(size=(d, d))
        diagonal, beside, q = whitening.bidiagonal(a)
        b = np.diag(diagonal) + np.diag(beside, 1)
        assert np.allclose(q @ q.T, np.eye(d), atol=1e-13) and np.allclose(q @ b.T @ b @ q.T, a.T @ a, atol=1e-10)
        assert np.allclose(whitening.squared_singular_values(diagonal, beside), np.linalg.svd(a, compute_uv=False) ** 2, rtol=1e-9)
    tiny = whitening.squared_singular_values(np.array([1.0, 1e-8, 1e-16]), np.array([0.0, 0.0]))
    assert np.allclose(tiny, [1.0, 1e-16, 1e-32], rtol=1e-14)


def test_query_contract(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(1024 * np.array([r["embedding"] for r in rows], dtype=np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = queries.op12_embedding_whitening(spark, SF).toPandas()
    assert len(out) == 8 * n and out.component.dtype == np.int32 and set(out.component) == set(range(1, 9)) and (out.n == n).all()
    w = out.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    mine = centred @ vectors[:, :8] / np.sqrt(values[:8])
    signs = np.sign((w * mine).sum(axis=0))
    assert np.abs(w * signs - mine).max() < 1e-9
    exact = [sum(int(v) ** 2 for v in row) for row in n * x - sums]
    assert out[out.component == 3].sort_values("vec_id").deviation.tolist() == exact
    assert np.allclose(out.groupby("component").explained.first(), values[:8] / values.sum(), rtol=1e-10)
    assert out.identity_error.nunique() == 1 and np.isclose(out.identity_error[0], np.abs(np.cov(w.T, bias=True) - np.eye(8)).max(), atol=1e-12) and out.identity_error[0] < 1e-9


def test_large_deviations_are_exact():
    y = np.array([[2**40 + 3, -(2**41) - 7, 5], [1, 2, 3]], dtype=np.int64)
    assert [int(v.as_py()) for v in whitening.deviations(y)] == [sum(int(v) ** 2 for v in r) for r in y]


def test_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, whitened string, n int"
    rows = [(1, [0.5, 1.0, 0.0], "a", 1), (1, [0.5, 1.0, 0.0], "a", 1), (None, [1.5, -1.0, 0.0], None, None), (2, None, "b", 2), (3, [], "c", 3),
            (4, [1.0, None, 2.0], "d", 4), (5, [1.0, math.nan, 2.0], "e", 5), (6, [1.0, math.inf, 2.0], "f", 6), (7, [1.0], "g", 7), (8, [0.0, 3.0, 0.0], None, 8)]
    df = spark.createDataFrame(rows, schema)
    model = whitening.fit_whitening(df)
    out = whitening.whiten(df, model).collect()
    assert sorted(str(r["vec_id"]) for r in out) == ["1", "1", "8", "None"] and model.n == 4 and {len(r["whitened"]) for r in out} == {2}
    assert whitening.identity_error(df, model) < 1e-12
    empty = whitening.fit_whitening(df.limit(0))
    assert empty.n == 0 and whitening.whiten(df.limit(0), empty).count() == 0 and whitening.identity_error(df.limit(0), empty) == 0.0
    same = df.where("vec_id = 1")
    flat = whitening.fit_whitening(same)
    assert [r["whitened"] for r in whitening.whiten(same, flat).collect()] == [[], []]


def test_factors_of_many_tasks(spark):
    df = spark.range(0, 900, 1, 70).selectExpr("id AS vec_id", "transform(sequence(1, 5), k -> CAST(sin(id * k) + k AS FLOAT)) AS embedding")
    one = whitening.fit_whitening(df.coalesce(1))
    many = whitening.fit_whitening(df)
    assert np.allclose(one.variances, many.variances, rtol=1e-12) and whitening.identity_error(df, many) < 1e-10  # two variances are a ten-thousandth apart
