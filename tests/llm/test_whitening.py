"""Whitening against a dense decomposition, and its edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from buildlens.llm import whitening
from buildlens.llm.common import written
from buildlens.llm.queries import QUERIES


def dense(x):
    """Deviations, whitened rows by a dense decomposition, shares of the trace; x: rows of integers."""
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    a = np.array([[c - s / n for c, s in zip(row, sums)] for row in x])
    values, vectors = np.linalg.eigh(a.T @ a / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return deviation, a, values, vectors


def compare(found, x, ids, most=8):
    deviation, a, values, vectors = dense(x)
    k = max(r.component for r in found)
    assert k == min(most, int((values > 1e-10 * values.sum()).sum())) and len(found) == k * len(x)
    got = {(r.vec_id, r.component): r for r in found}
    for j in range(1, k + 1):
        own = np.array([got[i, j].whitened for i in ids])
        exact = a @ vectors[:, j - 1] / math.sqrt(values[j - 1])
        sign = np.sign(own @ exact)
        assert np.abs(sign * own - exact).max() < 1e-8
        for i, d in zip(ids, deviation):
            r = got[i, j]
            assert (r.n, r.deviation) == (len(x), d) and r.identity_error < 1e-8
            assert r.explained == pytest.approx(values[j - 1] / values.sum(), rel=1e-9)


def test_query_against_a_dense_decomposition(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    x = [[math.floor(1024 * c) + 100000 for c in r.embedding] for r in rows]
    compare(QUERIES["op11_whitening"](spark, sf_dir).collect(), x, [r.vec_id for r in rows])


@pytest.mark.parametrize("spread", ["steep", "levels", "few"])
def test_hard_spectra(spark, spread):
    rng = np.random.default_rng(3)
    scale = {
        "steep": 10.0 ** -np.linspace(0, 4, 60),
        "levels": np.r_[1000, 900, 800, np.linspace(1.2, 1, 57)],
        "few": np.r_[5, 4, 3, np.zeros(57)],
    }[spread]
    turn = np.linalg.qr(rng.standard_normal((60, 60)))[0]
    vectors = (rng.standard_normal((400, 60)) * scale) @ turn * 100
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    x = [[math.floor(1024 * c) + 100000 for c in v] for v in vectors.tolist()]
    rows = written(whitening.integers(frame), "test")
    model = whitening.fit(rows)
    assert model.residuals.max() < 1e-11 * model.values[0] and model.passes < whitening.PASSES
    _, _, values, _ = dense(x)
    assert np.allclose(model.values, values[: len(model.values)], rtol=1e-7, atol=0)
    assert whitening.identity_error(rows, model) < 1e-4


def test_filter_damps_below_the_bound_and_grows_above():
    values = np.linspace(0, 2, 41)
    out = whitening.chebyshev(lambda q: values[:, None] * q, np.ones((41, 1)), np.zeros((41, 0)), 1.0, 2.0, 8)[:, 0]
    exact = np.polynomial.chebyshev.Chebyshev.basis(8)(2 * values - 1) / np.polynomial.chebyshev.Chebyshev.basis(8)(3.0)
    assert np.allclose(out, exact) and np.abs(out[values <= 1]).max() < 1e-4 and out[-1] == pytest.approx(1)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [-inf, 1.0]), (5, [-1.0, 0.25]), (5, [-1.0, 0.25]),
            (6, [2.0]), (7, []), (None, [0.5, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    frame = frame.withColumns({c: F.lit("-") for c in ("id", "x", "component", "n", "dim", "line", "whitened")})
    found = whitening.whitened(frame).collect()
    assert {r.n for r in found} == {6} and len(found) == 12
    kept = [v for _, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in (*v, 0.0, 0.0)[:2]] for v in kept]
    deviation, _, values, _ = dense(x)
    assert sorted(r.deviation for r in found if r.component == 1) == sorted(deviation)
    assert sorted({r.explained for r in found}, reverse=True) == pytest.approx(list(values / values.sum()))
    assert whitening.whitened(frame.limit(0)).count() == 0
    # one row, equal rows, only empty vectors: no component
    for where in ("vec_id = 0", "vec_id = 5", "vec_id = 7", "vec_id = 1"):
        assert whitening.whitened(frame.filter(where)).count() == 0


def test_deviations_are_exact_or_null(spark):
    big = [(i, [float(i * 10**k) for k in (0, 9, 13)]) for i in range(5)]
    frame = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    x = [[min(math.floor(1024 * c), whitening.LIMIT) + 100000 for c in v] for _, v in big]
    exact = dense(x)[0]
    found = {r.vec_id: r.deviation for r in whitening.whitened(frame).collect()}
    assert found == {i: d if d < 1 << 63 else None for i, d in enumerate(exact)} and None in found.values()
