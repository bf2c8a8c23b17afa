import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.whitening import Inertia, integer_vectors, leading_components, tridiagonal, whitened


def symmetric(values, seed=0):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


SPECTRA = [
    [5.0, 3.0, 2.0, 1.0, 0.5],
    [5.0, 5.0, 5.0, 1.0],
    [1.0, 1 - 1e-9, 1 - 2e-9, 0.1, 0.05],
    [1e8, 1.0, 1e-3, 1e-3, 1e-4],
    [3.0],
    [2.0, 0.0, 0.0],
    list(np.linspace(2, 1, 64)),
]


@pytest.mark.parametrize("values", SPECTRA)
def test_leading_components(values):
    matrix = symmetric(values)
    found, vectors = leading_components(matrix)
    want = sorted((v for v in values if v > 0), reverse=True)[:4]
    assert np.allclose(found, want, rtol=1e-10, atol=1e-13 * max(values))
    assert np.allclose(vectors @ vectors.T, np.eye(len(want)), atol=1e-10)
    assert np.abs(matrix @ vectors.T - vectors.T * found).max() < 1e-12 * max(values)


def test_counts_and_tridiagonal_form():
    matrix = symmetric([4.0, 3.0, 2.0, -1.0, 0.0, 7.0], 3)
    diagonal, beside = tridiagonal(matrix)
    form = np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1)
    assert np.allclose(np.linalg.eigvalsh(form), np.linalg.eigvalsh(matrix))
    counts = Inertia(matrix)
    assert [counts.above(s) for s in (-2, -0.5, 0.5, 2.5, 3.5, 6, 8)] == [6, 5, 4, 3, 2, 1, 0]


def table(spark, rows, extra=""):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>" + extra)


def plain(rows):
    """Integer vectors by id, their fit list's size, and its covariance in exact arithmetic."""
    vectors = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows]
    fit = sorted({x for _, x in vectors})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    centred = [[Fraction(n * x[j] - sums[j], n) for j in range(d)] for x in fit]
    covariance = np.array(
        [[float(sum(c[i] * c[j] for c in centred) / n) for j in range(d)] for i in range(d)]
    )
    return vectors, n, sums, covariance


def test_whitened_against_exact_arithmetic(spark):
    rng = np.random.default_rng(1)
    mixed = rng.standard_normal((60, 6)) * [3, 2, 1, 0.5, 0.1, 0.1] @ rng.standard_normal((6, 6))
    rows = [(i, [float(c) for c in v.astype(np.float32)]) for i, v in enumerate(mixed)]
    rows += [(i, rows[7][1]) for i in range(100, 150)] + [(3, rows[9][1]), (None, rows[0][1])]
    vectors, n, sums, covariance = plain(rows)
    found = whitened(table(spark, rows).repartition(5)).collect()
    assert len(found) == 4 * len(rows)
    e, vec = np.linalg.eigh(covariance)
    e, vec = e[::-1], vec[:, ::-1]
    want = {}
    for i, x in vectors:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        scores = (np.array(x) - np.array(sums) / n) @ vec[:, :4] / np.sqrt(e[:4])
        want.setdefault(i, []).append((deviation, scores))
    signs = {}
    for r in found:
        assert r.n == n == 60 and r.identity_error < 1e-9
        assert abs(r.explained / (e[r.component - 1] / e.sum()) - 1) < 1e-9
        near = [s[r.component - 1] for d, s in want[r.vec_id] if d == r.deviation]
        sign = signs.setdefault(r.component, np.sign(near[0] * r.whitened))
        assert min(abs(sign * r.whitened - s) for s in near) < 1e-9
    assert {r.component for r in found} == {1, 2, 3, 4}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, -0.25]), (2, [1.0, 0.0]), (3, [-1.0, 2.0]), (3, [-1.0, 2.0])]
    bad = [(4, None), (5, [nan, 1.0]), (6, [1.0, inf]), (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (10, [1.0])]
    found = whitened(table(spark, good + bad).withColumns({"x": F.lit(1), "id": F.lit("a"), "place": F.lit(2)}))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = found.collect()
    assert sorted((r.vec_id, r.component) for r in rows) == [(1, 1), (1, 2), (2, 1), (2, 2)] + [(3, 1)] * 2 + [(3, 2)] * 2
    assert {r.n for r in rows} == {3}


def test_little_or_no_variance(spark):
    assert whitened(table(spark, [])).collect() == []
    assert whitened(table(spark, [(1, None), (2, [])])).collect() == []
    assert whitened(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    line = [(i, [float(i), 2.0 * i, 3.0]) for i in range(9)]
    rows = whitened(table(spark, line)).collect()
    assert [r.component for r in rows] == [1] * 9 and all(abs(r.explained - 1) < 1e-12 for r in rows)


def test_entries_below_zero_round_down(spark):
    rows = integer_vectors(table(spark, [(1, [-0.001, -0.0, 0.999])])).collect()
    assert rows[0].x == [-1, 0, 255]


def test_deviations_beyond_a_long_are_null(spark):
    rows = whitened(table(spark, [(i, [1e15 * i, 1.0 * i]) for i in range(5)])).collect()
    assert all(r.deviation is None or r.deviation < 2**63 for r in rows)
    assert any(r.deviation is None for r in rows)
