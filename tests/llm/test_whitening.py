"""Whitening against covariances in fractions and a plain eigendecomposition."""

import math
from fractions import Fraction

import numpy as np
import pytest

from rimline.llm.common import table
from rimline.llm.whitening import op12_embedding_whitening, whiten


def whole(vectors):
    return [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]


def plain(vectors):
    """n, deviations, eigenvalues, components and trace from exact centred products."""
    x = whole(vectors)
    n, size = len(x), len(x[0])
    sums = [sum(row[d] for row in x) for d in range(size)]
    centred = [[Fraction(n * row[d] - sums[d], n) for d in range(size)] for row in x]
    v = np.array([[float(sum(r[a] * r[b] for r in centred) / n) for b in range(size)] for a in range(size)])
    values, axes = np.linalg.eigh(v)
    deviations = [sum((n * row[d] - sums[d]) ** 2 for d in range(size)) for row in x]
    return n, deviations, values[::-1], axes[:, ::-1], np.array([[float(c) for c in r] for r in centred]), np.trace(v)


def compare(found, ids, vectors):
    n, deviations, values, axes, centred, trace = plain(vectors)
    k = min(8, len(vectors[0]))
    assert len(found) == len(vectors) * k
    by = {(r.vec_id, r.component): r for r in found}
    for c in range(1, k + 1):
        expected = centred @ axes[:, c - 1] / math.sqrt(values[c - 1])
        got = np.array([by[i, c].whitened for i in ids])
        assert np.allclose(got, expected, atol=1e-8) or np.allclose(got, -expected, atol=1e-8)
        assert {by[i, c].n for i in ids} == {n}
        assert [by[i, c].deviation for i in ids] == deviations
        assert by[ids[0], c].explained == pytest.approx(values[c - 1] / trace, rel=1e-9)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-8


def test_random_vectors_of_unlike_scales(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) * np.logspace(-2, 2, 12) + 7).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(5)
    compare(whiten(df).collect(), list(range(300)), vectors)


def test_given_vectors(spark):
    rows = table(spark, "/root/testdata/sf0.001", "embeddings").collect()
    found = op12_embedding_whitening(spark, "/root/testdata/sf0.001").collect()
    some = [r.embedding for r in rows]
    n, deviations, values, axes, centred, trace = plain([v[:6] for v in some])  # Exact products of all dimensions take long.
    x = np.array(whole(some), float)
    v = np.cov(x.T, bias=True)
    top = np.linalg.eigh(v)[0][::-1][:8]
    assert np.allclose(sorted({r.explained for r in found}, reverse=True), top / np.trace(v), rtol=1e-9)
    assert len(found) == 8 * len(rows) and found[0].identity_error < 1e-8
    w = np.zeros((len(rows), 8))
    place = {r.vec_id: i for i, r in enumerate(rows)}
    for r in found:
        w[place[r.vec_id], r.component - 1] = r.whitened
    assert np.allclose(w.T @ w / len(rows), np.eye(8), atol=1e-8)
    xs = whole(some)
    sums = [sum(c) for c in zip(*xs)]
    first = [sum((len(xs) * a - s) ** 2 for a, s in zip(row, sums)) for row in xs]
    assert {r.vec_id: r.deviation for r in found} == {r.vec_id: d for r, d in zip(rows, first)}


def test_rows_that_are_left_out(spark):
    good = [[1.0, 2.0, -3.5], [2.0, 1.0, 4.0], [0.5, 0.25, 0.125], [9.0, -2.0, 1.0], [9.0, -2.0, 1.0]]
    odd = [None, [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 1.0, 1.0], [1.0, 2.0], [], [1e30, 0.0, 0.0]]
    data = [(i, v, 1, "x") for i, v in enumerate(good + odd)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, n int, entries string")
    compare(whiten(df).collect(), list(range(5)), good)
    assert whiten(df.where("vec_id >= 5 and vec_id <> 9 and vec_id <> 11")).count() == 0
    assert whiten(df.limit(0)).count() == 0


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(40, 5)) * 1e12).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = whiten(df).collect()
    n, deviations, values, axes, centred, trace = plain(vectors)
    assert all(r.deviation is None for r in found) and max(deviations) >= 1 << 63
    assert found[0].identity_error < 1e-8
    assert np.allclose(sorted({r.explained for r in found}, reverse=True), values[:5] / trace)


def test_nothing_varies(spark):
    df = spark.createDataFrame([(1, [1.0, 1.0]), (None, [1.0, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    found = whiten(df).collect()
    assert len(found) == 6
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in found} == {(0, None, None, None)}
    line = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], "vec_id long, embedding array<float>")
    found = sorted(whiten(line).collect(), key=lambda r: (r.component, r.vec_id))
    assert [r.whitened is None for r in found] == [False] * 4 + [True] * 4
    assert found[0].explained == pytest.approx(1.0) and found[0].identity_error < 1e-9
