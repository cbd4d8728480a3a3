"""Singular values and vectors against numpy, whitening against the covariance's eigenvectors in plain numpy and integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from leaksafe.llm import bidiagonal, queries, whitening

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, n string, deviation string, x int, part string"


def shapes():
    r = np.random.default_rng(4)
    ties = np.vstack([np.eye(8), -np.eye(8)]) * ([3.0] * 4 + [1.0] * 4)
    near = ties.copy()
    near[0, 0] *= 1 + 1e-9
    copies = r.standard_normal((300, 10))
    copies[:, 3], copies[:, 7] = 0, copies[:, 2]
    return {
        "plain": r.standard_normal((500, 64)),
        "graded": r.standard_normal((500, 25)) * 10.0 ** -np.arange(25),
        "low rank": r.standard_normal((500, 3)) @ r.standard_normal((3, 20)),
        "few rows": r.standard_normal((10, 40)),
        "ties": ties,
        "near ties": near @ np.linalg.qr(r.standard_normal((8, 8)))[0],
        "zero and equal columns": copies,
        "one column": r.standard_normal((50, 1)),
        "two columns": r.standard_normal((50, 2)),
        "nothing": np.zeros((5, 6)),
    }


@pytest.mark.parametrize("name", shapes())
def test_leading_vectors(name):
    rows = shapes()[name]
    r = np.linalg.qr(rows - rows.mean(axis=0), mode="r")
    r = np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))])
    squares, vectors = bidiagonal.leading(r, 4)
    want = np.linalg.svd(r, compute_uv=False)
    top = max(want[0], 1e-300)
    assert np.abs(np.sqrt(squares) - want).max() <= 1e-14 * top
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-12
    for square, v in zip(squares, vectors, strict=False):
        assert np.linalg.norm(r.T @ (r @ v) - square * v) <= 1e-13 * top**2


def test_small_values_keep_their_digits():
    """A bidiagonal matrix whose singular values span 200 orders of magnitude, known from its inverse and determinant."""
    squares = bidiagonal.dqds(np.array([1.0, 1e-100, 1e-200]), np.array([1e-50, 1e-150]))
    assert squares[0] == pytest.approx(1 + 1e-100, rel=1e-13)
    assert math.prod(float(s) ** 0.5 for s in squares[:2]) == pytest.approx(1e-100, rel=1e-12)


def plain(vectors):
    """(x of the remaining rows, n, deviations, eigenvalues falling, components) by exact sums and numpy's eigenvectors."""
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(v) for _, v in kept)
    x = [(i, [math.floor(256 * float(np.float32(c))) for c in v] + [0] * (width - len(v))) for i, v in kept]
    fit = sorted({tuple(v) for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    far = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for _, v in x]
    centred = np.array([[n * c - s for c, s in zip(v, sums, strict=True)] for v in fit], float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    rows = np.array([[n * c - s for c, s in zip(v, sums, strict=True)] for _, v in x], float) / n
    return [i for i, _ in x], n, far, values[::-1], axes[:, ::-1].T, rows


def check(got, vectors, most=4):
    ids, n, far, values, axes, rows = plain(vectors)
    k = min(most, int((values > 1e-20 * values[0]).sum()))
    assert len(got) == len(ids) * k
    for c in range(k):
        own = sorted((r.vec_id is not None, r.vec_id or 0, r.deviation, r.whitened) for r in got if r.component == c + 1)
        want = rows @ axes[c] / values[c] ** 0.5
        sides = [
            sorted((i is not None, i or 0, d if d <= whitening.LARGEST else None, float(w)) for i, d, w in zip(ids, far, side, strict=True))
            for side in (want, -want)
        ]
        assert [o[:3] for o in own] == [w[:3] for w in sides[0]]
        apart = [max(abs(o[3] - w[3]) for o, w in zip(own, side, strict=True)) for side in sides]
        assert min(apart) < 1e-9
    for r in got:
        assert r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-10)


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(queries.QUERIES["op12_whitening"](spark, SF).collect(), [(r.vec_id, r.embedding) for r in rows])


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "a", "b", 3, None) for i, v in vectors], SCHEMA)


def test_edges(spark, monkeypatch):
    """Nulls, non-finite entries, repeated rows, null ids, vectors of several lengths, clashing names; a tree of several levels."""
    monkeypatch.setattr(whitening, "WIDTH", 2)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 3)
    r = np.random.default_rng(5)
    vectors = [(i, [float(c) for c in np.float32(r.standard_normal(6) * [5, 3, 2, 1, 0.5, 0.1])]) for i in range(60)]
    vectors += [(100, None), (101, [None] * 6), (102, [float("nan")] + [0.0] * 5), (103, [float("inf")] + [0.0] * 5)]
    vectors += [(104, [-0.0] * 6), (105, [1.0, 2.0]), (106, []), (None, [0.5] * 6), *vectors[:5], *[(200 + i, vectors[0][1]) for i in range(20)]]
    check(whitening.whitened(frame(spark, vectors).repartition(7)).collect(), vectors)


def test_small_and_empty(spark):
    assert whitening.whitened(frame(spark, [])).collect() == []
    assert whitening.whitened(frame(spark, [(1, None)])).collect() == []
    assert whitening.whitened(frame(spark, [(1, []), (2, [])])).collect() == []
    assert whitening.whitened(frame(spark, [(1, [1.0, 2.0])] * 3)).collect() == []  # no variance, no component
    two = [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (2, [3.0, 2.0])]
    check(whitening.whitened(frame(spark, two)).collect(), two)
    wide = [(i, [float(np.float32(c))]) for i, c in enumerate([1e15, -1e15, 3e14, 7.0])]
    got = whitening.whitened(frame(spark, wide)).collect()
    assert [r.deviation for r in got] == [None] * 4


def test_ties(spark):
    """Equal eigenvalues: any axes of their space, orthonormal and the same for all rows."""
    axes = np.vstack([np.eye(5), -np.eye(5)]).tolist()
    got = whitening.whitened(frame(spark, [*enumerate(axes)])).collect()
    y = np.zeros((10, 4))
    for r in got:
        y[r.vec_id, r.component - 1] = r.whitened
        assert r.explained == pytest.approx(0.2)
    assert np.allclose(y.T @ y / 10, np.eye(4)) and np.allclose(y[:5], -y[5:])
