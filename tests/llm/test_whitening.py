"""Whitening against a direct solution, and the eigenvector solver by itself."""

import math

import numpy as np
import pytest

from tarjuman.llm import whitening
from tarjuman.llm.qdwh import eigenvectors, polar


@pytest.mark.parametrize("size", [1, 2, 5, 40])
@pytest.mark.parametrize("kind", ["plain", "low rank", "equal", "two clusters", "diagonal", "zero"])
def test_eigenvectors(size, kind):
    rng = np.random.default_rng(size)
    rows = rng.standard_normal((max(size // 3, 1) if kind == "low rank" else 3 * size, size))
    turned = np.linalg.qr(rng.standard_normal((size, size)))[0]
    a = {
        "plain": rows.T @ rows, "low rank": rows.T @ rows, "equal": 3 * np.eye(size),
        "two clusters": turned @ np.diag(np.repeat([5.0, 1.0], [size // 2, size - size // 2])) @ turned.T,
        "diagonal": np.diag(np.arange(size, dtype=float)), "zero": np.zeros((size, size)),
    }[kind]
    values, vectors = eigenvectors(a)
    scale = max(np.abs(a).max(), 1.0)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-12 * scale * size)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * scale * size
    assert np.abs(vectors.T @ vectors - np.eye(size)).max() < 1e-12 * size


def test_polar_factor():
    a = np.diag([3.0, 1e-9, -2.0, -1e-12])
    assert np.allclose(polar(a), np.diag([1.0, 1.0, -1.0, -1.0]), atol=1e-12)


def plain(vectors, components):
    """Fit over distinct integer vectors, projections of all rows."""
    size = max((len(v) for v in vectors), default=0)
    x = np.array([[math.floor(256 * float(c)) for c in v] + [0] * (size - len(v)) for v in vectors])
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    deviation = [int(sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums))) for row in x]
    return n, deviation, (x - sums / n) @ basis / np.sqrt(values), values, np.trace(centred.T @ centred / n)


SCHEMA = "vec_id long, embedding array<float>, whitened string, deviation int, label int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "w", 5, None) for i, v in enumerate(vectors)], SCHEMA)


def test_against_direct_solution(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((400, 12)) * np.arange(1, 13)).astype(np.float32).tolist()
    vectors += vectors[:50] + [vectors[3]] * 200
    bad = [None, [1.0, None], [float("nan")] * 12, [float("inf")] * 12]
    table = frame(spark, vectors + bad).repartition(4)
    model = whitening.fit(table, components=4)
    rows, deviation, whitened = whitening.whiten(table, model)
    assert (deviation, whitened) == ("_deviation", "_whitened")
    assert rows.columns == [*table.columns, deviation, whitened]
    got = {r["vec_id"]: r for r in rows.collect()}
    n, squares, projected, values, trace = plain(vectors, 4)
    assert len(got) == len(vectors) and model.n == n == 400
    assert np.allclose(model.values, values, rtol=1e-12) and math.isclose(model.trace, trace, rel_tol=1e-12)
    assert model.identity_error < 1e-10
    own = np.array([got[i][whitened] for i in range(len(vectors))])
    signs = np.sign((own * projected).sum(axis=0))
    assert np.allclose(own * signs, projected, atol=1e-9)
    assert [int(got[i][deviation]) for i in range(len(vectors))] == squares
    assert all(got[0][c] == "w" for c in ["whitened"])


@pytest.mark.parametrize("vectors", [[], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None]])
def test_too_few_vectors(spark, vectors):
    table = frame(spark, vectors)
    model = whitening.fit(table, components=4)
    rows, deviation, whitened = whitening.whiten(table, model)
    found = rows.collect()
    assert len(found) == sum(v is not None for v in vectors)
    assert all(list(r[whitened]) == [] and r[deviation] == 0 for r in found)


def test_short_vectors_and_huge_entries(spark):
    vectors = [[1.0, 2.0, 0.5], [1.0], [3e38, 1.0, 1.0], [1.0, 0.0, 0.0], []]
    table = frame(spark, vectors)
    model = whitening.fit(table)
    assert model.n == 4  # [1] and [1, 0, 0] are one vector
    rows, deviation, whitened = whitening.whiten(table, model)
    got = {r["vec_id"]: r for r in rows.collect()}
    most = (1 << 63) - 1
    x = [[256, 512, 128], [256, 0, 0], [most, 256, 256], [256, 0, 0], [0, 0, 0]]
    sums = [sum(c) for c in zip(x[0], x[1], x[2], x[4])]
    for i, row in enumerate(x[:2]):
        assert got[i][deviation] == sum((4 * c - s) ** 2 for c, s in zip(row, sums))
    assert len(got) == 5
