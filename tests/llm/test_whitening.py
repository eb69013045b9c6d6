"""Whitening against numpy's eigensolver and exact integers; inertia counts against eigenvalues."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tastemine.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, n int, _x string, component string, whitened double"


def _covariances():
    rng = np.random.default_rng(2)
    for d in (1, 2, 7, 40):
        x = rng.standard_normal((3 * d, d)) * rng.uniform(0.1, 90, d)
        yield x.T @ x / (3 * d)
    yield np.eye(9) * 5  # all eigenvalues agree
    yield np.diag([3.0, 3, 3, 2, 2, 1, 0, 0])
    x = rng.standard_normal((4, 12))
    yield x.T @ x  # rank 4
    q, _ = np.linalg.qr(rng.standard_normal((12, 12)))
    near = q @ np.diag([1e6, 1e6 * (1 + 1e-15), 1e6 * (1 + 1e-9), *np.ones(6), 1e-6, 1e-6, 0]) @ q.T
    yield (near + near.T) / 2
    yield np.zeros((3, 3))


@pytest.mark.parametrize("a", list(_covariances()), ids=lambda a: str(len(a)))
def test_eigenpairs(a):
    values, vectors = whitening.leading_eigenpairs(a, 32)
    exact = np.linalg.eigvalsh(a)[::-1]
    assert len(values) == min(32, (exact > 4 * np.finfo(float).eps * len(a) * max(np.trace(a), 0)).sum())
    scale = max(exact.max(), 1e-300)
    assert np.abs(values - exact[: len(values)]).max(initial=0) <= 1e-13 * scale
    assert np.abs(a @ vectors - vectors * values).max(initial=0) <= 1e-12 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) <= 1e-12


def test_inertia_counts_eigenvalues_below():
    rng = np.random.default_rng(4)
    for _ in range(60):
        x = rng.standard_normal((6, 6))
        s = rng.standard_normal()
        assert whitening.inertia(x + x.T, s) == (np.linalg.eigvalsh(x + x.T) < s).sum()
        z = rng.integers(-2, 3, (6, 6)).astype(float)  # zero pivots
        assert whitening.inertia(z + z.T, 0.5) == (np.linalg.eigvalsh(z + z.T) < 0.5).sum()


def _vectors(n, d, rng):
    mix = rng.standard_normal((d, d))
    return (rng.standard_normal((n, d)) @ mix).astype(np.float32)


def _hold(rows, got, components=32):
    """``got`` against exact integers and numpy's eigenvectors, each up to its sign."""
    fine = [r for r in rows if r[1] is not None and all(e is not None and math.isfinite(e) for e in r[1])]
    sizes = sorted(((sum(len(r[1]) == d for r in fine), d) for d in {len(r[1]) for r in fine}), reverse=True)
    fine = [r for r in fine if len(r[1]) == sizes[0][1]]
    x = [[math.floor(64 * float(e)) + 1_000_000 for e in r[1]] for r in fine]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    m = np.array(x, dtype=float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(m.T @ m / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-12 * values.sum()).sum()))
    assert len(got) == n * k
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    white = m @ vectors[:, :k] / np.sqrt(values[:k])
    for j in range(k):
        own = [sorted((r["deviation"], r["whitened"]) for r in by[v][j + 1]) for v in {r[0] for r in fine}]
        assert all(r["n"] == n and abs(r["explained"] - values[j] / values.sum()) < 1e-9 and r["identity_error"] < 1e-6 for v in by for r in by[v][j + 1])
        deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for v in x]
        alike = []
        for sign in (1, -1):
            expected = {}
            for r, dev, w in zip(fine, deviation, sign * white[:, j], strict=True):
                expected.setdefault(r[0], []).append((dev, w))
            wanted = [sorted(expected[v]) for v in {r[0] for r in fine}]
            alike.append(all(len(a) == len(b) and all(p[0] == q[0] and abs(p[1] - q[1]) < 1e-8 for p, q in zip(a, b, strict=True)) for a, b in zip(own, wanted, strict=True)))
        assert any(alike), j


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", "y", 3.0) for r in rows], SCHEMA).repartition(4)


def _run(df):
    white, fit = whitening.whiten(df)
    return whitening.by_component(white, fit)


def test_whitening(spark):
    rng, pick = np.random.default_rng(8), random.Random(1)
    rows = [(k, v.tolist()) for k, v in enumerate(_vectors(150, 9, rng))]
    rows += [(3, rows[3][1]), (None, rows[0][1]), (3, rows[4][1])]  # repeated rows, ids and a null id
    rows += [(900, None), (901, [None] + [1.0] * 8), (902, [float("nan")] * 9), (903, [float("inf")] + [0.0] * 8), (904, []), (905, [1.0, 2.0])]
    pick.shuffle(rows)
    out = _run(_frame(spark, rows))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    _hold(rows, out.collect())


def test_more_dimensions_than_components(spark):
    rows = [(k, v.tolist()) for k, v in enumerate(_vectors(300, 40, np.random.default_rng(9)))]
    got = _run(_frame(spark, rows)).collect()
    assert {r["component"] for r in got} == set(range(1, 33))
    _hold(rows, got)


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(k, [1e9 * (-1) ** k, float(k)]) for k in range(40)]
    got = _run(_frame(spark, rows)).collect()
    assert got and all(r["deviation"] is None for r in got)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        out = _run(_frame(spark, rows) if rows else spark.createDataFrame([], SCHEMA))
        assert out.count() == 0
        assert dict(out.dtypes)["component"] == "int"


def test_sf_table(spark):
    got = whitening.query(spark, "/root/testdata/sf0.001").collect()
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    _hold(rows, got)
