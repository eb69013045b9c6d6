"""K2: models that advance together against separate Lloyd runs from the same starts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from tastemine.operators import cluster, kmeans


def _features(spark, x):
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id bigint, x array<double>")
    return rows.select("id", array_to_vector("x").alias("features"))


def _lloyd(x, centers, tol):
    """Plain Lloyd: final centers, cost, iterations."""
    for step in range(1, 301):
        label = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[label == c].mean(axis=0) if (label == c).any() else centers[c] for c in range(len(centers))])
        shift, centers = ((new - centers) ** 2).sum(), new
        if shift <= tol:
            break
    return centers, ((x[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1).sum(), step


@pytest.mark.parametrize("block", [4096, 13])
def test_models_that_advance_together(spark, monkeypatch, block):
    monkeypatch.setattr(kmeans, "BLOCK", block)
    monkeypatch.setattr(kmeans, "PARTITION", 40)
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 1.0, (60, 5)) for c in (-4.0, 0.0, 5.0)])
    pts = kmeans.points(_features(spark, x))
    assert abs(pts.mean_variance - x.var(axis=0).mean()) < 1e-9
    models, passes = kmeans.fit_many(pts, range(2, 6), range(42, 45))
    assert len(models) == 12
    for m in models:
        assert all((x == c).all(axis=1).any() for c in m.start)  # starts are points
        centers, cost, steps = _lloyd(x, m.start, kmeans.TOL * x.var(axis=0).mean())
        assert np.allclose(m.centers, centers, atol=1e-9) and abs(m.cost - cost) < 1e-6 * cost and m.iterations == steps
    assert passes == 5 + max(m.iterations for m in models) + 1
    by_seed = {}
    for m in models:
        for a, b in zip(by_seed.setdefault(m.seed, m.start), m.start, strict=False):
            assert (a == b).all()
    labels = {r["id"]: r["prediction"] for r in models[-1].transform(_features(spark, x)).collect()}
    assert [labels[k] for k in range(len(x))] == ((x[:, None] - models[-1].centers[None]) ** 2).sum(axis=2).argmin(axis=1).tolist()
    pts.unpersist()


def test_draws_follow_the_squared_distance(spark):
    """Of a far point and many near ones the far one is drawn nearly always, and seeds differ."""
    x = np.concatenate([np.random.default_rng(2).normal(0, 0.01, (50, 2)), [[100.0, 0.0]]])
    pts = kmeans.points(_features(spark, x))
    drawn = kmeans.starts(pts, 2, list(range(20)))
    assert sum(any(c[0] == 100 for c in s) for s in drawn.values()) == 20
    assert len({tuple(s[0]) for s in drawn.values()}) > 8


def test_fewer_points_than_centers(spark):
    model = cluster.fit_kmeans(_features(spark, np.array([[1.0, 1.0], [1.0, 1.0], [3.0, 1.0]])), 4, n_init=2)
    assert model.cost == 0 and model.centers.shape == (4, 2)


def test_one_pass_serves_all_models(spark):
    rng = np.random.default_rng(3)
    sweep = cluster.k_sweep(_features(spark, rng.normal(0, 1, (300, 3))), k_values=range(2, 6), n_init=4)
    assert sweep.passes < 120 and set(sweep.models) == {2, 3, 4, 5}
