"""R1 over routed blocks, R2 / J7 by bounds: against dense NumPy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemine.operators import blocked_svd, factorize, topk


def _cells(spark, n_users=90, n_items=70, seed=0):
    rng = np.random.default_rng(seed)
    a = np.round(rng.gamma(1.0, 1.0, (n_users, 4)) @ rng.gamma(1.0, 1.0, (4, n_items)), 3) * (rng.random((n_users, n_items)) < 0.2)
    a[3] = np.arange(n_items) + 1.0  # a user who rated everything
    a[:, 5] = 2.0  # an item that everybody rated
    cells = [(int(u), int(i), float(a[u, i])) for u, i in zip(*np.nonzero(a), strict=True)]
    return a, spark.createDataFrame(cells, "u_row bigint, i_col bigint, rating double").repartition(7)


@pytest.mark.parametrize(("block", "part"), [(2048, 1 << 17), (16, 40), (7, 5)])
def test_svd_does_not_depend_on_the_blocks(spark, monkeypatch, block, part):
    monkeypatch.setattr(blocked_svd, "BLOCK", block)
    monkeypatch.setattr(blocked_svd, "PART_CELLS", part)
    a, cells = _cells(spark)
    us, v, sigma = blocked_svd.randomized_svd(cells, 8, a.shape[1])
    exact = np.linalg.svd(a, compute_uv=False)
    assert np.allclose(sigma, exact[:8], rtol=2e-3) and abs(sigma[0] / exact[0] - 1) < 1e-9
    us = np.array([r["factors"] for r in us.orderBy("u_row").collect()])
    v = np.array([r["factors"] for r in v.orderBy("i_col").collect()])
    assert us.shape == (90, 8) and v.shape == (70, 8)
    assert np.allclose(v.T @ v, np.eye(8), atol=1e-9)
    assert np.allclose(us, a @ v, atol=1e-3 * exact[0])
    whole, wv, ws = blocked_svd.randomized_svd(cells, a.shape[1], a.shape[1])
    assert np.allclose(ws, exact, atol=1e-8)
    whole = np.array([r["factors"] for r in whole.orderBy("u_row").collect()])
    wv = np.array([r["factors"] for r in wv.orderBy("i_col").collect()])
    assert np.allclose(whole @ wv.T, a, atol=1e-8)


def test_hot_blocks_are_cut_and_rows_go_only_where_they_are_needed(spark, monkeypatch):
    monkeypatch.setattr(blocked_svd, "BLOCK", 10)
    monkeypatch.setattr(blocked_svd, "PART_CELLS", 60)
    a, cells = _cells(spark)
    users, items = blocked_svd.sides(cells, 4)
    sizes = users.cells.select(F.size("row").alias("n")).collect()
    assert sum(r["n"] for r in sizes) == np.count_nonzero(a) and max(r["n"] for r in sizes) < 120
    shipped = items.routes.select(F.sum(F.size("rows"))).first()[0]
    parts = {(r["block"], r["part"]): set(r["col"]) for r in users.cells.collect()}
    assert shipped == sum(map(len, parts.values()))
    users.unpersist()
    items.unpersist()


def test_rows_are_stored_once_and_not_for_every_block_that_needs_them(spark, monkeypatch):
    """Pieces, a row for every block that needs it, are made anew for each pass; after a pass its shuffles may go."""
    monkeypatch.setattr(blocked_svd, "BLOCK", 10)
    kept, released = [], []
    keep = blocked_svd.checkpoint

    def checkpoint(df):
        kept.append(keep(df))
        return kept[-1]
    monkeypatch.setattr(blocked_svd, "checkpoint", checkpoint)
    monkeypatch.setattr(blocked_svd, "release", lambda s: released.append(s), raising=False)
    a, cells = _cells(spark)
    blocked_svd.randomized_svd(cells, 8, a.shape[1], oversample=2, n_iter=2)
    passes = [df for df in kept if "data" in df.columns]
    assert len(passes) == 4 and len(released) >= 2
    for df in passes:
        sizes = [len(r["rows"]) // 4 for r in df.select("rows").collect()]
        assert sum(sizes) <= max(a.shape)


def test_passes_in_rounds_give_the_same_factors(spark, monkeypatch):
    """Rounds send a share of the rows each, their shuffles may go, and no stored rows stay but those of the factors."""
    from pathlib import Path
    from urllib.parse import urlparse
    monkeypatch.setattr(blocked_svd, "BLOCK", 10)
    a, cells = _cells(spark)
    folder = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)
    us, v, sigma = blocked_svd.randomized_svd(cells, 8, a.shape[1], n_iter=1)
    us, v = us.orderBy("u_row").collect(), v.orderBy("i_col").collect()
    monkeypatch.setattr(blocked_svd, "PASS_BYTES", 40_000)
    monkeypatch.setattr(blocked_svd, "ROUNDS", 3)
    sent, before = [], set(folder.rglob("part-*"))
    half_pass = blocked_svd.half_pass

    def counted(pieces, to, m=None):
        sent.append(sum(len(r["rows"]) // 4 for r in pieces.select("rows").collect()))
        return half_pass(pieces, to, m)
    monkeypatch.setattr(blocked_svd, "half_pass", counted)
    us3, v3, sigma3, remove = blocked_svd.factors_of(cells, 8, a.shape[1], n_iter=1)
    assert len(sent) == 3 * 4 and max(sent) < 0.6 * sum(sent[:3])
    assert np.allclose(sigma, sigma3, rtol=1e-12)
    for one, three in ((us, us3.orderBy("u_row").collect()), (v, v3.orderBy("i_col").collect())):
        assert np.allclose(np.abs([r["factors"] for r in one]), np.abs([r["factors"] for r in three]), atol=1e-9)  # signs are arbitrary
    remove()
    assert not [f for f in set(folder.rglob("part-*")) - before if f.stat().st_size]


def _dense(u, v, k, seen=()):
    scores = u @ v.T
    for a, b in seen:
        scores[a, b] = -np.inf
    return [[int(i) for i in np.lexsort((np.arange(len(v)), -scores[r]))[:k] if np.isfinite(scores[r, i])] for r in range(len(u))]


def _frames(spark, u, v):
    users = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(u)], "u_row bigint, factors array<double>").repartition(3)
    return users, spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "i_col bigint, factors array<double>").repartition(3)


def _lists(best, n):
    out = [[] for _ in range(n)]
    for r in best.orderBy("u_row", "rank").collect():
        assert r["rank"] == len(out[r["u_row"]]) + 1
        out[r["u_row"]].append(r["i_col"])
    return out


@pytest.mark.parametrize("share", [1, 32])
def test_top_items_equals_the_dense_result(spark, monkeypatch, share):
    monkeypatch.setattr(topk, "USER_BLOCK", 16)
    monkeypatch.setattr(topk, "ITEM_BLOCK", 8)
    monkeypatch.setattr(topk, "SHARE", share)
    rng = np.random.default_rng(5)
    u, v = rng.integers(-3, 4, (50, 4)).astype(float), rng.integers(-3, 4, (100, 4)).astype(float)  # ties everywhere
    v *= np.exp2(rng.integers(-6, 3, 100))[:, None]
    v[10] = 0
    u[7] = 0
    users, items = _frames(spark, u, v)
    best, told = topk.top_items(users, items, 6)
    assert _lists(best, 50) == _dense(u, v, 6)
    assert told["pairs"] == 50 * 13 and 0 < told["scored"] < 0.8 * told["pairs"] and told["rounds"] == 3
    seen = [(int(a), int(b)) for a, b in zip(rng.integers(0, 50, 900), rng.integers(0, 100, 900), strict=True)] + [(2, k) for k in range(97)]
    best, _ = topk.top_items(users, items, 6, spark.createDataFrame(seen, "u_row bigint, i_col bigint").distinct())
    assert _lists(best, 50) == _dense(u, v, 6, seen)


def test_fewer_items_than_wanted_and_nothing_at_all(spark):
    u, v = np.ones((3, 2)), np.array([[1.0, 0.0], [0.0, 2.0]])
    users, items = _frames(spark, u, v)
    assert _lists(topk.top_items(users, items, 10)[0], 3) == [[1, 0]] * 3
    assert topk.top_items(users, items.where("false"), 10)[0].count() == 0
    assert topk.top_items(users.where("false"), items, 10)[0].count() == 0


def test_predictions_of_all_factors_are_the_ratings(spark):
    rows = [("a", "x", 4.0), ("a", "y", 2.0), ("b", "x", 1.0), ("c", "z", 5.0), ("c", "x", 3.0), ("c", "x", 4.0)]
    fact = factorize.factorize(spark.createDataFrame(rows, "user_id string, movie_id string, rating double"), n_factors=None)
    got = {(r["user_id"], r["movie_id"]): (r["rating"], r["prediction"]) for r in factorize.predicted(fact).collect()}
    assert got.keys() == {("a", "x"), ("a", "y"), ("b", "x"), ("c", "z"), ("c", "x")}
    assert all(abs(a - b) < 1e-9 for a, b in got.values()) and got["c", "x"][0] == 3.5


def test_blocks_are_sent_to_tiles_not_to_every_block(spark, monkeypatch):
    monkeypatch.setattr(topk, "USER_BLOCK", 1)
    monkeypatch.setattr(topk, "ITEM_BLOCK", 1)
    monkeypatch.setattr(topk, "TILES", 4, raising=False)
    rng = np.random.default_rng(2)
    u, v = rng.integers(-3, 4, (40, 3)).astype(float), rng.integers(1, 4, (40, 3)).astype(float)
    users, items = _frames(spark, u, v)
    sent, join = [], type(users).join

    def counted(self, other, *a, **k):
        if "_items" in self.columns + other.columns:
            sent.extend([self.count(), other.count()])
        return join(self, other, *a, **k)
    monkeypatch.setattr(type(users), "join", counted)
    seen = [(k, k) for k in range(40)]
    best, _ = topk.top_items(users, items, 3, spark.createDataFrame(seen, "u_row bigint, i_col bigint"))
    assert _lists(best, 40) == _dense(u, v, 3, seen)
    assert sent and sum(sent) < 40 * 40 / 4


def test_rounds_of_the_search_are_bounded_by_what_they_send(spark, monkeypatch):
    """A round takes as many blocks as it may send; only the last lists stay stored."""
    from pathlib import Path
    from urllib.parse import urlparse
    monkeypatch.setattr(topk, "USER_BLOCK", 16)
    monkeypatch.setattr(topk, "ITEM_BLOCK", 4)
    monkeypatch.setattr(topk, "SHARE", 2)
    monkeypatch.setattr(topk, "TILES", 4)
    monkeypatch.setattr(topk, "ROUND_BYTES", 1, raising=False)
    rng = np.random.default_rng(7)
    u, v = rng.integers(-3, 4, (40, 3)).astype(float), rng.integers(-3, 4, (50, 3)).astype(float)
    users, items = _frames(spark, u, v)
    folder = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)
    before = set(folder.iterdir())
    best, told = topk.top_items(users, items, 6)
    assert _lists(best, 40) == _dense(u, v, 6)
    assert told["rounds"] == 7  # 13 blocks: 1, then 2 at a time
    tables = [f for f in set(folder.iterdir()) - before if f.name.startswith("stored-")]
    assert len(tables) == 2  # the lists, and the items' order


def test_best_of_a_block_keeps_ties_and_bars():
    rng = np.random.default_rng(3)
    for k in (1, 3, 20):
        scores = rng.integers(-4, 5, (30, 12)).astype(float)
        scores[rng.random(scores.shape) < 0.1] = -np.inf
        items, least = rng.permutation(12), np.where(rng.random(30) < 0.5, -np.inf, rng.integers(-4, 5, 30).astype(float))
        row, item, value = topk._best(scores, items, least, k)
        for r in range(30):
            order = [c for c in np.lexsort((items, -scores[r])) if np.isfinite(scores[r, c])][: min(k, 12)]
            want = [(int(items[c]), scores[r, c]) for c in order if scores[r, c] >= least[r]]
            assert [(int(i), x) for i, x in zip(item[row == r], value[row == r], strict=True)] == want
