"""Rules, lookups, clustering and factorization: edge cases and invariants
(FIXTURES.md sections 3-4)."""


import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from conftest import rows
from tastemine.operators import cluster as K
from tastemine.operators import factorize as R
from tastemine.operators import lookup as L
from tastemine.operators import rules as M


@pytest.fixture(scope="module")
def toy_rules(spark):
    tx = [(1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "b"), (2, "c"), (3, "a"), (4, "d")]
    df = spark.createDataFrame(tx, "t long, item string")
    b = M.baskets(df, "t", "item")
    fi = M.frequent_itemsets(b, 0.3)
    return fi, M.association_rules(fi, min_lift=None)


def test_rules_multi_item_consequents(toy_rules):
    fi, rules = toy_rules
    assert fi.count() == 7
    r = {("|".join(x["antecedents"]), "|".join(x["consequents"])): x for x in rows(rules)}
    assert len(r) == 12  # 3 pairs x 2 + one triple x 6
    bc_a = r[("b|c", "a")]
    assert abs(bc_a["lift"] - 4 / 3) < 1e-12
    assert bc_a["conviction"] is None and bc_a["conviction_inf"] is True
    assert ("a", "b|c") in r


def test_rules_min_support_ceiling(spark):
    df = spark.createDataFrame([(t, i) for t in range(10) for i in (["x", "y"] if t < 3 else ["x"])],
                               "t long, item string")
    fi = M.frequent_itemsets(M.baskets(df, "t", "item"), 0.3)
    assert sorted("|".join(r["items"]) for r in fi.collect()) == ["x", "x|y", "y"]


def test_item_dictionary_last_first_seen(spark):
    df = spark.createDataFrame([(1, 1, "X"), (2, 1, "Y"), (3, 1, "X")], "row_ord long, movie_id long, movie_title string")
    assert M.item_dictionary(df).first()["movie_title"] == "Y"


def test_title_matches_equal_brute_force(spark):
    titles = ["small ring", "Red Widget", "blue widget", "ab", "a", "", None, "x%y_z", "widget"]
    queries = ["red widget", "WIDG", "zzz", "a", "AB", "ing", "%y", "", None, "widget red", "et"]
    q = spark.createDataFrame([(x,) for x in queries], "query string")
    t = spark.createDataFrame([(x,) for x in titles], "title string")
    got = {(r["query"], r["title"]): r["score"] for r in L.match_titles(q, t).collect()}
    expected = {(x, y): 2.0 if x.lower() == y.lower() else 1.5
                for x in queries if x for y in titles if y is not None and x.lower() in y.lower()}
    assert got == expected


def test_rule_lookup(spark, toy_rules):
    _, rules = toy_rules
    q = spark.createDataFrame([("A",), ("zzz",)], "query string")
    out = rows(L.rule_recommendations(q, rules), ["rank"])
    assert {r["query"] for r in out} == {"A"}
    assert all(r["movie_title"].lower() != "a" for r in out)
    assert [r["rank"] for r in out] == list(range(1, len(out) + 1))
    assert all(r["searched_movie"] == "a" for r in out)


def test_cold_start(spark):
    recs = spark.createDataFrame([("u1", i, f"t{i}", 1.0, i) for i in range(1, 11)] +
                                 [("u2", i, f"t{i}", 1.0, i) for i in range(3, 13)],
                                 "user_id string, movie_id long, movie_title string, score double, rank int")
    req = spark.createDataFrame([("u1",), ("new",), (L.NEW_USER,)], "user_id string")
    out = L.recommendations_for(req, recs, cold_start="absent")
    new = rows(out.filter(F.col("user_id") == "new"), ["rank"])
    assert [r["rank"] for r in new] == list(range(1, 11))
    assert new[0]["movie_title"] == "t10" and new[0]["score"] == 2.0
    sentinel = L.recommendations_for(req, recs, cold_start="sentinel")
    assert sentinel.filter(F.col("user_id") == "new").count() == 0
    assert sentinel.filter(F.col("user_id") == L.NEW_USER).count() == 10


def _blobs(spark, n=60, seed=0):
    rnd = np.random.default_rng(seed)
    pts = np.vstack([rnd.normal(c, 0.5, size=(n, 3)) for c in ([0, 0, 0], [5, 5, 0], [0, 6, 6])])
    labels = np.repeat([0, 1, 2], n)
    df = spark.createDataFrame([(i, [float(v) for v in p], int(l)) for i, (p, l) in enumerate(zip(pts, labels))],
                               "id long, x array<double>, label int")
    return df, pts, labels


def test_cluster_indices_match_numpy(spark):
    df, pts, lab = _blobs(spark)
    sil = K.silhouette_sq(df, "x", "label").first()[0]
    db = K.davies_bouldin(df, "x", "label").first()[0]
    ch = K.calinski_harabasz(df, "x", "label").first()[0]
    ks = np.unique(lab)
    mu = np.array([pts[lab == k].mean(0) for k in ks])
    d2 = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(len(pts)):
        own = lab == lab[i]
        a = d2[i, own].sum() / (own.sum() - 1)
        b = min(d2[i, lab == k].mean() for k in ks if k != lab[i])
        s.append((b - a) / max(a, b))
    assert abs(sil - np.mean(s)) < 1e-9
    spread = np.array([np.linalg.norm(pts[lab == k] - mu[k], axis=1).mean() for k in ks])
    dbn = np.mean([max((spread[i] + spread[j]) / np.linalg.norm(mu[i] - mu[j]) for j in ks if j != i) for i in ks])
    assert abs(db - dbn) < 1e-9
    g = pts.mean(0)
    B = sum((lab == k).sum() * ((mu[k] - g) ** 2).sum() for k in ks)
    W = sum(((pts[lab == k] - mu[k]) ** 2).sum() for k in ks)
    assert abs(ch - (B / 2) / (W / (len(pts) - 3))) < 1e-6


def test_kmeans_sweep_invariants(spark):
    df, _, _ = _blobs(spark, n=30, seed=1)
    feats = df.select("id", array_to_vector("x").alias("features"))
    sw = K.k_sweep(feats, k_values=range(2, 5), n_init=3, parallel=4)
    t = rows(sw.table, ["k"])
    inertia = [r["inertia"] for r in t]
    assert inertia == sorted(inertia, reverse=True)
    best = max(t, key=lambda r: (r["silhouette"], -r["k"]))["k"]
    assert sw.best_k == best == 3
    labels = K.relabel_by_size(sw.models[3].transform(feats))
    assert labels.select("user_cluster").distinct().count() == 3


def test_standard_scale_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    got = [r["x"] for r in K.standard_scale(df, ["x"]).collect()]
    sd = np.std([1, 2, 4])
    assert np.allclose(got, (np.array([1, 2, 4]) - 7 / 3) / sd)


def test_svd_invariants_and_topk(spark):
    rnd = np.random.default_rng(3)
    data = [(f"u{u:02d}", int(i), float(rnd.integers(1, 11))) for u in range(30) for i in rnd.choice(40, 8, replace=False)]
    df = spark.createDataFrame(data, "user_id string, movie_id long, rating double")
    fact = R.factorize(df, n_factors=5)  # randomized (the reference's algorithm)
    v = np.array([r["factors"] for r in fact.items.orderBy("i_col").collect()])
    assert np.allclose(v.T @ v, np.eye(fact.n_factors), atol=1e-6)
    # dense reference
    users = sorted({d[0] for d in data})
    items = sorted({d[1] for d in data})
    a = np.zeros((len(users), len(items)))
    for u, i, r in data:
        a[users.index(u), items.index(i)] = r
    s_np = np.linalg.svd(a, compute_uv=False)[:5]
    assert np.allclose(sorted(fact.sigma, reverse=True), s_np, rtol=1e-4)
    assert np.sum(a ** 2) >= np.sum(np.array(fact.sigma) ** 2) - 1e-6
    recs = R.recommend(fact, k=10, exclude_seen=True)
    per = {}
    for r in recs.collect():
        per.setdefault(r["user_id"], []).append((r["rank"], r["score"], r["movie_id"]))
    seen = {(u, i) for u, i, _ in data}
    for u, lst in per.items():
        lst.sort()
        assert [x[0] for x in lst] == list(range(1, len(lst) + 1)) and len(lst) <= 10
        sc = [x[1] for x in lst]
        assert sc == sorted(sc, reverse=True)
        assert not any((u, x[2]) in seen for x in lst)
    err = R.reconstruction_error(fact).first()
    assert err["rmse"] >= 0 and err["rmse_all_cells"] >= 0


@pytest.mark.parametrize("rows", [50, 10_000])
def test_svd_matches_numpy_whatever_the_batches(spark, rows):
    """Singular values and top lists against dense NumPy, with many items and tiny Arrow batches."""
    rnd = np.random.default_rng(8)
    n_users, n_items = 150, 20_000
    taste, shape = rnd.gamma(1.0, 1.0, (n_users, 6)), rnd.gamma(1.0, 1.0, (6, n_items))
    full = taste @ shape
    data = [(f"u{u:03d}", int(i), float(full[u, i])) for u in range(n_users) for i in rnd.choice(n_items, 400, replace=False)]
    data += [(f"u{n_users - 1:03d}", i, 1.0) for i in range(n_items) if i % 7 == 0]
    df = spark.createDataFrame(data, "user_id string, movie_id long, rating double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        fact = R.factorize(df, n_factors=20)
        cells = {(r["user_id"], r["movie_id"]): r["rating"] for r in R.rating_matrix(df).collect()}
        users, items = sorted({u for u, _ in cells}), sorted({i for _, i in cells})
        at_u, at_i = {u: k for k, u in enumerate(users)}, {i: k for k, i in enumerate(items)}
        a = np.zeros((len(users), len(items)))
        for (u, i), x in cells.items():
            a[at_u[u], at_i[i]] = x
        s = np.linalg.svd(a, compute_uv=False)
        assert np.allclose(fact.sigma[:10], s[:10], rtol=2e-2) and abs(fact.sigma[0] / s[0] - 1) < 1e-6
        us = np.array([r["factors"] for r in fact.users.orderBy("u_row").collect()])
        v = np.array([r["factors"] for r in fact.items.orderBy("i_col").collect()])
        assert np.allclose(v.T @ v, np.eye(20), atol=1e-6)
        assert np.allclose(np.linalg.norm(us, axis=0), fact.sigma, rtol=1e-6)
        scores = us @ v.T
        got = {}
        for r in R.recommend(fact, k=10).collect():
            got.setdefault(r["user_id"], {})[r["rank"]] = r["movie_id"]
        for k, u in enumerate(users):
            best = np.lexsort((np.arange(len(items)), -scores[k]))[:10]
            same = sum(items[j] == got[u][n + 1] for n, j in enumerate(best))
            assert same >= 9, (u, same)  # scores that agree in the last digits may change places
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rules_of_long_itemsets_are_opened_in_steps(spark, monkeypatch):
    from tastemine.operators import rules

    items = [f"i{k}" for k in range(7)]
    sets = [([x for k, x in enumerate(items) if m >> k & 1], (8 - m.bit_count()) / 10) for m in range(1, 128)]
    df = spark.createDataFrame(sets, "items array<string>, support double")
    found = []
    for bits in (10, 3):
        monkeypatch.setattr(rules, "MASK_BITS", bits)
        found.append(sorted((r["antecedents"], r["consequents"], r["support"]) for r in rules.association_rules(df, None).collect()))
    assert found[0] == found[1]
    assert len(found[0]) == sum(2 ** len(s) - 2 for s, _ in sets) == len({(*a, "|", *c) for a, c, _ in found[0]})


def test_kmeans_does_not_depend_on_the_input_partitions(spark):
    df, _, _ = _blobs(spark, n=60, seed=4)
    feats = df.select("id", array_to_vector("x").alias("features"))
    costs = {round(K.fit_kmeans(feats.repartition(n), 3, n_init=2).cost, 9) for n in (1, 5, 16)}
    assert len(costs) == 1
