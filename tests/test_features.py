"""Imputation, encoding, split and statistics edge cases (FIXTURES.md sections 3-4)."""

import math

from pyspark.sql import functions as F

from conftest import rows
from tastemine.operators import encode as E
from tastemine.operators import impute as I
from tastemine.operators import split as S
from tastemine.operators import stats as ST
from tastemine.operators.indexing import encode_labels, top_k_per_group


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([(1, "t", v) for v in ["b", "a", "b", "a"]] + [(1, "t", None)],
                               "movie_id long, movie_title string, cast string")
    out = I.impute_by_mode(df, columns=["cast"])
    assert sorted(r["cast"] for r in out.collect()) == ["a", "a", "a", "b", "b"]


def test_imputation_donors_t8(spark):
    # row 3 is filled from movie 1 ("x"); row 4 (movie 2, same title, blank) must
    # not use that filled value: its title donors are only original values -> unknown
    df = spark.createDataFrame([
        (1, 1, "t1", "x"), (2, 1, "t1", " "), (3, 2, "t2", None), (4, 3, "t2", ""),
    ], "id long, movie_id long, movie_title string, cast string")
    out = {r["id"]: r["cast"] for r in I.impute_by_mode(df, columns=["cast"]).collect()}
    assert out == {1: "x", 2: "x", 3: "unknown", 4: "unknown"}


def test_minmax_constant_is_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    got = [r["s"] for r in E.minmax_scale(df, {"s": F.col("x")}).collect()]
    assert got == [0.0, 0.0, 0.0]


def test_label_encode_as_string(spark):
    df = spark.createDataFrame([(100,), (2,), (30,), (2,)], "movie_id long")
    got = {r["movie_id"]: r["idx"] for r in encode_labels(df, "movie_id", "idx").collect()}
    assert got == {100: 0, 2: 1, 30: 2}


def test_tfidf_matches_formula(spark):
    df = spark.createDataFrame([(1, "A, B"), (2, "A"), (3, "c")], "k long, cast string")
    out = {(r["k"], r["term"]): r["weight"] for r in E.tfidf(df, "k").collect()}
    idf = {t: math.log((1 + 3) / (1 + d)) + 1 for t, d in {"a": 2, " b": 1, "c": 1}.items()}
    n1 = math.sqrt(idf["a"] ** 2 + idf[" b"] ** 2)
    assert abs(out[(1, "a")] - idf["a"] / n1) < 1e-12
    assert abs(out[(1, " b")] - idf[" b"] / n1) < 1e-12
    assert out[(2, "a")] == 1.0 and out[(3, "c")] == 1.0


def test_group_split_counts_and_disjoint(spark):
    df = spark.range(0, 3506).select(F.col("id").alias("user"), (F.col("id") % 7).alias("v"))
    df = df.unionByName(df)  # every user has two rows
    assign = S.group_assignment(df, "user")
    counts = {r["split"]: r["count"] for r in assign.groupBy("split").count().collect()}
    assert counts == {"train": 2454, "val": 526, "test": 526}
    again = {r["user"]: r["split"] for r in S.group_assignment(df, "user").collect()}
    assert again == {r["user"]: r["split"] for r in assign.collect()}
    labelled = S.group_split(df, "user")
    assert labelled.groupBy("user").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0


def test_threshold_split_is_stable(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "user")
    a = {r["user"]: r["split"] for r in S.group_assignment(df, "user", mode="threshold").collect()}
    b = {r["user"]: r["split"] for r in S.group_assignment(df.filter("user < 1000"), "user", mode="threshold").collect()}
    assert all(a[u] == s for u, s in b.items())


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 10]], "x double")
    got = [r["count"] for r in rows(ST.histogram(df, "x", 5), ["bin"])]
    assert got == [2, 1, 0, 0, 1]
    const = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r["count"] for r in rows(ST.histogram(const, "x", 3), ["bin"])] == [2, 0, 0]


def test_density_integrates_to_one(spark):
    import random
    rnd = random.Random(1)
    df = spark.createDataFrame([(rnd.gauss(0, 1),) for _ in range(400)], "x double")
    d = rows(ST.density(df, "x", 200), ["point"])
    lo, hi = d[0]["x"], d[-1]["x"]
    step = (hi - lo) / 199
    area = sum(r["density"] for r in d) * step
    assert 0.9 < area < 1.01


def test_describe_exact_quartiles(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "x double")
    r = ST.describe(df, ["x"]).first()
    assert (r["p25"], r["p50"], r["p75"]) == (1.75, 2.5, 3.25)
    assert abs(r["std"] - 1.2909944487358056) < 1e-12


def test_top_k_per_group(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    out = top_k_per_group(df, ["g"], [F.desc("v")], 2)
    got = sorted((r["g"], r["v"], r["rank"]) for r in out.collect())
    assert got == [(0, 996, 2), (0, 999, 1), (1, 994, 2), (1, 997, 1), (2, 995, 2), (2, 998, 1)]


def test_reduction_matches_numpy_pca(spark):
    import numpy as np
    from tastemine.operators.features import fit_reduction

    rnd = np.random.default_rng(5)
    base = rnd.normal(size=(300, 3))
    x = np.column_stack([base[:, 0], base[:, 0] * 2 + base[:, 1] * 0.1, base[:, 2], np.ones(300),
                         rnd.normal(size=300) * 0.01])
    cols = ["a", "b", "c", "const", "tiny"]
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in x], ", ".join(f"{c} double" for c in cols))
    red = fit_reduction(df, cols, kept_variance=0.95)
    assert "const" not in red.kept and "tiny" in red.kept  # scaled variance 1 > 0.01
    z = (x[:, [0, 1, 2, 4]] - x[:, [0, 1, 2, 4]].mean(0)) / x[:, [0, 1, 2, 4]].std(0)
    ev = np.sort(np.linalg.eigvalsh(np.cov(z.T, bias=True)))[::-1]
    ratios = ev / ev.sum()
    k = int(np.searchsorted(np.cumsum(ratios), 0.95, side="right") + 1)
    assert red.n_components == k and np.allclose(red.ratios, ratios[:k])
    proj = np.array([[r[f"pca_{i}"] for i in range(k)] for r in red.transform(df, []).collect()])
    assert np.allclose(proj.mean(0), 0, atol=1e-9)
    assert np.allclose(np.cov(proj.T, bias=True), np.diag(ev[:k]), atol=1e-9)
