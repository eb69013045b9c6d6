"""Hand-made edge cases of FIXTURES.md section 3 (cleaning, parsing, integration)."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tastemine.functions import genres as G
from tastemine.functions.text import standard_year
from tastemine.operators import cleaning as C
from tastemine.operators import integrate as U
from tastemine.operators import quality as Q

RAW = "row_ord long, user_id string, movie_id long, movie_title string, rating double, genres string, cast string, " \
      "release_year string, language string"


def _raw(spark, data):
    return spark.createDataFrame(data, RAW)


def test_dedup_order_t1(spark):
    # A(1), B(2), A again(3), same key: exact dedup keeps A(1); keep-last then picks B
    a = (1, "u1", 10, "t", 5.0, "Drama", "x", "2000", "en")
    b = (2, "u1", 10, "t", 6.0, "Drama", "x", "2000", "en")
    a2 = (3,) + a[1:]
    out = C.clean_dataset(_raw(spark, [a, b, a2])).df
    assert [r["rating"] for r in rows(out)] == [6.0]


def test_dedup_before_null_drop_t2(spark):
    good = (1, "u1", 10, "t", 8.0, "Drama", "x", "2000", "en")
    bad = (2, "u1", 10, "t", None, "Drama", "x", "2000", "en")
    res = C.clean_dataset(_raw(spark, [good, bad]))
    assert res.df.count() == 0
    st = rows(res.stats)[0]
    assert st["rows_before"] == 2 and st["rows_after"] == 0
    assert st["dropped_exact_duplicates"] == 0 and st["dropped_missing_core_fields"] == 2


def test_clean_trims_lowercases_and_filters_language(spark):
    data = [
        (1, " u1 ", 10, "t", 7.0, "Drama", "x", "2000", " EN "),
        (2, "u2", 11, "t", 7.0, "Drama", "x", "2000", "fr"),
        (3, "u3", 12, "t", 7.0, "Drama", "x", "2000", None),
        (4, "u4", 13, "t", 7.0, "", "x", "2000", "en"),
        (5, "u5", 14, "t", 7.0, "Drama", None, "2000", "en"),
        (6, "u6", 15, "t", 7.0, "Drama", "x", "2000", "en "),
    ]
    res = C.clean_dataset(_raw(spark, data))
    got = rows(res.df, ["user_id"])
    assert [r["user_id"] for r in got] == ["u1", "u6"]
    assert all(r["language"] == "en" for r in got)
    st = rows(res.stats)[0]
    assert (st["dropped_null_core"], st["dropped_empty_genres"], st["dropped_language"]) == (1, 1, 2)


@pytest.mark.parametrize("text,clean,transform", [
    ("Action|Sci-Fi", ["action", "science fiction"], ["action", "science fiction"]),
    ('["Action","Sci-Fi"]', ["action", "science fiction"], ["action", "science fiction"]),
    ("['Action','Sci-Fi']", ["action", "science fiction"], ["action", "science fiction"]),
    ('[{"id":1,"name":"Action"}]', ["action"], ["action"]),
    ("[]", [], []),
    ("", [], []),
    (None, [], []),
    ("Sci-Fi & Fantasy", ["sci fi & fantasy"], ["sci fi & fantasy"]),
    ("[1, 2]", ["1", "2"], ["1", "2"]),
    ("Science_Fiction, Drama/Comedy; War", ["science fiction", "drama", "comedy", "war"],
     ["science fiction", "drama", "comedy", "war"]),
    ("sci-fi-fantasy", ["science fiction"], ["science fiction"]),
])
def test_genre_parsers(spark, text, clean, transform):
    df = spark.createDataFrame([(text,)], "g string")
    r = df.select(G.parse_genres_clean(F.col("g")).alias("c"), G.parse_genres_transform(F.col("g")).alias("t")).first()
    assert r["c"] == clean
    assert r["t"] == transform


def test_notebook_parser_pipe_first(spark):
    df = spark.createDataFrame([("Action|Drama, War",), ("Action, Drama",)], "g string")
    got = [r[0] for r in df.select(G.parse_genres_notebook(F.col("g"))).collect()]
    assert got == [["action", "drama, war"], ["action", "drama"]]


def test_dict_without_name_falls_back_to_text(spark):
    df = spark.createDataFrame([('[{"id": 1}]',)], "g string")
    got = df.select(G.parse_genres_clean(F.col("g"))).first()[0]
    assert got == ['[{"id": 1}]']


@pytest.mark.parametrize("text,year", [
    ("2019", 2019), ("2019-05-03", 2019), ("1500", None), ("abc", None), ("1870", 1870), ("2100", 2100),
    ("2019.0", 2019), (None, None),
])
def test_year(spark, text, year):
    df = spark.createDataFrame([(text,)], "y string")
    assert df.select(standard_year(F.col("y"), df.schema["y"].dataType)).first()[0] == year


def test_half_step(spark):
    df = spark.createDataFrame([(7.5,), (7.0,), (7.49,), (10.0,), (None,)], "rating double")
    got = [r[0] for r in C.adjust_half_step(df).collect()]
    assert got == [8.0, 7.0, 7.49, 10.0, None]


@pytest.mark.parametrize("values,ratio,verdict", [
    ([3, 5, 8], 1.0, "balanced"),
    ([8, 8, 8], 0.0, "imbalanced"),
    ([3, 3, 5, 5, 8], 0.5, "moderately-imbalanced"),
    ([], None, "cannot-evaluate"),
])
def test_rating_balance(spark, values, ratio, verdict):
    df = spark.createDataFrame([(float(v),) for v in values], "rating double")
    r = Q.rating_balance(df).first()
    assert r["ratio"] == ratio and r["verdict"] == verdict


def test_integrate_first_source_wins(spark):
    cols = "row_ord long, user_id string, movie_id long, rating double, cast string"
    a = spark.createDataFrame([(1, "u1", 1, 7.0, "from A")], cols)
    b = spark.createDataFrame([(1, "u1", 1, 7.0, "from B"), (2, "u1", 1, 7.0, "from B")], cols)
    res = U.integrate({"TMDB_cleaned": a, "Trakt_cleaned": b})
    assert [r["cast"] for r in rows(res.df)] == ["from A"]
    st = rows(res.stats)[0]
    assert (st["tmdb_rows"], st["trakt_rows"], st["merged_before_dedup"], st["merged_after_exact_dedup"],
            st["merged_after_key_dedup"]) == (1, 2, 3, 2, 1)


def test_drop_identical_columns(spark):
    df = spark.createDataFrame([(1, 1.0, "a", "a", None, None), (2, 2.0, "b", "b", 1, None)],
                               "a int, b double, c string, d string, e int, f int")
    out, dropped = C.drop_identical_columns(df, protect=())
    assert dropped == ["b", "d"]
    assert out.columns == ["a", "c", "e", "f"]


def test_dedupe_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("a", "b", "a")
    out = C.dedupe_column_names(df)
    assert out.columns == ["a", "b"] and out.first()["a"] == 1


def test_infer_cluster_column_and_affix(spark):
    from tastemine.functions.text import columns_by_affix, infer_cluster_column
    df = spark.createDataFrame([(1, 2, 3)], "user_idx int, user_cluster int, z int")
    assert infer_cluster_column(df) == "user_cluster"
    assert infer_cluster_column(df.drop("user_cluster")) == "z"
    cols = ["genre_a", "genre_count", "genre_count_scaled", "x_pref", "genre_b_pref"]
    assert columns_by_affix(cols, prefix="genre_", exclude=("genre_count_scaled",)) == ["genre_a", "genre_count", "genre_b_pref"]
    assert columns_by_affix(cols, suffix="_pref") == ["x_pref", "genre_b_pref"]


def test_key_dedup_hot_key_and_plan(spark):
    """One key holds most rows; the plan groups by hash and sorts nothing to find a winner."""
    df = spark.createDataFrame([(1 if k % 3 else k, "m", float(k), k) for k in range(3000)], "user_id long, movie_id string, rating double, row_ord long")
    last = C.keep_last_by_key(df, ["user_id", "movie_id"], "row_ord")
    got = {r["user_id"]: r["row_ord"] for r in last.collect()}
    assert got[1] == 2999 and got[3] == 3 and len(got) == 1001
    first = {r["user_id"]: r["row_ord"] for r in C.keep_first_by_key(df, ["user_id", "movie_id"], "row_ord").collect()}
    assert first[1] == 1
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
