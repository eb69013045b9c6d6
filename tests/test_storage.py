"""Stage tables: stored by columns, winners in one shuffle, no mining for baskets alone."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tastemine.operators import cleaning as C
from tastemine.operators import impute as I
from tastemine.operators import integrate as U
from tastemine.operators import rules as R
from tastemine.operators.indexing import dense_index
from tastemine.plans import catalog
from tastemine.plans.pipeline import Stages


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_table_is_broadcast_without_a_shuffle(spark):
    from tastemine.session import stored
    small = stored(spark.createDataFrame([("a", [1]), (None, None)], "k string, v array<int>"))
    assert rows(small, ["k"]) == [{"k": None, "v": None}, {"k": "a", "v": [1]}]
    big = spark.range(1000).select(F.when(F.col("id") % 2 == 0, F.lit("a")).alias("k"))
    codes = dense_index(small.select("k"), ["k"], "code")
    for right in (small, codes):
        joined = big.join(right, big["k"].eqNullSafe(right["k"]), "left")
        assert "BroadcastHashJoin" in _plan(joined) and "hashpartitioning" not in _plan(joined)
        assert joined.count() == 1000


def test_dense_index_of_many_and_of_no_rows(spark):
    df = spark.range(1000).repartition(16).withColumn("more", F.lit("x"))
    got = dense_index(df, [F.desc("id")], "at", keep=["id"])
    assert got.columns == ["id", "at"]
    assert {r["id"]: r["at"] for r in got.collect()} == {i: 999 - i for i in range(1000)}
    assert dense_index(df.where("false"), ["id"], "at").count() == 0


def test_winners_are_kept_whole_in_one_shuffle(spark):
    """One key holds most rows, another is null; tasks pass on their own winners only."""
    df = spark.createDataFrame([(None if k == 1 else k if k % 3 == 0 else 1, "m", float(k), k) for k in range(3000)], "user_id long, movie_id string, rating double, row_ord long")
    last = C.keep_ranked(df, ["user_id", "movie_id"], F.desc("row_ord"))
    plan = _plan(last)
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1
    got = {r["user_id"]: (r["rating"], r["row_ord"]) for r in last.collect()}
    assert got[1] == (2999.0, 2999) and got[3] == (3.0, 3) and got[None] == (1.0, 1) and len(got) == 1002


def test_complete_rows_are_imputed_without_a_shuffle(spark):
    df = spark.createDataFrame([(i % 50, f"t{i % 50}", "x" if i else None, "Drama") for i in range(500)], "movie_id long, movie_title string, cast string, genres string")
    out = I.impute_by_mode(df)
    complete, missing = _plan(out).split("Union", 1)[1].split("\n   +- ", 1)
    assert "Exchange" not in complete and "Join" in missing
    assert out.where("cast = 'x'").count() == 500 and out.columns == df.columns


@pytest.fixture
def tables(spark, tmp_path):
    day = datetime.date(1995, 1, 1)
    spark.createDataFrame([(o, p, 1, n, 5.0 + o + n, 1.0, 0.0, 0.0, "N", "O", day) for o in range(40) for n, p in enumerate((1, 2, 1 + o % 5))],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                          "l_tax double, l_returnflag string, l_linestatus string, l_shipdate date").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(o, o % 7) for o in range(40)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(p, f"part {p}", "STEEL", "B") for p in range(1, 6)], "p_partkey long, p_name string, p_type string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, "Supplier#1")], "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    return str(tmp_path)


def test_basket_shape_mines_nothing(spark, tables, monkeypatch):
    def mine(*a, **k):
        raise AssertionError("mined")
    monkeypatch.setattr(R, "frequent_itemsets", mine)
    r = catalog.q_basket_shape(spark, tables).first()
    assert (r["items"], r["baskets"]) == (5, 40) and r["mean_size"] == (16 * 2 + 24 * 3) / 40


def test_encoded_rows_are_stored_without_the_wide_block(spark, tables):
    st = Stages.of(spark, tables)
    enc, split = st.encoded(), st.split()
    wide = [f"genre_{g.replace(' ', '_')}" for g in enc.genre_vocab]
    assert enc.genre_vocab and set(wide) <= set(enc.df.columns) and "split" not in enc.df.columns
    assert split.columns == [*enc.df.columns, "split"] or set(split.columns) == {*enc.df.columns, "split"}
    scanned = split._jdf.queryExecution().optimizedPlan().collectLeaves().head().schema().fieldNames()
    assert not set(wide) & set(scanned)
    assert split.count() == enc.df.count() > 0


def _itemsets(b, support):
    return {(tuple(r["items"]), r["freq"], round(r["support"], 12)) for r in R.frequent_itemsets(b, support).collect()}


@pytest.mark.parametrize("support", [0.0, 0.02, 0.2])
def test_short_baskets_are_mined_without_trees(spark, monkeypatch, support):
    import numpy as np
    rng = np.random.default_rng(3)
    baskets = [(t, sorted({f"i{k}" for k in rng.zipf(1.6, 5) if k < 15})) for t in range(300)] + [(300, []), (301, None)]
    b = spark.createDataFrame(baskets, "t long, items array<string>")
    with monkeypatch.context() as m:
        m.setattr(R, "SUBSETS", 0)
        expected = _itemsets(b, support)

    def trees(*a, **k):
        raise AssertionError("FP-Growth over short baskets")
    monkeypatch.setattr(R, "FPGrowth", trees)
    assert _itemsets(b, support) == expected and max(len(x[0]) for x in expected) >= 2
    assert R.frequent_itemsets(b.where("false"), support).count() == 0
    long = spark.createDataFrame([([f"i{k}" for k in range(30)],)], "items array<string>")
    with pytest.raises(AssertionError):
        R.frequent_itemsets(long, 0.5)


def test_both_dedups_of_the_cleaning_share_one_shuffle(spark):
    data = [(u, m, f"t{m}", r, "Drama", "c", "1999", "en", k) for k, (u, m, r) in enumerate(
        [("a", 1, 1.0), ("a", 1, 2.0), ("a", 1, 1.0), (None, 1, 3.0), (None, 1, 3.0), ("b", 2, 4.0)])]
    df = spark.createDataFrame(data, ", ".join(f"{c} {t}" for c, t in C.COMMON_SCHEMA[:8]) + ", row_ord long")
    exact = C.drop_exact_duplicates(df, count_col="n", within=C.KEY_COLUMNS)
    kept = C.keep_ranked(exact, C.KEY_COLUMNS, F.desc("row_ord"))
    assert _plan(kept).count("Exchange hashpartitioning") == 1
    assert {(r["user_id"], r["movie_id"]): (r["rating"], r["row_ord"], r["n"]) for r in kept.collect()} == {
        ("a", 1): (2.0, 1, 1), (None, 1): (3.0, 3, 2), ("b", 2): (4.0, 5, 1)}
    assert exact.agg(F.sum("n")).first()[0] == 6 and exact.count() == 4


def test_integrated_rows_are_shuffled_without_the_lists_that_are_parsed_anew(spark, tables):
    st = Stages.of(spark, tables)
    whole, rows_ = st.integrated().df, st.integrated_table()
    assert rows_.schema.names == whole.schema.names and [f.dataType for f in rows_.schema] == [f.dataType for f in whole.schema]
    scanned = rows_._jdf.queryExecution().optimizedPlan().collectLeaves().head().schema().fieldNames()
    assert not set(I.REBUILT_COLUMNS) & set(scanned) and set(whole.columns) - set(I.REBUILT_COLUMNS) == set(scanned)
    expected = I.transform(whole, drop_identical=False)
    got = I.transform(rows_, drop_identical=False)
    assert got.columns == expected.columns and expected.where("genre_count > 0").count() > 0
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_the_rating_chain_keeps_neither_shuffles_nor_superseded_rows(spark, tables):
    """A stage's shuffles go when its table is stored, and so do the rows that only led to the next table."""
    import time
    from pathlib import Path
    from urllib.parse import urlparse

    from tastemine.session import release
    release(spark)
    folder = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)
    shuffles, stored_before = _shuffle_files(spark), set(folder.iterdir())
    st = Stages(spark, tables)
    st.integrated_table()
    for _ in range(50):
        if not (left := _shuffle_files(spark) - shuffles):
            break
        time.sleep(0.2)
    assert not left
    kept = [set(spark.read.parquet(str(f)).columns) for f in set(folder.iterdir()) - stored_before if f.name.startswith("stored-")]
    assert {*C.COMMON_COLUMNS[:8], "row_ord"} not in kept  # deduplicated, not yet parsed
    whole = Stages(spark, tables)
    before = set(folder.iterdir())
    assert whole.split().count() == st.split().count() > 0  # st has its integrated rows still
    kept = [set(spark.read.parquet(str(f)).columns) for f in set(folder.iterdir()) - before if f.name.startswith("stored-")]
    assert not [c for c in kept if {"source", "genres"} <= c and "genres_list" not in c]
    assert sorted(map(str, st.integrated_table().collect())) == sorted(map(str, whole.integrated_table().collect()))


def test_frames_with_one_row_a_key_meet_by_their_keys(spark):
    schema = "user_id string, movie_id long, rating double, genres string, row_ord long"
    a = spark.createDataFrame([("a", 1, 2.0, "x", 3), ("b", 1, None, "x", 4), (None, 2, 5.0, "x", 5), ("c", 3, 0.0, None, 6)], schema)
    b = spark.createDataFrame([("a", 1, 2.0, "y", 1), ("a", 2, 2.0, "y", 2), ("b", 1, None, "y", 3), (None, 2, 5.0, "y", 4), ("c", 3, 1.0, "y", 5), ("c", 4, -0.0, "y", 6)], schema)
    c = spark.createDataFrame([("a", 2, 2.0, "z", 1), ("d", 2, 2.0, "z", 2), ("c", 3, 0.0, "z", 3)], schema)
    frames = {"A_x": a, "B_x": b, "C_x": c}
    ranked, met = U.integrate(frames), U.integrate(frames, unique=("user_id", "movie_id"))
    assert met.df.columns == ranked.df.columns
    assert sorted(map(str, met.df.collect())) == sorted(map(str, ranked.df.collect())) and met.df.count() == 8
    assert met.stats.collect() == ranked.stats.collect()
    assert "Window" in _plan(ranked.df) and "Window" not in _plan(met.df)
    # not unique by the keys that count: ranked as before
    assert "Window" in _plan(U.integrate(frames, unique=("user_id", "genres")).df)


def test_split_of_users_reaches_the_rows_with_their_code(spark, tables, monkeypatch):
    """No join of whole rows for the split alone, and the rounds of a large table make the same rows."""
    from tastemine.operators import encode as E
    from tastemine.operators import split as S
    from tastemine.plans import pipeline
    sized = []
    operator = S.group_split
    monkeypatch.setattr(S, "group_split", lambda df, col, **kw: (sized.append(df.count()), operator(df, col, **kw))[1])
    one = Stages(spark, tables)
    split = one.split()
    users = split.select("user_idx").distinct().count()
    assert sized == [users] and split.count() > users
    enc = E.preprocess_features(one.transformed()).df
    expected = operator(enc, "user_idx")
    assert split.columns[: len(expected.columns)] == expected.columns
    table = sorted(map(str, expected.collect()))
    assert sorted(map(str, split.select(*expected.columns).collect())) == table
    monkeypatch.setattr(pipeline, "rounds_for", lambda rows: 3)
    again = Stages(spark, tables).split()
    assert sorted(map(str, again.select(*expected.columns).collect())) == table
    assert E.genre_vocabulary(again) == E.genre_vocabulary(split)
