"""Sources and sinks (IO1-IO9) round trips."""

import os

from pyspark.sql import functions as F

from tastemine.sources import files as IO


def test_csv_round_trip_with_null_tokens(spark, tmp_path):
    src = tmp_path / "in.csv"
    src.write_text('user_id,movie_id,movie_title,rating,genres,cast,release_year,language\n'
                   'u1,1,"A, ""quoted"" title",7.5,"[""Drama""]",x,2001,en\n'
                   'NA,2,b,n/a,null,,NaN,None\n')
    df = IO.read_csv(spark, str(src), schema=IO.RAW_SCHEMA, multi_line=True)
    r = sorted(df.drop("row_ord").collect(), key=lambda x: x["movie_id"])
    assert r[0]["movie_title"] == 'A, "quoted" title' and r[0]["genres"] == '["Drama"]'
    assert all(v is None for k, v in r[1].asDict().items() if k not in ("movie_id", "movie_title"))
    pruned = IO.read_csv(spark, str(src), schema=IO.RAW_SCHEMA, multi_line=True, columns=["user_id", "rating"])
    assert pruned.columns == ["user_id", "rating", "row_ord"]
    out = tmp_path / "out"
    IO.write_csv(df.withColumn("lst", F.array(F.lit("a"), F.lit("b"))).drop("row_ord"), str(out))
    back = spark.read.option("header", True).option("escape", "\"").csv(str(out))
    assert sorted(r["lst"] for r in back.collect()) == ['["a","b"]', '["a","b"]']


def test_parquet_json_sparse_and_paths(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "id long, l array<string>")
    IO.write_parquet(df, str(tmp_path / "p"))
    assert IO.read_parquet(spark, str(tmp_path / "p"), ["l"]).columns == ["l"]
    m = IO.metrics_frame(spark, {"num_rules": 3, "avg_lift": 1.5})
    IO.write_metrics(m, str(tmp_path / "m"))
    assert IO.read_metrics(spark, str(tmp_path / "m")).first()["num_rules"] == 3
    trip = spark.createDataFrame([(1, 3, 0.5), (1, 0, 1.0), (2, 1, 2.0)], "k long, i int, v double")
    IO.write_sparse(trip, "k", "i", "v", 5, str(tmp_path / "s"))
    got = {r["k"]: (r["indices"], r["values"]) for r in spark.read.parquet(str(tmp_path / "s")).collect()}
    assert got[1] == ([0, 3], [1.0, 0.5])
    os.makedirs(tmp_path / "second")
    assert IO.resolve_first_existing(spark, str(tmp_path), "first", "second") == str(tmp_path / "second")
    assert IO.resolve_first_existing(spark, str(tmp_path), "x", "y") == str(tmp_path / "x")
