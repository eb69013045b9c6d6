"""Sketches merged are sketches built whole, and their error."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemine.operators import sketch


def test_merged_is_built_whole_and_near_the_exact_count(spark):
    df = spark.range(0, 400_000, 1, 8).select(
        (F.col("id") % 4).alias("a"), (F.col("id") % 3).alias("b"), F.when(F.col("id") % 10 > 0, F.concat(F.lit("user "), (F.xxhash64("id") % 100_000).cast("string"))).alias("v"))
    fine = sketch.sketch(df, ["a", "b"], "v")
    for by in (["a"], ["b"], ["a", "b"]):
        merged = {tuple(r[c] for c in by): (r["k"], r["hashes"]) for r in sketch.merge(fine, by).collect()}
        assert merged == {tuple(r[c] for c in by): (r["k"], r["hashes"]) for r in sketch.sketch(df, by, "v").collect()}
        exact = {tuple(r[c] for c in by): r["n"] for r in df.groupBy(*by).agg(F.countDistinct("v").alias("n")).collect()}
        for r in sketch.merge(fine, by).select(*by, sketch.estimate().alias("e")).collect():
            n = exact[tuple(r[c] for c in by)]
            assert abs(r["e"] - n) < 0.02 * n
    rows = sketch.sketch(df, ["a"], "v").collect()
    assert all(len(r["hashes"]) == sketch.K and r["hashes"] == sorted(set(r["hashes"])) for r in rows)


def test_few_values_are_counted_exactly(spark):
    df = spark.createDataFrame([("x", "1"), ("x", "1"), ("x", "2"), ("y", None), (None, "é"), (None, "")], "g string, v string")
    got = {r["g"]: r["e"] for r in sketch.sketch(df, ["g"], "v", 4).select("g", sketch.estimate().alias("e")).collect()}
    assert got == {"x": 2.0, None: 2.0}
    assert sketch.sketch(df.where("false"), ["g"], "v").count() == 0
