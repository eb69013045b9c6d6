"""Adapter: derive rating-like interaction sources from the driver's test tables.

The reference consumes two user x movie rating files that are not shipped. The
test tables are TPC-H-like, so the interaction sources are *derived* from
``lineitem ⋈ orders ⋈ part ⋈ supplier`` with the fixed formulas of FIXTURES.md
section 2. Nulls, duplicates and every parse branch are injected by formula so
that the cleaning operators have something to do. The same formulas are
written as SQL in ``tastemine.plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemine.operators.indexing import dense_index
from tastemine.session import release

# the copy's number stands above a row's position in the order
COPY_SHIFT = 58
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# lineitem columns in table order: together with the copy number they totally
# order the rows ((l_orderkey, l_linenumber) alone is not unique).
LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
# those the sources are derived from
USED_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"]
ORDER_COL = "row_ord"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (Parquet, column pruning / pushdown by Catalyst)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ordered_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The used columns of ``lineitem`` with ``_pos``, the row's place in the
    order of all columns (the rows are distinct): the file position a real
    source would have, as one 64-bit number."""
    rows = dense_index(table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS), list(LINEITEM_COLUMNS), "_pos", USED_COLUMNS, "zstd")
    release(spark)
    return rows


def _base(spark: SparkSession, li: DataFrame, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    # Join strategy is left to AQE: dimension sides become broadcasts only when
    # their runtime size is under the threshold.
    return (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .join(part, li.l_partkey == part.p_partkey)
        .join(supp, li.l_suppkey == supp.s_suppkey)
    )


def _genres(pk: Column, t: Column, b: Column) -> Column:
    m5 = pk % 5
    return (
        F.when(pk % 29 == 0, F.lit(None).cast("string"))
        .when(pk % 31 == 0, F.lit(""))
        .when(m5 == 0, F.concat(t, F.lit("|"), b))
        .when(m5 == 1, F.concat(F.lit('["'), t, F.lit('", "Sci-Fi"]')))
        .when(m5 == 2, F.concat(F.lit("['"), t, F.lit("', 'Science_Fiction']")))
        .when(m5 == 3, F.concat(F.lit('[{"id": 1, "name": "'), t, F.lit('"}]')))
        .otherwise(F.concat(t, F.lit(", "), b, F.lit("/Drama")))
    )


def _interaction_columns(copy: int | Column, cast_name: str) -> list[Column]:
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    rating = F.when(
        (F.col("l_linenumber") == 7) & (F.col("l_orderkey") % 5 == 0), F.lit(None).cast("double")
    ).otherwise(F.lit(0.5) * (F.lit(1.0) + F.col("l_quantity") % 20))
    cast = F.when((sk + pk) % 17 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.col("s_name"), F.lit(", Supplier#"), (sk % 7).cast("string"))
    )
    year = (
        F.when(pk % 13 == 0, F.lit("1500"))
        .when(pk % 11 == 0, F.lit(None).cast("string"))
        .when(pk % 7 == 0, F.date_format("l_shipdate", "yyyy-MM-dd"))
        .otherwise(F.year("l_shipdate").cast("string"))
    )
    language = (
        F.when(pk % 10 == 0, F.lit("fr"))
        .when(pk % 10 == 1, F.lit(" EN "))
        .when(pk % 23 == 0, F.lit(None).cast("string"))
        .otherwise(F.lit("en"))
    )
    return [
        (F.shiftleft((copy if isinstance(copy, Column) else F.lit(copy)).cast("bigint"), COPY_SHIFT) + F.col("_pos")).alias(ORDER_COL),
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        F.col("p_name").alias("movie_title"),
        rating.alias("rating"),
        _genres(pk, F.col("p_type"), F.col("p_brand")).alias("genres"),
        cast.alias(cast_name),
        year.alias("release_year"),
        language.alias("language"),
    ]


def interactions_raw(spark: SparkSession, sf_dir: str, source: str = "A", lineitem: DataFrame | None = None) -> DataFrame:
    """Raw rating source ``A`` (TMDB-like) or ``B`` (Trakt-like, ``cast_names``).

    A = ``l_orderkey mod 10 < 6`` plus a second copy (after all others) of
    its rows with ``l_orderkey mod 100 = 0``; B = ``l_orderkey mod 10 >= 5``.
    ``mod 10 = 5`` is in both, so the sources share keys.
    """
    base = _base(spark, lineitem if lineitem is not None else ordered_lineitem(spark, sf_dir), sf_dir)
    if source.upper() == "A":
        # one pass over the join: rows of orders divisible by 100 are emitted twice
        copies = F.when(F.col("l_orderkey") % 100 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        a = base.filter(F.col("l_orderkey") % 10 < 6).withColumn("_copy", F.explode(copies))
        return a.select(*_interaction_columns(F.col("_copy"), "cast"))
    if source.upper() == "B":
        return base.filter(F.col("l_orderkey") % 10 >= 5).select(*_interaction_columns(0, "cast_names"))
    raise ValueError(f"unknown source {source!r}")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
