"""Imputation and field consolidation (A12, A12b, A13, P17, P18) and the
transform stage that composes them with the F3 genre parse."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemine.functions import genres as G
from tastemine.functions.text import is_blank, is_unknown, lenient_double, strip_unicode
from tastemine.operators.cleaning import ORDER_COL, drop_identical_columns
from tastemine.session import stored

IMPUTE_COLUMNS = ("cast", "genres")
# what ``transform`` computes from the imputed genres, whatever the columns held before
REBUILT_COLUMNS = ("genres_list", "primary_genre", "genre_count")
UNKNOWN = "unknown"


def _modes(donors: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per ``key``, the most frequent value of each column (ties -> smallest).

    Two aggregates, both with map-side combine: counts per (key, column,
    value), then the best value per key. A hot key is reduced to one row per
    distinct value on each mapper before any shuffle.
    """
    long = donors.select(
        F.col(key), F.explode(F.array(*[
            F.struct(F.lit(c).alias("which"), F.col(c).alias("v")) for c in columns
        ])).alias("_e")
    ).select(key, "_e.which", "_e.v").filter(F.col("v").isNotNull())
    counts = long.groupBy(key, "which", "v").agg(F.count(F.lit(1)).alias("n"))
    picks = []
    for c in columns:
        hit = F.col("which") == c
        order = F.when(hit, F.struct((-F.col("n")).alias("neg_n"), F.col("v").alias("v")))
        picks.append(F.min_by(F.when(hit, F.col("v")), order).alias(f"_mode_{c}"))
    return counts.groupBy(key).agg(*picks)


def impute_by_mode(df: DataFrame, columns=IMPUTE_COLUMNS, keys=("movie_id", "movie_title"),
                   fill: str = UNKNOWN) -> DataFrame:
    """blank/null -> mode by ``movie_id``, then by ``movie_title``, then ``unknown``.

    Donors are the originally non-blank values, trimmed; values filled in the
    first pass never become donors of the second (trap T8). Non-missing
    values are kept as they are. Only rows with a missing value meet the
    modes, and only their keys get any: complete rows are not shuffled, and
    values of other keys are not counted.
    """
    columns = [c for c in columns if c in df.columns]
    keys = [k for k in keys if k in df.columns]
    if not columns:
        return df
    donor_vals = {c: F.when(~is_blank(F.col(c)), strip_unicode(F.col(c).cast("string"))) for c in columns}
    donors = df.select(*keys, *[v.alias(c) for c, v in donor_vals.items()])
    out = df.withColumns({c: F.when(~is_blank(F.col(c)), F.col(c).cast("string")) for c in columns})
    lacks = reduce(or_, [F.col(c).isNull() for c in columns])
    filled = out.where(lacks)
    for key in keys:
        wanted = stored(out.where(lacks).select(key).distinct(), "snappy")
        modes = _modes(donors.join(wanted, key, "left_semi"), key, columns)
        filled = filled.join(modes, key, "left").withColumns(
            {c: F.coalesce(F.col(c), F.col(f"_mode_{c}")) for c in columns}
        ).drop(*[f"_mode_{c}" for c in columns])
    filled = filled.withColumns({c: F.coalesce(F.col(c), F.lit(fill)) for c in columns})
    return out.where(~lacks).unionByName(filled.select(*out.columns))


def impute_unknown(df: DataFrame, columns=IMPUTE_COLUMNS, fill: str = UNKNOWN) -> DataFrame:
    """blank/null -> ``unknown`` directly."""
    return df.withColumns({
        c: F.coalesce(F.nullif(strip_unicode(F.col(c)), F.lit("")), F.lit(fill))
        for c in columns if c in df.columns
    })


def imputation_audit(df: DataFrame, columns=IMPUTE_COLUMNS) -> DataFrame:
    """Rows, missing %, empty and ``unknown`` counts, one aggregate row."""
    aggs: list[Column] = [F.count(F.lit(1)).cast("bigint").alias("rows")]
    for c in columns:
        col = F.col(c)
        aggs += [
            F.round(F.avg(col.isNull().cast("double")) * 100.0, 6).alias(f"missing_pct_{c}"),
            F.count_if(col.isNotNull() & (strip_unicode(col) == "")).cast("bigint").alias(f"empty_{c}"),
            F.count_if(is_unknown(col)).cast("bigint").alias(f"unknown_{c}"),
        ]
    return df.agg(*aggs)


def consolidate_fields(df: DataFrame, drop_identical: bool = True) -> DataFrame:
    """One numeric ``release_year`` (original, else the cleaned year; the
    ``release_year_clen`` typo column is folded in first), drop raw ``genres``
    when ``genres_list`` exists, then P17."""
    out = df
    if "release_year_clen" in out.columns:
        if "release_year" not in out.columns:
            out = out.withColumnRenamed("release_year_clen", "release_year")
        else:
            out = out.withColumn("release_year", F.coalesce(
                lenient_double(F.col("release_year"), out.schema["release_year"].dataType),
                lenient_double(F.col("release_year_clen"), out.schema["release_year_clen"].dataType),
            )).drop("release_year_clen")
    if "release_year_clean" in out.columns:
        cleaned = lenient_double(F.col("release_year_clean"), out.schema["release_year_clean"].dataType)
        if "release_year" in out.columns:
            orig = lenient_double(F.col("release_year"), out.schema["release_year"].dataType)
            out = out.withColumn("release_year", F.coalesce(orig, cleaned))
        else:
            out = out.withColumn("release_year", cleaned)
        out = out.drop("release_year_clean")
    if "genres_list" in out.columns and "genres" in out.columns:
        out = out.drop("genres")
    if drop_identical:
        out, _ = drop_identical_columns(out, protect=(ORDER_COL,))
    return out


def transform(df: DataFrame, impute: str = "mode", drop_identical: bool = True) -> DataFrame:
    """Transform stage: impute cast/genres, rebuild the genre fields with the
    F3 parser (primary genre ``unknown`` when empty), consolidate fields."""
    out = impute_by_mode(df) if impute == "mode" else impute_unknown(df)
    if "genres" in out.columns:
        from tastemine.operators.cleaning import _staged_genres, parse_by_dictionary
        out = out.drop("genres_list") if "genres_list" in out.columns else out
        out = parse_by_dictionary(out, "genres", {"genres_list": _staged_genres("transform")})
        out = out.withColumns(G.genre_columns(F.col("genres_list"), missing=F.lit(UNKNOWN)))
    return consolidate_fields(out, drop_identical=drop_identical)
