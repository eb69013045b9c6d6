"""Distinct counts from mergeable sketches (A17 at scale).

A sketch is the ``k`` least different hashes of a group's values, kept in order (bottom-k). The k least of a union are among
the k least of its parts, so sketches of parts, merged, are exactly the sketch built from all rows: sketches are stored
once per finest group and rolled up to any coarser one without the rows. Below ``k`` different values the count is exact;
beyond, with the k-th least hash at share x of the hash range, it is (k - 1) / x, with a relative error of about
1 / sqrt(k - 2) (one standard deviation).

Hashes are 60 bits of md5. Building is a map-side combined distinct and a limit per group that Spark applies before the
shuffle as well, so a hot group sends at most ``k`` rows per task. Null values are not counted; a null in a group column
is a group of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 8192
_BITS = 60


def hashed(value: Column) -> Column:
    """60 bits of md5 of a value as text, as a long."""
    digits = F.substring(F.md5(value.cast("string").cast("binary")), 1, _BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")


def _least(hashes: DataFrame, by: list[str], k: int) -> DataFrame:
    """Sketches (``by``, ``k``, ``hashes``) of rows (``by``, ``_h``)."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("_h"))
    kept = hashes.distinct().withColumn("_rank", rank).where(F.col("_rank") <= k)
    return kept.groupBy(*by).agg(F.array_sort(F.collect_list("_h")).alias("hashes")).select(*by, F.lit(k).alias("k"), "hashes")


def sketch(df: DataFrame, by: list[str], value: str, k: int = K) -> DataFrame:
    """A sketch of ``value`` per group; a group without values has none."""
    return _least(df.where(F.col(value).isNotNull()).select(*by, hashed(F.col(value)).alias("_h")), by, k)


def merge(sketches: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """Sketches of the coarser groups ``by``; all were built with at least ``k``."""
    return _least(sketches.select(*by, F.explode("hashes").alias("_h")), by, k)


def estimate(k: Column | str = "k", hashes: Column | str = "hashes") -> Column:
    """The number of different values that a sketch stands for."""
    k, hashes = (F.col(c) if isinstance(c, str) else c for c in (k, hashes))
    share = (F.element_at(hashes, -1) + 1).cast("double") / float(1 << _BITS)
    return F.when(F.size(hashes) < k, F.size(hashes).cast("double")).otherwise((k - 1) / share)
