"""Set operations and integration."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemine.operators.cleaning import ORDER_COL, drop_exact_duplicates, keep_ranked

# Fixed values that must equal the reference: source tags.
SOURCE_TAGS = ("TMDB_cleaned", "Trakt_cleaned")
PART_SHIFT = 60
DEDUP_KEYS = ("user_id", "movie_id", "rating", "timestamp")


def tag_union(frames: dict[str, DataFrame], order_col: str = ORDER_COL) -> DataFrame:
    """Tag each frame with ``source`` and UNION ALL by name.

    The row order continues across frames: the frame's index goes into the
    bits above the frames' own 64-bit orders (below 2^60), so the first
    frame's rows come first.
    """
    return reduce(_union, tag_frames(frames, order_col))


def tag_frames(frames: dict[str, DataFrame], order_col: str = ORDER_COL) -> list[DataFrame]:
    """The frames of ``tag_union``, each by itself."""
    parts = []
    for i, (name, df) in enumerate(frames.items()):
        inner = F.col(order_col) if order_col in df.columns else F.monotonically_increasing_id()
        parts.append(
            df.withColumn("source", F.lit(name))
            .withColumn(order_col, F.lit(i << PART_SHIFT).cast("bigint") + inner)
        )
    return parts


def _union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def _keep_unseen(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """All rows of the first frame, and those of each later one whose key (nulls equal) no earlier frame has."""
    kept = parts[:1]
    for i, part in enumerate(parts[1:], 1):
        seen = reduce(DataFrame.unionByName, [p.select(*keys) for p in parts[:i]]).toDF(*[f"_seen{j}" for j in range(len(keys))])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_seen{j}")) for j, k in enumerate(keys)])
        kept.append(part.join(seen, same, "left_anti"))
    return reduce(_union, kept)


@dataclass
class Integrated:
    df: DataFrame
    stats: DataFrame


def integrate(frames: dict[str, DataFrame], order_col: str = ORDER_COL, unique: tuple[str, ...] = ()) -> Integrated:
    """U4 = U1 -> U2 (distinct over all columns incl. ``source``) -> U3 (keep
    the first row per ``(user_id, movie_id, rating[, timestamp])``).

    The first row of a key is the first of its first exact class, so the rows
    need one pass only (``keep_ranked``). The stats frame (``tmdb_rows, trakt_rows`` style
    per-source counts, ``merged_before_dedup, merged_after_exact_dedup,
    merged_after_key_dedup``) counts rows, distinct rows and keys when it is
    asked for. ``unique`` names columns by which the rows of each frame already
    were reduced to the one of a key (equal orders aside): where the keys here contain them,
    the first frame is complete as it is, and rows of a later one leave if their
    key is in an earlier one, so only these rows and the keys are shuffled.
    """
    merged = tag_union(frames, order_col)
    keys = [c for c in DEDUP_KEYS if c in merged.columns]
    df = _keep_unseen(tag_frames(frames, order_col), keys) if unique and set(unique) <= set(keys) else keep_ranked(merged, keys, F.asc(order_col))
    rows = merged.agg(
        *[F.count_if(F.col("source") == name).cast("bigint").alias(f"{_slug(name)}_rows") for name in frames],
        F.count(F.lit(1)).cast("bigint").alias("merged_before_dedup"))
    exact = drop_exact_duplicates(merged, order_col).agg(F.count(F.lit(1)).cast("bigint").alias("merged_after_exact_dedup"))
    kept = merged.select(*keys).distinct().agg(F.count(F.lit(1)).cast("bigint").alias("merged_after_key_dedup"))
    return Integrated(df, rows.crossJoin(exact).crossJoin(kept))


def _slug(name: str) -> str:
    return name.split("_")[0].lower()


def split_overlap(df: DataFrame, group_col: str, split_col: str = "split") -> DataFrame:
    """Groups that appear in more than one split (empty when disjoint)."""
    return (df.groupBy(group_col).agg(F.countDistinct(split_col).alias("n_splits"))
            .filter(F.col("n_splits") > 1))


def union_domain(datasets: dict[str, DataFrame], col: str) -> DataFrame:
    """Union of a column's value domain across datasets, with presence."""
    parts = [df.select(F.col(col).alias("value"), F.lit(n).alias("dataset")) for n, df in datasets.items()]
    u = reduce(DataFrame.unionByName, parts).filter(F.col("value").isNotNull())
    return u.groupBy("value").agg(F.sort_array(F.collect_set("dataset")).alias("datasets"))
