"""User profiles and cluster profiles.

A profile is one ``groupBy(user)`` aggregate over the interaction rows; the
reference's per-user Python loop re-filters the whole table per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemine.functions.text import columns_by_affix

PROFILE_STATS = ("avg_rating", "num_ratings", "rating_std")


def genre_feature_columns(df: DataFrame, include_count_features: bool = True) -> list[str]:
    """Columns averaged into ``<col>_pref``: every ``genre_*`` column. The
    prefix also catches ``genre_count`` / ``genre_count_scaled`` (trap T6);
    ``include_count_features=False`` leaves them out."""
    cols = columns_by_affix(df.columns, prefix="genre_")
    if not include_count_features:
        cols = [c for c in cols if c not in ("genre_count", "genre_count_scaled")]
    return cols


def user_profiles(df: DataFrame, user_col: str = "user_idx", rating_col: str = "rating_scaled",
                  include_count_features: bool = True) -> DataFrame:
    """Mean / count / sample std (null for one rating) of the scaled
    rating and the mean of each genre column, per user, in one aggregate."""
    genres = genre_feature_columns(df, include_count_features)
    return df.groupBy(user_col).agg(
        F.avg(rating_col).alias("avg_rating"),
        F.count(F.lit(1)).cast("bigint").alias("num_ratings"),
        F.stddev_samp(rating_col).alias("rating_std"),
        *[F.avg(F.col(f"`{c}`").cast("double")).alias(f"{c}_pref") for c in genres],
    )


def profile_features(profiles: DataFrame, user_col: str = "user_idx") -> list[str]:
    return [c for c in profiles.columns if c != user_col and c != "user_cluster"]


def long_prefs(profiles: DataFrame, key_cols: list[str]) -> DataFrame:
    """Unpivot ``*_pref`` columns to ``(keys..., genre, preference_score)``."""
    prefs = columns_by_affix(profiles.columns, suffix="_pref")
    if not prefs:
        return profiles.select(*key_cols, F.lit(None).cast("string").alias("genre"),
                               F.lit(None).cast("double").alias("preference_score")).limit(0)
    stacked = profiles.select(*key_cols, F.explode(F.array(*[
        F.struct(F.lit(c.replace("genre_", "").replace("_pref", "")).alias("genre"),
                 F.col(f"`{c}`").cast("double").alias("preference_score")) for c in prefs
    ])).alias("_p"))
    return stacked.select(*key_cols, "_p.genre", "_p.preference_score")


def cluster_profiles(users: DataFrame, cluster_col: str = "user_cluster", top_genres: int = 5) -> DataFrame:
    """Users, % of users, mean of avg_rating / num_ratings / rating_std
    (nulls skipped) and the top genre preferences (highest mean, ties by
    genre) as ``array<struct<genre, preference_score>>``.

    The per-cluster genre means have one row per (cluster, genre), so the
    top-N window is bounded by the number of genres.
    """
    prefs = columns_by_affix(users.columns, suffix="_pref")
    total = users.agg(F.count(F.lit(1)).alias("_total"))
    base = users.groupBy(cluster_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("num_users"),
        F.avg("avg_rating").alias("avg_rating"),
        F.avg("num_ratings").alias("avg_num_ratings"),
        F.avg("rating_std").alias("avg_rating_std"),
        *[F.avg(F.col(f"`{c}`")).alias(c) for c in prefs],
    )
    base = base.crossJoin(F.broadcast(total)).withColumn(
        "percentage", F.col("num_users") / F.col("_total") * 100.0).drop("_total")
    means = long_prefs(base.select(cluster_col, *prefs), [cluster_col])
    w = Window.partitionBy(cluster_col).orderBy(F.desc("preference_score"), "genre")
    top = (means.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= top_genres)
           .groupBy(cluster_col).agg(F.array_sort(F.collect_list(F.struct("_r", "genre", "preference_score")))
                                     .alias("_t")))
    top = top.select(cluster_col, F.transform("_t", lambda s: F.struct(
        s["genre"].alias("genre"), s["preference_score"].alias("preference_score"))).alias("top_genres"))
    return base.select(
        F.col(cluster_col).alias("cluster_id"), "num_users", "percentage", "avg_rating", "avg_num_ratings",
        "avg_rating_std").join(top.withColumnRenamed(cluster_col, "cluster_id"), "cluster_id", "left")


def cluster_distribution(labels: DataFrame, cluster_col: str = "user_cluster") -> DataFrame:
    """Size and percentage of every cluster."""
    total = labels.agg(F.count(F.lit(1)).alias("_total"))
    return labels.groupBy(cluster_col).agg(F.count(F.lit(1)).cast("bigint").alias("count")).crossJoin(
        F.broadcast(total)).select(cluster_col, "count", (F.col("count") / F.col("_total") * 100.0).alias("percentage"))
