"""Group-based train / validation / test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemine.operators.cleaning import ORDER_COL
from tastemine.operators.indexing import dense_index
from tastemine.session import stored

SEED = 42
TRAIN_SIZE = 0.7
VAL_SHARE = 0.5  # of the remainder


def seeded_hash(c: Column, seed: int = SEED) -> Column:
    """``md5('<seed>:<value>')`` — same hex in Spark and DuckDB."""
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def group_assignment(df: DataFrame, group_col: str, seed: int = SEED, train: float = TRAIN_SIZE,
                     val_share: float = VAL_SHARE, mode: str = "exact") -> DataFrame:
    """One row per group with its split.

    ``exact``: groups ordered by ``md5(seed:group)``; the first
    ``floor(train*U)`` are train, the next ``floor(val_share*rest)`` val, the
    rest test (sklearn's GroupShuffleSplit counts). Ranks come from the
    range-partitioned ``dense_index``; the group count is a one-row table.
    ``threshold``: one pass, ``hash in [0,1)`` against the cumulative shares
    (stable when new groups arrive, counts only approximately exact).
    """
    groups = df.select(F.col(group_col)).distinct().withColumn("_h", seeded_hash(F.col(group_col), seed))
    if mode == "threshold":
        u = F.conv(F.substring("_h", 1, 13), 16, 10).cast("double") / float(16 ** 13)
        cut = train + (1 - train) * val_share
        split = F.when(u < train, "train").when(u < cut, "val").otherwise("test")
        return groups.select(group_col, split.alias("split"))
    ranked = dense_index(groups, ["_h", group_col], "_rank")
    total = groups.agg(F.count(F.lit(1)).alias("_u"))
    n_train = F.floor(F.lit(train) * F.col("_u"))
    n_val = F.floor(F.lit(val_share) * (F.col("_u") - n_train))
    split = F.when(F.col("_rank") < n_train, "train").when(F.col("_rank") < n_train + n_val, "val").otherwise("test")
    return ranked.crossJoin(F.broadcast(total)).select(group_col, split.alias("split"))


def group_split(df: DataFrame, group_col: str, **kw) -> DataFrame:
    """Every row labelled with its group's split (rows follow their group)."""
    assign = stored(group_assignment(df, group_col, **kw), "snappy")
    return df.join(assign, group_col, "left")


def split_index(df: DataFrame, order_col: str = ORDER_COL) -> DataFrame:
    """``(index, split)`` where index is the row position in ``order_col`` order."""
    return dense_index(df.select(order_col, "split"), [order_col], "index").select("index", "split")


def sampling_report(df: DataFrame, group_col: str, item_col: str | None = None) -> DataFrame:
    """Per split samples, groups, sample ratio (and items, % of groups)."""
    aggs = [F.count(F.lit(1)).alias("samples"), F.countDistinct(group_col).alias("users")]
    if item_col:
        aggs.append(F.countDistinct(item_col).alias("movies"))
    per = df.groupBy("split").agg(*aggs)
    tot = df.agg(F.count(F.lit(1)).alias("_n"), F.countDistinct(group_col).alias("_u"))
    out = per.crossJoin(F.broadcast(tot)).select(
        "split", F.col("samples").cast("bigint"), F.col("users").cast("bigint"),
        *([F.col("movies").cast("bigint")] if item_col else []),
        F.round(F.col("samples") / F.col("_n"), 6).alias("ratio"),
        F.round(F.col("users") / F.col("_u") * 100.0, 6).alias("user_pct"),
    )
    return out
