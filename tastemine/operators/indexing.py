"""Distributed dense ranks (E4 label codes, W8 user order, W9 row positions).

A window without ``partitionBy`` would pull every row into one task. Instead:
sort (range partitioning), tag rows with ``monotonically_increasing_id``
(partition index in the high bits, position in the low bits), store so
that the ids are stable, count rows per partition, and add the running count
of earlier partitions. There is one offset per partition, so their number is
bounded by the partition count.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemine.session import checkpoint, stored

_SHIFT = 33  # monotonically_increasing_id puts the partition index above bit 33


def dense_index(values: DataFrame, order_by: list[Column | str], out: str = "idx", keep: list[str] | None = None,
                compression: str = "snappy") -> DataFrame:
    """Append ``out`` = 0-based position of each row of ``values`` in the total
    order ``order_by`` (rows must be distinct under that order). ``keep`` names
    the columns that are wanted beside it (all by default)."""
    keep = list(keep or values.columns)
    ordered = values.orderBy(*order_by).select(*keep, F.monotonically_increasing_id().alias("_mid"))
    ordered = stored(ordered, compression)
    part = F.shiftright(F.col("_mid"), _SHIFT)
    counts = {r["_p"]: r["_n"] for r in ordered.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n")).collect()}
    # rows before each partition, one number a partition
    offsets = list(accumulate((counts.get(p, 0) for p in range(max(counts, default=0))), initial=0))
    before = F.get(F.array(*[F.lit(n).cast("bigint") for n in offsets]), part.cast("int"))
    local = F.col("_mid") - F.shiftleft(part, _SHIFT)
    return ordered.select(*keep, (before + local).cast("bigint").alias(out))


def running_count(counts: DataFrame, order_by: list[Column | str], count_col: str, out: str = "cum") -> DataFrame:
    """Append ``out`` = the sum of ``count_col`` up to and including each row,
    in the total order ``order_by``. Like ``dense_index``: one distributed
    sort, sums per sorted partition, and a window within each of them."""
    ordered = checkpoint(counts.orderBy(*order_by).withColumn("_mid", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("_p", F.shiftright(F.col("_mid"), _SHIFT))
    sums = ordered.groupBy(F.col("_p").alias("_q")).agg(F.sum(count_col).alias("_n"))
    offsets = sums.select("_q", F.coalesce(F.sum("_n").over(Window.orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_p").orderBy("_mid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = ordered.withColumn("_in", F.sum(count_col).over(within)).join(F.broadcast(offsets), F.col("_p") == F.col("_q"))
    return cum.select(*counts.columns, (F.col("_off") + F.col("_in")).cast("bigint").alias(out))


def label_codes(df: DataFrame, col: str | Column, out: str, as_string: bool = True) -> DataFrame:
    """E4 vocabulary: distinct values (as strings, like ``LabelEncoder`` over
    ``astype(str)``) with their code 0..n-1 in lexicographic order."""
    c = F.col(col) if isinstance(col, str) else col
    if as_string:
        c = c.cast("string")
    values = df.select(c.alias("_value")).distinct()
    return dense_index(values, ["_value"], out)


def encode_labels(df: DataFrame, col: str, out: str, fill: str | None = None) -> DataFrame:
    """Append the lexicographic label code of ``col`` (as string)."""
    key = F.col(col).cast("string")
    if fill is not None:
        key = F.coalesce(key, F.lit(fill))
    keyed = df.withColumn("_key", key)
    codes = label_codes(keyed, "_key", out)
    return keyed.join(codes, keyed["_key"].eqNullSafe(codes["_value"]), "left").drop("_key", "_value")


def encode_many(df: DataFrame, specs: list[tuple[str, str, str | None]], attach: dict | None = None) -> DataFrame:
    """E4 for several columns: ``specs`` = (column, output, null fill). The
    code tables are independent jobs (each blocks on its checkpoint), so they
    are built concurrently from a small thread pool, then joined. ``attach`` maps
    an output to a function of its code table that adds columns: what belongs to a code
    reaches the rows in the join of the code."""
    attach = attach or {}
    from concurrent.futures import ThreadPoolExecutor

    keyed = df
    for i, (col, _, fill) in enumerate(specs):
        key = F.col(col).cast("string")
        keyed = keyed.withColumn(f"_key{i}", F.coalesce(key, F.lit(fill)) if fill is not None else key)
    with ThreadPoolExecutor(max_workers=len(specs)) as ex:
        codes = list(ex.map(lambda i: attach.get(specs[i][1], lambda c: c)(label_codes(keyed, f"_key{i}", specs[i][1])), range(len(specs))))
    out = keyed
    for i, c in enumerate(codes):
        c = c.withColumnRenamed("_value", f"_value{i}")
        out = out.join(c, out[f"_key{i}"].eqNullSafe(c[f"_value{i}"]), "left").drop(f"_key{i}", f"_value{i}")
    return out


def top_k_per_group(df: DataFrame, group_cols: list[str], order_cols: list[Column], k: int,
                    rank_col: str = "rank", buckets: int = 64) -> DataFrame:
    """First ``k`` rows of every group in ``order_cols`` order, with ranks 1..k.

    Two levels so that no group is sorted whole in one task: rows are salted
    into ``buckets`` by a hash, the top ``k`` per (group, bucket) are kept, and
    the final ranking sees at most ``k * buckets`` rows per group.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(buckets))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order_cols)
    first = (df.withColumn("_salt", salt).withColumn("_r1", F.row_number().over(w1))
             .filter(F.col("_r1") <= k).drop("_r1", "_salt"))
    w2 = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return first.withColumn(rank_col, F.row_number().over(w2)).filter(F.col(rank_col) <= k)
