"""Exact maximum-inner-product search (R2, J7, W2): the k items with the largest u . v for every user.

Items are sorted by falling norm and cut into blocks of ``ITEM_BLOCK``, taken in rounds that grow by ``GROWTH``. A user
carries the k-th best score so far; no item of norm n can score above |u| n, so users whose bound for the next round's
longest item is lower are done and leave. Within a round each pair of a user and a block is held against the block's own
bound, the lesser of |u| max|v| and, with the first component apart, max(u1 v1) + |u'| max|v'|; pairs that cannot win are
skipped, the others are scored as one product of matrices and cut to the k best. What is found is merged per user.

Blocks of users meet blocks of items in tiles: up to ``SHARE`` blocks of users by as many of items, an equi-join on the tile.
A block of users is sent once to every tile of items and a block of items once to every tile of users, so what is shuffled
is a ``SHARE``-th of the pairs of blocks; the pairs themselves are made where they are scored. Pairs to be left out travel with
their users. A round takes no more blocks than send ``ROUND_BYTES``, or one tile across; its shuffles and what it supersedes
go before the next.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemine.operators.indexing import dense_index
from tastemine.session import checkpoint, held, release, scratch

USER_BLOCK = 1024
ITEM_BLOCK = 1024
GROWTH = 4
#: blocks of users, and of items, in a tile at most; tiles there are at least where blocks suffice
SHARE = 32
TILES = 64
#: bytes that a round sends at most, beyond one tile across
ROUND_BYTES = 1 << 30
#: bounds are raised by this share, more than the rounding of a product of factors
_SLACK = 1e-9


def _norm(c: str, first: int = 1) -> Column:
    """Length of a vector, from its ``first`` entry on."""
    return F.sqrt(F.aggregate(F.slice(c, first, F.greatest(F.size(c) - first + 1, F.lit(0))), F.lit(0.0), lambda s, x: s + x * x))


def _vectors(rows: pa.ListScalar, names: tuple[str, ...]) -> list[np.ndarray]:
    """The fields of an array of structs, lists as matrices."""
    struct = rows.values
    fields = [struct.field(n) for n in names]
    fields = [f.slice(struct.offset, len(struct)) if len(f) != len(struct) else f for f in fields]
    return [np.asarray(f.flatten()).reshape(len(f), -1) if pa.types.is_list(f.type) else np.asarray(f) for f in fields]


def _best(scores: np.ndarray, items: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, score) of each row's k best that reach ``least``, ties by item."""
    n = scores.shape[1]
    top = min(k, n)
    row, col = np.divmod(np.flatnonzero(scores >= least[:, None]), n)
    many = np.flatnonzero(np.bincount(row, minlength=len(scores)) > top)  # only these are cut, few once a bar is known
    if len(many):
        bar = np.full(len(scores), -np.inf)
        bar[many] = np.partition(scores[many], n - top, axis=1)[:, n - top]
        kept = scores[row, col] >= bar[row]
        row, col = row[kept], col[kept]
    finite = np.isfinite(scores[row, col])
    row, col = row[finite], col[finite]
    value = scores[row, col]
    order = np.lexsort((items[col], -value, row))
    row, col, value = row[order], col[order], value[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < top
    return row[kept], items[col[kept]], value[kept]


def _scored(k: int, masked: bool):
    """Pairs of a block of users and one of items -> candidates; a row with ``i_col`` null says how many pairs of a user
    and this block there were (``u_row``) and how many were scored (``raw_score``)."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                uid, u, least = _vectors(batch.column(0)[at], ("u_row", "factors", "least"))
                iid, v = _vectors(batch.column(1)[at], ("i_col", "factors"))
                tail = np.sqrt((v[:, 1:] ** 2).sum(axis=1)).max()
                bound = np.minimum(
                    np.linalg.norm(u, axis=1) * np.linalg.norm(v, axis=1).max(),
                    np.maximum(u[:, 0] * v[:, 0].max(), u[:, 0] * v[:, 0].min()) + np.linalg.norm(u[:, 1:], axis=1) * tail,
                )
                live = np.flatnonzero(bound + np.abs(bound) * _SLACK >= least)
                found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
                if len(live):
                    scores = u[live] @ v.T
                    if masked and batch.column(2)[at].is_valid:
                        su, si = (np.asarray(batch.column(c)[at].values) for c in (2, 3))
                        held = np.isin(su, uid) & np.isin(si, iid)
                        su, si = su[held], si[held]
                        place = np.full(len(uid), -1)
                        place[live] = np.arange(len(live))
                        order = np.argsort(iid)
                        a, b = place[np.searchsorted(uid, su)], order[np.searchsorted(iid, si, sorter=order)]
                        scores[a[a >= 0], b[a >= 0]] = -np.inf
                    row, item, value = _best(scores, iid, least[live], k)
                    found = uid[live[row]], item, value
                n = len(found[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(found[0], len(uid))), pa.array([*found[1].tolist(), None], pa.int64()), pa.array(np.append(found[2], float(len(live))))],
                    names=["u_row", "i_col", "raw_score"],
                ) if n else pa.RecordBatch.from_arrays([pa.array([len(uid)]), pa.array([None], pa.int64()), pa.array([float(len(live))])], names=["u_row", "i_col", "raw_score"])

    return run


def top_items(users: DataFrame, items: DataFrame, k: int, seen: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """(u_row, i_col, raw_score, rank): the k best items of each user, ties by the smaller ``i_col``; and how many pairs
    of a user and an item block there are (``pairs``) and were scored (``scored``), with the number of ``rounds``.

    ``users`` (u_row, factors), ``items`` (i_col, factors); pairs in ``seen`` (u_row, i_col) are left out."""
    spark = users.sparkSession
    # the order needs the norms alone
    placed = dense_index(items.select("i_col", _norm("factors").alias("_norm")), [F.desc("_norm"), "i_col"], "_at")
    placed = placed.withColumn("ib", F.floor(F.col("_at") / ITEM_BLOCK).cast("bigint"))
    blocks, drop_blocks = held(items.select("i_col", "factors").join(placed, "i_col").groupBy("ib").agg(F.array_sort(F.collect_list(F.struct("i_col", "factors"))).alias("_items"), F.max("_norm").alias("_most")))
    release(spark)
    n_blocks = blocks.count()
    last_user = users.agg(F.max("u_row")).first()[0]
    n_users = users.count()
    dim = users.agg(F.max(F.size("factors"))).first()[0] or 0
    user_blocks = 1 if last_user is None else last_user // USER_BLOCK + 1
    share = max(1, min(SHARE, math.isqrt(user_blocks * n_blocks // TILES)))
    salts = (user_blocks - 1) // share + 1
    # a tile's width of blocks sends every user once and its items to every tile of users
    across = 8 * (dim + 2) * (n_users + share * ITEM_BLOCK * salts)
    most_blocks = share * max(1, ROUND_BYTES // across)
    ub, tile = F.floor(F.col("u_row") / USER_BLOCK).cast("bigint"), F.floor(F.col("ib") / share).cast("bigint")
    met = None
    if seen is not None:
        met = seen.select("u_row", "i_col").join(placed.select("i_col", "ib"), "i_col").groupBy(tile.alias("_tile"), ub.alias("ub"))
        met = checkpoint(met.agg(F.collect_list("u_row").alias("_su"), F.collect_list("i_col").alias("_si")))
    live = users.select("u_row", "factors", _norm("factors").alias("_norm"))
    best, drop_best, told = None, None, {"pairs": n_users * n_blocks, "scored": 0, "rounds": 0}
    first, size = 0, 1
    while first < n_blocks:
        size = min(size, most_blocks)
        group = blocks.where(F.col("ib").between(first, first + size - 1))
        rows = live.withColumn("least", F.lit(float("-inf")))
        if best is not None:
            bar = best.groupBy("u_row").agg(F.min("raw_score").alias("_bar"), F.count(F.lit(1)).alias("_n"))
            bar = bar.select("u_row", F.when(F.col("_n") >= k, F.col("_bar")).otherwise(float("-inf")).alias("least"))
            rows = live.join(bar, "u_row", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
            most = blocks.where(F.col("ib") == first).first()["_most"]
            rows = rows.where(F.col("_norm") * F.lit(most * (1 + _SLACK)) >= F.col("least"))
        last = min(first + size, n_blocks) - 1
        sent = rows.groupBy(ub.alias("ub")).agg(F.array_sort(F.collect_list(F.struct("u_row", "factors", "least"))).alias("_users"))
        sent = sent.withColumn("_tile", F.explode(F.sequence(F.lit(first // share).cast("bigint"), F.lit(last // share).cast("bigint"))))
        if met is not None:
            sent = sent.join(met, ["ub", "_tile"], "left")
        sent = sent.withColumn("_salt", F.floor(F.col("ub") / share).cast("int"))
        copies = group.withColumn("_of", tile).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        # items first: a merge keeps the rows of the other side in memory, a tile's blocks of users
        pairs = copies.join(sent, (F.col("_of") == F.col("_tile")) & (F.col("_copy") == F.col("_salt")))
        pairs = pairs.select("_users", "_items", *(["_su", "_si"] if met is not None else []))
        found, drop_found = scratch(pairs.mapInArrow(_scored(k, met is not None), "u_row bigint, i_col bigint, raw_score double"))
        told["scored"] += int(found.where("i_col IS NULL").agg(F.sum("raw_score")).first()[0] or 0)
        told["rounds"] += 1
        found = found.where("i_col IS NOT NULL")
        ranked = found if best is None else best.drop("rank").unionByName(found)
        rank = F.row_number().over(Window.partitionBy("u_row").orderBy(F.desc("raw_score"), "i_col"))
        superseded = drop_best
        best, drop_best = scratch(ranked.withColumn("rank", rank).where(F.col("rank") <= k))
        if superseded:
            superseded()
        drop_found()
        release(spark)
        first, size = first + size, size * GROWTH
    drop_blocks()
    if best is None:
        best = users.sparkSession.createDataFrame([], "u_row bigint, i_col bigint, raw_score double, rank int")
    return best, told
