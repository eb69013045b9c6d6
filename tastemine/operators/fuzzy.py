"""Fuzzy title match (F10, J6): the Ratcliff-Obershelp similarity as a similarity join.

``ratio(a, b) = 2 M / (len(a) + len(b))``, where M counts the characters in the longest common run, the longest common
runs to its left and right, and so on. A pair is similar if the ratio exceeds a cutoff, so a pair of texts needs at least
``need = floor(cutoff / 2 * (len(a) + len(b))) + 1`` matched characters. Filters come before the kernel, from cheap to
dear; none of them loses a similar pair:

1. length: M is at most the shorter length, so lengths must be near each other; lengths meet by an equi-join.
2. characters: matched characters are common ones, counted with repetition. A text is the set of its characters numbered
   by occurrence, in one global order with rare ones first; sets that share ``need`` elements share one among their first
   ``len - need + 1``, so pairs are made by an equi-join on these prefixes alone, then held against position and the
   complete intersection (all in the JVM).
3. common subsequence: matched runs do not cross, so M is at most the length of the longest common subsequence. It is
   computed for a batch of pairs at once with one machine word per pair.
4. the kernel: all open stretches of all pairs of a batch are matched together, one round per level of the recursion.

The ratio is not symmetric; the first text is the query. As in the reference's matcher, in a second text of 200 or more
characters those that make up more than a hundredth of it do not start a match, but extend one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemine.operators.indexing import dense_index
from tastemine.session import checkpoint

# Fixed values that must equal the reference's: a pair is similar above this ratio; popular characters.
CUTOFF = 0.7
POPULAR_FROM, POPULAR_SHARE = 200, 100
#: longest text of a pair that is compared in a batch (a machine word); pairs compared at once
WORD = 63
AT_ONCE = 2048


# --- kernels


def _codes(texts: list[str], width: int, pad: int) -> np.ndarray:
    """Code points, one text a row, padded."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.full((len(texts), width), pad, dtype=np.int32)
    out[np.arange(width) < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<i4")
    return out


def common_subsequences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each pair of rows (at most ``WORD`` columns, paddings differ): the
    bit-parallel recurrence on one word per pair."""
    masks = np.zeros(a.shape, dtype=np.uint64)
    for j in range(b.shape[1]):
        masks |= (a == b[:, j : j + 1]).astype(np.uint64) << np.uint64(j)
    v = np.full(len(a), (1 << b.shape[1]) - 1, dtype=np.uint64)
    for i in range(a.shape[1]):
        u = v & masks[:, i]
        v = (v + u) | (v - u)
    low = np.uint64((1 << b.shape[1]) - 1)
    return b.shape[1] - np.bitwise_count(v & low).astype(np.int64)


def matched_characters(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """M of each pair of rows (padded, paddings differ), for texts without popular characters."""
    n, width, height = len(a), a.shape[1], b.shape[1]
    runs = np.zeros((n, width, height), dtype=np.uint8)  # length of the common run that ends at i, j
    for i in range(width):
        same = a[:, i : i + 1] == b
        runs[:, i] = same
        if i:
            runs[:, i, 1:] += runs[:, i - 1, :-1] * same[:, 1:]
    total = np.zeros(n, dtype=np.int64)
    pair, a_lo, a_hi, b_lo, b_hi = np.arange(n), np.zeros(n, np.int64), a_size.astype(np.int64), np.zeros(n, np.int64), b_size.astype(np.int64)
    i, j = np.arange(width), np.arange(height)
    while len(pair):
        # a run may not begin before the stretch does
        in_a = np.where(i < a_hi[:, None], np.maximum(i + 1 - a_lo[:, None], 0), 0).astype(np.uint8)
        in_b = np.where(j < b_hi[:, None], np.maximum(j + 1 - b_lo[:, None], 0), 0).astype(np.uint8)
        best = np.minimum(np.minimum(runs[pair], in_a[:, :, None]), in_b[:, None, :]).reshape(len(pair), -1)
        at = best.argmax(axis=1)  # of the longest the first in a, then in b
        size = best[np.arange(len(pair)), at].astype(np.int64)
        np.add.at(total, pair, size)
        x, y = at // height + 1, at % height + 1
        some = size > 0
        stretches = [np.concatenate(z) for z in zip((pair, a_lo, x - size, b_lo, y - size), (pair, x, a_hi, y, b_hi), strict=True)]
        some = np.concatenate([some, some]) & (stretches[1] < stretches[2]) & (stretches[3] < stretches[4])
        pair, a_lo, a_hi, b_lo, b_hi = (z[some] for z in stretches)
    return total


def matched_of_long(a: np.ndarray, b: np.ndarray) -> int:
    """M of one pair of any length: one row of the table of runs at a time."""
    popular = np.zeros(0, dtype=b.dtype)
    if len(b) >= POPULAR_FROM:
        values, counts = np.unique(b, return_counts=True)
        popular = values[counts > len(b) // POPULAR_SHARE + 1]
    start = ~np.isin(b, popular)
    total, stretches = 0, [(0, len(a), 0, len(b))]
    while stretches:
        a_lo, a_hi, b_lo, b_hi = stretches.pop()
        part, fine = b[b_lo:b_hi], start[b_lo:b_hi]
        x, y, size = a_lo, b_lo, 0
        runs = np.zeros(len(part) + 1, dtype=np.int64)
        for i in range(a_lo, a_hi):
            now = np.zeros_like(runs)
            now[1:] = np.where((part == a[i]) & fine, runs[:-1] + 1, 0)
            j = int(now.argmax())
            if now[j] > size:
                size = int(now[j])
                x, y = i + 1 - size, b_lo + j - size
            runs = now
        while x > a_lo and y > b_lo and a[x - 1] == b[y - 1]:
            x, y, size = x - 1, y - 1, size + 1
        while x + size < a_hi and y + size < b_hi and a[x + size] == b[y + size]:
            size += 1
        if size:
            total += size
            stretches += [s for s in ((a_lo, x, b_lo, y), (x + size, a_hi, y + size, b_hi)) if s[0] < s[1] and s[2] < s[3]]
    return total


def pair_ratios(first: list[str], second: list[str], cutoff: float = CUTOFF) -> tuple[np.ndarray, np.ndarray]:
    """(whether the common subsequence is long enough, ratio) of pairs; the ratio is NaN where it is not."""
    passed, ratio = np.zeros(len(first), dtype=bool), np.full(len(first), np.nan)
    short = [k for k in range(len(first)) if 0 < len(first[k]) <= WORD and 0 < len(second[k]) <= WORD]
    a_size, b_size = (np.fromiter((len(x[k]) for k in short), np.int64, len(short)) for x in (first, second))
    if short:
        a = _codes([first[k] for k in short], int(a_size.max()), -1)
        b = _codes([second[k] for k in short], int(b_size.max()), -2)
        near = 2.0 * common_subsequences(a, b) / (a_size + b_size) > cutoff
        some, place = np.flatnonzero(near), np.array(short)
        passed[place[some]] = True
        if len(some):
            ratio[place[some]] = 2.0 * matched_characters(a[some], b[some], a_size[some], b_size[some]) / (a_size + b_size)[some]
    for k in set(range(len(first))).difference(short):
        x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<i4") for t in (first[k], second[k]))
        passed[k] = True
        ratio[k] = 2.0 * matched_of_long(x, y) / (len(x) + len(y)) if len(x) + len(y) else 1.0
    return passed, ratio


# --- the join


def _need(cutoff: float, la: Column, lb: Column) -> Column:
    return (F.floor(F.lit(cutoff / 2) * (la + lb)) + 1).cast("int")


def _shortest(cutoff: float, size: Column) -> Column:
    """The least length that may be similar to a text of that ``size``."""
    return F.ceil(F.lit(cutoff / (2 - cutoff)) * size - 1e-6).cast("int")


def _numbered(texts: DataFrame) -> DataFrame:
    """(_text, _c, _k): the characters of each text, numbered by occurrence."""
    chars = texts.select("_text", F.explode(F.transform(F.sequence(F.lit(1), F.length("_text")), lambda i: F.substring(F.col("_text"), i, F.lit(1)))).alias("_c"))
    counts = chars.groupBy("_text", "_c").agg(F.count(F.lit(1)).alias("_n"))
    return counts.select("_text", "_c", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_k"))


def candidate_pairs(queries: DataFrame, titles: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(_q, _t, _la, _lb): the pairs of distinct, non-empty ``_text`` of both sides that pass length and characters."""
    q, t = (_numbered(x.select("_text")) for x in (queries, titles))
    both = q.select(F.lit(True).alias("_is_q"), "*").unionByName(t.select(F.lit(False).alias("_is_q"), "*"))
    order = both.groupBy("_c", "_k").agg(F.count(F.lit(1)).alias("_n"))
    order = dense_index(order, ["_n", F.col("_k").desc(), "_c"], "_rank").drop("_n")
    sets = both.join(order, ["_c", "_k"]).groupBy("_is_q", "_text").agg(F.array_sort(F.collect_list(F.col("_rank").cast("int"))).alias("_set"))
    sets = checkpoint(sets.withColumn("_l", F.size("_set")))
    la, lb = F.col("_la"), F.col("_lb")
    t = sets.where("not _is_q").select(F.col("_text").alias("_t"), F.col("_l").alias("_lb"), F.col("_set").alias("_ts"))
    lengths = t.select(F.col("_lb").alias("_length")).distinct()
    q = sets.where("_is_q").select(F.col("_text").alias("_q"), F.col("_l").alias("_la"), F.col("_set").alias("_qs"))
    longest = F.floor(F.lit((2 - cutoff) / cutoff) * la + 1e-6).cast("int")
    q = q.withColumn("_length", F.explode(F.sequence(F.greatest(_shortest(cutoff, la), F.lit(1)), longest))).join(lengths, "_length")
    q = q.select("*", F.posexplode(F.slice("_qs", 1, F.greatest(la - _need(cutoff, la, F.col("_length")) + 1, F.lit(0)))).alias("_i", "_token"))
    t = t.select("*", F.posexplode(F.slice("_ts", 1, F.greatest(lb - _need(cutoff, F.greatest(_shortest(cutoff, lb), F.lit(1)), lb) + 1, F.lit(0)))).alias("_j", "_other"))
    met = q.join(t, (F.col("_token") == F.col("_other")) & (F.col("_length") == lb))
    need = _need(cutoff, la, lb)
    met = met.where(F.least(la - F.col("_i"), lb - F.col("_j")) >= need)
    met = met.withColumn("_common", F.array_intersect("_qs", "_ts"))
    # the first common element makes the pair, so it is made once
    return met.where((F.size("_common") >= need) & (F.element_at("_common", 1) == F.col("_token"))).select("_q", "_t", "_la", "_lb")


def compared(pairs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(_q, _t, passed, ratio) of candidate pairs: whether the common subsequence is long enough, and the ratio if so."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                some = batch.slice(at, AT_ONCE)
                passed, ratio = pair_ratios(some.column(0).to_pylist(), some.column(1).to_pylist(), cutoff)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(passed), pa.array(ratio, mask=np.isnan(ratio))], names=["_q", "_t", "passed", "ratio"])

    return pairs.select("_q", "_t").mapInArrow(run, "_q string, _t string, passed boolean, ratio double")


def _texts(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.lower(F.col(col)).alias("_text")).where(F.length("_text") > 0).distinct()


def similar(queries: DataFrame, titles: DataFrame, query_col: str = "query", title_col: str = "title", cutoff: float = CUTOFF) -> DataFrame:
    """(_q, _t, ratio): lower-cased texts whose ratio exceeds ``cutoff``. Null and empty texts match nothing."""
    pairs = candidate_pairs(_texts(queries, query_col), _texts(titles, title_col), cutoff)
    return compared(pairs, cutoff).where(F.col("ratio") > cutoff).select("_q", "_t", "ratio")


def filter_report(queries: DataFrame, titles: DataFrame, query_col: str = "query", title_col: str = "title", cutoff: float = CUTOFF) -> DataFrame:
    """One row: how many pairs of distinct texts there are, and how many are left after each filter."""
    q, t = _texts(queries, query_col), _texts(titles, title_col)
    n_q, n_t = (x.groupBy(F.length("_text").alias(f"l_{s}")).agg(F.count(F.lit(1)).alias(f"n_{s}")) for x, s in ((q, "q"), (t, "t")))
    l_q, l_t, n = F.col("l_q"), F.col("l_t"), F.col("n_q") * F.col("n_t")
    # lengths against lengths: one row per length on either side
    sizes = n_q.crossJoin(n_t).agg(F.sum(n).alias("pairs"), F.sum(F.when(F.least(l_q, l_t) >= _need(cutoff, l_q, l_t), n).otherwise(0)).alias("by_length"))
    done = compared(candidate_pairs(q, t, cutoff), cutoff)
    counts = done.agg(F.count(F.lit(1)).alias("by_characters"), F.count_if("passed").alias("by_subsequence"), F.count_if(F.col("ratio") > cutoff).alias("similar"))
    return sizes.crossJoin(counts).select(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("pairs", "by_length", "by_characters", "by_subsequence", "similar")])
