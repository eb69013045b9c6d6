"""Frequent itemsets and association rules.

Itemsets of short baskets are counted level by level, those of long ones come
from Spark ML's parallel FP-Growth. Its own rule generator
only emits single-item consequents, so rules are expanded here: every
frequent itemset of size k >= 2 is split by the bitmasks 1 .. 2^k - 2 into
antecedent / consequent (sorted subsets of a sorted array stay sorted), and
the supports of both sides are looked up with two equi-joins on the sorted
arrays. The itemset table is small relative to the baskets; AQE turns the
lookups into broadcasts when its runtime size allows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemine.functions.text import list_text
from tastemine.operators.cleaning import ORDER_COL, filter_high_rating
from tastemine.session import partitions_for, stored

MIN_SUPPORT = 0.003
MIN_LIFT = 1.0
HIGH_RATING = 7.0
# bits of a subset's number that are opened together
MASK_BITS = 10
# subsets a basket may have on average for them to be counted level by level
SUBSETS = 1024


def baskets(df: DataFrame, txn_col: str, item_col: str, min_rating: float | None = None,
            rating_col: str = "rating") -> DataFrame:
    """M1: per transaction the *set* of items (sorted array).

    ``collect_set`` merges partial sets map-side, so a basket is bounded by the
    number of distinct items, not by the number of rows of a hot transaction.
    """
    if min_rating is not None:
        df = filter_high_rating(df, min_rating, rating_col)
    return (df.filter(F.col(item_col).isNotNull())
            .groupBy(txn_col).agg(F.array_sort(F.collect_set(item_col)).alias("items")))


def basket_shape(b: DataFrame) -> DataFrame:
    """M1 report: baskets, distinct items, mean basket size."""
    return b.select(F.size("items").alias("n"), F.explode("items").alias("item")).agg(
        F.countDistinct("item").alias("items")).crossJoin(
        b.agg(F.count(F.lit(1)).cast("bigint").alias("baskets"), F.round(F.avg(F.size("items")), 6).alias("mean_size")))


def frequent_itemsets(b: DataFrame, min_support: float = MIN_SUPPORT, num_partitions: int | None = None) -> DataFrame:
    """M2: ``(items sorted array, freq, support)`` with ``freq >= ceil(min_support * n)``.

    FP-Growth keeps every basket in a tree of each group of items it touches, in memory: with short baskets, which have few
    subsets, the trees outgrow the baskets themselves. These are counted instead (``_counted_itemsets``): passes over the baskets,
    combined map-side, that hold one number per candidate.
    """
    size = F.coalesce(F.size("items"), F.lit(0))
    n, filled, subsets = b.agg(F.count(F.lit(1)), F.count("items"), F.sum(F.pow(F.lit(2.0), size))).first()
    if n == 0 or subsets <= SUBSETS * n:
        found = _counted_itemsets(b, math.ceil(min_support * filled))
    else:
        fp = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0)
        fp = fp.setNumPartitions(num_partitions or max(b.sparkSession.sparkContext.defaultParallelism, partitions_for(n)))
        found = fp.fit(b).freqItemsets
    return found.select(F.array_sort("items").alias("items"), F.col("freq").cast("bigint").alias("freq"),
                        (F.col("freq") / F.lit(n)).alias("support"))


def _counted_itemsets(b: DataFrame, least: int) -> DataFrame:
    """(items, freq) of the sets in at least ``least`` baskets. A set is grown by later items of its basket if it is frequent,
    and counted if it is without its first item too; the frequent sets of a level are stored."""
    at, of = F.col("_at"), F.col("_all")

    def frequent(sets: DataFrame) -> DataFrame:
        return stored(sets.groupBy(F.col("_set").alias("items")).agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least), "snappy")

    sets = b.select(F.array_sort(F.array_distinct("items")).alias("_all"))
    sets = sets.select("_all", F.posexplode("_all").alias("_at", "_item")).select("_all", "_at", F.array("_item").alias("_set"))
    levels = [frequent(sets)]
    while not levels[-1].isEmpty():
        last = levels[-1].select("items")
        grown = sets.where(at < F.size(of) - 1).join(last, F.col("_set") == F.col("items"), "left_semi")
        grown = grown.select("_all", "_set", F.explode(F.sequence(at + 1, F.size(of) - 1)).alias("_at"))
        sets = grown.select("_all", "_at", F.array_append("_set", F.get(of, at)).alias("_set"))
        sets = sets.join(last, F.slice("_set", 2, len(levels)) == F.col("items"), "left_semi")
        levels.append(frequent(sets))
    return reduce(DataFrame.unionByName, levels)


def _split(items: str, mask: str, take: int) -> Column:
    # element i belongs to the side whose mask bit i equals ``take``
    return F.expr(f"filter({items}, (x, i) -> (({mask} >> i) & 1) = {take})")


def association_rules(itemsets: DataFrame, min_lift: float | None = MIN_LIFT,
                      max_len: int | None = None) -> DataFrame:
    """M3: all antecedent -> consequent splits of each frequent itemset
    (multi-item consequents), with support metrics, filtered by lift.

    Columns: antecedents, consequents, antecedent_support, consequent_support,
    support, confidence, lift, leverage, conviction (null when confidence is
    1, i.e. +inf, flagged by ``conviction_inf``), zhangs_metric, jaccard,
    certainty, kulczynski. ``max_len`` is an optional cap on itemset size
    (off by default: every itemset is expanded).
    """
    multi = itemsets.filter(F.size("items") >= 2)
    if max_len:
        multi = multi.filter(F.size("items") <= max_len)
    # subsets by number, opened in two steps so that a long itemset is never one array of 2^n
    high = F.expr(f"sequence(0L, shiftright(shiftleft(1L, size(items)) - 1, {MASK_BITS}))")
    low = F.expr(f"sequence(0L, least(shiftleft(1L, {MASK_BITS}), shiftleft(1L, size(items))) - 1)")
    masks = multi.select("items", "support", F.explode(high).alias("_high")).select("items", "support", "_high", F.explode(low).alias("_low"))
    masks = masks.withColumn("mask", F.expr(f"shiftleft(_high, {MASK_BITS}) + _low"))
    splits = masks.where(F.expr("mask BETWEEN 1 AND shiftleft(1L, size(items)) - 2")).select(
        _split("items", "mask", 1).alias("antecedents"),
        _split("items", "mask", 0).alias("consequents"),
        "support",
    )
    sup = itemsets.select("items", "support")
    ant = sup.withColumnsRenamed({"items": "antecedents", "support": "antecedent_support"})
    con = sup.withColumnsRenamed({"items": "consequents", "support": "consequent_support"})
    r = splits.join(ant, "antecedents").join(con, "consequents")
    sA, sC, sAC = F.col("antecedent_support"), F.col("consequent_support"), F.col("support")
    conf = sAC / sA
    lift = conf / sC
    r = r.select(
        "antecedents", "consequents", sA, sC, sAC,
        conf.alias("confidence"), lift.alias("lift"),
        (sAC - sA * sC).alias("leverage"),
        F.when(conf < 1.0, (1.0 - sC) / (1.0 - conf)).alias("conviction"),
        (conf >= 1.0).alias("conviction_inf"),
        ((sAC - sA * sC) / F.greatest(sAC * (1.0 - sA), sA * (sC - sAC))).alias("zhangs_metric"),
        (sAC / (sA + sC - sAC)).alias("jaccard"),
        F.when(sC < 1.0, (conf - sC) / (1.0 - sC)).otherwise(F.lit(0.0)).alias("certainty"),
        ((sAC / sA + sAC / sC) / 2.0).alias("kulczynski"),
    )
    if min_lift is not None:
        r = r.filter(F.col("lift") >= min_lift)
    return r


def rule_text(rules: DataFrame) -> DataFrame:
    """M4: list + text columns (``antecedents_str``, ``consequents_str``, ``rule``)."""
    return rules.withColumns({
        "antecedents_str": list_text(F.col("antecedents")),
        "consequents_str": list_text(F.col("consequents")),
        "rule": F.concat(list_text(F.col("antecedents")), F.lit(" -> "), list_text(F.col("consequents"))),
    })


def item_dictionary(df: DataFrame, id_col: str = "movie_id", title_col: str = "movie_title",
                    order_col: str = ORDER_COL) -> DataFrame:
    """M5: id -> title where, among the distinct (id, title) pairs, the pair
    first seen latest wins (``drop_duplicates`` then ``to_dict``)."""
    pairs = df.groupBy(id_col, title_col).agg(F.min(order_col).alias("_first"))
    return pairs.groupBy(id_col).agg(F.max_by(title_col, "_first").alias(title_col))


def rule_stats(rules: DataFrame, itemsets: DataFrame) -> DataFrame:
    """Rule and itemset counts, min / max / mean of support,
    confidence, lift (averages 0 when there are no rules)."""
    r = rules.agg(
        F.count(F.lit(1)).cast("bigint").alias("num_rules"),
        *[f(F.col(c)).alias(f"{n}_{c}") for c in ("support", "confidence", "lift")
          for n, f in (("min", F.min), ("max", F.max), ("avg", F.avg))],
    )
    i = itemsets.agg(F.count(F.lit(1)).cast("bigint").alias("num_itemsets"))
    cols = [F.col("num_rules"), F.col("num_itemsets")]
    for c in ("support", "confidence", "lift"):
        cols += [F.round(F.col(f"min_{c}"), 6).alias(f"min_{c}"), F.round(F.col(f"max_{c}"), 6).alias(f"max_{c}"),
                 F.round(F.coalesce(F.col(f"avg_{c}"), F.lit(0.0)), 6).alias(f"avg_{c}")]
    return r.crossJoin(i).select(*cols)


def itemset_lengths(itemsets: DataFrame) -> DataFrame:
    """Itemset length distribution."""
    return itemsets.groupBy(F.size("items").alias("length")).agg(F.count(F.lit(1)).cast("bigint").alias("count"))


def top_rules(rules: DataFrame, n: int = 100, by: tuple[str, ...] = ("lift",)) -> DataFrame:
    """Drop null / NaN / infinite sort keys, sort descending by
    ``by`` (rounded to 9 places so float noise cannot reorder), break ties by
    the rule text, keep N. The limit is the feature (a top-N report)."""
    out = rules
    for c in by:
        col = F.col(c)
        out = out.filter(col.isNotNull() & ~F.isnan(col) & (F.abs(col) < F.lit(float("inf"))))
    keys = [F.desc(F.round(F.col(c), 9)) for c in by] + [
        F.array_join("antecedents", "|"), F.array_join("consequents", "|")]
    return out.orderBy(*keys).limit(n)


@dataclass
class Mined:
    baskets: DataFrame
    itemsets: DataFrame
    rules: DataFrame


def mine(df: DataFrame, txn_col: str, item_col: str, min_support: float = MIN_SUPPORT,
         min_lift: float | None = MIN_LIFT, min_rating: float | None = None) -> Mined:
    """M1 -> M2 -> M3 -> M4."""
    b = baskets(df, txn_col, item_col, min_rating=min_rating)
    fi = frequent_itemsets(b, min_support)
    return Mined(b, fi, rule_text(association_rules(fi, min_lift)))
