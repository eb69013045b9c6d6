"""Exact dedup by content sort.

Texts are equal if they are identical once white space is deleted. Sampled splitters (``repartitionByRange``) deal the
documents out by the first characters and the hash of the normalised text, each partition sorts its rows externally by
the complete normalised bytes, and a window then compares neighbours in full: equal texts lie side by side. Of equal
texts the longest original stays, then the smallest id.

The splitters are taken from a short key, not from whole texts, so what the sampling sends to the driver stays small
however long the texts are; a short key is a function of the normalised text, so equal texts share it.

Hot groups: a first count of the hashes finds those with more rows than a quarter of a mean partition (at most four
times as many as there are partitions, so that table may be broadcast). Their rows get a salt, are resolved per salt
like any other group, and the few winners per salt (again bounded by the partitions) are compared once more.

A null text is an empty one; all empty texts form one group. Rows that agree in id and text are one group in which
exactly one row is kept. A null id sorts after all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemine.llm import common

PREFIX = 24
#: a group is hot if it has more rows than a mean partition divided by this
SHARE = 4


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` (with ``carry`` also the whole
    input row in ``_row``)."""
    spark = docs.sparkSession
    norm = lambda c: F.regexp_replace(c, common.SPACE + "+", "")
    text = common.text_of(text_col)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, docs.count() // (SHARE * partitions))

    hashes = docs.select(F.xxhash64(norm(text)).alias("_hot"))
    hot = hashes.groupBy("_hot").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > max(most, 16))
    hot = hot.select("_hot", F.ceil(F.col("_rows") / F.lit(max(most, 16))).cast("bigint").alias("_salts"))

    df = common.packed(docs, carry, _id=F.col(f"`{id_col}`"), _t=text)
    df = df.withColumn("_n0", norm(F.col("_t"))).withColumn("_h", F.xxhash64("_n0")).withColumn("_p", F.substring("_n0", 1, PREFIX)).drop("_n0")
    df = df.join(F.broadcast(hot), F.col("_h") == F.col("_hot"), "left")
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64("_id"), F.col("_salts"))).otherwise(F.lit(0))
    df = df.withColumn("_salt", salt.cast("bigint")).withColumn("_is_hot", F.col("_salts").isNotNull()).drop("_salts", "_hot")
    order = [F.col("_chars").desc(), F.col("_id").asc_nulls_last()]

    def resolved(rows: DataFrame) -> DataFrame:
        """Deal out, sort, and compare neighbours within (salted) groups."""
        rows = rows.repartitionByRange("_p", "_h", "_salt")
        rows = rows.withColumn("_norm", norm(F.col("_t"))).withColumn("_chars", F.length("_t")).drop("_t")
        group = Window.partitionBy("_p", "_h", "_salt", "_norm")
        so_far = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return (
            rows.withColumn("_rank", F.row_number().over(group.orderBy(*order)))
            .withColumn("_keep", F.first("_id").over(so_far))
            .withColumn("_size", F.count(F.lit(1)).over(group))
            .withColumn("_sha", F.sha2("_norm", 256))
        )

    # The winners of the salts of hot groups, compared in full: at most as many as there are salts.
    again = Window.partitionBy("_h", "_norm")
    so_far = again.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    winners = resolved(df.where("_is_hot").drop(common.ROW)).where(F.col("_rank") == 1).select(
        F.col("_h").alias("_wh"),
        F.col("_salt").alias("_wsalt"),
        F.col("_sha").alias("_wsha"),
        F.first("_id").over(so_far).alias("_wkeep"),
        F.sum("_size").over(again).alias("_wsize"),
        (F.row_number().over(again.orderBy(*order)) == 1).alias("_wfirst"),
    )
    df = resolved(df).drop("_norm").join(
        F.broadcast(winners), F.col("_is_hot") & (F.col("_h") == F.col("_wh")) & (F.col("_salt") == F.col("_wsalt")) & (F.col("_sha") == F.col("_wsha")), "left"
    )
    whole = F.col("_is_hot")
    out = [
        F.col("_id").alias(id_col),
        F.when(whole, F.col("_wkeep")).otherwise(F.col("_keep")).alias("keep_id"),
        F.when(whole, F.col("_wsize")).otherwise(F.col("_size")).cast("bigint").alias("group_size"),
        ((F.col("_rank") == 1) & F.coalesce(F.col("_wfirst"), F.lit(True))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    ]
    return df.select(*out, *([F.col(common.ROW)] if carry else []))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One whole row of each group of equal texts."""
    return common.unpacked(exact_dedup(docs, carry=True).where("kept"), docs)


def query(spark, sf_dir):
    """op9: every document with the one that stays in its place."""
    return exact_dedup(common.documents(spark, sf_dir))


SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS n FROM documents
)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, CAST(count(*) OVER (PARTITION BY n) AS BIGINT) AS group_size,
       row_number() OVER g = 1 AS kept, sha256(n) AS text_sha256
FROM d
WINDOW g AS (PARTITION BY n ORDER BY length(t) DESC, doc_id)
"""
