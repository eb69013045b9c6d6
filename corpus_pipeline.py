"""A pretraining corpus pipeline: five stages over ``documents``, each one of the operators of ``tastemine.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's
documents, so a lost executor costs no more than the stage at work. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tastemine.llm import common, exact_dedup, mixing, packing, quality_rules, simhash
from tastemine.session import ensure_checkpoint_dir


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current quality policy keeps; null and empty texts fail it."""
    return quality_rules.kept_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space."""
    return exact_dedup.distinct_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash.distinct_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; at most one per shard is cut."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of the mixed documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [("quality_rules", rules), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixture), ("packing", packed)]

ORACLE_SQL = None  # fingerprints and tokens are beyond SQL; tests hold run() against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; tables between stages lie in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    docs = common.documents(spark, sf_dir)
    base = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{base}/{k}-{name}")
            docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs
