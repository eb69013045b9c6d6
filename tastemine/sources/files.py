"""File sources and sinks (IO1-IO9).

CSV is read with an explicit schema (no inference pass over the data) and
the pandas null-token list mapped to SQL NULL; every sink writes through the
DataFrame writer, so output is produced by the executors in parallel, one
file per partition. Arrays are native in Parquet and JSON-encoded for CSV.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's CSV reader: text read as null.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Raw interaction file layout (all text; numbers are parsed leniently later).
RAW_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("movie_id", T.StringType()),
    T.StructField("movie_title", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("genres", T.StringType()),
    T.StructField("cast", T.StringType()),
    T.StructField("release_year", T.StringType()),
    T.StructField("language", T.StringType()),
])


def null_tokens_to_null(df: DataFrame) -> DataFrame:
    """Map the pandas default NA tokens of string columns to NULL."""
    tokens = F.array(*[F.lit(t) for t in NULL_TOKENS])
    return df.select(*[
        F.when(F.array_contains(tokens, F.col(f"`{f.name}`")), F.lit(None).cast("string"))
        .otherwise(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             columns: list[str] | None = None, order_col: str | None = "row_ord",
             multi_line: bool = False) -> DataFrame:
    """IO1 / IO2: header CSV, explicit schema, pandas null tokens -> NULL,
    optional column pruning (Catalyst prunes the scan). ``row_ord`` = (file,
    position) keeps the file order for keep-first / keep-last semantics.
    ``multi_line`` admits line breaks in quoted fields; Spark then reads each
    file in one task, so it is off unless asked for."""
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if order_col:
        df = df.withColumn(order_col, F.struct(F.input_file_name().alias("file"),
                                               F.monotonically_increasing_id().alias("pos")))
    df = null_tokens_to_null(df)
    if columns:
        df = df.select(*columns, *([order_col] if order_col else []))
    return df


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """IO3: Parquet scan; a column list becomes the ReadSchema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def resolve_first_existing(spark: SparkSession, base: str, *names: str) -> str:
    """IO4: the first candidate path that exists (Hadoop file system, so
    works for shared storage), else the first candidate."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in names:
        p = jvm.org.apache.hadoop.fs.Path(os.path.join(base, name))
        if p.getFileSystem(conf).exists(p):
            return os.path.join(base, name)
    return os.path.join(base, names[0])


def for_csv(df: DataFrame) -> DataFrame:
    """Arrays / structs / maps -> JSON text so the frame fits CSV."""
    return df.select(*[
        F.to_json(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO5: CSV sink with header (never onto its own input path)."""
    for_csv(df).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """IO6: Parquet sink (arrays and structs native)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_metrics(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO7 sink: a (small) metrics frame as JSON lines, one file."""
    df.coalesce(1).write.mode(mode).json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """IO7 source / L9: read a metrics JSON back."""
    return spark.read.json(path)


def metrics_frame(spark: SparkSession, metrics: dict) -> DataFrame:
    """A one-row frame from a dict of scalars (for IO7)."""
    return spark.read.json(spark.sparkContext.parallelize([json.dumps(metrics)]))


def write_sparse(df: DataFrame, key: str, index_col: str, value_col: str, size: int, path: str) -> None:
    """IO8: long sparse triples -> one sparse row per key (size, sorted
    indices, values) in Parquet; ``array_to_vector``-ready."""
    grouped = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(index_col, value_col))).alias("_e"))
    out = grouped.select(
        key, F.lit(size).alias("size"),
        F.transform("_e", lambda e: e[index_col].cast("int")).alias("indices"),
        F.transform("_e", lambda e: e[value_col].cast("double")).alias("values"))
    out.write.mode("overwrite").parquet(path)


def save_model(model, path: str) -> None:
    """IO9: fitted Spark ML models / pipelines."""
    model.write().overwrite().save(path)


def save_params(df: DataFrame, path: str) -> None:
    """IO9: fitted parameter tables (min/max, vocabularies, label codes); a
    label-code table has a row per user or item, so it is written as it lies."""
    write_parquet(df, path)
