"""Feature encoding.

Fitted parameters (min/max, vocabularies, label codes, idf) are small Spark
tables computed by aggregates and applied by join; a one-row parameter table
is broadcast (its size is fixed), vocabularies of unbounded size are joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemine.functions.genres import canonical_genre
from tastemine.operators.indexing import encode_many

# Fixed values that must equal the reference: source -> code, TF-IDF settings.
SOURCE_CODES = {"TMDB_cleaned": 0, "Trakt_cleaned": 1}
TFIDF_MAX_FEATURES = 500
TFIDF_TOKEN_PATTERN = r"[^,]+"


def minmax_params(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """One-row table of min / max per feature (nulls ignored)."""
    aggs = []
    for name, c in cols.items():
        aggs += [F.min(c).alias(f"_min_{name}"), F.max(c).alias(f"_max_{name}")]
    return df.agg(*aggs)


def minmax_scale(df: DataFrame, cols: dict[str, Column], params: DataFrame | None = None) -> DataFrame:
    """``(x - min) / (max - min)``, constant features -> 0 (sklearn),
    unlike ``ml.MinMaxScaler`` (0.5). ``cols`` maps output name -> input
    expression; ``params`` (fit elsewhere, e.g. on train) is a one-row frame."""
    p = params if params is not None else minmax_params(df, cols)
    joined = df.crossJoin(F.broadcast(p))
    out = {}
    for name, c in cols.items():
        lo, hi = F.col(f"_min_{name}"), F.col(f"_max_{name}")
        rng = hi - lo
        out[name] = F.when(rng == 0, c - lo).otherwise((c - lo) / rng)
    return joined.withColumns(out).drop(*p.columns)


def genre_vocabulary(df: DataFrame, col: str = "genres_list") -> list[str]:
    """Sorted distinct genre names, for the wide form alone: they become its
    columns, so they have to be known to the plan."""
    vocab = df.select(F.explode(col).alias("g")).where(F.col("g").isNotNull()).distinct()
    return [r["g"] for r in vocab.orderBy("g").collect()]


def genre_column_name(g: str) -> str:
    return "genre_" + g.replace(" ", "_")


def multi_hot(df: DataFrame, vocab: list[str], col: str = "genres_list") -> DataFrame:
    """``genre_<g>`` 0/1 per vocabulary entry (sorted), spaces -> ``_``."""
    return df.withColumns({genre_column_name(g): F.array_contains(col, g).cast("int") for g in vocab})


def genre_long(df: DataFrame, key: str, col: str = "genres_list") -> DataFrame:
    """E3 long form: ``(key, genre)`` for every genre present (the sparse
    equivalent of the one-hot block; no vocabulary on the driver)."""
    return df.select(key, F.explode(F.array_distinct(col)).alias("genre"))


def source_code(c: Column) -> Column:
    """Source tag -> 0/1, unmapped -> null."""
    m = F.create_map(*[F.lit(x) for kv in SOURCE_CODES.items() for x in kv])
    return m[c]


@dataclass
class Encoded:
    df: DataFrame
    genre_vocab: list[str]


def preprocess_features(df: DataFrame, wide_genres: bool = False, attach: dict | None = None) -> Encoded:
    """Cast null -> unknown, re-canonical genre list, E1 rating scale, E3
    multi-hot (``wide_genres``; else see ``genre_long``), E4 label codes (primary genre, user, movie as strings), E6
    source code, E2 year / genre-count scale with null -> 0. ``attach``: see ``encode_many``."""
    out = df.withColumn("cast", F.coalesce(F.col("cast"), F.lit("unknown")))
    out = out.withColumn(
        "genres_list",
        F.filter(F.transform(F.coalesce("genres_list", F.array().cast("array<string>")), canonical_genre),
                 lambda g: g != ""),
    )
    vocab: list[str] = []
    if wide_genres:
        vocab = genre_vocabulary(out)
        out = multi_hot(out, vocab)
    out = encode_many(out, [("primary_genre", "primary_genre_encoded", "unknown"),
                            ("user_id", "user_idx", None), ("movie_id", "movie_idx", None)], attach)
    if "source" in out.columns:
        out = out.withColumn("source_encoded", source_code(F.col("source")))
    feats = {
        "rating_scaled": F.col("rating"),
        "year_scaled": F.coalesce(F.col("release_year").cast("double"), F.lit(0.0)),
        "genre_count_scaled": F.coalesce(F.col("genre_count").cast("double"), F.lit(0.0)),
    }
    out = minmax_scale(out, feats)
    return Encoded(out, vocab)


def tfidf(df: DataFrame, key: str, col: str = "cast", max_features: int = TFIDF_MAX_FEATURES,
          trim_tokens: bool = False) -> DataFrame:
    """E5: TF-IDF of comma-separated tokens, long sparse form ``(key, term, weight)``.

    Tokens are lower-cased ``[^,]+`` runs (spaces kept unless ``trim_tokens``),
    vocabulary = the ``max_features`` terms of highest total count (ties:
    term ascending), tf = raw count, idf = ln((1+n)/(1+df)) + 1 with n the
    number of rows, rows L2-normalised. All by aggregates and joins; the
    vocabulary (bounded by ``max_features``) is broadcast.
    """
    tok = F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col(col), F.lit(""))), F.lit(TFIDF_TOKEN_PATTERN), 0))
    terms = df.select(key, tok.alias("term"))
    if trim_tokens:
        terms = terms.withColumn("term", F.trim("term")).filter(F.col("term") != "")
    tf = terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    n_docs = df.agg(F.count(F.lit(1)).alias("_n"))
    stats = tf.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
    vocab = stats.orderBy(F.desc("total"), "term").limit(max_features)
    vocab = vocab.crossJoin(F.broadcast(n_docs)).select(
        F.col("term").alias("_v"), (F.log((1.0 + F.col("_n")) / (1.0 + F.col("df"))) + 1.0).alias("idf"))
    # with the vocabulary known, one grouping gathers a key's terms and an array expression scales them
    kept = terms.join(F.broadcast(vocab), F.col("term") == F.col("_v"))
    w = kept.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("term", "idf"))).alias("_t"))
    of = lambda t: F.size(F.filter("_t", lambda x: x["term"] == t["term"])) * t["idf"]
    w = w.select(key, F.transform(F.array_distinct("_t"), lambda t: F.struct(t["term"].alias("term"), of(t).alias("w"))).alias("_w"))
    norm = F.sqrt(F.aggregate("_w", F.lit(0.0), lambda s, x: s + x["w"] * x["w"]))
    w = w.select(key, F.explode("_w").alias("_x"), norm.alias("_norm"))
    return w.select(key, F.col("_x.term").alias("term"), (F.col("_x.w") / F.col("_norm")).alias("weight"))
