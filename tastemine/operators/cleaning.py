"""Projection, filter and cleaning operators.

Row order: Spark has no row order, so every frame carries ``row_ord``, a
column (any orderable type; the adapter uses a struct) that totally orders the
rows. Keep-first / keep-last become ``min`` / ``max_by`` over it: both are
partial aggregates, so a hot key is collapsed map-side before the shuffle and
never lands whole in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemine.functions import genres as G
from tastemine.functions.text import lenient_double, standard_year, strip_unicode
from tastemine.session import observed, release, scratch, stored

ORDER_COL = "row_ord"

# Fixed values that must equal the reference: the 12 cleaned columns in order.
COMMON_SCHEMA = [
    ("user_id", "string"),
    ("movie_id", "bigint"),
    ("movie_title", "string"),
    ("rating", "double"),
    ("genres", "string"),
    ("cast", "string"),
    ("release_year", "string"),
    ("language", "string"),
    ("release_year_clean", "int"),
    ("genres_list", "array<string>"),
    ("primary_genre", "string"),
    ("genre_count", "int"),
]
COMMON_COLUMNS = [c for c, _ in COMMON_SCHEMA]
NUMERIC_COLUMNS = ("rating", "vote_average", "vote_count")
KEY_COLUMNS = ("user_id", "movie_id")
REQUIRED_COLUMNS = ("user_id", "movie_id", "rating", "genres", "cast")
REQUIRED_BASIC = ("user_id", "movie_id", "rating")


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip every string column (Unicode white space), others untouched."""
    return df.select(
        *[
            strip_unicode(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def trim_column_names(df: DataFrame) -> DataFrame:
    """Strip column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def dedupe_column_names(df: DataFrame) -> DataFrame:
    """Keep the first of repeated column names."""
    seen: set[str] = set()
    keep = []
    for i, c in enumerate(df.columns):
        if c not in seen:
            seen.add(c)
            keep.append(i)
    if len(keep) == len(df.columns):
        return df
    # positional selection is needed because the names are ambiguous
    renamed = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return renamed.select(*[F.col(f"_c{i}").alias(df.columns[i]) for i in keep])


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def parse_by_dictionary(df: DataFrame, src: str, outputs: dict, key: str = "_dkey",
                        materialize: bool = True) -> DataFrame:
    """Evaluate expensive per-value expressions once per *distinct* value of
    ``src`` and join the result back (null keys match null).

    Genre and year texts repeat massively, and their parsing (JSON, regexes,
    collation-aware case mapping) costs microseconds per value. The distinct
    values come from a map-side-combined aggregate; the dictionary is
    stored, so its size is known and a small one is broadcast without a
    shuffle of ``df``. ``df`` should be cheap to read twice. ``outputs`` maps
    output name -> function(Column) -> Column, or a staged builder.
    """
    d = df.select(F.col(src).alias(key)).distinct()
    for name, build in outputs.items():
        if getattr(build, "staged", False):
            d = build(d, key, name)
        else:
            d = d.withColumn(name, build(F.col(key)))
    if materialize:
        d = stored(d, "snappy")
    joined = df.join(d, df[src].eqNullSafe(d[key]), "left")
    return joined.drop(key)


def _staged_genres(variant: str):
    def build(d: DataFrame, key: str, out: str) -> DataFrame:
        return G.with_parsed_genres(d, key, out, variant)
    build.staged = True
    return build


def standardize_columns(df: DataFrame, genre_parser: str = "clean", year_date_fallback: bool = True,
                        lower_language: bool = True) -> DataFrame:
    """Lenient numerics, standard year, lower language, genre columns.

    Year and genre parsing run once per distinct text (``parse_by_dictionary``)."""
    cols = {c: F.col(c) for c in df.columns}
    for c in NUMERIC_COLUMNS:
        if c in cols:
            cols[c] = lenient_double(F.col(c), _dtype(df, c))
    if "language" in cols and lower_language:
        cols["language"] = F.lower(F.col("language"))
    out = df.select(*[v.alias(k) for k, v in cols.items()])
    if "release_year" in cols:
        dtype = _dtype(df, "release_year")
        out = parse_by_dictionary(out, "release_year", {
            "release_year_clean": lambda c: standard_year(c, dtype, date_fallback=year_date_fallback)})
    if "genres" in cols:
        out = parse_by_dictionary(out, "genres", {"genres_list": _staged_genres(genre_parser)})
        # primary_genre / genre_count read the parsed list once it is a column
        out = out.withColumns(G.genre_columns(F.col("genres_list")))
    return out


def harmonize_schema(df: DataFrame, keep: tuple[str, ...] = (ORDER_COL,)) -> DataFrame:
    """``cast_names`` -> ``cast``, absent columns as typed nulls, exact order.

    When both ``cast`` and ``cast_names`` exist, they are coalesced (the
    reference would produce duplicate names).
    """
    present = set(df.columns)
    exprs: list[Column] = []
    for name, dtype in COMMON_SCHEMA:
        if name == "cast" and "cast_names" in present:
            src = F.coalesce(F.col("cast"), F.col("cast_names")) if "cast" in present else F.col("cast_names")
            exprs.append(src.cast(dtype).alias(name))
        elif name in present:
            exprs.append(F.col(name).cast(dtype).alias(name) if name != "movie_id" else
                         F.col(name).try_cast(dtype).alias(name))
        else:
            exprs.append(F.lit(None).cast(dtype).alias(name))
    extras = [F.col(c) for c in keep if c in present]
    return df.select(*exprs, *extras)


def drop_exact_duplicates(df: DataFrame, order_col: str = ORDER_COL, count_col: str | None = None,
                          within: tuple[str, ...] = ()) -> DataFrame:
    """One row per distinct value of all other columns, keeping the
    first occurrence (``min(row_ord)``). Nulls compare equal; arrays are
    compared by value. Partial aggregation combines copies map-side.
    With ``within``, rows first move to the place of those columns: a later
    step per ``within`` then needs no shuffle of its own, but copies travel.
    """
    cols = [c for c in df.columns if c != order_col]
    if within:
        df = df.repartition(*within)
    aggs = [F.min(order_col).alias(order_col)]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return df.groupBy(*cols).agg(*aggs)


def _keep_by_key(df: DataFrame, keys: list[str], order_col: str, last: bool) -> DataFrame:
    """The winner's order per key, then its row: with a 64-bit order both the
    grouping and the join work on hashes of fixed-size values, no row is
    sorted to find a maximum. The order is unique, so it names the row."""
    pick = F.max if last else F.min
    best = df.groupBy(*keys).agg(pick(order_col).alias("_best")).select("_best")
    return df.join(best, F.col(order_col) == F.col("_best"), "left_semi")


def keep_last_by_key(df: DataFrame, keys=KEY_COLUMNS, order_col: str = ORDER_COL) -> DataFrame:
    """``drop_duplicates(subset=keys, keep='last')`` (null keys equal)."""
    return _keep_by_key(df, list(keys), order_col, True)


def keep_first_by_key(df: DataFrame, keys, order_col: str = ORDER_COL) -> DataFrame:
    """``drop_duplicates(subset=keys, keep='first')`` (null keys equal)."""
    return _keep_by_key(df, list(keys), order_col, False)


def keep_ranked(df: DataFrame, keys, order: Column) -> DataFrame:
    """The rows that come first per key (null keys equal) in ``order``, whole, in one shuffle. Each task passes on its
    first row of a key only (a window group limit), so a hot key collapses before the shuffle. With a unique order that is
    one row a key."""
    first = F.rank().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_first", first).where(F.col("_first") == 1).drop("_first")


def drop_missing(df: DataFrame, subset=REQUIRED_COLUMNS) -> DataFrame:
    """P10: drop rows null in any present required column."""
    present = [c for c in subset if c in df.columns]
    return df.dropna(subset=present) if present else df


def drop_empty_genres(df: DataFrame) -> DataFrame:
    """P11."""
    return df.filter(F.size("genres_list") > 0)


def filter_language(df: DataFrame, language: str = "en") -> DataFrame:
    """Keep one language (compared lower-cased); null languages are dropped."""
    return df.filter(F.lower(F.col("language")) == language) if "language" in df.columns else df


def adjust_half_step(df: DataFrame, col: str = "rating") -> DataFrame:
    """A rating whose fractional part is 0.5 (np.isclose tolerances) gains 0.5."""
    return df.withColumn(col, half_step_up(F.col(col)))


def half_step_up(r: Column) -> Column:
    """P14 as an expression."""
    frac = r - F.floor(r)
    close = F.abs(frac - 0.5) <= (1e-8 + 1e-5 * 0.5)
    return F.when(close, r + 0.5).otherwise(r)


def filter_high_rating(df: DataFrame, threshold: float = 7.0, col: str = "rating") -> DataFrame:
    """P15."""
    return df.filter(F.col(col) >= threshold)


@dataclass
class Cleaned:
    """Result of ``clean_dataset``: the cleaned rows, a one-row stats frame, and the metrics that were observed while
    the rows were written (the stats come from them)."""

    df: DataFrame
    stats: DataFrame
    metrics: dict


def clean_dataset(raw: DataFrame, profile: str = "full", genre_parser: str = "clean",
                  language: str = "en", order_col: str = ORDER_COL, observe=None) -> Cleaned:
    """P13 (``profile='full'``) / P13b (``profile='basic'``).

    full : trim strings -> standardise -> harmonise -> exact dedup (first)
           -> key dedup (last) -> drop null core fields -> drop empty genres
           -> language filter.
    basic: no trim, no exact dedup, only user/movie/rating required, no
           empty-genre filter, no date fallback for the year.

    Dedup happens before the filters (a later invalid row evicts an earlier
    valid one, then is dropped itself). The derived columns (clean year,
    genre list, primary genre, count) are functions of the raw ones, so the
    exact dedup compares the 8 normalised raw columns and the derived
    columns are computed after the dedups, once per distinct text, from the
    aggregated rows (no second scan of the source). Stats: ``rows_before,
    rows_after, dropped_exact_duplicates, dropped_missing_core_fields`` (the
    reference counts every post-dedup loss there) plus a per-reason breakdown;
    they are observed while the rows are written. ``observe`` maps the columns
    of the cleaned rows and a condition (a row is among them) to aggregates
    that are observed as well.
    """
    full = profile == "full"
    if not full and genre_parser == "clean":
        genre_parser = "notebook"
    df = trim_column_names(raw)
    if full:
        df = trim_strings(df)
    cols = {c: F.col(c) for c in df.columns}
    for c in NUMERIC_COLUMNS:
        if c in cols:
            cols[c] = lenient_double(F.col(c), _dtype(df, c))
    if "language" in cols and full:
        cols["language"] = F.lower(F.col("language"))
    year_type = _dtype(df, "release_year") if "release_year" in df.columns else T.StringType()
    df = df.select(*[v.alias(k) for k, v in cols.items()])
    df = harmonize_schema(df, keep=(order_col,)).select(*COMMON_COLUMNS[:8], order_col)

    # both dedups in one shuffle: copies of a row have its key
    exact = drop_exact_duplicates(df, order_col, count_col="_rows", within=KEY_COLUMNS) if full else df.withColumn("_rows", F.lit(1).cast("bigint"))
    # stage boundary: the deduplicated rows are read by the dictionaries and
    # the cleaned output; rows and exact classes are counted on the way
    told = Observation()
    exact = exact.observe(told, F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("after_exact"))
    survivors, remove = scratch(keep_ranked(exact.drop("_rows"), KEY_COLUMNS, F.desc(order_col)))
    release(raw.sparkSession)
    survivors = parse_by_dictionary(survivors, "release_year", {
        "release_year_clean": lambda c: standard_year(c, year_type, date_fallback=full)})
    survivors = parse_by_dictionary(survivors, "genres", {"genres_list": _staged_genres(genre_parser)})
    survivors = survivors.withColumns(G.genre_columns(F.col("genres_list")))

    required = REQUIRED_COLUMNS if full else REQUIRED_BASIC
    has_core = F.lit(True)
    for c in required:
        has_core = has_core & F.col(c).isNotNull()
    has_genres = F.size("genres_list") > 0 if full else F.lit(True)
    is_lang = F.coalesce(F.lower(F.col("language")) == language, F.lit(False))
    survivors = survivors.withColumn(
        "_reason",
        F.when(~has_core, "missing_core").when(~has_genres, "empty_genres").when(~is_lang, "language"),
    )
    kept = F.col("_reason").isNull()
    survivors, m = observed(
        survivors.select(*COMMON_COLUMNS, order_col, "_reason"), after_key=F.count(F.lit(1)),
        rows_after=F.count_if(kept), **{r: F.count_if(F.col("_reason") == r) for r in ("missing_core", "empty_genres", "language")},
        **(observe(COMMON_COLUMNS, kept) if observe else {}),
    )
    remove()
    release(raw.sparkSession)
    m = {**told.get, **m}
    stats = {
        "rows_before": m["rows_before"], "rows_after": m["rows_after"],
        "dropped_exact_duplicates": m["rows_before"] - m["after_exact"], "dropped_missing_core_fields": m["after_exact"] - m["rows_after"],
        "dropped_key_duplicates": m["after_exact"] - m["after_key"], "dropped_null_core": m["missing_core"],
        "dropped_empty_genres": m["empty_genres"], "dropped_language": m["language"],
    }
    table = raw.sparkSession.createDataFrame([tuple(stats.values())], ", ".join(f"{c} bigint" for c in stats))
    return Cleaned(survivors.filter(kept).select(*COMMON_COLUMNS, order_col), table, m)


def drop_identical_columns(df: DataFrame, protect: tuple[str, ...] = (ORDER_COL,)) -> tuple[DataFrame, list[str]]:
    """Drop every column equal (null-safe, on all rows) to an earlier one.

    One pass computes, per column, its null count and a sum of 64-bit value
    hashes; only columns with matching fingerprints are candidate pairs, and
    those are verified exactly with ``min(a <=> b)`` in a second single pass.
    Returns the frame and the dropped names (driver sees only per-column
    scalars, never rows).
    """
    cols = [c for c in df.columns if c not in protect]
    if len(cols) < 2:
        return df, []
    types = [df.schema[c].dataType for c in cols]
    numeric = [isinstance(t, T.NumericType) for t in types]
    fp_aggs = []
    for i, c in enumerate(cols):
        # numbers are hashed as doubles so that 1 (int) and 1.0 (double) agree
        v = F.col(c).cast("double") if numeric[i] else F.col(c)
        fp_aggs.append(F.count_if(F.col(c).isNull()).alias(f"n{i}"))
        fp_aggs.append(F.sum((F.xxhash64(v) % 1000003).cast("double")).alias(f"h{i}"))
    fp = df.agg(*fp_aggs).first()
    candidates = []
    for j in range(len(cols)):
        for i in range(j):
            comparable = types[i] == types[j] or (numeric[i] and numeric[j])
            if comparable and fp[f"n{i}"] == fp[f"n{j}"] and fp[f"h{i}"] == fp[f"h{j}"]:
                candidates.append((i, j))
    if not candidates:
        return df, []
    checks = df.agg(
        *[F.min(F.col(cols[i]).eqNullSafe(F.col(cols[j])).cast("int")).alias(f"e{i}_{j}") for i, j in candidates]
    ).first()
    kept: list[int] = []
    dropped: list[str] = []
    equal = {(i, j) for i, j in candidates if checks[f"e{i}_{j}"] in (1, None)}
    for j in range(len(cols)):
        if any((i, j) in equal for i in kept):
            dropped.append(cols[j])
        else:
            kept.append(j)
    return df.drop(*dropped), dropped
