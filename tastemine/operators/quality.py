"""Dataset-quality aggregates.

Each report is one aggregate pass producing a small frame; nothing is
collected except where a text report is explicitly requested.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemine.operators.cleaning import ORDER_COL

HIDDEN = (ORDER_COL,)

# Fixed values that must equal the reference: balance class bounds and verdicts.
BALANCE_BOUNDS = (4.0, 7.0)
BALANCE_BALANCED = 0.6
BALANCE_MODERATE = 0.35


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in HIDDEN]


def missing_long(df: DataFrame) -> DataFrame:
    """Per-column missing percentage, long form ``(field, missing_pct)``; one pass."""
    cols = _data_columns(df)
    wide = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100.0).alias(f"_{i}") for i, c in enumerate(cols)])
    stack = F.expr(
        "stack({n}, {args})".format(
            n=len(cols), args=", ".join(f"'{c}', `_{i}`" for i, c in enumerate(cols))
        )
    ).alias("field", "missing_pct")
    return wide.select(stack).select("field", F.coalesce("missing_pct", F.lit(0.0)).alias("missing_pct"))


def missing_top(df: DataFrame, top: int = 8) -> DataFrame:
    """A1: fields with missing % > 0, highest first (tie: name), top N."""
    return _top_missing(missing_long(df), top)


def _top_missing(missing: DataFrame, top: int) -> DataFrame:
    return missing.filter(F.col("missing_pct") > 0).orderBy(F.desc("missing_pct"), "field").limit(top)


def missing_comparison(datasets: dict[str, DataFrame], top: int = 10) -> DataFrame:
    """A2: missing % per dataset for the top-N fields by summed %; absent -> 0."""
    parts = [missing_long(df).withColumn("dataset", F.lit(name)) for name, df in datasets.items()]
    long = reduce(DataFrame.unionByName, parts)
    top_fields = (
        long.groupBy("field").agg(F.sum("missing_pct").alias("_total"))
        .filter(F.col("_total") > 0).orderBy(F.desc("_total"), "field").limit(top).select("field")
    )
    names = F.array(*[F.lit(n) for n in datasets]).alias("dataset")
    grid = top_fields.select("field", F.explode(names).alias("dataset"))
    return grid.join(long, ["field", "dataset"], "left").select(
        "field", "dataset", F.coalesce("missing_pct", F.lit(0.0)).alias("missing_pct")
    )


def value_counts(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """A3: non-null value counts, sorted by value."""
    name = alias or col
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias(name))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(name))


def top_values(df: DataFrame, col: str | Column, top: int = 10, fill: str | None = "unknown",
               alias: str = "value") -> DataFrame:
    """A4: top-N value counts, null -> ``fill`` (ties: value ascending)."""
    c = F.col(col) if isinstance(col, str) else col
    if fill is not None:
        c = F.coalesce(c.cast("string"), F.lit(fill))
    counts = df.groupBy(c.alias(alias)).agg(F.count(F.lit(1)).alias("count"))
    if fill is None:
        counts = counts.filter(F.col(alias).isNotNull())
    return counts.orderBy(F.desc("count"), alias).limit(top)


def top_genres(df: DataFrame, top: int = 10, col: str = "genres_list") -> DataFrame:
    """A5: explode the genre lists, count, top N."""
    exploded = df.select(F.explode(col).alias("genre"))
    return top_values(exploded, "genre", top=top, fill=None, alias="genre")


def year_counts(df: DataFrame, col: str = "release_year_clean", latest: int = 20) -> DataFrame:
    """Counts of the latest N years present, ascending."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("year")).limit(latest).orderBy("year")


def _tagged_union(datasets: dict[str, DataFrame], col: str | Column, alias: str) -> DataFrame:
    c = F.col(col) if isinstance(col, str) else col
    parts = [df.select(c.alias(alias), F.lit(name).alias("dataset")) for name, df in datasets.items()]
    return reduce(DataFrame.unionByName, parts)


def _aligned(keys: DataFrame, long: DataFrame, key: str, names: list[str]) -> DataFrame:
    grid = keys.select(key, F.explode(F.array(*[F.lit(n) for n in names])).alias("dataset"))
    return grid.join(long, [key, "dataset"], "left").select(
        key, "dataset", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def rating_comparison(datasets: dict[str, DataFrame], col: str = "rating") -> DataFrame:
    """Rating value counts per dataset, outer-aligned, absent -> 0 (long form)."""
    u = _tagged_union(datasets, col, "rating").filter(F.col("rating").isNotNull())
    long = u.groupBy("rating", "dataset").agg(F.count(F.lit(1)).alias("count"))
    keys = long.select("rating").distinct()
    return _aligned(keys, long, "rating", list(datasets))


def language_comparison(datasets: dict[str, DataFrame], col: str = "language", top: int = 10) -> DataFrame:
    """Language counts (null -> unknown) for the top-N languages by total."""
    u = _tagged_union(datasets, F.coalesce(F.col(col), F.lit("unknown")), "language")
    long = u.groupBy("language", "dataset").agg(F.count(F.lit(1)).alias("count"))
    keys = (long.groupBy("language").agg(F.sum("count").alias("_t"))
            .orderBy(F.desc("_t"), "language").limit(top).select("language"))
    return _aligned(keys, long, "language", list(datasets))


def year_comparison(datasets: dict[str, DataFrame], col: str = "release_year_clean", latest: int = 20) -> DataFrame:
    """Year counts per dataset for the latest N years of the union."""
    u = _tagged_union(datasets, F.col(col).cast("int"), "year").filter(F.col("year").isNotNull())
    long = u.groupBy("year", "dataset").agg(F.count(F.lit(1)).alias("count"))
    keys = long.select("year").distinct().orderBy(F.desc("year")).limit(latest)
    return _aligned(keys, long, "year", list(datasets))


def class_balance(df: DataFrame, classes: dict[str, Column]) -> DataFrame:
    """A10 generalised: conditional counts in one pass (zero classes count),
    ratio = min / max, verdict. No rows -> ``cannot-evaluate``."""
    counts = df.agg(*[F.count_if(cond).cast("bigint").alias(name) for name, cond in classes.items()],
                    F.count(F.lit(1)).alias("_n"))
    return _verdict(counts, list(classes))


def _verdict(counts: DataFrame, classes: list[str]) -> DataFrame:
    """Ratio and verdict of a row of class counts, ``_n`` being their sum."""
    lo = F.least(*[F.col(n) for n in classes])
    hi = F.greatest(*[F.col(n) for n in classes])
    ratio = F.when(hi > 0, lo / hi)
    verdict = (
        F.when(F.col("_n") == 0, "cannot-evaluate")
        .when(ratio >= BALANCE_BALANCED, "balanced")
        .when(ratio >= BALANCE_MODERATE, "moderately-imbalanced")
        .otherwise("imbalanced")
    )
    return counts.select(*classes, F.round(ratio, 6).alias("ratio"), verdict.alias("verdict"))


def rating_balance(df: DataFrame, col: str = "rating") -> DataFrame:
    """A10: negative [-inf, 4), neutral [4, 7), positive [7, inf)."""
    r = F.col(col)
    return class_balance(df.filter(r.isNotNull() & ~F.isnan(r)), _classes(r))


def _classes(r: Column) -> dict[str, Column]:
    lo, hi = BALANCE_BOUNDS
    return {"negative": r < lo, "neutral": (r >= lo) & (r < hi), "positive": (r >= hi) & (r < F.lit(float("inf")))}


# Fixed values that must equal the reference: recommendation text per verdict.
RECOMMENDATIONS = {
    "balanced": "Dataset has acceptable class spread for rating-based classification; "
                "no immediate balancing is required.",
    "moderately-imbalanced": "Dataset is usable, but classification tasks should consider class weights "
                             "or targeted resampling.",
    "imbalanced": "Dataset is imbalanced for rating-class tasks; apply resampling or class-weighted "
                  "training if you build a classifier.",
}


def observed_metrics(columns: list[str], kept: Column, rating: Column | None = None) -> dict[str, Column]:
    """What ``quality_report`` needs, as aggregates that can be observed while the rows are written: nulls per column and
    the classes of ``rating`` (as adjusted) among the rows with ``kept``."""
    r = F.col("rating") if rating is None else rating
    nulls = {f"null_{c}": F.count_if(kept & F.col(c).isNull()) for c in columns}
    rated = kept & r.isNotNull() & ~F.isnan(r)
    return nulls | {f"class_{name}": F.count_if(rated & cond) for name, cond in _classes(r).items()} | {"rated": F.count_if(rated)}


def quality_report(cleaned: DataFrame, stats: DataFrame, top_missing: int = 8, metrics: dict | None = None) -> DataFrame:
    """The dataset report as a ``(section, key, value)`` frame.

    Built from the cleaning stats (P13), missing top-N (A1) and balance (A10);
    every part is a small aggregate, or comes from ``metrics`` that were
    observed while the rows were written, so that nothing is read. The
    recommendation text follows the verdict (anything not balanced / moderate
    falls to the imbalanced text).
    """
    ncols = len(_data_columns(cleaned))
    if metrics is None:
        lacking, bal = missing_long(cleaned), rating_balance(cleaned)
    else:
        spark, n = cleaned.sparkSession, metrics["rows_after"]
        lacking = [(c, 100.0 * metrics[f"null_{c}"] / n if n else 0.0) for c in _data_columns(cleaned)]
        lacking = spark.createDataFrame(lacking, "field string, missing_pct double")
        counts = [metrics[f"class_{c}"] for c in ("negative", "neutral", "positive")]
        bal = _verdict(spark.createDataFrame([(*counts, metrics["rated"])], "negative bigint, neutral bigint, positive bigint, _n bigint"), ["negative", "neutral", "positive"])
    size = stats.select(
        F.lit("size").alias("section"),
        F.explode(F.create_map(
            F.lit("rows_before"), F.col("rows_before").cast("string"),
            F.lit("rows_after"), F.col("rows_after").cast("string"),
            F.lit("columns"), F.lit(str(ncols)),
        )).alias("key", "value"))
    cleaning = stats.select(
        F.lit("cleaning").alias("section"),
        F.explode(F.create_map(
            F.lit("dropped_exact_duplicates"), F.col("dropped_exact_duplicates").cast("string"),
            F.lit("dropped_missing_core_fields"), F.col("dropped_missing_core_fields").cast("string"),
        )).alias("key", "value"))
    missing = _top_missing(lacking, top_missing).select(
        F.lit("missing").alias("section"), F.col("field").alias("key"),
        F.format_number(F.col("missing_pct"), 2).alias("value"))
    balance = bal.select(
        F.lit("balance").alias("section"),
        F.explode(F.create_map(
            F.lit("negative"), F.col("negative").cast("string"),
            F.lit("neutral"), F.col("neutral").cast("string"),
            F.lit("positive"), F.col("positive").cast("string"),
            F.lit("ratio"), F.format_number(F.col("ratio"), 3),
            F.lit("verdict"), F.col("verdict"),
        )).alias("key", "value"))
    text = F.create_map(*[F.lit(x) for kv in RECOMMENDATIONS.items() for x in kv])
    rec = bal.select(F.lit("recommendation").alias("section"), F.lit("text").alias("key"),
                     F.coalesce(text[F.col("verdict")], F.lit(RECOMMENDATIONS["imbalanced"])).alias("value"))
    return reduce(DataFrame.unionByName, [size, cleaning, missing, balance, rec])


def report_markdown(name: str, report: DataFrame) -> str:
    """Render the (small) A11 frame as Markdown on the driver."""
    rows = report.collect()
    by = {}
    for r in rows:
        by.setdefault(r["section"], []).append((r["key"], r["value"]))
    lines = [f"# Dataset Evaluation: {name}", ""]  # fixed value: the heading
    for section, items in by.items():
        lines.append(f"## {section.title()}")
        lines.extend(f"- {k}: {v}" for k, v in items)
        lines.append("")
    return "\n".join(lines)
