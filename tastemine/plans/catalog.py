"""Registered queries: one Spark callable and (where exact) one DuckDB SQL each.

Every query reads the driver's tables (or frames Spark derives from them) in
full; no id subsets, no row caps except where a top-N is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemine.operators import quality as Q
from tastemine.plans import oracle as O
from tastemine.plans.pipeline import Stages, emit

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


CLEAN_OUT = (
    'user_id, movie_id, movie_title, {r} AS rating, genres, "cast", release_year, language, release_year_clean, '
    "array_to_string(genres_list, '|') AS genres_list, primary_genre, genre_count"
)


# The sources by the letter of their frames, with their tags.
SOURCES = {"a": "TMDB_cleaned", "b": "Trakt_cleaned"}


def _each_sql(select) -> str:
    """The rows of both sources, ``select`` giving the query for a source's letter."""
    return " UNION ALL ".join(f"SELECT '{tag}' AS source, * FROM ({select(x)})" for x, tag in SOURCES.items())


def _each(fn) -> DataFrame:
    a, b = (fn(x.upper()).withColumn("source", F.lit(tag)) for x, tag in SOURCES.items())
    return a.unionByName(b)


# --- P13 clean --------------------------------------------------------------------------------

@register("clean", O.with_query(O.pipeline_ctes(), _each_sql(lambda x: f"SELECT {CLEAN_OUT.format(r=O.r6('rating'))} FROM clean_{x}")))
def q_clean(spark, sf):
    """P13 of both sources."""
    return _each(lambda x: emit(Stages.of(spark, sf).cleaned(x).df))


def _stats_sql(src: str, name: str) -> str:
    return f"""SELECT
  (SELECT count(*) FROM raw_{src})::BIGINT AS rows_before,
  (SELECT count(*) FROM {name})::BIGINT AS rows_after,
  (SELECT count(*) FROM raw_{src})::BIGINT - (SELECT count(*) FROM {name}_ex)::BIGINT AS dropped_exact_duplicates,
  (SELECT count(*) FROM {name}_ex)::BIGINT - (SELECT count(*) FROM {name})::BIGINT AS dropped_missing_core_fields,
  (SELECT count(*) FROM {name}_ex)::BIGINT - (SELECT count(*) FROM {name}_key)::BIGINT AS dropped_key_duplicates,
  (SELECT count(*) FROM {name}_key WHERE user_id IS NULL OR movie_id IS NULL OR rating IS NULL
      OR genres IS NULL OR "cast" IS NULL)::BIGINT AS dropped_null_core,
  (SELECT count(*) FROM {name}_key WHERE NOT (user_id IS NULL OR movie_id IS NULL OR rating IS NULL
      OR genres IS NULL OR "cast" IS NULL) AND len(genres_list) = 0)::BIGINT AS dropped_empty_genres,
  (SELECT count(*) FROM {name}_key WHERE NOT (user_id IS NULL OR movie_id IS NULL OR rating IS NULL
      OR genres IS NULL OR "cast" IS NULL) AND len(genres_list) > 0
      AND coalesce(language = 'en', false) = false)::BIGINT AS dropped_language"""


@register("clean_stats", O.with_query(O.pipeline_ctes(), _each_sql(lambda x: _stats_sql(x, f"clean_{x}"))))
def q_clean_stats(spark, sf):
    """P13's counts of both sources."""
    return _each(lambda x: Stages.of(spark, sf).cleaned(x).stats)


def _basic_sql() -> str:
    ctes = O.raw_ctes() + O.clean_ctes("raw_a", "basic_a", "cast", profile="basic") + O.clean_ctes("raw_b", "basic_b", "cast_names", profile="basic")
    return O.with_query(ctes, _each_sql(lambda x: f"SELECT {CLEAN_OUT.format(r=O.r6('rating'))} FROM basic_{x}"))


@register("clean_basic", _basic_sql())
def q_clean_basic(spark, sf):
    """P13b of both sources."""
    return _each(lambda x: emit(Stages.of(spark, sf).cleaned(x, profile="basic").df))


# --- A10 rating balance (flagship) -------------------------------------------------------------

BALANCE_SQL = """SELECT
  count_if(rating < 4)::BIGINT AS negative,
  count_if(rating >= 4 AND rating < 7)::BIGINT AS neutral,
  count_if(rating >= 7 AND rating < 'inf'::DOUBLE)::BIGINT AS positive,
  round(least(count_if(rating < 4), count_if(rating >= 4 AND rating < 7), count_if(rating >= 7 AND rating < 'inf'::DOUBLE))
     / nullif(greatest(count_if(rating < 4), count_if(rating >= 4 AND rating < 7), count_if(rating >= 7 AND rating < 'inf'::DOUBLE)), 0), 6) AS ratio,
  CASE WHEN count(*) = 0 THEN 'cannot-evaluate'
       WHEN least(count_if(rating < 4), count_if(rating >= 4 AND rating < 7), count_if(rating >= 7 AND rating < 'inf'::DOUBLE))
            / greatest(count_if(rating < 4), count_if(rating >= 4 AND rating < 7), count_if(rating >= 7 AND rating < 'inf'::DOUBLE)) >= 0.6 THEN 'balanced'
       WHEN least(count_if(rating < 4), count_if(rating >= 4 AND rating < 7), count_if(rating >= 7 AND rating < 'inf'::DOUBLE))
            / greatest(count_if(rating < 4), count_if(rating >= 4 AND rating < 7), count_if(rating >= 7 AND rating < 'inf'::DOUBLE)) >= 0.35 THEN 'moderately-imbalanced'
       ELSE 'imbalanced' END AS verdict
FROM {src} WHERE rating IS NOT NULL"""


@register("rating_balance", O.with_query(O.pipeline_ctes("adjusted"), _each_sql(lambda x: BALANCE_SQL.format(src=f"clean_{x}_adj"))))
def q_rating_balance(spark, sf):
    """Flagship: clean each source, adjust half steps, balance verdict."""
    return _each(lambda x: Q.rating_balance(Stages.of(spark, sf).adjusted(x)))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_rating_balance(spark, sf_dir)


# --- U4 integrate -----------------------------------------------------------------------------

@register("integrate", O.with_query(O.pipeline_ctes("integrated"),
                                    f"SELECT {CLEAN_OUT.format(r=O.r6('rating'))}, source FROM integ"))
def q_integrate(spark, sf):
    return emit(Stages.of(spark, sf).integrated().df)


@register("integrate_stats", O.with_query(O.pipeline_ctes("integrated"), """SELECT
  (SELECT count(*) FROM clean_a_adj)::BIGINT AS tmdb_rows,
  (SELECT count(*) FROM clean_b_adj)::BIGINT AS trakt_rows,
  (SELECT count(*) FROM integ_u)::BIGINT AS merged_before_dedup,
  (SELECT count(*) FROM integ_ex)::BIGINT AS merged_after_exact_dedup,
  (SELECT count(*) FROM integ)::BIGINT AS merged_after_key_dedup"""))
def q_integrate_stats(spark, sf):
    return Stages.of(spark, sf).integrated().stats


# --- A12 / A13 imputation, P18 transform ------------------------------------------------------

def _impute_raw_sql() -> list[str]:
    ctes = O.raw_ctes()
    for x, cast in (("a", '"cast"'), ("b", "cast_names")):
        ctes.append(f"""don_{x} AS (
  SELECT movie_id, movie_title, CASE WHEN trim({cast}) <> '' THEN trim({cast}) END AS c,
    CASE WHEN trim(genres) <> '' THEN trim(genres) END AS g
  FROM raw_{x})""")
        for key, col, name in [("movie_id", "c", "ic"), ("movie_id", "g", "ig"), ("movie_title", "c", "tc"), ("movie_title", "g", "tg")]:
            ctes.append(f"""{name}_{x} AS (
  SELECT {key}, v FROM (SELECT {key}, {col} AS v, count(*) AS n FROM don_{x} WHERE {col} IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY n DESC, v) = 1)""")
        ctes.append(f"""imp_{x} AS (
  SELECT r.user_id, r.movie_id, r.movie_title,
    coalesce(CASE WHEN trim(r.{cast}) <> '' THEN r.{cast} END, ic.v, tc.v, 'unknown') AS "cast",
    coalesce(CASE WHEN trim(r.genres) <> '' THEN r.genres END, ig.v, tg.v, 'unknown') AS genres
  FROM raw_{x} r
  LEFT JOIN ic_{x} ic ON r.movie_id = ic.movie_id LEFT JOIN ig_{x} ig ON r.movie_id = ig.movie_id
  LEFT JOIN tc_{x} tc ON r.movie_title = tc.movie_title LEFT JOIN tg_{x} tg ON r.movie_title = tg.movie_title)""")
    return ctes


def _raw_fields(spark, sf, x: str) -> DataFrame:
    cast = F.col("cast" if x == "A" else "cast_names").alias("cast")
    return Stages.of(spark, sf).raw(x).select("row_ord", "user_id", "movie_id", "movie_title", cast, "genres")


def _impute_raw(spark, sf, x: str) -> DataFrame:
    """Imputation reads the rows several times, so they are derived once and stored."""
    from tastemine.operators import impute as I
    from tastemine.session import stored
    return I.impute_by_mode(stored(_raw_fields(spark, sf, x)))


@register("impute_mode_raw", O.with_query(_impute_raw_sql(), _each_sql(lambda x: f'SELECT user_id, movie_id, movie_title, "cast", genres FROM imp_{x}')))
def q_impute_mode_raw(spark, sf):
    return _each(lambda x: emit(_impute_raw(spark, sf, x)))


@register("imputation_audit", O.with_query(_impute_raw_sql(), _each_sql(lambda x: f"""SELECT count(*)::BIGINT AS rows,
  round(avg(CASE WHEN "cast" IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS missing_pct_cast,
  count_if("cast" IS NOT NULL AND trim("cast") = '')::BIGINT AS empty_cast,
  count_if(lower("cast") = 'unknown')::BIGINT AS unknown_cast,
  round(avg(CASE WHEN genres IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS missing_pct_genres,
  count_if(genres IS NOT NULL AND trim(genres) = '')::BIGINT AS empty_genres,
  count_if(lower(genres) = 'unknown')::BIGINT AS unknown_genres
FROM imp_{x}""")))
def q_imputation_audit(spark, sf):
    from tastemine.operators import impute as I
    return _each(lambda x: I.imputation_audit(_impute_raw(spark, sf, x)))


@register("impute_unknown_raw", O.with_query(O.raw_ctes(), _each_sql(lambda x: """SELECT user_id, movie_id,
  coalesce(nullif(trim({cast}), ''), 'unknown') AS "cast", coalesce(nullif(trim(genres), ''), 'unknown') AS genres
FROM raw_{x}""".format(x=x, cast='"cast"' if x == "a" else "cast_names"))))
def q_impute_unknown_raw(spark, sf):
    from tastemine.operators import impute as I
    return _each(lambda x: emit(I.impute_unknown(_raw_fields(spark, sf, x).drop("movie_title"))))


TRANS_OUT = ('user_id, movie_id, movie_title, {r} AS rating, "cast", {y} AS release_year, language, '
             "array_to_string(genres_list, '|') AS genres_list, primary_genre, genre_count, source")


@register("transform", O.with_query(O.stage_ctes("transformed"),
                                    f"SELECT {TRANS_OUT.format(r=O.r6('rating'), y=O.r6('release_year'))} FROM trans"))
def q_transform(spark, sf):
    return emit(Stages.of(spark, sf).transformed())


# --- E7 encode, E5 TF-IDF ---------------------------------------------------------------------

ENC_COLS = ["user_id", "movie_id", "rating", "user_idx", "movie_idx", "primary_genre", "primary_genre_encoded",
            "source_encoded", "rating_scaled", "year_scaled", "genre_count_scaled"]


@register("encode", O.with_query(O.stage_ctes("encoded"), """SELECT user_id, movie_id, round(rating, 6) AS rating,
  user_idx::BIGINT AS user_idx, movie_idx::BIGINT AS movie_idx, primary_genre,
  primary_genre_encoded::BIGINT AS primary_genre_encoded, source_encoded::INTEGER AS source_encoded,
  round(rating_scaled, 6) AS rating_scaled, round(year_scaled, 6) AS year_scaled,
  round(genre_count_scaled, 6) AS genre_count_scaled
FROM enc"""))
def q_encode(spark, sf):
    return emit(Stages.of(spark, sf).encoded().df.select(*ENC_COLS))


@register("encode_genre_onehot", O.with_query(O.stage_ctes("encoded"), """SELECT user_idx::BIGINT AS user_idx,
  movie_idx::BIGINT AS movie_idx, round(rating, 6) AS rating, g AS genre
FROM enc, unnest(list_distinct(genres_list)) AS t(g)"""))
def q_encode_genre_onehot(spark, sf):
    """E3 checked in long form: one row per (row, genre) whose one-hot cell is 1."""
    enc = Stages.of(spark, sf).encoded()
    cols = [F.when(F.col(f"`{E_name(g)}`") == 1, F.lit(g)) for g in enc.genre_vocab]
    hot = enc.df.select("user_idx", "movie_idx", "rating", F.explode(F.array(*cols)).alias("genre"))
    return emit(hot.filter(F.col("genre").isNotNull()))


def E_name(g: str) -> str:
    from tastemine.operators.encode import genre_column_name
    return genre_column_name(g)


@register("tfidf_cast", O.with_query(O.stage_ctes("transformed"), """,
tok AS (SELECT user_id, movie_id, rating, t AS term
        FROM (SELECT *, coalesce("cast", 'unknown') AS c FROM trans), unnest(regexp_extract_all(lower(c), '[^,]+')) AS u(t)),
tf AS (SELECT user_id, movie_id, rating, term, count(*) AS tf FROM tok GROUP BY ALL),
st AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term),
voc AS (SELECT term, ln((1.0 + (SELECT count(*) FROM trans)) / (1.0 + df)) + 1.0 AS idf
        FROM st ORDER BY total DESC, term LIMIT 500),
w AS (SELECT tf.*, tf.tf * voc.idf AS w FROM tf JOIN voc USING (term))
SELECT user_id, movie_id, round(rating, 6) AS rating, term,
       round(w / sqrt(sum(w * w) OVER (PARTITION BY user_id, movie_id, rating)), 6) AS weight
FROM w"""))
def q_tfidf_cast(spark, sf):
    from tastemine.operators.encode import tfidf
    t = Stages.of(spark, sf).transformed().withColumn("_k", F.struct("user_id", "movie_id", "rating"))
    out = tfidf(t, "_k")
    return emit(out.select("_k.user_id", "_k.movie_id", "_k.rating", "term", "weight"))


# --- W8 / W9 / A18 / U5 split -----------------------------------------------------------------

@register("split_assign", O.with_query(O.stage_ctes("split"), "SELECT user_idx::BIGINT AS user_idx, split FROM assign"))
def q_split_assign(spark, sf):
    from tastemine.operators.split import group_assignment
    return emit(group_assignment(Stages.of(spark, sf).encoded().df, "user_idx"))


@register("split_report", O.with_query(O.stage_ctes("split"), """SELECT split, count(*)::BIGINT AS samples,
  count(DISTINCT user_idx)::BIGINT AS users, count(DISTINCT movie_id)::BIGINT AS movies,
  round(count(*) / (SELECT count(*) FROM splitted), 6) AS ratio,
  round(count(DISTINCT user_idx) / (SELECT count(DISTINCT user_idx) FROM splitted) * 100.0, 6) AS user_pct
FROM splitted GROUP BY split"""))
def q_split_report(spark, sf):
    from tastemine.operators.split import sampling_report
    return sampling_report(Stages.of(spark, sf).split(), "user_idx", "movie_id")


@register("split_threshold", O.with_query(O.stage_ctes("encoded"), """SELECT user_id, CASE WHEN u < 0.7 THEN 'train'
  WHEN u < 0.85 THEN 'val' ELSE 'test' END AS split FROM (
  SELECT DISTINCT user_id, ('0x' || substr(md5('42:' || user_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM enc)"""))
def q_split_threshold(spark, sf):
    """W8 in one pass: a user's split from its hash alone, so it stays when users are added."""
    from tastemine.operators.split import group_assignment
    return group_assignment(Stages.of(spark, sf).encoded().df, "user_id", mode="threshold")


SKETCH_K = 256
SKETCH_SQL = O.with_query(O.stage_ctes("split") + ["""v AS (SELECT split, 'users' AS counted, ('0x' || substr(md5(user_id), 1, 15))::BIGINT AS h FROM splitted
  UNION SELECT split, 'movies', ('0x' || substr(md5(CAST(movie_id AS VARCHAR)), 1, 15))::BIGINT FROM splitted)""",
    "g AS (SELECT split, counted, h FROM v UNION SELECT 'all', counted, h FROM v)",
    f"least_ AS (SELECT *, row_number() OVER (PARTITION BY split, counted ORDER BY h) AS n FROM g QUALIFY n <= {SKETCH_K})"],
    f"""SELECT split, counted, count(*)::BIGINT AS kept, round(CASE WHEN count(*) < {SKETCH_K} THEN count(*)::DOUBLE
  ELSE {SKETCH_K - 1} / ((max(h) + 1)::DOUBLE / 1152921504606846976.0::DOUBLE) END, 6) AS estimate FROM least_ GROUP BY split, counted""")


@register("distinct_sketches", SKETCH_SQL)
def q_distinct_sketches(spark, sf):
    """A17 at scale: sketches of users and movies per split and source, stored, read back, and rolled up to splits and to
    all rows."""
    import uuid

    from tastemine.operators import sketch as K
    from tastemine.session import ensure_checkpoint_dir
    from tastemine.sources import files
    rows = Stages.of(spark, sf).split().select("split", "source", "user_id", "movie_id")
    path = f"{ensure_checkpoint_dir(spark)}/sketches-{uuid.uuid4().hex}"
    for name, col in (("users", "user_id"), ("movies", "movie_id")):
        files.write_parquet(K.sketch(rows, ["split", "source"], col, SKETCH_K).withColumn("counted", F.lit(name)), f"{path}/{name}")
    stored = files.read_parquet(spark, f"{path}/users").unionByName(files.read_parquet(spark, f"{path}/movies"))
    split = K.merge(stored, ["split", "counted"], SKETCH_K)
    whole = K.merge(split, ["counted"], SKETCH_K).withColumn("split", F.lit("all"))
    return emit(split.unionByName(whole).select("split", "counted", F.size("hashes").cast("bigint").alias("kept"), K.estimate().alias("estimate")))


@register("split_index", O.with_query(O.stage_ctes("split"), f"""SELECT
  (row_number() OVER (ORDER BY _part, {O.ORD}) - 1)::BIGINT AS "index", split FROM splitted"""))
def q_split_index(spark, sf):
    from tastemine.operators.split import split_index
    return split_index(Stages.of(spark, sf).split())


@register("split_overlap", O.with_query(O.stage_ctes("split"), """SELECT user_idx::BIGINT AS user_idx,
  count(DISTINCT split)::BIGINT AS n_splits FROM splitted GROUP BY user_idx HAVING count(DISTINCT split) > 1"""))
def q_split_overlap(spark, sf):
    from tastemine.operators.integrate import split_overlap
    return split_overlap(Stages.of(spark, sf).split(), "user_idx")


@register("split_events", """WITH g AS (SELECT DISTINCT user_id FROM events),
r AS (SELECT user_id, row_number() OVER (ORDER BY md5('42:' || CAST(user_id AS VARCHAR)), user_id) - 1 AS r,
             count(*) OVER () AS u FROM g)
SELECT user_id, CASE WHEN r < floor(0.7 * u) THEN 'train'
                     WHEN r < floor(0.7 * u) + floor(0.5 * (u - floor(0.7 * u))) THEN 'val' ELSE 'test' END AS split
FROM r""")
def q_split_events(spark, sf):
    from tastemine.operators.split import group_assignment
    from tastemine.sources.views import events
    return group_assignment(events(spark, sf), "user_id")


# --- M1-M6 / A22 / A23 / L4 / L5 association rules --------------------------------------------
# Baskets: transaction = order, item = part name, no rating floor (FIXTURES.md:
# a (customer, name) basket makes every pair frequent). min_support 0.0007 covers
# itemsets of size 3, hence multi-item consequents.

RULE_SUPPORT = 0.0007


def _mined(spark, sf):
    return Stages.of(spark, sf).mined(RULE_SUPPORT)


def _level_sql(k: int) -> list[str]:
    if k == 1:
        occurs = "SELECT t, [item] AS items, item AS last FROM bk"
    else:
        occurs = f"SELECT o.t, list_append(o.items, b.item) AS items, b.item AS last FROM o{k - 1} o JOIN bk b ON b.t = o.t AND b.item > o.last"
    return [f"a{k} AS MATERIALIZED ({occurs})",
            f"f{k} AS MATERIALIZED (SELECT items, count(*) AS c FROM a{k} GROUP BY items HAVING count(*) >= (SELECT m FROM nb))",
            f"o{k} AS MATERIALIZED (SELECT a.* FROM a{k} a SEMI JOIN f{k} f ON a.items = f.items)"]


def _itemset_sql() -> list[str]:
    s = RULE_SUPPORT
    return [
        "bk AS (SELECT DISTINCT l.l_orderkey AS t, p.p_name AS item FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)",
        "nb AS (SELECT count(DISTINCT t) AS n, ceil(" + repr(s) + " * count(DISTINCT t)) AS m FROM bk)",
        # level by level: occurrences of frequent sets, each extended by a later item of its basket. A basket has at
        # most as many items as an order has lines (7), so seven levels are all there are.
        *[part for k in range(1, 8) for part in _level_sql(k)],
        "fi AS (" + " UNION ALL ".join(f"SELECT items, c, c / (SELECT n FROM nb) AS support FROM f{k}" for k in range(1, 8)) + ")",
        """sp AS (SELECT items, support, m AS mask FROM fi, range(1, (1 << len(items)) - 1) AS r(m) WHERE len(items) >= 2)""",
        """ru AS (SELECT list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 1) AS antecedents,
                 list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 0) AS consequents, support FROM sp)""",
        """rules AS (SELECT ru.antecedents, ru.consequents, a.support AS antecedent_support, c.support AS consequent_support,
     ru.support, ru.support / a.support AS confidence, ru.support / a.support / c.support AS lift,
     ru.support - a.support * c.support AS leverage,
     CASE WHEN ru.support / a.support < 1 THEN (1 - c.support) / (1 - ru.support / a.support) END AS conviction
   FROM ru JOIN fi a ON ru.antecedents = a.items JOIN fi c ON ru.consequents = c.items
   WHERE ru.support / a.support / c.support >= 1.0)""",
    ]


@register("frequent_itemsets", O.with_query(_itemset_sql(), """SELECT array_to_string(items, '|') AS items,
  c::BIGINT AS freq, round(support, 6) AS support FROM fi"""))
def q_frequent_itemsets(spark, sf):
    return emit(_mined(spark, sf).itemsets)


RULE_COLS = ["antecedents", "consequents", "antecedent_support", "consequent_support", "support", "confidence",
             "lift", "leverage", "conviction"]


@register("association_rules", O.with_query(_itemset_sql(), """SELECT array_to_string(antecedents, '|') AS antecedents,
  array_to_string(consequents, '|') AS consequents, round(antecedent_support, 6) AS antecedent_support,
  round(consequent_support, 6) AS consequent_support, round(support, 6) AS support, round(confidence, 6) AS confidence,
  round(lift, 6) AS lift, round(leverage, 6) AS leverage, round(conviction, 6) AS conviction FROM rules"""))
def q_association_rules(spark, sf):
    return emit(_mined(spark, sf).rules.select(*RULE_COLS))


@register("rule_stats", O.with_query(_itemset_sql(), """SELECT count(*)::BIGINT AS num_rules,
  (SELECT count(*) FROM fi)::BIGINT AS num_itemsets,
  round(min(support), 6) AS min_support, round(max(support), 6) AS max_support, round(coalesce(avg(support), 0), 6) AS avg_support,
  round(min(confidence), 6) AS min_confidence, round(max(confidence), 6) AS max_confidence, round(coalesce(avg(confidence), 0), 6) AS avg_confidence,
  round(min(lift), 6) AS min_lift, round(max(lift), 6) AS max_lift, round(coalesce(avg(lift), 0), 6) AS avg_lift
FROM rules"""))
def q_rule_stats(spark, sf):
    from tastemine.operators.rules import rule_stats
    m = _mined(spark, sf)
    return rule_stats(m.rules, m.itemsets)


@register("itemset_lengths", O.with_query(_itemset_sql(),
                                          "SELECT len(items)::INTEGER AS length, count(*)::BIGINT AS count FROM fi GROUP BY 1"))
def q_itemset_lengths(spark, sf):
    from tastemine.operators.rules import itemset_lengths
    return itemset_lengths(_mined(spark, sf).itemsets)


@register("basket_shape", O.with_query(_itemset_sql(), """SELECT (SELECT count(DISTINCT item) FROM bk)::BIGINT AS items,
  count(*)::BIGINT AS baskets, round(avg(k), 6) AS mean_size FROM (SELECT t, count(*) AS k FROM bk GROUP BY t)"""))
def q_basket_shape(spark, sf):
    from tastemine.operators.rules import basket_shape
    return basket_shape(Stages.of(spark, sf).baskets())


def _top_rules_sql(n: int, keys: list[str]) -> str:
    order = ", ".join(f"round({k}, 9) DESC" for k in keys)
    return O.with_query(_itemset_sql(), f"""SELECT array_to_string(antecedents, '|') AS antecedents,
  array_to_string(consequents, '|') AS consequents, round(support, 6) AS support, round(confidence, 6) AS confidence,
  round(lift, 6) AS lift FROM rules
ORDER BY {order}, array_to_string(antecedents, '|'), array_to_string(consequents, '|') LIMIT {n}""")


@register("top_rules_lift", _top_rules_sql(100, ["lift"]))
def q_top_rules_lift(spark, sf):
    """Top 100 rules by lift (null / NaN / inf lift dropped)."""
    from tastemine.operators.rules import top_rules
    return emit(top_rules(_mined(spark, sf).rules, 100, ("lift",)).select(
        "antecedents", "consequents", "support", "confidence", "lift"))


@register("top_rules_multi", _top_rules_sql(10, ["lift", "confidence", "support"]))
def q_top_rules_multi(spark, sf):
    """Top 10 by lift, confidence, support."""
    from tastemine.operators.rules import top_rules
    return emit(top_rules(_mined(spark, sf).rules, 10, ("lift", "confidence", "support")).select(
        "antecedents", "consequents", "support", "confidence", "lift"))


def _title_queries(spark, sf):
    """Query table derived from the part names: the name, its upper case,
    its first word and the name without its last letter (exact, exact,
    substring, substring)."""
    from tastemine.sources.views import table
    p = table(spark, sf, "part").select("p_name")
    return (p.select(F.col("p_name").alias("query"))
            .unionByName(p.select(F.upper("p_name").alias("query")))
            .unionByName(p.select(F.split("p_name", " ")[0].alias("query")))
            .unionByName(p.select(F.expr("substring(p_name, 1, length(p_name) - 1)").alias("query")))
            .filter(F.length("query") > 0).distinct())


TITLE_QUERIES_SQL = """q AS (SELECT DISTINCT query FROM (
  SELECT p_name AS query FROM part UNION ALL SELECT upper(p_name) FROM part
  UNION ALL SELECT split_part(p_name, ' ', 1) FROM part UNION ALL SELECT left(p_name, length(p_name) - 1) FROM part)
  WHERE length(query) > 0)"""


def _rule_lookup_sql(ctes: list[str]) -> str:
    """L5 over the matches in ``m`` that ``ctes`` end with."""
    return O.with_query(_itemset_sql() + [*ctes, """best AS (
  SELECT query, title AS searched_movie FROM m QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, title) = 1)""",
    """rr AS (SELECT row_number() OVER () AS rid, * FROM rules)""", """hit AS (
  SELECT DISTINCT m.query, rr.rid FROM m JOIN (SELECT rid, unnest(antecedents) AS title FROM rr) a ON m.title = a.title
  JOIN rr ON rr.rid = a.rid)""", """cand AS (
  SELECT h.query, b.searched_movie, c AS movie_title, rr.confidence, rr.lift, array_to_string(rr.antecedents, '|') AS atext
  FROM hit h JOIN rr ON h.rid = rr.rid JOIN best b ON b.query = h.query, unnest(rr.consequents) AS u(c)
  WHERE lower(c) <> lower(b.searched_movie))""", """per AS (
  SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY query, movie_title
    ORDER BY lift DESC, confidence DESC, length(atext) DESC, atext DESC) = 1)"""],
    """SELECT query, searched_movie, movie_title, round(confidence, 6) AS confidence, round(lift, 6) AS lift, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY lift DESC, movie_title)::INTEGER AS rank FROM per) WHERE rank <= 20""", True)


TITLES_SQL = "titles AS (SELECT DISTINCT unnest(antecedents) AS title FROM rules)"
MATCH_SQL = """m AS (
  SELECT query, title, score FROM (
    SELECT query, title, CASE WHEN lower(query) = lower(title) THEN 2.0
                              WHEN contains(lower(title), lower(query)) THEN 1.5 END AS score FROM q, titles)
  WHERE score IS NOT NULL)"""


@register("rule_lookup_exact", _rule_lookup_sql([TITLE_QUERIES_SQL, TITLES_SQL, MATCH_SQL]))
def q_rule_lookup_exact(spark, sf):
    """L5 with exact and substring matching (SQL-checkable)."""
    from tastemine.operators.lookup import rule_recommendations
    return emit(rule_recommendations(_title_queries(spark, sf), _mined(spark, sf).rules))


def _misspelt_queries(spark, sf):
    """Part names with one letter left out, with one letter exchanged (which one, and for what, by the part's key), and
    with the words in reverse order."""
    from tastemine.sources.views import table
    p = table(spark, sf, "part").select("p_name", F.pmod("p_partkey", F.length("p_name")).cast("int").alias("place"),
                                        F.char((F.col("p_partkey") / 7).cast("bigint") % 26 + 97).alias("letter"))
    before, behind = F.expr("left(p_name, place)"), F.expr("substring(p_name, place + 2)")
    return (p.select(F.concat(before, behind).alias("query"))
            .unionByName(p.select(F.concat(before, "letter", behind).alias("query")))
            .unionByName(p.select(F.concat_ws(" ", F.reverse(F.split("p_name", " "))).alias("query")))
            .filter(F.length("query") > 0).distinct())


MISSPELT_SQL = """q AS (SELECT DISTINCT query FROM (
  SELECT left(p_name, place) || substring(p_name, place + 2) AS query FROM p
  UNION ALL SELECT left(p_name, place) || letter || substring(p_name, place + 2) FROM p
  UNION ALL SELECT array_to_string(list_reverse(string_split(p_name, ' ')), ' ') FROM p) WHERE length(query) > 0)"""
P_SQL = """p AS (SELECT p_name, (p_partkey % length(p_name))::INTEGER AS place, chr(((p_partkey // 7) % 26 + 97)::INTEGER) AS letter FROM part)"""
# The longest common run of each stretch (of equally long ones the first in the query, then in the title), then of the
# stretches to its left and right, until nothing is common.
BEST_RUN = """SELECT s.id, s.alo, s.ahi, s.blo, s.bhi, max((least(r.len, r.i - s.alo + 1, r.j - s.blo + 1), -r.i, -r.j)) AS b
    FROM stretch s JOIN runs r ON r.id = s.id AND r.i BETWEEN s.alo AND s.ahi AND r.j BETWEEN s.blo AND s.bhi
    GROUP BY s.id, s.alo, s.ahi, s.blo, s.bhi"""
SIMILAR_SQL = ["""texts AS (
  SELECT row_number() OVER () AS id, a, b, length(a) AS la, length(b) AS lb
  FROM (SELECT DISTINCT lower(query) AS a FROM q), (SELECT DISTINCT lower(title) AS b FROM titles)
  WHERE 20 * least(length(a), length(b)) > 7 * (length(a) + length(b)))""", """runs AS (
  SELECT id, i, j, i - min(i) OVER (PARTITION BY id, i - j, g) + 1 AS len FROM (
    SELECT id, i, j, i - row_number() OVER (PARTITION BY id, i - j ORDER BY i) AS g FROM (
      SELECT id, i, unnest(range(1, lb + 1)) AS j, a, b FROM (SELECT *, unnest(range(1, la + 1)) AS i FROM texts))
    WHERE a[i] = b[j]))""", f"""stretch AS (
  SELECT id, 1::BIGINT AS alo, la::BIGINT AS ahi, 1::BIGINT AS blo, lb::BIGINT AS bhi FROM texts
  UNION ALL
  SELECT id, x.alo, x.ahi, x.blo, x.bhi FROM (
    SELECT id, unnest([{{'alo': alo, 'ahi': -b[2] - b[1], 'blo': blo, 'bhi': -b[3] - b[1]}},
                       {{'alo': 1 - b[2], 'ahi': ahi, 'blo': 1 - b[3], 'bhi': bhi}}]) AS x FROM ({BEST_RUN}))
  WHERE x.alo <= x.ahi AND x.blo <= x.bhi)""", f"""alike AS (
  SELECT a, b, 2.0::DOUBLE * sum(m) / (la + lb) AS ratio FROM texts JOIN (SELECT id, b[1] AS m FROM ({BEST_RUN})) USING (id)
  GROUP BY a, b, la, lb HAVING 20 * sum(m) > 7 * (la + lb))""", MATCH_SQL.replace("m AS", "plain AS", 1), """m AS (
  SELECT query, title, max(score::DOUBLE) AS score FROM (
    SELECT * FROM plain UNION ALL
    SELECT query, title, ratio FROM alike JOIN q ON lower(query) = a JOIN titles ON lower(title) = b) GROUP BY ALL)"""]


@register("rule_lookup_fuzzy", _rule_lookup_sql([P_SQL, MISSPELT_SQL, TITLES_SQL, *SIMILAR_SQL]))
def q_rule_lookup_fuzzy(spark, sf):
    """L5 with all three ways to match, over misspelt titles."""
    from tastemine.operators import fuzzy
    from tastemine.operators.lookup import rule_recommendations
    return emit(rule_recommendations(_misspelt_queries(spark, sf), _mined(spark, sf).rules, cutoff=fuzzy.CUTOFF))


def _rule_titles(spark, sf):
    return _mined(spark, sf).rules.select(F.explode("antecedents").alias("title")).distinct()


@register("title_matches_fuzzy", O.with_query(_itemset_sql() + [P_SQL, MISSPELT_SQL, TITLES_SQL, *SIMILAR_SQL], "SELECT query, title, round(score, 6) AS score FROM m", True))
def q_title_matches_fuzzy(spark, sf):
    """Every title that a misspelt one matches, with the score."""
    from tastemine.operators.lookup import match_titles_fuzzy
    return emit(match_titles_fuzzy(_misspelt_queries(spark, sf), _rule_titles(spark, sf)))


@register("title_matches_report", O.with_query(_itemset_sql() + [P_SQL, MISSPELT_SQL, TITLES_SQL, *SIMILAR_SQL, """chars AS (
  SELECT id, side, c, count(*) AS n FROM (
    SELECT id, 'a' AS side, unnest(string_split(a, '')) AS c FROM texts UNION ALL SELECT id, 'b', unnest(string_split(b, '')) FROM texts)
  GROUP BY ALL)""", """common AS (
  SELECT x.id, sum(least(x.n, y.n)) AS n FROM chars x JOIN chars y ON x.id = y.id AND x.c = y.c AND x.side = 'a' AND y.side = 'b' GROUP BY x.id)"""],
    """SELECT (SELECT count(DISTINCT lower(query)) FROM q) * (SELECT count(DISTINCT lower(title)) FROM titles) AS pairs,
  (SELECT count(*) FROM texts) AS by_length,
  (SELECT count(*) FROM texts JOIN common USING (id) WHERE 20 * n > 7 * (la + lb)) AS by_characters,
  (SELECT count(*) FROM alike) AS "similar" """, True))
def q_title_matches_report(spark, sf):
    """Pairs of texts that are left after each filter."""
    from tastemine.operators.fuzzy import filter_report
    return filter_report(_misspelt_queries(spark, sf), _rule_titles(spark, sf)).drop("by_subsequence")


@register("item_dictionary", O.with_query(O.stage_ctes("split"), f"""SELECT movie_id, movie_title FROM (
  SELECT movie_id, movie_title, min((_part, {O.ORD})) AS f FROM splitted WHERE split = 'train' GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY f DESC) = 1"""))
def q_item_dictionary(spark, sf):
    """M5 over the training split."""
    from tastemine.operators.rules import item_dictionary
    return item_dictionary(Stages.of(spark, sf).part("train"))


# --- A14-A16 profiles, K3-K5 indices on given labels -------------------------------------------

def _profiles(spark, sf):
    return Stages.of(spark, sf).profiles()


TRAIN = "tr AS (SELECT * FROM splitted WHERE split = 'train')"


@register("user_profile_stats", O.with_query(O.stage_ctes("split") + [TRAIN], """SELECT user_idx::BIGINT AS user_idx,
  round(avg(rating_scaled), 6) AS avg_rating, count(*)::BIGINT AS num_ratings, round(stddev_samp(rating_scaled), 6) AS rating_std,
  round(avg(genre_count), 6) AS genre_count_pref, round(avg(genre_count_scaled), 6) AS genre_count_scaled_pref
FROM tr GROUP BY user_idx"""))
def q_user_profile_stats(spark, sf):
    """A14 (scalar part) on the training split."""
    return emit(_profiles(spark, sf).select("user_idx", "avg_rating", "num_ratings", "rating_std",
                                            "genre_count_pref", "genre_count_scaled_pref"))


@register("user_genre_prefs", O.with_query(O.stage_ctes("split") + [TRAIN], """SELECT user_idx::BIGINT AS user_idx,
  replace(g, ' ', '_') AS genre, round(count(*) / any_value(n), 6) AS preference_score
FROM (SELECT *, count(*) OVER (PARTITION BY user_idx) AS n FROM tr), unnest(list_distinct(genres_list)) AS u(g)
GROUP BY user_idx, g"""))
def q_user_genre_prefs(spark, sf):
    """A14 (genre part), long form, non-zero preferences."""
    from tastemine.operators.profiles import long_prefs
    p = long_prefs(_profiles(spark, sf), ["user_idx"])
    return emit(p.filter(~F.col("genre").isin("count", "count_scaled") & (F.col("preference_score") > 0)))


def _segment_labels(spark, sf):
    """Given labels for users: their customer's market segment (code 0..4)."""
    from tastemine.operators.indexing import encode_labels
    from tastemine.sources.views import table
    c = table(spark, sf, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("user_id"), "c_mktsegment")
    return encode_labels(c, "c_mktsegment", "user_cluster").select("user_id", F.col("user_cluster").cast("int"))


def _labelled_profiles(spark, sf):
    st = Stages.of(spark, sf)
    users = st.part("train").select("user_idx", "user_id").distinct()
    return _profiles(spark, sf).join(users, "user_idx").join(_segment_labels(spark, sf), "user_id")


SEG_SQL = """seg AS (SELECT 'u' || CAST(c_custkey AS VARCHAR) AS user_id,
  (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::INTEGER AS user_cluster FROM customer)"""
PROF_SQL = """prof AS (SELECT user_idx, any_value(user_id) AS user_id, avg(rating_scaled) AS avg_rating,
  count(*) AS num_ratings, stddev_samp(rating_scaled) AS rating_std FROM tr GROUP BY user_idx)"""


@register("cluster_distribution", O.with_query(O.stage_ctes("split") + [TRAIN, SEG_SQL, PROF_SQL], """SELECT
  s.user_cluster, count(*)::BIGINT AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage
FROM prof p JOIN seg s USING (user_id) GROUP BY s.user_cluster"""))
def q_cluster_distribution(spark, sf):
    """A16 on given labels (customer segment of each training user)."""
    from tastemine.operators.profiles import cluster_distribution
    return emit(cluster_distribution(_labelled_profiles(spark, sf)))


@register("cluster_profiles", O.with_query(O.stage_ctes("split") + [TRAIN, SEG_SQL, PROF_SQL, """gp AS (
  SELECT s.user_cluster, replace(g, ' ', '_') AS genre, avg(CASE WHEN list_contains(t.genres_list, g) THEN 1.0 ELSE 0.0 END) AS x
  FROM tr t JOIN seg s USING (user_id), (SELECT DISTINCT unnest(genres_list) AS g FROM tr) v
  GROUP BY ALL)""", """up AS (
  SELECT t.user_idx, s.user_cluster, v.g, avg(CASE WHEN list_contains(t.genres_list, v.g) THEN 1.0 ELSE 0.0 END) AS x
  FROM tr t JOIN seg s USING (user_id), (SELECT DISTINCT unnest(genres_list) AS g FROM tr) v GROUP BY ALL)""",
    """cg AS (SELECT user_cluster, replace(g, ' ', '_') AS genre, avg(x) AS score FROM up GROUP BY ALL
  UNION ALL SELECT s.user_cluster, 'count', avg(gc) FROM (SELECT user_idx, any_value(user_id) AS user_id, avg(genre_count) AS gc FROM tr GROUP BY 1) q JOIN seg s USING (user_id) GROUP BY 1, 2
  UNION ALL SELECT s.user_cluster, 'count_scaled', avg(gc) FROM (SELECT user_idx, any_value(user_id) AS user_id, avg(genre_count_scaled) AS gc FROM tr GROUP BY 1) q JOIN seg s USING (user_id) GROUP BY 1, 2)""",
    """top AS (SELECT user_cluster, string_agg(genre, '|' ORDER BY r) AS top_genres FROM (
  SELECT *, row_number() OVER (PARTITION BY user_cluster ORDER BY round(score, 12) DESC, genre) AS r FROM cg) WHERE r <= 5 GROUP BY 1)"""],
    """SELECT s.user_cluster AS cluster_id, count(*)::BIGINT AS num_users,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage, round(avg(avg_rating), 6) AS avg_rating,
  round(avg(num_ratings), 6) AS avg_num_ratings, round(avg(rating_std), 6) AS avg_rating_std, any_value(top.top_genres) AS top_genres
FROM prof p JOIN seg s USING (user_id) JOIN top ON top.user_cluster = s.user_cluster GROUP BY s.user_cluster"""))
def q_cluster_profiles(spark, sf):
    """A15 on given labels: sizes, means and the top-5 genre preferences."""
    from tastemine.operators.profiles import cluster_profiles
    cp = cluster_profiles(_labelled_profiles(spark, sf))
    return emit(cp.withColumn("top_genres", F.array_join(F.transform("top_genres", lambda g: g["genre"]), "|")))


EMB_SQL = [
    "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)",
    "el AS (SELECT vec_id, label, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM e)",
    "mu AS (SELECT label, i, avg(v) AS m FROM el GROUP BY label, i)",
    "cn AS (SELECT label, count(*) AS n FROM e GROUP BY label)",
]


@register("embedding_silhouette", O.with_query(EMB_SQL + [
    """pd AS (SELECT p.vec_id, p.label AS own, c.label AS c, sum((p.v - c.m) * (p.v - c.m)) AS d2
  FROM el p JOIN mu c ON p.i = c.i GROUP BY 1, 2, 3)""",
    """sq AS (SELECT c.label, sum(l.v * l.v) / count(DISTINCT l.vec_id) - sum(m.m * m.m) / count(DISTINCT l.vec_id) AS var_c
  FROM el l JOIN mu m ON l.label = m.label AND l.i = m.i JOIN cn c ON c.label = l.label GROUP BY c.label)""",
    """ds AS (SELECT pd.vec_id, pd.own, pd.c, cn.n, pd.d2 + (SELECT sum(v * v) FROM el WHERE el.label = pd.c) / cn.n
       - (SELECT sum(m * m) FROM mu WHERE mu.label = pd.c) AS d FROM pd JOIN cn ON cn.label = pd.c)""",
    """ps AS (SELECT vec_id, max(CASE WHEN c = own THEN n END) AS nown, max(CASE WHEN c = own THEN d * n / (n - 1) END) AS a,
  min(CASE WHEN c <> own THEN d END) AS b FROM ds GROUP BY vec_id)"""],
    """SELECT round(avg(CASE WHEN nown <= 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END), 6)
  AS silhouette_sq FROM ps"""))
def q_embedding_silhouette(spark, sf):
    """K3 on the given embedding labels (squared Euclidean, linear time)."""
    from tastemine.operators.cluster import silhouette_sq
    from tastemine.sources.views import table
    return emit(silhouette_sq(table(spark, sf, "embeddings"), "embedding", "label"))


@register("inferred_clusters", """SELECT t AS "table", c AS "column", label, count(*)::BIGINT AS count FROM (
  SELECT 'embeddings' AS t, 'label' AS c, CAST(label AS VARCHAR) AS label FROM embeddings
  UNION ALL SELECT 'labels', 'toxic', CAST(toxic AS VARCHAR) FROM labels
  UNION ALL SELECT 'customer', 'c_mktsegment', c_mktsegment FROM customer) GROUP BY ALL""")
def q_inferred_clusters(spark, sf):
    """the column that holds the labels (named so, else the last one), and how many rows each label has."""
    from functools import reduce

    from tastemine.functions.text import infer_cluster_column
    from tastemine.sources.views import table

    def counted(name, df):
        column = infer_cluster_column(df)
        counts = df.groupBy(F.col(column).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("count"))
        return counts.select(F.lit(name).alias("table"), F.lit(column).alias("column"), "label", "count")

    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return reduce(DataFrame.unionByName, [counted("embeddings", table(spark, sf, "embeddings")), counted("labels", table(spark, sf, "labels")), counted("customer", customer)])


@register("embedding_silhouette_euclidean", O.with_query([
    "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)", "cn AS (SELECT label, count(*) AS n FROM e GROUP BY label)",
    """ds AS (SELECT a.vec_id, a.label AS own, b.label AS c, sum(list_distance(a.x, b.x)) AS d
  FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY ALL)""",
    """ps AS (SELECT ds.vec_id, max(CASE WHEN c = own THEN d / (n - 1) END) AS a, min(CASE WHEN c <> own THEN d / n END) AS b
  FROM ds JOIN cn ON cn.label = ds.c GROUP BY ds.vec_id)""",
    "s AS (SELECT avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS s FROM ps)"],
    "SELECT round(s, 6) AS silhouette, CASE WHEN s > 0.5 THEN 'good' WHEN s > 0.3 THEN 'medium' ELSE 'weak' END AS quality FROM s"))
def q_embedding_silhouette_euclidean(spark, sf):
    """K3 as the reference has it, exact, on the given embedding labels; F9's label."""
    from tastemine.functions.text import quality_label
    from tastemine.operators.silhouette import silhouettes
    from tastemine.sources.views import table
    out = silhouettes(table(spark, sf, "embeddings"), ["label"], "embedding")
    return emit(out.select("silhouette", quality_label(F.col("silhouette")).alias("quality")))


@register("embedding_davies_bouldin", O.with_query(EMB_SQL + [
    """sp AS (SELECT label, avg(sqrt(d2)) AS s FROM (SELECT p.vec_id, p.label, sum((p.v - c.m) * (p.v - c.m)) AS d2
  FROM el p JOIN mu c ON p.i = c.i AND p.label = c.label GROUP BY 1, 2) GROUP BY label)""",
    """mm AS (SELECT a.label AS la, b.label AS lb, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS dist
  FROM mu a JOIN mu b ON a.i = b.i AND a.label <> b.label GROUP BY 1, 2)"""],
    """SELECT round(avg(r), 6) AS davies_bouldin FROM (
  SELECT mm.la, max((sa.s + sb.s) / mm.dist) AS r FROM mm JOIN sp sa ON sa.label = mm.la JOIN sp sb ON sb.label = mm.lb GROUP BY mm.la)"""))
def q_embedding_davies_bouldin(spark, sf):
    """K4 on the given embedding labels."""
    from tastemine.operators.cluster import davies_bouldin
    from tastemine.sources.views import table
    return emit(davies_bouldin(table(spark, sf, "embeddings"), "embedding", "label"))


@register("embedding_calinski_harabasz", O.with_query(EMB_SQL + [
    "g AS (SELECT i, avg(v) AS m FROM el GROUP BY i)",
    "w AS (SELECT sum((p.v - c.m) * (p.v - c.m)) AS W FROM el p JOIN mu c ON p.i = c.i AND p.label = c.label)",
    "bb AS (SELECT sum(cn.n * d) AS B FROM (SELECT mu.label, sum((mu.m - g.m) * (mu.m - g.m)) AS d FROM mu JOIN g USING (i) GROUP BY 1) x JOIN cn USING (label))"],
    """SELECT round((B / ((SELECT count(*) FROM cn) - 1)) / (W / ((SELECT count(*) FROM e) - (SELECT count(*) FROM cn))), 6)
  AS calinski_harabasz FROM w, bb"""))
def q_embedding_calinski_harabasz(spark, sf):
    """K5 on the given embedding labels."""
    from tastemine.operators.cluster import calinski_harabasz
    from tastemine.sources.views import table
    return emit(calinski_harabasz(table(spark, sf, "embeddings"), "embedding", "label"))


# --- K1/K2/K6/K7/E12 k-means on user profiles (rows-only: iterative, seeded) ------------------

def _features(spark, sf):
    st = Stages.of(spark, sf)
    return st.features(), st.profiles()


@register("kmeans_sweep")
def q_kmeans_sweep(spark, sf):
    """K2: k = 2..10, best of 10 seeded runs each; inertia and the three indices."""
    return emit(Stages.of(spark, sf).sweep().table)


def _clustered(spark, sf, k: int | None = None):
    st = Stages.of(spark, sf)
    labels, users, model = st.clustered(k)
    return st.features(), users, labels, model


@register("user_clusters")
def q_user_clusters(spark, sf):
    """K6: final labels at the best k (relabelled by cluster size)."""
    _, _, labels, _ = _clustered(spark, sf)
    return labels


@register("kmeans_evaluation")
def q_kmeans_evaluation(spark, sf):
    """K6/K7 at a fixed k = 10 (the committed best k): the indices, and F9's label."""
    from tastemine.functions.text import quality_label
    from tastemine.operators.cluster import cluster_indices
    from tastemine.operators.silhouette import silhouettes
    feats, _, labels, model = _clustered(spark, sf, k=10)
    pts = feats.join(labels, "user_idx").withColumnRenamed("user_cluster", "prediction")
    exact = silhouettes(pts, ["prediction"]).select("silhouette", quality_label(F.col("silhouette")).alias("quality"))
    return emit(cluster_indices(pts).crossJoin(exact).withColumn("inertia", F.lit(model.cost)))


@register("kmeans_cluster_cards")
def q_kmeans_cluster_cards(spark, sf):
    """A15 + L6 on the k-means labels: id, users, avg rating, display genres."""
    from tastemine.operators.lookup import cluster_cards
    from tastemine.operators.profiles import cluster_profiles
    _, users, _, _ = _clustered(spark, sf, k=10)
    return emit(cluster_cards(cluster_profiles(users)))


@register("kmeans_cluster_insight")
def q_kmeans_cluster_insight(spark, sf):
    """Top two genres and five sample users per cluster."""
    from tastemine.operators.lookup import cluster_insight
    from tastemine.operators.profiles import cluster_profiles
    _, users, _, _ = _clustered(spark, sf, k=10)
    out = cluster_insight(cluster_profiles(users), users)
    return out.withColumn("sample_users", F.array_join("sample_users", "|"))


@register("cluster_pca")
def q_cluster_pca(spark, sf):
    """Explained variance of the first two components of the scaled profiles."""
    from tastemine.operators.cluster import pca_2d
    feats, _ = _features(spark, sf)
    _, ratios = pca_2d(feats)
    return spark.createDataFrame([(i, r) for i, r in enumerate(ratios)], "component int, ratio double")


# --- E8-E11 feature selection (rows-only: eigen-decomposition) --------------------------------

@register("feature_reduction")
def q_feature_reduction(spark, sf):
    """Fit on train (scale, variance filter, PCA 95 %), per-component report."""
    from tastemine.operators.features import fit_reduction
    red = fit_reduction(Stages.of(spark, sf).part("train"))
    return red.report(spark)


@register("feature_projection")
def q_feature_projection(spark, sf):
    """Train / val / test projected with the train fit (ids + pca_i)."""
    from tastemine.operators.features import fit_reduction
    st = Stages.of(spark, sf)
    red = fit_reduction(st.part("train"))
    parts = [red.transform(st.part(n)).withColumn("split", F.lit(n)) for n in ("train", "val", "test")]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return emit(out)


# --- A19/A20/R1-R4/W2 factorization -----------------------------------------------------------

@register("rating_matrix", O.with_query(O.stage_ctes("split") + [TRAIN], """SELECT user_id, movie_id,
  round(avg(rating), 6) AS rating FROM tr GROUP BY user_id, movie_id"""))
def q_rating_matrix(spark, sf):
    """Mean rating per (user, movie) of the training split."""
    from tastemine.operators.factorize import rating_matrix
    return emit(rating_matrix(Stages.of(spark, sf).part("train")))


@register("matrix_shape", O.with_query(O.stage_ctes("split") + [TRAIN, """cells AS (
  SELECT user_id, movie_id, avg(rating) AS rating FROM tr GROUP BY ALL)"""], """SELECT count(DISTINCT user_id)::BIGINT AS users,
  count(DISTINCT movie_id)::BIGINT AS items, count_if(rating <> 0)::BIGINT AS nnz,
  round(1 - count_if(rating <> 0) / (count(DISTINCT user_id) * count(DISTINCT movie_id)), 9) AS sparsity FROM cells"""))
def q_matrix_shape(spark, sf):
    """Users, items, non-zeros, sparsity."""
    from tastemine.operators.factorize import matrix_shape, rating_matrix
    return matrix_shape(rating_matrix(Stages.of(spark, sf).part("train")))


def _factorized(spark, sf):
    st = Stages.of(spark, sf)
    return st, st.factorization()


def _recs(spark, sf):
    st = Stages.of(spark, sf)
    return st, st.recommendations()


@register("svd_recommendations")
def q_svd_recommendations(spark, sf):
    """Top-10 items per training user from U.Sigma.V^T (all users)."""
    return _recs(spark, sf)[1]


GENRE_CELLS = f"""cells AS (SELECT user_id, primary_genre, avg(rating) AS rating FROM splitted
  WHERE split = 'train' AND primary_genre IS NOT NULL GROUP BY ALL)"""


@register("svd_reconstruction", O.with_query(O.stage_ctes("split") + [GENRE_CELLS],
                                             "SELECT user_id, primary_genre, round(rating, 6) AS rating FROM cells"))
def q_svd_reconstruction(spark, sf):
    """R1 with as many factors as there are columns, where U.Sigma.V^T is the matrix itself: mean ratings by user and
    genre, back from the factors."""
    from tastemine.operators.factorize import factorize, predicted
    train = Stages.of(spark, sf).part("train").where("primary_genre IS NOT NULL")
    fact = factorize(train, item_col="primary_genre", n_factors=None)
    return emit(predicted(fact).select("user_id", "primary_genre", F.col("prediction").alias("rating")))


@register("svd_energy", O.with_query(O.stage_ctes("split") + [GENRE_CELLS], "SELECT round(sum(rating * rating), 3) AS energy, count(DISTINCT primary_genre) AS columns FROM cells"))
def q_svd_energy(spark, sf):
    """The squares of all singular values add up to those of the cells."""
    from tastemine.operators.factorize import factorize
    train = Stages.of(spark, sf).part("train").where("primary_genre IS NOT NULL")
    fact = factorize(train, item_col="primary_genre", n_factors=None)
    energy = fact.users.agg(F.round(F.sum(F.aggregate("factors", F.lit(0.0), lambda a, x: a + x * x)), 3).alias("energy"))
    return energy.crossJoin(fact.items.agg(F.count(F.lit(1)).alias("columns")))


@register("embedding_top_products", """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT vec_id, other_id, round(score, 6) AS score, rank FROM (
  SELECT a.vec_id, b.vec_id AS other_id, list_inner_product(a.v, b.v) AS score,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_inner_product(a.v, b.v) DESC, b.vec_id)::INTEGER AS rank
  FROM e a JOIN e b ON a.vec_id <> b.vec_id) WHERE rank <= 10""")
def q_embedding_top_products(spark, sf):
    """For every vector the ten others with the largest inner product."""
    return emit(_top_products(spark, sf)[0].withColumnRenamed("raw_score", "score"))


def _top_products(spark, sf):
    from tastemine.operators.indexing import dense_index
    from tastemine.operators.topk import top_items
    from tastemine.session import checkpoint
    from tastemine.sources.views import table
    e = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("factors"))
    e = checkpoint(dense_index(e, ["vec_id"], "row"))
    users, items = e.select(F.col("row").alias("u_row"), "factors"), e.select(F.col("row").alias("i_col"), "factors")
    best, told = top_items(users, items, 10, e.select(F.col("row").alias("u_row"), F.col("row").alias("i_col")))
    a, b = e.select("vec_id", F.col("row").alias("u_row")), e.select(F.col("vec_id").alias("other_id"), F.col("row").alias("i_col"))
    return best.join(a, "u_row").join(b, "i_col").select("vec_id", "other_id", "raw_score", "rank"), told


def _held_out(spark, sf):
    """Cells of validation and test users with their split, whether they are given, and the training cells."""
    from tastemine.operators.evaluate import is_given
    from tastemine.operators.factorize import rating_matrix
    st = Stages.of(spark, sf)
    parts = [rating_matrix(st.part(p)).withColumn("split", F.lit(p)) for p in ("val", "test")]
    held = parts[0].unionByName(parts[1]).withColumn("given", is_given("user_id", "movie_id"))
    return held, rating_matrix(st.part("train"))


HELD_SQL = ["""held AS (SELECT split, user_id, movie_id, avg(rating) AS rating,
  md5('42:' || user_id || ':' || CAST(movie_id AS VARCHAR))[1] < '8' AS given FROM splitted WHERE split IN ('val', 'test') GROUP BY ALL)""",
            "wanted AS (SELECT split, user_id, movie_id FROM held WHERE NOT given AND rating >= 7.0)"]


@register("held_out_popular", O.with_query(O.stage_ctes("split") + [*HELD_SQL, """pop AS (
  SELECT movie_id, row_number() OVER (ORDER BY count(*) DESC, movie_id) AS rank
  FROM (SELECT DISTINCT user_id, movie_id FROM splitted WHERE split = 'train') GROUP BY movie_id QUALIFY rank <= 10)""", """per AS (
  SELECT split, user_id, count(*) AS wanted, count(rank) AS hits, coalesce(sum(1 / log2(rank + 1)), 0) AS gain
  FROM wanted LEFT JOIN pop USING (movie_id) GROUP BY split, user_id)"""], """SELECT split, count(*) AS users, round(avg(hits / 10), 6) AS "precision",
  round(avg(hits / wanted), 6) AS recall, round(avg(gain / list_sum(list_transform(range(1, least(wanted, 10) + 1), lambda r: 1 / log2(r + 1)))), 6) AS ndcg,
  round(avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate FROM per GROUP BY split"""))
def q_held_out_popular(spark, sf):
    """Rank-aware metrics of the most popular training items for validation and test users."""
    from tastemine.operators.evaluate import RELEVANT, popular_items, ranking_metrics
    held, train = _held_out(spark, sf)
    wanted = held.where(~F.col("given") & (F.col("rating") >= RELEVANT)).select("split", "user_id", "movie_id")
    lists = held.select("user_id").distinct().crossJoin(F.broadcast(popular_items(train)))  # ten rows
    return emit(ranking_metrics(lists, wanted, by=("split",)))


@register("held_out_popular_users", O.with_query(O.stage_ctes("split") + HELD_SQL, """SELECT split, count(DISTINCT user_id) AS users, count(*) AS cells,
  count(*) FILTER (given) AS given, count(*) FILTER (NOT given AND rating >= 7.0) AS wanted FROM held GROUP BY split"""))
def q_held_out_popular_users(spark, sf):
    """How the cells of validation and test users are divided into given and hidden ones."""
    from tastemine.operators.evaluate import RELEVANT
    held, _ = _held_out(spark, sf)
    return held.groupBy("split").agg(F.countDistinct("user_id").alias("users"), F.count(F.lit(1)).alias("cells"), F.count_if("given").alias("given"),
                                     F.count_if(~F.col("given") & (F.col("rating") >= RELEVANT)).alias("wanted"))


@register("held_out_metrics")
def q_held_out_metrics(spark, sf):
    """Validation and test users folded into the factorization by their given cells, beside the popular items."""
    from tastemine.operators.evaluate import RELEVANT, ranking_metrics, recommend_folded
    from tastemine.session import stored
    held, _ = _held_out(spark, sf)
    held = stored(held)
    wanted = held.where(~F.col("given") & (F.col("rating") >= RELEVANT)).select("split", "user_id", "movie_id")
    lists = recommend_folded(Stages.of(spark, sf).factorization(), held.where("given").select("user_id", "movie_id", "rating"))
    folded = ranking_metrics(lists, wanted, by=("split",)).withColumn("model", F.lit("folded in"))
    return emit(folded).unionByName(q_held_out_popular(spark, sf).withColumn("model", F.lit("popular")))


@register("topk_search_report")
def q_topk_search_report(spark, sf):
    """Of all pairs of a user and a block of items, how many were scored; factors, and embeddings."""
    from tastemine.operators.topk import top_items
    fact = Stages.of(spark, sf).factorization()
    _, told = top_items(fact.users.select("u_row", "factors"), fact.items.select("i_col", "factors"), 10)
    rows = [("factors", told), ("embeddings", _top_products(spark, sf)[1])]
    return spark.createDataFrame([(n, x["pairs"], x["scored"], x["rounds"], x["scored"] / max(1, x["pairs"])) for n, x in rows],
                                 "vectors string, pairs bigint, scored bigint, rounds int, share double")


@register("svd_metrics")
def q_svd_metrics(spark, sf):
    """RMSE / MAE on rated cells, all-cells RMSE, explained variance, k."""
    from tastemine.operators.factorize import explained_variance, reconstruction_error
    _, fact = _factorized(spark, sf)
    ev = explained_variance(fact).agg(F.sum("ratio").alias("explained_variance"))
    return reconstruction_error(fact).crossJoin(ev).withColumn("n_factors", F.lit(fact.n_factors))


@register("svd_explained_variance")
def q_svd_explained_variance(spark, sf):
    """R4 per component with W5 cumulative sum."""
    from tastemine.operators.factorize import explained_variance
    from tastemine.operators.stats import cumulative
    _, fact = _factorized(spark, sf)
    return cumulative(explained_variance(fact), "component", "ratio")


# --- L1-L3, L6-L8, J1, A31, A32 lookups over the artifacts ------------------------------------

@register("users_with_recommendations")
def q_users_with_recommendations(spark, sf):
    """L1."""
    from tastemine.operators.lookup import users_with_recommendations
    return users_with_recommendations(_recs(spark, sf)[1])


@register("popular_recommended")
def q_popular_recommended(spark, sf):
    """The ten most recommended titles (cold-start list)."""
    from tastemine.operators.lookup import popular_titles
    return popular_titles(_recs(spark, sf)[1])


@register("recommendations_lookup")
def q_recommendations_lookup(spark, sf):
    """L2 + L3 + J1: requests = every user of all three splits plus the
    new-user sentinel; answers = own recommendations or the popular list,
    with the user's k-means cluster (null when unknown)."""
    from tastemine.operators.lookup import NEW_USER, recommendations_for, user_clusters
    st, recs = _recs(spark, sf)
    reqs = st.split().select("user_id").distinct().unionByName(
        spark.range(1).select(F.lit(NEW_USER).alias("user_id")))
    _, _, labels, _ = _clustered(spark, sf, k=10)
    clusters = user_clusters(st.encoded().df, labels)
    return recommendations_for(reqs, recs, clusters, cold_start="absent")


@register("sample_user_recommendations")
def q_sample_user_recommendations(spark, sf):
    """Recommendations of the first training user (by id), by rank."""
    from tastemine.operators.lookup import user_recommendations
    st, recs = _recs(spark, sf)
    first = st.part("train").agg(F.min("user_id")).first()[0]
    return user_recommendations(recs, first)


@register("report_overview")
def q_report_overview(spark, sf):
    """Users, rules, clusters, recommendations."""
    from tastemine.operators.stats import overview
    st, recs = _recs(spark, sf)
    _, _, labels, _ = _clustered(spark, sf, k=10)
    return overview(st.part("train"), _mined(spark, sf).rules, labels, recs)


# --- A1-A11 quality aggregates ----------------------------------------------------------------

RAW_FIELDS_A = ["user_id", "movie_id", "movie_title", "rating", "genres", "cast", "release_year", "language"]
RAW_FIELDS_B = ["user_id", "movie_id", "movie_title", "rating", "genres", "cast_names", "release_year", "language"]


def _missing_sql(src: str, fields: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS field, avg(CASE WHEN \"{f}\" IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS missing_pct FROM {src}"
        for f in fields)


@register("missing_top", O.with_query(O.raw_ctes(), _each_sql(lambda x: f"""SELECT field, round(missing_pct, 6) AS missing_pct FROM (
  {_missing_sql(f"raw_{x}", RAW_FIELDS_A if x == "a" else RAW_FIELDS_B)}) WHERE missing_pct > 0 ORDER BY missing_pct DESC, field LIMIT 8""")))
def q_missing_top(spark, sf):
    """A1: top-8 fields by missing % of each raw source."""
    return _each(lambda x: emit(Q.missing_top(Stages.of(spark, sf).raw(x), 8)))


@register("missing_comparison", O.with_query(O.raw_ctes() + [
    f"ma AS ({_missing_sql('raw_a', RAW_FIELDS_A)})", f"mb AS ({_missing_sql('raw_b', RAW_FIELDS_B)})",
    "u AS (SELECT field, 'TMDB_cleaned' AS dataset, missing_pct FROM ma UNION ALL SELECT field, 'Trakt_cleaned', missing_pct FROM mb)",
    "tf AS (SELECT field FROM u GROUP BY field HAVING sum(missing_pct) > 0 ORDER BY sum(missing_pct) DESC, field LIMIT 10)"],
    """SELECT tf.field, d.dataset, round(coalesce(u.missing_pct, 0.0), 6) AS missing_pct
FROM tf CROSS JOIN (VALUES ('TMDB_cleaned'), ('Trakt_cleaned')) d(dataset) LEFT JOIN u ON u.field = tf.field AND u.dataset = d.dataset"""))
def q_missing_comparison(spark, sf):
    """A2: missing % of the two raw sources for the top-10 fields (absent -> 0)."""
    st = Stages.of(spark, sf)
    return emit(Q.missing_comparison({"TMDB_cleaned": st.raw("A"), "Trakt_cleaned": st.raw("B")}))


@register("rating_counts", O.with_query(O.pipeline_ctes("adjusted"),
                                        _each_sql(lambda x: f"SELECT round(rating, 6) AS rating, count(*)::BIGINT AS count FROM clean_{x}_adj WHERE rating IS NOT NULL GROUP BY rating")))
def q_rating_counts(spark, sf):
    """A3: rating value counts of each cleaned source."""
    return _each(lambda x: emit(Q.value_counts(Stages.of(spark, sf).adjusted(x), "rating")))


@register("language_top", """SELECT coalesce(lang, 'unknown') AS value, count(*)::BIGINT AS count FROM documents
GROUP BY 1 ORDER BY count DESC, value LIMIT 10""")
def q_language_top(spark, sf):
    """A4: top-10 languages of the documents table (null -> unknown)."""
    from tastemine.sources.views import table
    return Q.top_values(table(spark, sf, "documents"), "lang", 10)


@register("top_genres", O.with_query(O.pipeline_ctes("adjusted"), _each_sql(lambda x: f"""SELECT g AS genre, count(*)::BIGINT AS count
FROM clean_{x}_adj, unnest(genres_list) AS u(g) GROUP BY g ORDER BY count DESC, genre LIMIT 10""")))
def q_top_genres(spark, sf):
    """A5: top-10 genres of each cleaned source."""
    return _each(lambda x: Q.top_genres(Stages.of(spark, sf).adjusted(x)))


@register("year_counts", O.with_query(O.pipeline_ctes("adjusted"), _each_sql(lambda x: f"""SELECT year, count FROM (
  SELECT release_year_clean AS year, count(*)::BIGINT AS count FROM clean_{x}_adj WHERE release_year_clean IS NOT NULL
  GROUP BY 1 ORDER BY year DESC LIMIT 20)""")))
def q_year_counts(spark, sf):
    """Counts of the latest 20 release years of each source."""
    return _each(lambda x: Q.year_counts(Stages.of(spark, sf).adjusted(x)))


def _two(spark, sf, adjusted: bool = True):
    st = Stages.of(spark, sf)
    if adjusted:
        return {"TMDB_cleaned": st.adjusted("A"), "Trakt_cleaned": st.adjusted("B")}
    return {"TMDB_cleaned": st.raw("A"), "Trakt_cleaned": st.raw("B")}


TWO_SQL = """two AS (SELECT rating, language, release_year_clean, 'TMDB_cleaned' AS dataset FROM clean_a_adj
  UNION ALL SELECT rating, language, release_year_clean, 'Trakt_cleaned' FROM clean_b_adj)"""
GRID = "(VALUES ('TMDB_cleaned'), ('Trakt_cleaned')) d(dataset)"


@register("rating_comparison", O.with_query(O.pipeline_ctes("adjusted") + [TWO_SQL], f"""SELECT round(k.rating, 6) AS rating,
  d.dataset, coalesce(c.count, 0)::BIGINT AS count
FROM (SELECT DISTINCT rating FROM two WHERE rating IS NOT NULL) k CROSS JOIN {GRID}
LEFT JOIN (SELECT rating, dataset, count(*) AS count FROM two GROUP BY ALL) c ON c.rating = k.rating AND c.dataset = d.dataset"""))
def q_rating_comparison(spark, sf):
    """Rating distribution of both cleaned sources, aligned, 0-filled."""
    return emit(Q.rating_comparison(_two(spark, sf)))


@register("language_comparison", O.with_query(O.raw_ctes() + ["""tw AS (
  SELECT coalesce(language, 'unknown') AS language, 'TMDB_cleaned' AS dataset FROM raw_a
  UNION ALL SELECT coalesce(language, 'unknown'), 'Trakt_cleaned' FROM raw_b)"""], f"""SELECT k.language, d.dataset,
  coalesce(c.count, 0)::BIGINT AS count
FROM (SELECT language FROM tw GROUP BY 1 ORDER BY count(*) DESC, language LIMIT 10) k CROSS JOIN {GRID}
LEFT JOIN (SELECT language, dataset, count(*) AS count FROM tw GROUP BY ALL) c ON c.language = k.language AND c.dataset = d.dataset"""))
def q_language_comparison(spark, sf):
    """Language counts of the two raw sources, top 10 by total."""
    return Q.language_comparison(_two(spark, sf, adjusted=False))


@register("year_comparison", O.with_query(O.pipeline_ctes("adjusted") + [TWO_SQL], f"""SELECT k.year, d.dataset,
  coalesce(c.count, 0)::BIGINT AS count
FROM (SELECT DISTINCT release_year_clean AS year FROM two WHERE release_year_clean IS NOT NULL ORDER BY year DESC LIMIT 20) k
CROSS JOIN {GRID}
LEFT JOIN (SELECT release_year_clean AS year, dataset, count(*) AS count FROM two GROUP BY ALL) c ON c.year = k.year AND c.dataset = d.dataset"""))
def q_year_comparison(spark, sf):
    """Release-year counts of both cleaned sources, latest 20 years."""
    return Q.year_comparison(_two(spark, sf))


@register("labels_balance", """SELECT count_if(quality = 0)::BIGINT AS low, count_if(quality = 1)::BIGINT AS high,
  round(least(count_if(quality = 0), count_if(quality = 1)) / nullif(greatest(count_if(quality = 0), count_if(quality = 1)), 0), 6) AS ratio,
  CASE WHEN count(*) = 0 THEN 'cannot-evaluate'
       WHEN least(count_if(quality = 0), count_if(quality = 1)) / greatest(count_if(quality = 0), count_if(quality = 1)) >= 0.6 THEN 'balanced'
       WHEN least(count_if(quality = 0), count_if(quality = 1)) / greatest(count_if(quality = 0), count_if(quality = 1)) >= 0.35 THEN 'moderately-imbalanced'
       ELSE 'imbalanced' END AS verdict
FROM labels WHERE quality IS NOT NULL""")
def q_labels_balance(spark, sf):
    """A10 generalised: class balance of the document quality labels."""
    from tastemine.sources.views import table
    lab = table(spark, sf, "labels").filter(F.col("quality").isNotNull())
    return Q.class_balance(lab, {"low": F.col("quality") == 0, "high": F.col("quality") == 1})


# Fixed values, written out for the oracle: the recommendation for each verdict.
RECOMMENDATION_SQL = {
    "balanced": "Dataset has acceptable class spread for rating-based classification; no immediate balancing is required.",
    "moderately-imbalanced": "Dataset is usable, but classification tasks should consider class weights or targeted resampling.",
    "imbalanced": "Dataset is imbalanced for rating-class tasks; apply resampling or class-weighted training if you build a classifier.",
}


def _report_ctes(x: str) -> list[str]:
    return [f"""ms_{x} AS (
  SELECT field, missing_pct FROM ({_missing_sql(f'clean_{x}_adj', [c.strip('"') for c in O.CLEAN_COLUMNS.split(', ')])})
  WHERE missing_pct > 0 ORDER BY missing_pct DESC, field LIMIT 8)""", f"""bal_{x} AS (
  SELECT count_if(rating < 4) AS neg, count_if(rating >= 4 AND rating < 7) AS neu, count_if(rating >= 7) AS pos FROM clean_{x}_adj)""",
    f"""ver_{x} AS (SELECT *, least(neg, neu, pos) / greatest(neg, neu, pos) AS ratio,
  CASE WHEN least(neg, neu, pos) / greatest(neg, neu, pos) >= 0.6 THEN 'balanced'
       WHEN least(neg, neu, pos) / greatest(neg, neu, pos) >= 0.35 THEN 'moderately-imbalanced' ELSE 'imbalanced' END AS verdict FROM bal_{x})"""]


def _report_sql(x: str) -> str:
    return f"""SELECT 'size' AS section, 'rows_before' AS key, CAST((SELECT count(*) FROM raw_{x}) AS VARCHAR) AS value
UNION ALL SELECT 'size', 'rows_after', CAST((SELECT count(*) FROM clean_{x}) AS VARCHAR)
UNION ALL SELECT 'size', 'columns', '12'
UNION ALL SELECT 'cleaning', 'dropped_exact_duplicates', CAST((SELECT count(*) FROM raw_{x}) - (SELECT count(*) FROM clean_{x}_ex) AS VARCHAR)
UNION ALL SELECT 'cleaning', 'dropped_missing_core_fields', CAST((SELECT count(*) FROM clean_{x}_ex) - (SELECT count(*) FROM clean_{x}) AS VARCHAR)
UNION ALL SELECT 'missing', field, printf('%.2f', missing_pct) FROM ms_{x}
UNION ALL SELECT 'balance', 'negative', CAST(neg AS VARCHAR) FROM ver_{x}
UNION ALL SELECT 'balance', 'neutral', CAST(neu AS VARCHAR) FROM ver_{x}
UNION ALL SELECT 'balance', 'positive', CAST(pos AS VARCHAR) FROM ver_{x}
UNION ALL SELECT 'balance', 'ratio', printf('%.3f', ratio) FROM ver_{x}
UNION ALL SELECT 'balance', 'verdict', verdict FROM ver_{x}
UNION ALL SELECT 'recommendation', 'text', CASE verdict
  WHEN 'balanced' THEN '{RECOMMENDATION_SQL["balanced"]}'
  WHEN 'moderately-imbalanced' THEN '{RECOMMENDATION_SQL["moderately-imbalanced"]}'
  ELSE '{RECOMMENDATION_SQL["imbalanced"]}' END FROM ver_{x}"""


@register("quality_report", O.with_query(O.pipeline_ctes("adjusted") + _report_ctes("a") + _report_ctes("b"), _each_sql(_report_sql)))
def q_quality_report(spark, sf):
    """The dataset report of each cleaned, adjusted source."""
    st = Stages.of(spark, sf)
    return _each(lambda x: Q.quality_report(st.adjusted(x), st.cleaned(x).stats, metrics=st.cleaned(x).metrics))


# --- A21 / A24-A30 / A33 statistics -----------------------------------------------------------

@register("describe_events", """SELECT field, count, round(mean, 6) AS mean, round(std, 6) AS std, round("min", 6) AS "min",
  round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, round("max", 6) AS "max" FROM (
  SELECT 'value' AS field, count(value)::BIGINT AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS "min",
    quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, max(value) AS "max" FROM events
  UNION ALL SELECT 'user_id', count(user_id), avg(user_id), stddev_samp(user_id), min(user_id), quantile_cont(user_id, 0.25),
    quantile_cont(user_id, 0.5), quantile_cont(user_id, 0.75), max(user_id) FROM events)""")
def q_describe_events(spark, sf):
    """describe() of the events table's numeric columns (exact quartiles)."""
    from tastemine.operators.stats import describe
    from tastemine.sources.views import table
    return emit(describe(table(spark, sf, "events"), ["value", "user_id"]))


@register("rating_histogram", O.with_query(O.stage_ctes("transformed") + ["""r AS (SELECT min(rating) AS lo, max(rating) AS hi FROM trans)""",
    """b AS (SELECT CASE WHEN hi = lo THEN 1 ELSE least(floor(10.0 * (rating - lo) / (hi - lo)) + 1, 10) END AS bin
  FROM trans, r WHERE rating IS NOT NULL)"""], """SELECT g.bin::INTEGER AS bin, round(lo + (g.bin - 1) * (hi - lo) / 10, 6) AS lower,
  round(lo + g.bin * (hi - lo) / 10, 6) AS upper, coalesce(c.count, 0)::BIGINT AS count
FROM range(1, 11) g(bin) CROSS JOIN r LEFT JOIN (SELECT bin, count(*) AS count FROM b GROUP BY bin) c ON c.bin = g.bin"""))
def q_rating_histogram(spark, sf):
    """10 equal-width bins of the integrated ratings."""
    from tastemine.operators.stats import histogram
    return emit(histogram(Stages.of(spark, sf).transformed(), "rating", 10))


@register("rating_density", O.with_query(O.stage_ctes("transformed") + [
    "st AS (SELECT min(rating) AS lo, max(rating) AS hi, stddev_samp(rating) * pow(count(rating), -0.2) AS h, count(rating) AS n FROM trans)",
    "vals AS (SELECT rating AS v, count(*) AS c FROM trans WHERE rating IS NOT NULL GROUP BY 1)",
    "grid AS (SELECT i, lo + (hi - lo) * i / 49 AS g, h, n FROM st, range(0, 50) AS r(i))"],
    """SELECT i::INTEGER AS point, round(any_value(g), 6) AS x,
  round(sum(c * exp(-0.5 * pow((v - g) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density FROM grid, vals GROUP BY i"""))
def q_rating_density(spark, sf):
    """Gaussian KDE (Scott bandwidth) of the integrated ratings on 50 points."""
    from tastemine.operators.stats import density
    return emit(density(Stages.of(spark, sf).transformed(), "rating", 50))


@register("box_value_by_type", """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3, min(value) AS mn, max(value) AS mx FROM events GROUP BY event_type)
SELECT q.event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(mn, 6) AS "min", round(mx, 6) AS "max",
  round(min(CASE WHEN e.value >= q1 - 1.5 * (q3 - q1) THEN e.value END), 6) AS whisker_low,
  round(max(CASE WHEN e.value <= q3 + 1.5 * (q3 - q1) THEN e.value END), 6) AS whisker_high
FROM events e JOIN q USING (event_type) GROUP BY ALL""")
def q_box_value_by_type(spark, sf):
    """Box statistics of event values per event type."""
    from tastemine.operators.stats import box_stats
    from tastemine.sources.views import table
    return emit(box_stats(table(spark, sf, "events"), "event_type", "value"))


@register("source_share", O.with_query(O.stage_ctes("transformed"), """SELECT source, count(*)::BIGINT AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage FROM trans GROUP BY source"""))
def q_source_share(spark, sf):
    """Share of each source in the integrated data."""
    from tastemine.operators.stats import category_share
    return emit(category_share(Stages.of(spark, sf).transformed(), "source"))


@register("genre_indicator_sums", O.with_query(O.stage_ctes("encoded"), """SELECT 'genre_' || replace(g, ' ', '_') AS genre,
  count(*)::BIGINT AS count FROM enc, unnest(list_distinct(genres_list)) AS u(g) GROUP BY g"""))
def q_genre_indicator_sums(spark, sf):
    """Sums of the one-hot genre columns."""
    from tastemine.operators.encode import genre_column_name
    from tastemine.operators.stats import indicator_sums
    enc = Stages.of(spark, sf).encoded()
    return indicator_sums(enc.df, [genre_column_name(g) for g in enc.genre_vocab])


CORR_COLS = ["rating", "release_year", "genre_count", "primary_genre_encoded", "source_encoded"]


@register("feature_correlation", O.with_query(O.stage_ctes("encoded"), " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM enc"
    for a in CORR_COLS for b in CORR_COLS)))
def q_feature_correlation(spark, sf):
    """Pearson correlation matrix of five numeric features (long form)."""
    from tastemine.operators.stats import correlation
    return emit(correlation(Stages.of(spark, sf).encoded().df, CORR_COLS))


@register("genre_count_distribution", O.with_query(O.stage_ctes("transformed"),
                                                   "SELECT genre_count, count(*)::BIGINT AS count FROM trans GROUP BY 1"))
def q_genre_count_distribution(spark, sf):
    """A30."""
    from tastemine.operators.stats import value_distribution
    return value_distribution(Stages.of(spark, sf).transformed(), "genre_count", "genre_count")


@register("high_rated_profile", O.with_query(O.stage_ctes("split") + [TRAIN], """SELECT count_if(rating >= 7)::BIGINT AS rows,
  round(count_if(rating >= 7) / count(*), 6) AS share, count(DISTINCT CASE WHEN rating >= 7 THEN user_id END)::BIGINT AS users,
  count(DISTINCT CASE WHEN rating >= 7 THEN movie_title END)::BIGINT AS titles FROM tr"""))
def q_high_rated_profile(spark, sf):
    """The high-rated subset of the training split."""
    from tastemine.operators.stats import high_rated_profile
    return emit(high_rated_profile(Stages.of(spark, sf).part("train")))


# --- F1-F5 scalar functions, P17, U6, W6, W7, M4 ----------------------------------------------

@register("genre_parse_variants", O.with_query(O.raw_ctes() + [
    "g AS (SELECT DISTINCT trim(genres) AS genres FROM (SELECT genres FROM raw_a UNION ALL SELECT genres FROM raw_b))"],
    f"""SELECT genres, array_to_string({O.genre_parse('genres', 'clean')}, '|') AS parsed_clean,
  array_to_string({O.genre_parse('genres', 'clean')}, '|') AS parsed_transform,
  array_to_string({O.genre_parse('genres', 'notebook')}, '|') AS parsed_notebook FROM g"""))
def q_genre_parse_variants(spark, sf):
    """Every distinct raw genre text through the three parsers."""
    from tastemine.functions import genres as G
    from tastemine.functions.text import strip_unicode
    st = Stages.of(spark, sf)
    g = st.raw("A").select("genres").unionByName(st.raw("B").select("genres")).select(
        strip_unicode(F.col("genres")).alias("genres")).distinct()
    return emit(g.select("genres", G.parse_genres_clean(F.col("genres")).alias("parsed_clean"),
                         G.parse_genres_transform(F.col("genres")).alias("parsed_transform"),
                         G.parse_genres_notebook(F.col("genres")).alias("parsed_notebook")))


@register("genre_json_roundtrip", O.with_query(O.pipeline_ctes(), _each_sql(lambda x: f"""SELECT user_id, movie_id, to_json(genres_list)::VARCHAR AS genres_json,
  array_to_string(CAST(json(to_json(genres_list)) AS VARCHAR[]), '|') AS genres_decoded FROM clean_{x}""")))
def q_genre_json_roundtrip(spark, sf):
    """genre lists encoded to JSON text and decoded back."""
    from tastemine.functions.genres import from_json_list, to_json_list

    def one(x: str) -> DataFrame:
        j = Stages.of(spark, sf).cleaned(x).df.select("user_id", "movie_id", to_json_list(F.col("genres_list")).alias("genres_json"))
        return emit(j.withColumn("genres_decoded", from_json_list(F.col("genres_json"))))
    return _each(one)


@register("event_props", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def q_event_props(spark, sf):
    """F5 decode of the JSON ``props`` column of events."""
    from tastemine.sources.views import table
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


def _joined_lo(spark, sf):
    from tastemine.sources.views import table
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey)


LO_COLUMNS = [("l_orderkey", "n"), ("l_partkey", "n"), ("l_suppkey", "n"), ("l_linenumber", "n"), ("l_quantity", "n"),
              ("l_extendedprice", "n"), ("l_discount", "n"), ("l_tax", "n"), ("l_returnflag", "s"),
              ("l_linestatus", "s"), ("l_shipdate", "t"), ("o_orderkey", "n"), ("o_custkey", "n"),
              ("o_orderstatus", "s"), ("o_totalprice", "n"), ("o_orderdate", "t"), ("o_orderpriority", "s")]


def _identical_sql() -> str:
    pairs = [(i, j) for j in range(len(LO_COLUMNS)) for i in range(j) if LO_COLUMNS[i][1] == LO_COLUMNS[j][1]]
    flags = ", ".join(f"bool_and({LO_COLUMNS[i][0]} IS NOT DISTINCT FROM {LO_COLUMNS[j][0]}) AS e{i}_{j}" for i, j in pairs)
    sel = []
    for j, (name, _) in enumerate(LO_COLUMNS):
        eq = [f"e{i}_{j}" for i, jj in pairs if jj == j]
        cond = " OR ".join(eq) if eq else "false"
        sel.append(f"SELECT {j}::INTEGER AS position, '{name}' AS column_name FROM flags WHERE NOT ({cond})")
    return f"""WITH lo AS (SELECT * FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
flags AS (SELECT {flags} FROM lo)
""" + "\nUNION ALL ".join(sel)


@register("identical_columns", _identical_sql())
def q_identical_columns(spark, sf):
    """Columns kept after dropping those identical to an earlier one,
    on lineitem joined to orders (``o_orderkey`` repeats ``l_orderkey``)."""
    from tastemine.operators.cleaning import drop_identical_columns
    joined = _joined_lo(spark, sf)
    kept, _ = drop_identical_columns(joined, protect=())
    return spark.createDataFrame([(joined.columns.index(c), c) for c in kept.columns],
                                 "position int, column_name string")


@register("rating_domain", O.with_query(O.pipeline_ctes("adjusted"), """SELECT round(value, 6) AS value,
  string_agg(DISTINCT dataset, '|' ORDER BY dataset) AS datasets FROM (
  SELECT rating AS value, 'TMDB_cleaned' AS dataset FROM clean_a_adj UNION ALL SELECT rating, 'Trakt_cleaned' FROM clean_b_adj)
WHERE value IS NOT NULL GROUP BY value"""))
def q_rating_domain(spark, sf):
    """Union of the rating-value domains of both sources, with presence."""
    from tastemine.operators.integrate import union_domain
    return emit(union_domain(_two(spark, sf), "rating").withColumnRenamed("datasets", "datasets"))


@register("first_users_sample", O.with_query(O.stage_ctes("split") + [TRAIN],
                                             "SELECT DISTINCT user_id FROM tr ORDER BY user_id LIMIT 50"))
def q_first_users_sample(spark, sf):
    """The first 50 training users by sorted id (the reference's scoring sample)."""
    return Stages.of(spark, sf).part("train").select("user_id").distinct().orderBy("user_id").limit(50)


@register("cells_sample", O.with_query(O.stage_ctes("split") + [TRAIN], """SELECT user_id, movie_id, round(rating, 6) AS rating
FROM tr ORDER BY md5('42:' || user_id || ':' || CAST(movie_id AS VARCHAR)), user_id, movie_id, rating LIMIT 1000"""))
def q_cells_sample(spark, sf):
    """Reproducible sample of 1000 rated cells (order by md5(seed:key))."""
    from tastemine.operators.split import seeded_hash
    t = Stages.of(spark, sf).part("train")
    key = F.concat_ws(":", "user_id", F.col("movie_id").cast("string"))
    return emit(t.orderBy(seeded_hash(key), "user_id", "movie_id", "rating").limit(1000).select(
        "user_id", "movie_id", "rating"))


@register("rule_labels", O.with_query(_itemset_sql(), """SELECT array_to_string(antecedents, ', ') AS antecedents_str,
  array_to_string(consequents, ', ') AS consequents_str,
  array_to_string(antecedents, ', ') || ' -> ' || array_to_string(consequents, ', ') AS rule FROM rules"""))
def q_rule_labels(spark, sf):
    """M4: rule export text columns."""
    return _mined(spark, sf).rules.select("antecedents_str", "consequents_str", "rule")


@register("clustering_metrics")
def q_clustering_metrics(spark, sf):
    """K7: the clustering metrics document as one nested row (users, features,
    k analysis, best k, distribution, indices, PCA, cluster profiles)."""
    from tastemine.operators.cluster import cluster_indices, pca_2d
    from tastemine.operators.profiles import cluster_distribution, cluster_profiles, profile_features
    st = Stages.of(spark, sf)
    sw = st.sweep()
    labels, users, model = st.clustered(None)
    feats = st.features()
    pts = feats.join(labels, "user_idx").withColumnRenamed("user_cluster", "prediction")
    ev = cluster_indices(pts)
    k_analysis = sw.table.agg(F.sort_array(F.collect_list(F.struct(
        "k", "inertia", "silhouette", "silhouette_sq", "davies_bouldin", "calinski_harabasz"))).alias("k_analysis"))
    dist = cluster_distribution(labels).agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat(F.lit("cluster_"), F.col("user_cluster").cast("string")), F.col("count")))).alias("cluster_distribution"))
    _, ratios = pca_2d(feats)
    prof = cluster_profiles(users).agg(F.sort_array(F.collect_list(F.struct("*"))).alias("cluster_profiles"))
    head = st.profiles().agg(F.count(F.lit(1)).alias("num_users")).withColumns({
        "num_features": F.lit(len(profile_features(st.profiles()))), "best_k": F.lit(sw.best_k),
        "pca_explained_variance_ratio": F.array(*[F.lit(r) for r in ratios]),
        "pca_total_explained_variance": F.lit(float(sum(ratios)))})
    return head.crossJoin(k_analysis).crossJoin(dist).crossJoin(ev).crossJoin(prof)


from tastemine.plans import served  # noqa: E402,F401  registers its queries
