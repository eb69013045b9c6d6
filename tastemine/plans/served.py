"""Lookups and reports over artifacts that SQL can compute as well: lists of each user's best-rated items in place of
factorized ones, market segments in place of k-means labels. Also sources and sinks, written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tastemine.operators import lookup as L
from tastemine.plans import oracle as O
from tastemine.plans.catalog import PROF_SQL, SEG_SQL, TRAIN, _itemset_sql, _labelled_profiles, _mined, _segment_labels, register
from tastemine.plans.pipeline import Stages, emit

# --- L1-L3, L6-L8, J1, J3, A31, A32 -----------------------------------------------------------

# Fixed value, written out for the oracle: the new-user sentinel.
NEW_USER_SQL = "--- Người Dùng Mới (New User) ---"
RECS_SQL = [TRAIN, f"""dict AS (SELECT movie_id, movie_title FROM (
  SELECT movie_id, movie_title, min((_part, {O.ORD})) AS f FROM splitted WHERE split = 'train' GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY f DESC) = 1)""", """recs AS MATERIALIZED (
  SELECT user_id, movie_id, coalesce(movie_title, 'Unknown') AS movie_title, score, rank FROM (
    SELECT user_id, movie_id, round(avg(rating), 2) AS score,
           (row_number() OVER (PARTITION BY user_id ORDER BY avg(rating) DESC, movie_id))::INTEGER AS rank
    FROM tr GROUP BY user_id, movie_id) LEFT JOIN dict USING (movie_id) WHERE rank <= 10)"""]
POP_SQL = """pop AS (SELECT (row_number() OVER (ORDER BY c DESC, movie_title))::INTEGER AS rank, movie_title, c::DOUBLE AS score
  FROM (SELECT movie_title, count(*) AS c FROM recs GROUP BY 1) ORDER BY c DESC, movie_title LIMIT 10)"""


def _recs_sql(*more: str) -> list[str]:
    return O.stage_ctes("split") + RECS_SQL + list(more)


def _best_rated(spark, sf):
    """Each training user's ten best-rated items (mean rating, ties by id), with titles."""
    from tastemine.operators.factorize import rating_matrix
    from tastemine.operators.rules import item_dictionary
    train = Stages.of(spark, sf).part("train")
    w = Window.partitionBy("user_id").orderBy(F.desc("rating"), "movie_id")
    best = rating_matrix(train).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 10)
    best = best.join(item_dictionary(train), "movie_id", "left")
    return best.select("user_id", "movie_id", F.coalesce("movie_title", F.lit("Unknown")).alias("movie_title"),
                       F.round("rating", 2).alias("score"), "rank")


@register("best_rated_recommendations", O.with_query(_recs_sql(), "SELECT * FROM recs"))
def q_best_rated_recommendations(spark, sf):
    """W2 / J2 on mean ratings: top ten per user with titles."""
    return _best_rated(spark, sf)


@register("served_users", O.with_query(_recs_sql(), "SELECT DISTINCT user_id FROM recs"))
def q_served_users(spark, sf):
    """L1."""
    return L.users_with_recommendations(_best_rated(spark, sf))


@register("served_popular", O.with_query(_recs_sql(POP_SQL), "SELECT * FROM pop"))
def q_served_popular(spark, sf):
    """A31 / L3."""
    return L.popular_titles(_best_rated(spark, sf))


@register("served_lookup", O.with_query(_recs_sql(POP_SQL, SEG_SQL, f"""cl AS (
  SELECT user_id, user_cluster FROM (SELECT DISTINCT user_id FROM splitted) JOIN seg USING (user_id))""", f"""req AS (
  SELECT DISTINCT user_id FROM splitted UNION SELECT '{NEW_USER_SQL}')""", """ans AS (
  SELECT req.user_id, recs.rank, recs.movie_id, recs.movie_title, recs.score FROM req JOIN recs USING (user_id)
  UNION ALL
  SELECT req.user_id, pop.rank, NULL, pop.movie_title, pop.score FROM req, pop
  WHERE req.user_id NOT IN (SELECT user_id FROM recs))"""),
    "SELECT ans.*, cl.user_cluster FROM ans LEFT JOIN cl USING (user_id)"))
def q_served_lookup(spark, sf):
    """Every user of all three splits and the new-user sentinel; own list or the popular one, with
    the segment of known users."""
    st = Stages.of(spark, sf)
    requests = st.split().select("user_id").distinct().unionByName(
        spark.range(1).select(F.lit(L.NEW_USER).alias("user_id")))
    encoded = st.encoded().df
    ids = encoded.select("user_id", "user_idx").distinct()
    labels = ids.join(_segment_labels(spark, sf), "user_id").select("user_idx", "user_cluster")
    return L.recommendations_for(requests, _best_rated(spark, sf), L.user_clusters(encoded, labels), cold_start="absent")


@register("served_user", O.with_query(_recs_sql(), """SELECT * FROM recs
WHERE user_id = (SELECT min(user_id) FROM tr)"""))
def q_served_user(spark, sf):
    """The first training user's list."""
    first = Stages.of(spark, sf).part("train").agg(F.min("user_id")).first()[0]
    return L.user_recommendations(_best_rated(spark, sf), first)


@register("served_overview", O.with_query(_recs_sql(SEG_SQL) + _itemset_sql(), """SELECT
  (SELECT count(DISTINCT user_id) FROM tr)::BIGINT AS users, (SELECT count(*) FROM rules)::BIGINT AS rules,
  (SELECT count(DISTINCT user_cluster) FROM seg)::BIGINT AS clusters, (SELECT count(*) FROM recs)::BIGINT AS recommendations"""))
def q_served_overview(spark, sf):
    """A32."""
    from tastemine.operators.stats import overview
    return overview(Stages.of(spark, sf).part("train"), _mined(spark, sf).rules, _segment_labels(spark, sf), _best_rated(spark, sf))


CARDS_SQL = [TRAIN, SEG_SQL, PROF_SQL, """cg AS (SELECT user_cluster, g AS genre, avg(x) AS score FROM (
  SELECT t.user_idx, s.user_cluster, v.g, avg(CASE WHEN list_contains(t.genres_list, v.g) THEN 1.0 ELSE 0.0 END) AS x
  FROM tr t JOIN seg s USING (user_id), (SELECT DISTINCT unnest(genres_list) AS g FROM tr) v GROUP BY ALL) GROUP BY ALL
  UNION ALL SELECT s.user_cluster, 'count', avg(gc) FROM (SELECT any_value(user_id) AS user_id, avg(genre_count) AS gc FROM tr GROUP BY user_idx) q JOIN seg s USING (user_id) GROUP BY 1
  UNION ALL SELECT s.user_cluster, 'count_scaled', avg(gc) FROM (SELECT any_value(user_id) AS user_id, avg(genre_count_scaled) AS gc FROM tr GROUP BY user_idx) q JOIN seg s USING (user_id) GROUP BY 1)""",
    """top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_cluster ORDER BY round(score, 12) DESC, replace(genre, ' ', '_')) AS r FROM cg) WHERE r <= 5)""",
    """title AS (SELECT user_cluster, r, array_to_string(list_transform(string_split(replace(genre, '_', ' '), ' '),
  lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS genre FROM top WHERE genre NOT IN ('count', 'count_scaled'))"""]


@register("segment_cards", O.with_query(O.stage_ctes("split") + CARDS_SQL, """SELECT s.user_cluster AS cluster_id, count(*)::BIGINT AS num_users,
  round(avg(avg_rating), 6) AS avg_rating, any_value(g.t) AS top_genres
FROM prof p JOIN seg s USING (user_id) JOIN (
  SELECT user_cluster, string_agg(genre, '|' ORDER BY r) AS t FROM (
    SELECT *, row_number() OVER (PARTITION BY user_cluster ORDER BY r) AS n FROM title) WHERE n <= 3 GROUP BY 1) g
ON g.user_cluster = s.user_cluster GROUP BY s.user_cluster"""))
def q_segment_cards(spark, sf):
    """A15, F6, L6 on given labels."""
    from tastemine.operators.profiles import cluster_profiles
    return emit(L.cluster_cards(cluster_profiles(_labelled_profiles(spark, sf))))


@register("segment_insight", O.with_query(O.stage_ctes("split") + CARDS_SQL, """SELECT s.user_cluster,
  (SELECT replace(genre, ' ', '_') FROM top t WHERE t.user_cluster = s.user_cluster AND r = 1) AS top_genre_1,
  (SELECT replace(genre, ' ', '_') FROM top t WHERE t.user_cluster = s.user_cluster AND r = 2) AS top_genre_2,
  array_to_string(list_slice(list_sort(list(p.user_idx)), 1, 5), '|') AS sample_users
FROM prof p JOIN seg s USING (user_id) GROUP BY s.user_cluster"""))
def q_segment_insight(spark, sf):
    """L7 on given labels."""
    from tastemine.operators.profiles import cluster_profiles
    users = _labelled_profiles(spark, sf)
    out = L.cluster_insight(cluster_profiles(users), users)
    return out.withColumn("sample_users", F.array_join(F.transform("sample_users", lambda u: u.cast("string")), "|"))


# --- E8 / K1, A25, E9, M1 ---------------------------------------------------------------------

@register("profile_scaled", O.with_query(O.stage_ctes("split") + [TRAIN, PROF_SQL, """v AS (SELECT user_idx::BIGINT AS user_idx,
  avg_rating, num_ratings, coalesce(rating_std, 0) AS rating_std FROM prof)"""], "SELECT user_idx, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END, 6) AS {c}"
    for c in ("avg_rating", "num_ratings", "rating_std")) + " FROM v"))
def q_profile_scaled(spark, sf):
    """The three numeric profile columns, nulls 0, standard scaled (population deviation)."""
    from tastemine.operators.cluster import standard_scale
    cols = ["avg_rating", "num_ratings", "rating_std"]
    prof = Stages.of(spark, sf).profiles().select("user_idx", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    return emit(standard_scale(prof, cols))


SCALED = ("rating_scaled", "year_scaled", "genre_count_scaled")


@register("feature_covariance", O.with_query(O.stage_ctes("split") + [TRAIN], " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(covar_pop({a}, {b}), 6) AS covariance FROM tr" for a in SCALED for b in SCALED)))
def q_feature_covariance(spark, sf):
    """The population covariance of scaled features that the reduction starts from."""
    from tastemine.operators.features import covariance
    cov = covariance(Stages.of(spark, sf).part("train"), list(SCALED))[1]
    rows = [(a, b, float(cov[i, j])) for i, a in enumerate(SCALED) for j, b in enumerate(SCALED)]
    return emit(spark.createDataFrame(rows, "a string, b string, covariance double"))


@register("feature_projection_norms", O.with_query(O.stage_ctes("split") + [TRAIN, "m AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED) + " FROM tr)"], "SELECT split, user_id, movie_id, round(" + " + ".join(
    f"power(({c} - m_{c}) / s_{c}, 2)" for c in SCALED) + ", 6) AS norm FROM splitted, m WHERE split <> 'train'"))
def q_feature_projection_norms(spark, sf):
    """E8-E10 with all components kept, which is a rotation: squared lengths of projected rows are those of scaled ones."""
    from tastemine.operators.features import fit_reduction
    st = Stages.of(spark, sf)
    red = fit_reduction(st.part("train"), list(SCALED), kept_variance=1.0)
    rows = st.split().where("split <> 'train'")
    out = red.transform(rows, ("split", "user_id", "movie_id"))
    norm = sum((F.col(f"pca_{k}") * F.col(f"pca_{k}") for k in range(red.n_components)), start=F.lit(0.0))
    return emit(out.select("split", "user_id", "movie_id", norm.alias("norm")))


@register("high_rated_baskets", O.with_query(O.stage_ctes("split") + [TRAIN], """SELECT user_id,
  count(DISTINCT movie_title)::BIGINT AS n_items, min(movie_title) AS first_item, max(movie_title) AS last_item
FROM tr WHERE rating >= 7 AND movie_title IS NOT NULL GROUP BY user_id"""))
def q_high_rated_baskets(spark, sf):
    """Baskets of titles a training user rated 7 or more."""
    from tastemine.operators.rules import HIGH_RATING, baskets
    b = baskets(Stages.of(spark, sf).part("train"), "user_id", "movie_title", min_rating=HIGH_RATING)
    return b.select("user_id", F.size("items").cast("bigint").alias("n_items"), F.array_min("items").alias("first_item"), F.array_max("items").alias("last_item"))


@register("matrix_total_variance", O.with_query(O.stage_ctes("split") + [TRAIN, "c AS (SELECT user_id, movie_id, avg(rating) AS r FROM tr GROUP BY ALL)",
    "nu AS (SELECT count(DISTINCT user_id) AS n FROM c)"], """SELECT round(sum(v), 6) AS total_variance FROM (
  SELECT sum(r * r) / any_value(n) - power(sum(r) / any_value(n), 2) AS v FROM c, nu GROUP BY movie_id)"""))
def q_matrix_total_variance(spark, sf):
    """R4's denominator: the variance of all columns of the 0-filled rating matrix."""
    from tastemine.operators.factorize import rating_matrix, total_variance
    cells = rating_matrix(Stages.of(spark, sf).part("train"))
    return emit(total_variance(cells, cells.select("user_id").distinct().count(), "movie_id"))


# --- sources and sinks: written under the shared checkpoint folder, read back ------------------

def _scratch(spark, name: str) -> str:
    from tastemine.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- IO9: encoders fitted on the training split, saved, loaded and applied to the others --------

_PERSISTED = ("rating", "release_year", "genre_count")
PERSISTED_SQL = O.with_query(O.stage_ctes("split") + ["""x AS (SELECT split, user_id, movie_id, "cast" AS people, primary_genre, rating,
  coalesce(release_year::DOUBLE, 0) AS release_year, coalesce(genre_count::DOUBLE, 0) AS genre_count FROM splitted)""",
    "tr AS (SELECT * FROM x WHERE split = 'train')", """scale AS (SELECT min(rating) AS lo0, max(rating) AS hi0, min(release_year) AS lo1, max(release_year) AS hi1,
  min(genre_count) AS lo2, max(genre_count) AS hi2, avg(rating) AS m, stddev_pop(rating) AS s FROM tr)""",
    """codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT CAST(movie_id AS VARCHAR) AS v FROM tr))""",
    """tok AS (SELECT row_number() OVER () AS id, * FROM x)""", """tf AS (SELECT id, split, term, count(*) AS tf
  FROM (SELECT id, split, unnest(regexp_extract_all(lower(coalesce(people, '')), '[^,]+')) AS term FROM tok) GROUP BY ALL)""",
    """voc AS (SELECT term, ln((1.0 + (SELECT count(*) FROM tr)) / (1.0 + count(*))) + 1.0 AS idf FROM tf WHERE split = 'train'
  GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 500)""",
    "w AS (SELECT id, count(*) AS terms, sum(tf * idf) / sqrt(sum(tf * idf * tf * idf)) AS weight FROM tf JOIN voc USING (term) GROUP BY id)"],
    """SELECT split, user_id, movie_id, round((rating - lo0) / (hi0 - lo0), 6) AS rating_scaled, round((release_year - lo1) / (hi1 - lo1), 6) AS release_year_scaled,
  round((genre_count - lo2) / (hi2 - lo2), 6) AS genre_count_scaled, round((rating - m) / s, 6) AS rating_standard, code AS movie_code,
  coalesce(terms, 0) AS terms, round(coalesce(weight, 0), 6) AS weight
FROM tok CROSS JOIN scale LEFT JOIN codes ON v = CAST(movie_id AS VARCHAR) LEFT JOIN w USING (id) WHERE split <> 'train'""")


@register("persisted_encoders", PERSISTED_SQL)
def q_persisted_encoders(spark, sf):
    """IO9: scalers, label codes, TF-IDF and the reduction in one pipeline, fitted on the training split, saved, and
    applied as loaded to the other splits."""
    from pyspark.ml import Pipeline, PipelineModel

    from tastemine.operators import transformers as M
    rows = Stages.of(spark, sf).split().select("split", "user_id", "movie_id", "cast", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in _PERSISTED])
    scaled = [f"{c}_scaled" for c in _PERSISTED]
    stages = [M.MinMax(inputCols=list(_PERSISTED), outputCols=scaled), M.Standard(inputCols=["rating"], outputCols=["rating_standard"]),
              M.LabelCodes(inputCol="movie_id", outputCol="movie_code"), M.TfIdf(inputCol="cast", outputCol="tfidf"), M.Reduction(inputCols=scaled, outputCol="pca")]
    path = _scratch(spark, "pipeline")
    Pipeline(stages=stages).fit(rows.where("split = 'train'")).write().save(path)
    out = PipelineModel.load(path).transform(rows.where("split <> 'train'"))
    weight = F.aggregate("tfidf", F.lit(0.0), lambda s, x: s + x["weight"])
    return emit(out.select("split", "user_id", "movie_id", *scaled, "rating_standard", "movie_code", F.size("tfidf").cast("bigint").alias("terms"), weight.alias("weight")))


@register("io_csv", "SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events")
def q_io_csv(spark, sf):
    """IO1, IO2, IO5: events as CSV files, read with an explicit schema and pruned."""
    from tastemine.sources import files, views
    df = views.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    path = _scratch(spark, "csv")
    files.write_csv(df, path)
    return emit(files.read_csv(spark, path, schema=df.schema).select(*df.columns))


@register("io_parquet", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def q_io_parquet(spark, sf):
    """IO3, IO4, IO6: a Parquet sink, found again as the first existing one of several paths."""
    from tastemine.sources import files, views
    path = _scratch(spark, "parquet")
    files.write_parquet(views.table(spark, sf, "customer"), f"{path}/table")
    found = files.resolve_first_existing(spark, path, "missing", "table")
    return files.read_parquet(spark, found, ["c_custkey", "c_name", "c_mktsegment"])


@register("io_metrics", "SELECT count(*)::BIGINT AS rows, round(avg(value), 6) AS mean_value FROM events")
def q_io_metrics(spark, sf):
    """IO7, L9: a metrics document written as JSON and read back."""
    from tastemine.sources import files, views
    path = _scratch(spark, "metrics")
    files.write_metrics(views.table(spark, sf, "events").agg(F.count(F.lit(1)).alias("rows"), F.avg("value").alias("mean_value")), path)
    return emit(files.read_metrics(spark, path).select("rows", "mean_value"))


@register("io_sparse", """SELECT o_custkey AS custkey, count(*)::BIGINT AS n, min(l_partkey)::INTEGER AS first_index,
  max(l_partkey)::INTEGER AS last_index, round(sum(q), 6) AS total
FROM (SELECT o_custkey, l_partkey, sum(l_quantity) AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) GROUP BY 1""")
def q_io_sparse(spark, sf):
    """IO8: quantities per customer and part as sparse rows, read back."""
    from tastemine.sources import files, views
    li = views.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    cells = li.join(views.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    cells = cells.groupBy(F.col("o_custkey").alias("custkey"), "l_partkey").agg(F.sum("l_quantity").alias("q"))
    path = _scratch(spark, "sparse")
    files.write_sparse(cells, "custkey", "l_partkey", "q", cells.agg(F.max("l_partkey")).first()[0] + 1, path)
    total = F.aggregate("values", F.lit(0.0), lambda s, x: s + x)
    return emit(files.read_parquet(spark, path).select("custkey", F.size("indices").cast("bigint").alias("n"), F.array_min("indices").alias("first_index"),
                                                       F.array_max("indices").alias("last_index"), total.alias("total")))


@register("io_params", """SELECT value, (dense_rank() OVER (ORDER BY value) - 1)::BIGINT AS code
FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS value FROM orders)""")
def q_io_params(spark, sf):
    """IO9: a label-code table saved and loaded."""
    from tastemine.operators.indexing import label_codes
    from tastemine.sources import files, views
    path = _scratch(spark, "params")
    files.save_params(label_codes(views.table(spark, sf, "orders"), "o_custkey", "code"), path)
    return files.read_parquet(spark, path).select(F.col("_value").alias("value"), "code")


# --- A21 info, P2 / P16, E3 long, E12 projections ----------------------------------------------

EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value", "ts", "props")


@register("info_events", " UNION ALL ".join(f"SELECT '{c}' AS field, count({c})::BIGINT AS non_null FROM events" for c in EVENT_COLUMNS))
def q_info_events(spark, sf):
    """A21 info(): filled rows per column."""
    from tastemine.operators.stats import info
    from tastemine.sources import views
    return info(views.table(spark, sf, "events").select(*EVENT_COLUMNS)).select("field", "non_null")


@register("tidy_column_names", "SELECT c_custkey AS id, c_mktsegment AS segment FROM customer")
def q_tidy_column_names(spark, sf):
    """Names with blanks trimmed, of equal names the first column kept."""
    from tastemine.operators.cleaning import dedupe_column_names, trim_column_names
    from tastemine.sources import views
    df = views.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name")
    return dedupe_column_names(trim_column_names(df.toDF(" id", "segment  ", "id ")))


@register("encode_genre_long", O.with_query(O.stage_ctes("encoded"), """SELECT user_idx::BIGINT AS user_idx, movie_idx::BIGINT AS movie_idx, g AS genre
FROM enc, unnest(list_distinct(genres_list)) AS t(g)"""))
def q_encode_genre_long(spark, sf):
    """E3 without a wide vocabulary: the form that any number of genres allows."""
    from tastemine.operators.encode import genre_long
    df = Stages.of(spark, sf).encoded().df.withColumn("_k", F.struct("user_idx", "movie_idx"))
    return genre_long(df, "_k").select("_k.*", "genre")


@register("cluster_projection")
def q_cluster_projection(spark, sf):
    """Users on the first two principal components, with the ten clusters' centres."""
    from tastemine.operators.cluster import pca_2d
    from tastemine.plans.catalog import _clustered
    feats, _, labels, _ = _clustered(spark, sf, k=10)
    proj, _ = pca_2d(feats)
    users = proj.join(labels, "user_idx").select("user_idx", "user_cluster", F.col("pca_xy")[0].alias("x"), F.col("pca_xy")[1].alias("y"))
    centres = users.groupBy("user_cluster").agg(F.avg("x").alias("x"), F.avg("y").alias("y")).withColumn("user_idx", F.lit(None).cast("bigint"))
    return emit(users.withColumn("kind", F.lit("user")).unionByName(centres.withColumn("kind", F.lit("centre"))))
