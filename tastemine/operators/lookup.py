"""Lookups served by the reference's demo, as batch table operators.

Every lookup takes a *table* of requests and answers all of them with joins,
so a million requests cost one job, not a million.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemine.functions.genres import display_genres
from tastemine.operators import fuzzy
from tastemine.operators.cleaning import ORDER_COL

# Fixed value that must equal the reference: the cold-start sentinel user.
NEW_USER = "--- Người Dùng Mới (New User) ---"
TOP_RULE_RECS = 20


def users_with_recommendations(recs: DataFrame) -> DataFrame:
    """L1."""
    return recs.select("user_id").distinct()


def popular_titles(recs: DataFrame, top: int = 10) -> DataFrame:
    """Most often recommended titles, rank 1..N (ties: title), score = count."""
    counts = recs.groupBy("movie_title").agg(F.count(F.lit(1)).alias("count"))
    top_n = counts.orderBy(F.desc("count"), "movie_title").limit(top)
    w = Window.orderBy(F.desc("count"), "movie_title")  # N rows only
    return top_n.select(F.row_number().over(w).alias("rank"), "movie_title",
                        F.col("count").cast("double").alias("score"))


def user_clusters(encoded: DataFrame, clusters: DataFrame, order_col: str = ORDER_COL) -> DataFrame:
    """``user_id -> user_cluster`` via the first row of each user (by row
    order) and an inner join on ``user_idx``."""
    first = encoded.groupBy("user_id").agg(F.min_by("user_idx", F.col(order_col)).alias("user_idx"))
    return first.join(clusters.select("user_idx", "user_cluster"), "user_idx", "inner").select(
        "user_id", "user_cluster")


def recommendations_for(requests: DataFrame, recs: DataFrame, clusters: DataFrame | None = None,
                        cold_start: str = "sentinel", popular: int = 10) -> DataFrame:
    """L2 + L3: recommendations for each requested ``user_id`` with the
    user's cluster (null when unknown).

    ``cold_start='sentinel'`` answers the new-user sentinel with the popular
    list (unknown ids get nothing, as in the reference); ``'absent'`` gives the
    popular list to every requested user without recommendations.
    """
    req = requests.select("user_id").distinct()
    own = req.join(recs, "user_id", "inner").select(
        "user_id", "rank", "movie_id", "movie_title", "score")
    pop = popular_titles(recs, popular)
    if cold_start == "sentinel":
        cold_users = req.filter(F.col("user_id") == NEW_USER)
    else:
        cold_users = req.join(recs.select("user_id").distinct(), "user_id", "left_anti")
    cold = cold_users.crossJoin(F.broadcast(pop)).select(  # pop has `popular` rows
        "user_id", "rank", F.lit(None).cast("bigint").alias("movie_id"), "movie_title", "score")
    out = own.unionByName(cold)
    if clusters is not None:
        out = out.join(clusters, "user_id", "left")
    else:
        out = out.withColumn("user_cluster", F.lit(None).cast("int"))
    return out


def user_recommendations(recs: DataFrame, user_id: str) -> DataFrame:
    """One user's recommendations by rank."""
    return recs.filter(F.col("user_id") == user_id).orderBy("rank")


# Scores of an exact and of a substring match.
EXACT_SCORE = 2.0
SUBSTRING_SCORE = 1.5
_GRAM = 3


def match_titles(queries: DataFrame, titles: DataFrame, query_col: str = "query", title_col: str = "title") -> DataFrame:
    """``(query, title, score)`` of every title that equals a query or contains it, in any case.

    Equal titles come from an equi-join on the lower-cased text. For substrings the first (up to) three characters of a
    query are joined with every run of that length in the titles: a title that contains the query has that run, so
    nothing is lost, and only those pairs are compared."""
    q = queries.select(F.col(query_col).alias("query")).where(F.length(query_col) > 0).distinct()
    q = q.withColumn("_q", F.lower("query")).withColumn("_gram", F.substring("_q", 1, _GRAM))
    t = titles.select(F.col(title_col).alias("title")).where(F.col(title_col).isNotNull()).distinct().withColumn("_t", F.lower("title"))
    starts = F.sequence(F.lit(1), F.greatest(F.length("_t"), F.lit(1)))
    runs = F.flatten(F.array(*[F.transform(starts, _run_of(n)) for n in range(1, _GRAM + 1)]))
    t = t.select("title", "_t", F.explode(F.array_distinct(runs)).alias("_gram"))
    both = q.join(t, "_gram").where(F.contains("_t", "_q"))
    score = F.when(F.col("_q") == F.col("_t"), EXACT_SCORE).otherwise(SUBSTRING_SCORE)
    return both.select("query", "title", score.alias("score"))


def _run_of(n: int):
    return lambda i: F.substring(F.col("_t"), i, F.lit(n))


def match_titles_fuzzy(queries: DataFrame, titles: DataFrame, query_col: str = "query", title_col: str = "title", cutoff: float = fuzzy.CUTOFF) -> DataFrame:
    """J6 with F10: the matches of ``match_titles``, and every other title whose similarity to the query exceeds
    ``cutoff``, the similarity being its score. A pair that matches in several ways has the best score."""
    plain = match_titles(queries, titles, query_col, title_col)
    alike = fuzzy.similar(queries, titles, query_col, title_col, cutoff)
    q = queries.select(F.col(query_col).alias("query")).distinct().withColumn("_q", F.lower("query"))
    t = titles.select(F.col(title_col).alias("title")).distinct().withColumn("_t", F.lower("title"))
    alike = alike.join(q, "_q").join(t, "_t").select("query", "title", F.col("ratio").alias("score"))
    return plain.unionByName(alike).groupBy("query", "title").agg(F.max("score").alias("score"))


def rule_recommendations(queries: DataFrame, rules: DataFrame, top: int = TOP_RULE_RECS, query_col: str = "query",
                         cutoff: float | None = None) -> DataFrame:
    """Title query -> rule-based recommendations, for a table of queries.

    A rule is kept for a query when any antecedent title matches it (exact or substring; with a ``cutoff`` also by
    similarity). The matched title of a query is its best match (score, then title). Consequents of the kept rules, minus the matched title (case-insensitive),
    keep their best rule (lift, then confidence); the top N per query by lift (ties: title) are returned.

    Rules are first reduced to the best one per antecedent title and consequent, so a query meets each consequent of a
    title once, not once per rule.
    """
    r = rules.filter(F.col("lift").isNotNull() & ~F.isnan("lift"))
    pairs = r.select(F.explode("antecedents").alias("title"), "consequents", "lift", "confidence")
    pairs = pairs.select("title", F.explode("consequents").alias("movie_title"), "lift", "confidence")
    best_rule = F.max(F.struct("lift", "confidence")).alias("_b")
    pairs = pairs.groupBy("title", "movie_title").agg(best_rule).select("title", "movie_title", "_b.*")
    if cutoff is None:
        matches = match_titles(queries, pairs.select("title"), query_col)
    else:
        matches = match_titles_fuzzy(queries, pairs.select("title"), query_col, cutoff=cutoff)
    searched = matches.groupBy("query").agg(
        F.min_by("title", F.struct(F.negative("score"), F.col("title"))).alias("searched_movie"))
    per = matches.join(pairs, "title").groupBy("query", "movie_title").agg(best_rule)
    per = per.join(searched, "query").filter(F.lower("movie_title") != F.lower("searched_movie"))
    w = Window.partitionBy("query").orderBy(F.desc("_b.lift"), "movie_title")
    ranked = per.select("query", "searched_movie", "movie_title", F.col("_b.confidence").alias("confidence"),
                        F.col("_b.lift").alias("lift"), F.row_number().over(w).alias("rank"))
    return ranked.filter(F.col("rank") <= top)


def cluster_cards(cluster_profiles: DataFrame, genres: int = 3) -> DataFrame:
    """Id, users, average rating, first display genres."""
    return cluster_profiles.select(
        "cluster_id", "num_users", "avg_rating",
        display_genres(F.transform("top_genres", lambda g: g["genre"]), genres).alias("top_genres"))


def cluster_insight(cluster_profiles: DataFrame, users: DataFrame, samples: int = 5) -> DataFrame:
    """Top two genres and sample users (smallest ids) per cluster."""
    w = Window.partitionBy("user_cluster").orderBy("user_idx")
    sample = (users.select("user_cluster", "user_idx").withColumn("_r", F.row_number().over(w))
              .filter(F.col("_r") <= samples)
              .groupBy("user_cluster").agg(F.array_sort(F.collect_list("user_idx")).alias("sample_users")))
    prof = cluster_profiles.select(
        F.col("cluster_id").alias("user_cluster"),
        F.col("top_genres")[0]["genre"].alias("top_genre_1"),
        F.col("top_genres")[1]["genre"].alias("top_genre_2"))
    return prof.join(sample, "user_cluster", "left")
