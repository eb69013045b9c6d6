"""Rating-matrix factorization and top-k recommendations.

The user x item matrix is never pivoted: it stays as cells ``(u_row, i_col, rating)``. The truncated SVD is randomized
(as the reference's ``TruncatedSVD``), see ``blocked_svd``.

Recommendations are the items with the largest products U.Sigma . V^T, see ``topk``; the dense score matrix never exists
as rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemine.operators.blocked_svd import factors_of
from tastemine.operators.indexing import dense_index
from tastemine.operators.topk import top_items
from tastemine.session import checkpoint, release, scratch, stored

N_FACTORS = 50
TOP_K = 10


def rating_matrix(df: DataFrame, user_col: str = "user_id", item_col: str = "movie_id",
                  rating_col: str = "rating") -> DataFrame:
    """Mean rating per (user, item) (pivot_table default), kept long."""
    return df.groupBy(user_col, item_col).agg(F.avg(rating_col).alias("rating"))


def matrix_shape(cells: DataFrame, user_col: str = "user_id", item_col: str = "movie_id") -> DataFrame:
    """Users, items, non-zero cells and sparsity ``1 - nnz / (users*items)``."""
    return cells.agg(
        F.countDistinct(user_col).cast("bigint").alias("users"),
        F.countDistinct(item_col).cast("bigint").alias("items"),
        F.count_if(F.col("rating") != 0).cast("bigint").alias("nnz"),
    ).withColumn("sparsity", F.round(1.0 - F.col("nnz") / (F.col("users") * F.col("items")), 9))


@dataclass
class Factorization:
    users: DataFrame          # user_id, u_row, factors array<double> (U.Sigma)
    items: DataFrame          # item_id, i_col, factors array<double> (V row)
    sigma: list[float]
    n_items: int
    n_factors: int
    cells: DataFrame          # user_id, item_id, u_row, i_col, rating


def factorize(ratings: DataFrame, user_col: str = "user_id", item_col: str = "movie_id",
              rating_col: str = "rating", n_factors: int | None = N_FACTORS) -> Factorization:
    """Truncated SVD of the 0-filled user x item mean-rating matrix (no
    centring), k = min(n_factors, items - 1), or all items for ``None``. Rows are users sorted by id,
    columns items sorted by id (the pivot's order)."""
    spark = ratings.sparkSession
    cells, remove = scratch(rating_matrix(ratings, user_col, item_col, rating_col))
    release(spark)
    u_idx = dense_index(cells.select(user_col).distinct(), [user_col], "u_row")
    i_idx = dense_index(cells.select(item_col).distinct(), [item_col], "i_col")
    numbered = stored(cells.join(u_idx, user_col).join(i_idx, item_col))
    remove()
    n_items = i_idx.count()
    release(spark)
    k = n_items if n_factors is None else max(1, min(n_factors, n_items - 1))
    us, v, sigma, remove = factors_of(numbered.select("u_row", "i_col", "rating"), k, n_items)
    users, items = checkpoint(us.join(u_idx, "u_row")), checkpoint(v.join(i_idx, "i_col"))
    remove()
    release(spark)
    return Factorization(users, items, [float(x) for x in sigma], n_items, len(sigma), numbered)


def recommend(fact: Factorization, titles: DataFrame | None = None, k: int = TOP_K,
              user_col: str = "user_id", item_col: str = "movie_id", exclude_seen: bool = False,
              unknown_title: str = "Unknown") -> DataFrame:
    """score = U.Sigma . V^T for every item, top k per user
    (score desc, item id asc), score rounded to 2, title lookup with default.

    See ``topk`` for the search. With ``exclude_seen`` rated items are left out before ranking.
    """
    best, _ = top_items(fact.users.select("u_row", "factors"), fact.items.select("i_col", "factors"), k, fact.cells if exclude_seen else None)
    recs = best.join(fact.users.select("u_row", user_col), "u_row").join(fact.items.select("i_col", item_col), "i_col")
    recs = recs.withColumn("score", F.round("raw_score", 2))
    if titles is not None:
        recs = recs.join(titles, item_col, "left")
    else:
        recs = recs.withColumn("movie_title", F.lit(None).cast("string"))
    return recs.withColumn("movie_title", F.coalesce("movie_title", F.lit(unknown_title))).select(
        user_col, item_col, "movie_title", "score", "rank")


def predicted(fact: Factorization) -> DataFrame:
    """The rated cells with ``prediction``, their value in U.Sigma.V^T."""
    c = fact.cells.join(fact.users.select("u_row", F.col("factors").alias("_u")), "u_row").join(
        fact.items.select("i_col", F.col("factors").alias("_v")), "i_col")
    dot = F.aggregate(F.zip_with("_u", "_v", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    return c.withColumn("prediction", dot).drop("_u", "_v")


def reconstruction_error(fact: Factorization) -> DataFrame:
    """RMSE / MAE of U.Sigma.V^T on the rated cells (all users), and the
    all-cells RMSE via sum over rated cells of (r^2 - 2 r p) plus the sum of
    all predictions squared = sum_u |U.Sigma_u . V^T|^2 = sum_u |U.Sigma_u|^2
    (V has orthonormal columns)."""
    c = predicted(fact).withColumnRenamed("prediction", "_p")
    rated = c.agg(
        F.sqrt(F.avg((F.col("rating") - F.col("_p")) ** 2)).alias("rmse"),
        F.avg(F.abs(F.col("rating") - F.col("_p"))).alias("mae"),
        F.sum(F.col("rating") ** 2 - 2 * F.col("rating") * F.col("_p")).alias("_cross"),
    )
    n_items = fact.n_items
    norms = fact.users.agg(
        F.sum(F.aggregate("factors", F.lit(0.0), lambda acc, x: acc + x * x)).alias("_pp"),
        F.count(F.lit(1)).alias("_nu"))
    return rated.crossJoin(norms).select(
        "rmse", "mae",
        F.sqrt((F.col("_cross") + F.col("_pp")) / (F.col("_nu") * F.lit(n_items))).alias("rmse_all_cells"))


def total_variance(cells: DataFrame, n_users: int, item_col: str) -> DataFrame:
    """The variance of all columns of the 0-filled matrix, from per-item sums of the cells."""
    col = cells.groupBy(item_col).agg(F.sum("rating").alias("s"), F.sum(F.col("rating") ** 2).alias("q"))
    return col.agg(F.sum(F.col("q") / n_users - (F.col("s") / n_users) ** 2).alias("total_variance"))


def explained_variance(fact: Factorization) -> DataFrame:
    """Var of each U.Sigma column / total column variance of the matrix
    (population variances, zeros included), one row per component plus the
    total. Column variances come from per-item sums of the sparse cells."""
    total = total_variance(fact.cells, fact.users.count(), "i_col").withColumnRenamed("total_variance", "_total")
    comp = fact.users.select(F.posexplode("factors").alias("component", "x")).groupBy("component").agg(
        F.var_pop("x").alias("_var"))
    return comp.crossJoin(total).select("component", (F.col("_var") / F.col("_total")).alias("ratio"))
