"""User clustering.

Quality indices are computed from per-cluster sufficient statistics (count,
vector sum, sum of squared norms), so every index is linear in the number of
points; the k x k centroid table is the only thing broadcast (bounded by k).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemine.operators.kmeans import Model, best_by_k, fit_many, points
from tastemine.operators.silhouette import silhouettes

SEED = 42
N_INIT = 10
K_RANGE = range(2, 11)


# --- E8 / K1 -------------------------------------------------------------------------------------

def standard_params(df: DataFrame, cols: list[str]) -> DataFrame:
    """One-row table of mean and population std per column."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(F.col(f"`{c}`")).alias(f"_m{i}"), F.stddev_pop(F.col(f"`{c}`")).alias(f"_s{i}")]
    return df.agg(*aggs)


def standard_scale(df: DataFrame, cols: list[str], params: DataFrame | None = None,
                   out: str | None = None) -> DataFrame:
    """``(x - mean) / std_pop`` with zero std -> divide by 1 (sklearn);
    ``ml.StandardScaler`` would use the sample std. ``params`` may be fit on
    another frame (train). With ``out`` the scaled values go to one array
    column, otherwise the columns are replaced."""
    p = params if params is not None else standard_params(df, cols)
    j = df.crossJoin(F.broadcast(p))  # one row
    scaled = []
    for i, c in enumerate(cols):
        s = F.col(f"_s{i}")
        scaled.append((F.col(f"`{c}`").cast("double") - F.col(f"_m{i}"))
                      / F.when(s.isNull() | (s == 0), F.lit(1.0)).otherwise(s))
    if out:
        return j.withColumn(out, F.array(*scaled)).drop(*p.columns)
    return j.withColumns({c: e for c, e in zip(cols, scaled)}).drop(*p.columns)


def feature_matrix(profiles: DataFrame, feature_cols: list[str], key: str = "user_idx") -> DataFrame:
    """K1: drop the id, null -> 0, standard scale, assemble ``features`` (vector)."""
    filled = profiles.fillna(0.0, subset=feature_cols).fillna(0, subset=feature_cols)
    scaled = standard_scale(filled, feature_cols, out="_x")
    return scaled.select(key, array_to_vector("_x").alias("features"))


# --- K3 / K4 / K5 --------------------------------------------------------------------------------

def _sq_norm(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def _sq_dist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)


def cluster_stats(points: DataFrame, feat: str, label: str) -> DataFrame:
    """Per cluster: n, centroid, sum of squared norms (one partial aggregate)."""
    from pyspark.ml.stat import Summarizer

    vec = array_to_vector(F.col(feat).cast("array<double>")) if dict(points.dtypes)[feat].startswith("array") \
        else F.col(feat)
    s = points.select(F.col(label).alias("_c"), vec.alias("_v"), _sq_norm(vector_to_array(vec)).alias("_q"))
    agg = s.groupBy("_c").agg(F.count(F.lit(1)).alias("_n"), Summarizer.mean(F.col("_v")).alias("_mu"),
                              F.sum("_q").alias("_qs"))
    return agg.select("_c", "_n", vector_to_array("_mu").alias("_mu"), "_qs")


def _as_array(points: DataFrame, feat: str) -> Column:
    c = F.col(feat) if dict(points.dtypes)[feat].startswith("array") else vector_to_array(feat)
    return c.cast("array<double>")


def silhouette_sq(points: DataFrame, feat: str = "features", label: str = "prediction") -> DataFrame:
    """K3: mean silhouette with squared Euclidean distance (Spark's
    ``ClusteringEvaluator`` definition), in linear time: the mean squared
    distance of x to cluster C is |x|^2 + Q_C/n_C - 2 x.mu_C. Points of
    singleton clusters score 0. The k cluster summaries travel as one
    broadcast row; each point is scored with array expressions (no shuffle)."""
    st = cluster_stats(points, feat, label)
    packed = st.agg(F.collect_list(F.struct("_c", "_n", "_mu", "_qs")).alias("_cs"))  # k entries
    x = points.select(F.col(label).alias("_own"), _as_array(points, feat).alias("_x"))
    x = x.withColumn("_xq", _sq_norm(F.col("_x"))).crossJoin(F.broadcast(packed))
    ds = F.transform("_cs", lambda c: F.struct(
        c["_c"].alias("c"), c["_n"].alias("n"),
        (F.col("_xq") + c["_qs"] / c["_n"] - 2.0 * _dot(F.col("_x"), c["_mu"])).alias("d")))
    scored = x.select(F.col("_own"), ds.alias("_ds")).select(
        F.filter("_ds", lambda d: d["c"] == F.col("_own"))[0].alias("_o"),
        F.array_min(F.transform(F.filter("_ds", lambda d: d["c"] != F.col("_own")), lambda d: d["d"])).alias("_b"),
    )
    a = F.col("_o.d") * F.col("_o.n") / (F.col("_o.n") - 1)
    b = F.col("_b")
    s = (F.when(F.col("_o.n") <= 1, F.lit(0.0))
         .when(a < b, 1.0 - a / b)
         .when(a > b, b / a - 1.0)
         .otherwise(F.lit(0.0)))
    return scored.agg(F.avg(s).alias("silhouette_sq"))


def davies_bouldin(points: DataFrame, feat: str = "features", label: str = "prediction") -> DataFrame:
    """K4: mean over clusters of max_j (S_i + S_j) / |mu_i - mu_j|, S = mean
    Euclidean distance to the centroid (sklearn). k x k pairs only."""
    st = cluster_stats(points, feat, label)
    x = points.select(F.col(label).alias("_c"), _as_array(points, feat).alias("_x"))
    spread = x.join(F.broadcast(st.select("_c", "_mu")), "_c").groupBy("_c").agg(
        F.avg(F.sqrt(_sq_dist(F.col("_x"), F.col("_mu")))).alias("_s"))
    c = st.select("_c", "_mu").join(spread, "_c")
    a, b = c.alias("a"), c.alias("b")
    pairs = a.join(b, F.col("a._c") != F.col("b._c")).select(
        F.col("a._c").alias("_c"),
        ((F.col("a._s") + F.col("b._s")) / F.sqrt(_sq_dist(F.col("a._mu"), F.col("b._mu")))).alias("_r"))
    return pairs.groupBy("_c").agg(F.max("_r").alias("_m")).agg(F.avg("_m").alias("davies_bouldin"))


def calinski_harabasz(points: DataFrame, feat: str = "features", label: str = "prediction") -> DataFrame:
    """K5: (B / (k - 1)) / (W / (n - k)); W = sum of squared distances to the
    own centroid (one pass, k centroids broadcast), B = sum n_C |mu_C - mu|^2
    over the k clusters (mu = global mean)."""
    st = cluster_stats(points, feat, label)
    x = points.select(F.col(label).alias("_c"), _as_array(points, feat).alias("_x"))
    w = x.join(F.broadcast(st.select("_c", "_mu")), "_c").agg(
        F.sum(_sq_dist(F.col("_x"), F.col("_mu"))).alias("W"))
    packed = st.agg(F.collect_list(F.struct("_n", "_mu")).alias("_cs"), F.sum("_n").alias("N"),
                    F.count(F.lit(1)).alias("K"))
    gmu = F.aggregate(
        F.col("_cs"), F.array_repeat(F.lit(0.0), F.size(F.col("_cs")[0]["_mu"])),
        lambda acc, c: F.zip_with(acc, c["_mu"], lambda a, m: a + m * c["_n"]))
    packed = packed.withColumn("_g", F.transform(gmu, lambda a: a / F.col("N")))
    b = packed.select("N", "K", F.aggregate(
        "_cs", F.lit(0.0), lambda acc, c: acc + c["_n"] * _sq_dist(c["_mu"], F.col("_g"))).alias("B"))
    return b.crossJoin(w).select(
        (F.when(F.col("W") == 0, F.lit(1.0))
         .otherwise((F.col("B") / (F.col("K") - 1)) / (F.col("W") / (F.col("N") - F.col("K"))))).alias("calinski_harabasz"))


def cluster_indices(points: DataFrame, feat: str = "features", label: str = "prediction") -> DataFrame:
    """K3-K5 together (one row) in linear time, the silhouette by squared distance; see ``silhouette`` for the Euclidean one."""
    return (silhouette_sq(points, feat, label).crossJoin(davies_bouldin(points, feat, label))
            .crossJoin(calinski_harabasz(points, feat, label)))


# --- K2 / K6 -------------------------------------------------------------------------------------

def fit_kmeans(features: DataFrame, k: int, seed: int = SEED, n_init: int = N_INIT) -> Model:
    """The best model for one k, the same as the sweep's."""
    pts = points(features)
    models, _ = fit_many(pts, [k], range(seed, seed + n_init))
    pts.unpersist()
    return best_by_k(models)[k]


@dataclass
class Sweep:
    table: DataFrame        # k, inertia, silhouette, silhouette_sq, davies_bouldin, calinski_harabasz
    best_k: int
    models: dict[int, Model]
    passes: int             # over the points, for all models


def k_sweep(features: DataFrame, k_values=K_RANGE, seed: int = SEED, n_init: int = N_INIT,
            parallel: int = 16) -> Sweep:
    """K2: for each k the best-of-n_init model, its inertia and the indices;
    best k = first maximum of the Euclidean silhouette, ties -> smaller k. All
    models are fitted in shared passes (``kmeans``), and all silhouettes come
    from one table of distances (``silhouette``)."""
    spark = features.sparkSession
    pts = points(features)
    ks = list(k_values)
    fitted, passes = fit_many(pts, ks, range(seed, seed + n_init))
    pts.unpersist()
    models = best_by_k(fitted)
    labelled = features.select("features")
    for k in ks:
        labelled = models[k].transform(labelled, out=f"p{k}")
    labelled = labelled.persist()

    def score(k):
        idx = cluster_indices(labelled, label=f"p{k}").first()
        return float(idx["silhouette_sq"]), float(idx["davies_bouldin"]), float(idx["calinski_harabasz"])

    with ThreadPoolExecutor(max_workers=parallel) as ex:
        rest = ex.map(score, ks)
        euclidean = {r["labelling"]: r["silhouette"] for r in silhouettes(labelled, [f"p{k}" for k in ks]).collect()}
        rows = [(k, models[k].cost, euclidean[f"p{k}"], *x) for k, x in zip(ks, rest, strict=True)]
    labelled.unpersist()
    best = max(rows, key=lambda r: (r[2] if r[2] is not None else -2.0, -r[0]))[0]
    table = spark.createDataFrame(rows, "k int, inertia double, silhouette double, silhouette_sq double, davies_bouldin double, "
                                        "calinski_harabasz double")
    return Sweep(table, best, models, passes)


def relabel_by_size(pred: DataFrame, label: str = "prediction", out: str = "user_cluster") -> DataFrame:
    """K6: cluster ids ordered by size descending (ties: original id) so that
    labels do not depend on k-means initialisation order. k rows broadcast."""
    sizes = pred.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    from pyspark.sql import Window
    ranked = sizes.select(label, (F.row_number().over(Window.orderBy(F.desc("_n"), label)) - 1).alias(out))
    return pred.join(F.broadcast(ranked), label).drop(label)


def pca_2d(features: DataFrame, k: int = 2) -> tuple[DataFrame, list[float]]:
    """Project scaled features on the first k principal components
    (features are already centred by the scaling). Returns projections and
    the explained variance ratios (d x d covariance on the driver, d small)."""
    model = PCA(k=k, inputCol="features", outputCol="pca").fit(features)
    proj = model.transform(features).select("*", vector_to_array("pca").alias("pca_xy"))
    return proj, [float(v) for v in model.explainedVariance]
