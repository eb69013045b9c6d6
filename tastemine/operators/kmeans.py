"""K-means for many (k, seed) at once (K2): all models advance together, one pass over the points per step.

Points are cut once into blocks (a matrix each) that stay cached. A pass assigns every point to its nearest center in
every model that is still moving, in one Arrow function, and adds up count, vector sum and cost per cluster; partial sums
of a model meet in one group of numbers whose size depends on k and the dimension alone. A model that has converged takes
part once more, for the cost of its final centers, and drops out; so the passes are those of the longest run, not of all
runs.

Starts are drawn by squared distance (k-means++). The draw is a race: a point's key is an exponential variate, a function
of its id, seed and step, over its squared distance to the centers so far, and the least key wins, so a draw is a minimum
and needs no cumulative sums. The centers drawn for a seed serve all k: a run for k starts from the first k of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemine.session import partitions_for

# scikit-learn's defaults (the reference): run to convergence
MAX_ITER = 300
TOL = 1e-4
#: points of a partition, and of a block
PARTITION = 16_384
BLOCK = 4096


@dataclass
class Model:
    k: int
    seed: int
    start: np.ndarray
    centers: np.ndarray
    cost: float = float("nan")
    iterations: int = 0

    def transform(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        """``df`` with the number of the nearest center, the first of equally near ones, as a JVM expression."""
        x = vector_to_array(features)
        centers = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in self.centers])

        def away(c: Column) -> Column:
            return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)

        d = F.transform(centers, away)
        return df.withColumn("_away", d).withColumn(out, (F.array_position("_away", F.array_min("_away")) - 1).cast("int")).drop("_away")


@dataclass
class Points:
    """Cached blocks of points: ``ids`` (a hash of the first column) and ``data``, both binary."""

    blocks: DataFrame
    dim: int
    mean_variance: float

    def unpersist(self) -> None:
        self.blocks.unpersist()


def points(features: DataFrame, col: str = "features") -> Points:
    """``features``: an id and a vector. Blocks depend on the data alone, not on the number of cores."""
    key = features.columns[0]
    rows = features.select(F.xxhash64(key).alias("_id"), vector_to_array(col).alias("_x"))
    rows = rows.repartition(partitions_for(rows.count(), PARTITION), "_id").sortWithinPartitions("_id", "_x")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                data = np.asarray(some.column(1).flatten(), dtype=float)
                yield pa.RecordBatch.from_arrays([pa.array([np.asarray(some.column(0)).tobytes()], pa.binary()), pa.array([data.tobytes()], pa.binary())], names=["ids", "data"])

    blocks = rows.mapInArrow(run, "ids binary, data binary").persist()
    stats = features.agg(Summarizer.metrics("mean", "variance", "count").summary(F.col(col)).alias("s")).select("s.*").first()
    n = stats["count"]
    dim = len(stats["mean"]) if n else 0
    return Points(blocks, dim, float(np.mean(stats["variance"].toArray())) * (n - 1) / n if n > 1 else 0.0)


def _blocks(batches: Iterable[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for ids, data in zip(batch.column(0), batch.column(1), strict=True):
            yield np.frombuffer(ids.as_buffer(), dtype=np.uint64), np.frombuffer(data.as_buffer(), dtype=float).reshape(-1, dim)


def _away(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of points to centers."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(axis=1), 0)


def _exponential(ids: np.ndarray, seed: int, step: int) -> np.ndarray:
    """Exponential variates, a function of id, seed and step."""
    x = ids + np.uint64((seed * 0x9E3779B97F4A7C15 + step * 0xD1B54A32D192ED03) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return -np.log((x >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54)


def starts(pts: Points, k: int, seeds: list[int]) -> dict[int, np.ndarray]:
    """``k`` centers for each seed, a pass per center for all seeds. Points that are centers already have no weight; if
    all have none, the last center is repeated."""
    dim = pts.dim
    found: dict[int, list[np.ndarray]] = {s: [] for s in seeds}
    for step in range(k):
        so_far = {s: np.array(c) for s, c in found.items()}

        def run(batches, step=step, so_far=so_far) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple[float, list[float]]] = {}
            for ids, x in _blocks(batches, dim):
                for seed, centers in so_far.items():
                    weight = _away(x, centers).min(axis=1) if len(centers) else np.ones(len(x))
                    if len(centers):  # a center itself, whatever the rounding
                        weight[(x[:, None] == centers[None]).all(axis=2).any(axis=1)] = 0
                    key = np.divide(_exponential(ids, seed, step), weight, out=np.full(len(x), np.inf), where=weight > 0)
                    at = int(key.argmin())
                    if np.isfinite(key[at]) and (seed not in best or key[at] < best[seed][0]):
                        best[seed] = float(key[at]), x[at].tolist()
            if best:
                yield pa.RecordBatch.from_arrays([pa.array(list(best)), pa.array([b[0] for b in best.values()]), pa.array([b[1] for b in best.values()])], names=["seed", "key", "x"])

        won = pts.blocks.mapInArrow(run, "seed bigint, key double, x array<double>").groupBy("seed").agg(F.min(F.struct("key", "x")).alias("b")).collect()
        new = {r["seed"]: np.array(r["b"]["x"]) for r in won}
        for s in seeds:
            found[s].append(new[s] if s in new else found[s][-1])
    return {s: np.array(c) for s, c in found.items()}


def _pass(pts: Points, centers: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per model: k rows of count, vector sum and cost of its clusters."""
    dim = pts.dim

    def run(batches) -> Iterator[pa.RecordBatch]:
        sums = {m: np.zeros((len(c), dim + 2)) for m, c in centers.items()}
        stack = np.concatenate(list(centers.values()))
        any_rows = False
        for _, x in _blocks(batches, dim):
            any_rows = True
            away, at = _away(x, stack), 0
            ones = np.column_stack([np.ones(len(x)), x])
            for m, c in centers.items():
                own = away[:, at : at + len(c)]
                at += len(c)
                label = own.argmin(axis=1)
                member = (label[:, None] == np.arange(len(c))).astype(float)
                sums[m][:, :-1] += member.T @ ones
                sums[m][:, -1] += member.T @ own[np.arange(len(x)), label]
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([s.ravel() for s in sums.values()])], names=["model", "sums"])

    partial = pts.blocks.mapInArrow(run, "model bigint, sums array<double>")
    rows = partial.groupBy("model").agg(Summarizer.sum(array_to_vector("sums")).alias("s")).collect()  # a few numbers a model
    return {r["model"]: r["s"].toArray().reshape(len(centers[r["model"]]), -1) for r in rows}


def advance(pts: Points, models: list[Model], max_iter: int = MAX_ITER, tol: float = TOL) -> int:
    """Run all ``models`` from their centers to convergence: until the centers together move by at most ``tol`` times the
    mean variance (squared). A center without points stays. Returns the number of passes."""
    moving, closing, passes = dict(enumerate(models)), {}, 0
    while moving or closing:
        sums = _pass(pts, {i: m.centers for i, m in (moving | closing).items()})
        passes += 1
        for i, m in closing.items():
            m.cost = float(sums[i][:, -1].sum())
        closing = {}
        for i, m in list(moving.items()):
            n = sums[i][:, :1]
            new = np.where(n > 0, sums[i][:, 1:-1] / np.maximum(n, 1), m.centers)
            shift = float(((new - m.centers) ** 2).sum())
            m.centers, m.iterations = new, m.iterations + 1
            if shift <= tol * pts.mean_variance or m.iterations >= max_iter:
                closing[i] = moving.pop(i)
    return passes


def fit_many(pts: Points, k_values, seeds) -> tuple[list[Model], int]:
    """A model for each (k, seed), and the number of passes over the points."""
    ks, seeds = list(k_values), list(seeds)
    drawn = starts(pts, max(ks), seeds)
    models = [Model(k, s, drawn[s][:k], drawn[s][:k].copy()) for k in ks for s in seeds]
    return models, max(ks) + advance(pts, models)


def best_by_k(models: list[Model]) -> dict[int, Model]:
    """For each k the model of least cost, the first of equals."""
    best: dict[int, Model] = {}
    for m in models:
        if m.k not in best or m.cost < best[m.k].cost:
            best[m.k] = m
    return best
