"""Embedding whitening by spectrum slicing.

Vectors become whole numbers first (``floor(SCALE * c) + SHIFT``), so counts, per-dimension sums and deviations are
exact. Three passes of partial sums in Arrow batches fit the transform: count and sums, the centred covariance, and,
over the whitened vectors, how far their covariance is from the identity. What reaches the driver is one square matrix
of the dimension, however many vectors there are.

Leading eigenpairs of the covariance V are found one after another on that matrix. The number of negative pivots of an
LDLᵀ factorization of V - sI is the number of eigenvalues below s (Sylvester's law of inertia); bisecting s on these
counts isolates the k-th largest eigenvalue in an interval that holds no other, or shows that several agree to rounding.
Inverse iteration from inside the interval, then Rayleigh quotient iteration (cubic convergence) give the pair. A pair
is accepted only inside its interval, and counts on both sides of it certify its number; otherwise the interval is cut
further. Vectors of a cluster that counts cannot part are made orthogonal to each other.

Null vectors and vectors with null or non-finite entries are dropped; so are those whose length is not the table's
dimension (the most frequent length, of equals the longest), as they lack entries. Repeated rows count and come back
as often as they occur; null ids are kept. Where V has fewer than ``components`` eigenvalues above rounding there are
as many components as that, so constant vectors or a single row give none. An empty table gives no rows. Entries beyond
the range of a long saturate; a deviation beyond it is null. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemine.session import checkpoint

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
_LONG = 2**63 - 1
#: eigenvalues below this share of the trace, times the dimension, are rounding
_ROUNDING = 4 * np.finfo(float).eps
#: rows of a batch worked on at once
_AT_ONCE = 2048


# --- eigenpairs of one small symmetric matrix


def inertia(a: np.ndarray, shift: float) -> int:
    """Eigenvalues of symmetric ``a`` below ``shift``: negative pivots of LDLᵀ with symmetric 1x1 and 2x2 pivoting."""
    m = a - shift * np.eye(len(a))
    tiny = np.finfo(float).eps * max(1e-300, np.abs(a).max(), abs(shift))
    alpha = (1 + 17**0.5) / 8
    negative = 0
    while n := len(m):
        column = np.abs(m[1:, 0])
        most = column.max(initial=0.0)
        two = False
        if max(abs(m[0, 0]), most) > tiny and abs(m[0, 0]) < alpha * most:
            r = 1 + int(column.argmax())
            beside = np.abs(m[r]).copy()
            beside[r] = 0
            if abs(m[0, 0]) * beside.max() >= alpha * most * most:
                pass
            elif abs(m[r, r]) >= alpha * beside.max():
                swap = np.arange(n)
                swap[[0, r]] = r, 0
                m = m[np.ix_(swap, swap)]
            else:
                swap = np.arange(n)
                swap[[1, r]] = r, 1
                m = m[np.ix_(swap, swap)]
                two = True
        if two:  # such a block has one eigenvalue of either sign
            negative += 1
            block, rest = m[:2, :2], m[2:, :2]
            m = m[2:, 2:] - rest @ np.linalg.solve(block, rest.T)
        else:
            pivot = m[0, 0] if abs(m[0, 0]) > tiny else -tiny
            negative += pivot < 0
            m = m[1:, 1:] - np.outer(m[1:, 0], m[1:, 0] / pivot)
        m = (m + m.T) / 2
    return int(negative)


def _solve(a: np.ndarray, shift: float, v: np.ndarray, nudge: float) -> np.ndarray:
    """(a - shift I)^-1 v, of unit length; a singular system is moved by rounding."""
    for k in range(4):
        try:
            x = np.linalg.solve(a - (shift + k * nudge) * np.eye(len(a)), v)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(x).all() and (size := np.linalg.norm(x)) > 0:
            return x / size
    return v


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues above rounding, falling, and their unit eigenvectors as columns."""
    d = len(a)
    size = float(np.abs(a).sum(axis=1).max(initial=0.0))  # Gershgorin: no eigenvalue is larger
    if not size:
        return np.zeros(0), np.zeros((d, 0))
    rounding = _ROUNDING * d * max(float(np.trace(a)), 0.0)
    tell = 8 * np.finfo(float).eps * size  # counts cannot part eigenvalues closer than this
    known: dict[float, int] = {}

    def above(s: float) -> int:
        """Eigenvalues of at least ``s``."""
        if s not in known:
            known[s] = d - inertia(a, s)
        return known[s]

    values: list[float] = []
    found = np.zeros((d, 0))
    top = size * (1 + 1e-9) + tell
    known[top] = 0
    while len(values) < min(k, d):
        number = len(values) + 1
        # lo: at least `number` eigenvalues above; hi: fewer
        hi = min(s for s, n in known.items() if n < number)
        lo = max((s for s, n in known.items() if n >= number), default=-top)
        known.setdefault(-top, d)
        while hi - lo > tell and not (known[lo] == number and known[hi] == number - 1 and hi - lo < 1e-2 * max(abs(lo), abs(hi))):
            mid = (lo + hi) / 2
            if above(mid) >= number:
                lo = mid
            else:
                hi = mid
        if hi <= rounding:
            break
        while True:
            cluster = known[lo] - known[hi]  # eigenvalues in between, one unless they agree to rounding
            got = _pairs(a, lo, hi, found, cluster, tell)
            if got is not None or hi - lo <= tell:
                break
            mid = (lo + hi) / 2
            if above(mid) >= number:
                lo = mid
            else:
                hi = mid
        if got is None:
            raise ArithmeticError(f"no eigenvector for the eigenvalue in [{lo}, {hi}]")
        for value, vector in got:
            values.append(value)
            found = np.column_stack([found, vector])
    order = np.argsort(-np.array(values), kind="stable")[:k]
    order = [i for i in order if values[i] > rounding]
    return np.array(values)[order], found[:, order]


def _pairs(a: np.ndarray, lo: float, hi: float, found: np.ndarray, cluster: int, tell: float) -> list[tuple[float, np.ndarray]] | None:
    """All eigenpairs in [lo, hi], or None if the iteration left the interval."""
    rng = np.random.default_rng(len(a))  # a fixed start: reruns agree
    out: list[tuple[float, np.ndarray]] = []
    basis = found
    for _ in range(cluster):
        free = lambda v: v - basis @ (basis.T @ v)  # noqa: E731, B023
        v = free(free(rng.standard_normal(len(a))))
        v /= np.linalg.norm(v)
        for _ in range(3):
            v = free(_solve(a, (lo + hi) / 2, v, tell))
            v /= np.linalg.norm(v)
        for _ in range(12):
            rho = float(v @ a @ v)
            rest = np.linalg.norm(a @ v - rho * v)
            if rest <= tell / 8:
                break
            if cluster > 1:  # quotients of a cluster agree: the shift stays
                rho = (lo + hi) / 2
            new = free(_solve(a, rho, v, tell))
            new /= np.linalg.norm(new)
            if np.linalg.norm(a @ new - (new @ a @ new) * new) >= rest:
                break
            v = new
        value = float(v @ a @ v)
        if not lo - tell <= value <= hi + tell or np.linalg.norm(a @ v - value * v) > 64 * tell:
            return None
        out.append((value, v))
        basis = np.column_stack([basis, v])
    return out


# --- passes over the vectors


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, d)


def _partials(df: DataFrame, d: int, make, names: str, zero) -> DataFrame:
    """One partial sum per partition: ``make(state, x, rest)`` adds a batch, rows come from the final state."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, any_rows = zero(), False
        for batch in batches:
            for at in range(0, batch.num_rows, _AT_ONCE):
                some = batch.slice(at, _AT_ONCE)
                any_rows = True
                make(state, _matrix(some.column(0), d))
        if any_rows:
            flat = state.reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["_at", "_v"])

    return df.mapInArrow(run, f"_at bigint, _v {names}").groupBy("_at").agg(F.sum("_v").alias("_v"))


def _summed(df: DataFrame, size: int, dtype) -> np.ndarray:
    """The sums of ``_partials``: ``size`` numbers, a function of the dimension alone."""
    out = np.zeros(size, dtype=dtype)
    for r in df.collect():
        out[r["_at"]] = r["_v"]
    return out


def whole_numbers(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(_id, _x array of longs) of the vectors that remain, and their dimension."""
    c = F.col(f"`{vector_col}`").cast("array<double>")
    fine = ~F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), c.alias("_c")).where(F.col("_c").isNotNull()).where(fine)
    sizes = rows.groupBy(F.size("_c").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    first = sizes.orderBy(F.col("_n").desc(), F.col("_d").desc()).first()
    d = first["_d"] if first else 0
    # floor() saturates at the range of a long; the shift stays inside it
    most = float(_LONG // 4)
    x = F.transform("_c", lambda e: F.floor(F.least(F.greatest(e * SCALE, F.lit(-most)), F.lit(most))) + F.lit(SHIFT).cast("bigint"))
    return rows.where(F.size("_c") == d).select("_id", x.alias("_x")), d


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sums over the dimensions of (n x - S)^2, exact; null beyond a long."""
    d = len(sums)
    most = max(int(x.max(initial=0)), -int(x.min(initial=0))) * n + int(np.abs(sums).max())
    if most * most * d <= _LONG:
        return pa.array(((n * x - sums) ** 2).sum(axis=1), pa.int64())
    off = x * float(n) - sums.astype(float)  # a bound on the true offsets, generous by rounding
    bound = int(np.abs(off).max(initial=0) * 1.001) + int(most * 1e-12) + 2
    if bound * bound * d <= _LONG and most <= _LONG:
        return pa.array(((n * x - sums) ** 2).sum(axis=1), pa.int64())
    own = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return pa.array([v if v <= _LONG else None for v in own], pa.int64())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, dict]:
    """(id, ``n``, ``deviation``, ``whitened`` array of doubles) per vector, and the fit: ``n``, ``mean``, ``values``,
    ``vectors`` (columns), ``explained``, ``identity_error``."""
    x, d = whole_numbers(df, id_col, vector_col)
    x = checkpoint(x)

    # count and sums, exact (Spark refuses a sum beyond a long)
    def add_sums(state, m):
        state[0] += len(m)
        state[1:] += m.sum(axis=0)

    n, *sums = _summed(_partials(x.select("_x"), d, add_sums, "bigint", lambda: np.zeros(d + 1, np.int64)), d + 1, np.int64).tolist() if d else [0]
    sums = np.array(sums, dtype=np.int64)
    mean = sums / max(n, 1)

    def gram(mean):
        def add(state, m):
            c = m - mean
            state += c.T @ c

        return add

    cov = np.zeros((d, d))
    if n:
        cov = _summed(_partials(x.select("_x"), d, gram(mean), "double", lambda: np.zeros((d, d))), d * d, float).reshape(d, d) / n
    values, vectors = leading_eigenpairs((cov + cov.T) / 2, components)
    trace = float(np.trace(cov))
    project = vectors / np.sqrt(values)
    k = len(values)

    schema = T.StructType([T.StructField("_id", df.schema[id_col].dataType), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _AT_ONCE):
                some = batch.slice(at, _AT_ONCE)
                m = _matrix(some.column(1), d)
                w = (m - mean) @ project
                offsets = pa.array(np.arange(len(m) + 1, dtype=np.int32) * k)
                white = pa.ListArray.from_arrays(offsets, pa.array(w.reshape(-1)))
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(np.full(len(m), n)), _deviations(m, n, sums), white], names=schema.names)

    out = x.mapInArrow(run, schema) if k else df.sparkSession.createDataFrame([], schema)
    error = None
    if k:
        out = checkpoint(out)

        def add_mean(state, m):
            state += m.sum(axis=0)

        center = _summed(_partials(out.select("whitened"), k, add_mean, "double", lambda: np.zeros(k)), k, float) / n
        own = _summed(_partials(out.select("whitened"), k, gram(center), "double", lambda: np.zeros((k, k))), k * k, float).reshape(k, k) / n
        error = float(np.abs(own - np.eye(k)).max())
    fit = {"n": n, "mean": mean, "values": values, "vectors": vectors, "explained": values / trace if trace else values, "identity_error": error}
    return out.select(F.col("_id").alias(id_col), "n", "deviation", "whitened"), fit


def by_component(white: DataFrame, fit: dict, id_col: str = "vec_id") -> DataFrame:
    """One row per vector and component, numbered from 1."""
    explained = F.array(*[F.lit(float(e)) for e in fit["explained"]]).cast("array<double>")
    rows = white.select(id_col, "n", "deviation", F.posexplode("whitened").alias("_k", "whitened"))
    return rows.select(
        id_col, (F.col("_k") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.element_at(explained, F.col("_k") + 1).alias("explained"),
        F.lit(fit["identity_error"]).cast("double").alias("identity_error"),
    )


def query(spark, sf_dir):
    """op11: the whitened embeddings."""
    white, fit = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return by_component(white, fit)
