"""Truncated SVD of a sparse matrix over routed blocks.

The cells are cut twice, once by blocks of ``BLOCK`` users and once by blocks of ``BLOCK`` items, and stay there for all
passes: both cuts are kept partitioned, so no pass moves a cell. A block with more than ``PART_CELLS`` cells (a hot user
or item) is cut further by the other side, and its parts' sums are added.

What moves are factor rows. A routing table says, for each block, which of its rows each block of the other side has
cells for. A pass ships a row once to every block that needs it; a block multiplies its cells with what it got into one
partial matrix; the parts of a block are added, and the sum is cut by the routing table again for the way back. So a
pass shuffles (rows x blocks that need them) rows of as many numbers as the sketch is wide, however many cells there are.

The algorithm is the randomized one of Halko, Martinsson and Tropp: a Gaussian test matrix that depends on an item's
position alone, power iterations, and the small problem on the driver. Matrices as wide as the sketch are all that
reaches the driver; orthogonalising is a product with such a matrix, done where the rows arrive next.

Where a half pass would send more than ``PASS_BYTES``, it is made in up to ``ROUNDS`` rounds, each for a share of the receiving
blocks, whose shuffles are released before the next; the rows of both sides are then stored in turn, and what is superseded goes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemine.session import checkpoint, held, release, scratch

BLOCK = 2048
PART_CELLS = 1 << 17
#: cells multiplied at once
_AT_ONCE = 1 << 16
#: bytes that a half pass sends at once, and rounds at most, as each reads all of the sending side's rows
PASS_BYTES = 1 << 30
ROUNDS = 8
#: a block's rows as they are sent to a part of a block of the other side, and whole with their Gram matrix
_PIECE = "to bigint, part int, src bigint, rows binary, data binary"
_WHOLE = "block bigint, rows binary, data binary, gram array<double>"


@dataclass
class Side:
    """One side of the matrix: its cells by (block, part), and where its rows are needed."""

    cells: DataFrame  # block, part, row (in the block) / col (on the other side) / rating: arrays in order of row, col
    routes: DataFrame  # block, to, part, rows (in the block, an array)
    remove: Callable[[], None] = lambda: None

    def unpersist(self) -> None:
        self.remove()

    def receiving(self, i: int, rounds: int) -> "Side":
        """The blocks of a round of ``rounds``, as receivers."""
        return self if rounds == 1 else Side(self.cells.where(F.pmod("block", F.lit(rounds)) == i), self.routes)

    def sending(self, i: int, rounds: int) -> "Side":
        """This side with its routes to the other's blocks of a round."""
        return self if rounds == 1 else Side(self.cells, self.routes.where(F.pmod("to", F.lit(rounds)) == i))


def _parted(cells: DataFrame, own: str, other: str) -> DataFrame:
    """(block, part, row, col, rating): each cell with its block and part on the side of ``own``."""
    cut = cells.select(F.floor(F.col(own) / BLOCK).cast("bigint").alias("block"), F.col(own).alias("row"), F.col(other).alias("col"), "rating")
    parts = cut.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / PART_CELLS).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("col"), F.col("_parts")).cast("int")
    return cut.join(parts, "block").select("block", part.alias("part"), "row", "col", "rating")


def sides(cells: DataFrame, partitions: int) -> tuple[Side, Side]:
    """Both sides of ``cells`` (u_row, i_col, rating), kept partitioned by block: as checkpoints, since a cached table
    would keep the shuffles that it was made by."""
    spark = cells.sparkSession
    cuts, drops = zip(*[scratch(_parted(cells, own, other)) for own, other in (("u_row", "i_col"), ("i_col", "u_row"))], strict=True)

    def side(mine: DataFrame, theirs: DataFrame) -> Side:
        blocks = mine.groupBy("block", "part").agg(F.array_sort(F.collect_list(F.struct((F.col("row") % BLOCK).cast("int").alias("row"), "col", "rating"))).alias("c"))
        blocks = blocks.select("block", "part", *[F.col(f"c.{x}").alias(x) for x in ("row", "col", "rating")])
        kept, drop = held(blocks.repartition(partitions, "block", "part"))
        release(spark)
        need = theirs.select(F.floor(F.col("col") / BLOCK).cast("bigint").alias("block"), F.col("block").alias("to"), "part", (F.col("col") % BLOCK).cast("int").alias("row"))
        routes = need.distinct().groupBy("block", "to", "part").agg(F.array_sort(F.collect_list("row")).alias("rows"))
        routes, drop_routes = held(routes.repartition(partitions, "block"))
        release(spark)
        return Side(kept, routes, lambda: [drop(), drop_routes()])

    both = side(*cuts), side(*cuts[::-1])
    for drop in drops:
        drop()
    return both


def _rows(x: pa.Scalar) -> np.ndarray:
    return np.frombuffer(x.as_buffer(), dtype=np.int32)


def _data(x: pa.Scalar) -> np.ndarray:
    return np.frombuffer(x.as_buffer(), dtype=np.float64)


def _sent(block: int, rows: np.ndarray, x: np.ndarray, routes: pa.Table) -> pa.Table:
    """A block's rows, cut for those that need them."""
    out: list[tuple] = []
    for to, part, needed in zip(*(routes[c].to_pylist() for c in ("to", "part")), routes["rows"].combine_chunks(), strict=True):
        which = np.asarray(needed.values, dtype=np.int32)
        out.append((to, part, block, which.tobytes(), x[np.searchsorted(rows, which)].tobytes()))
    types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.table([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types], names=["to", "part", "src", "rows", "data"])


def _test_matrix(side: Side, width: int, seed: int | None) -> DataFrame:
    """A row per position, sent along the routes of ``side``: Gaussian, or without a seed of the identity."""

    def of(position: int) -> np.ndarray:
        return np.eye(1, width, position)[0] if seed is None else np.random.default_rng((seed, position)).standard_normal(width)

    def run(routes: pa.Table) -> pa.Table:
        block = routes["block"][0].as_py()
        rows = np.unique(np.asarray(routes["rows"].combine_chunks().flatten()))
        x = np.stack([of(block * BLOCK + int(r)) for r in rows])
        return _sent(block, rows, x, routes)

    return side.routes.groupBy("block").applyInArrow(run, _PIECE)


def _multiplied(pieces: DataFrame, to: Side, m: np.ndarray | None) -> DataFrame:
    """The cells of each part of ``to`` times the rows it was sent (times ``m``): (block, part, rows, data)."""

    def run(sent: pa.Table, cells: pa.Table) -> pa.Table:
        sent = sent.sort_by("src").combine_chunks()
        ids = np.concatenate([BLOCK * src + _rows(r) for src, r in zip(sent["src"].to_pylist(), sent["rows"], strict=True)])
        x = np.concatenate([_data(d) for d in sent["data"]]).reshape(len(ids), -1)
        if m is not None:
            x = x @ m
        row, col, rating = (np.asarray(cells[c].combine_chunks().flatten()) for c in ("row", "col", "rating"))
        which, place = np.unique(row, return_inverse=True)
        at = np.searchsorted(ids, col)
        y = np.zeros((len(which), x.shape[1]))
        for lo in range(0, len(row), _AT_ONCE):  # in order of rows
            some = slice(lo, lo + _AT_ONCE)
            begin = np.flatnonzero(np.diff(place[some], prepend=-1))
            y[place[some][begin]] += np.add.reduceat(x[at[some]] * rating[some, None], begin, axis=0)
        return pa.table({"block": cells["block"].slice(0, 1), "part": cells["part"].slice(0, 1), "rows": pa.array([which.astype(np.int32).tobytes()], pa.binary()), "data": pa.array([y.tobytes()], pa.binary())})

    return pieces.groupBy("to", "part").cogroup(to.cells.groupBy("block", "part")).applyInArrow(run, "block bigint, part int, rows binary, data binary")


def _sum(parts: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a block and the sum of its parts, added up in their order."""
    parts = parts.sort_by("part").combine_chunks()
    each = [_rows(r) for r in parts["rows"]]
    rows = np.unique(np.concatenate(each))
    x = None
    for r, d in zip(each, parts["data"], strict=True):
        own_part = _data(d).reshape(len(r), -1)
        if x is None:
            x = np.zeros((len(rows), own_part.shape[1]))
        x[np.searchsorted(rows, r)] += own_part
    return rows, x


def half_pass(pieces: DataFrame, to: Side, m: np.ndarray | None = None) -> DataFrame:
    """The matrix (or its transpose) times the rows in ``pieces`` (times ``m``): each block's rows, whole."""

    def run(parts: pa.Table) -> pa.Table:
        rows, x = _sum(parts)
        own = (parts["block"][0].as_py(), rows.astype(np.int32).tobytes(), x.tobytes(), (x.T @ x).ravel())
        return pa.table([pa.array([c], t) for c, t in zip(own, (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.float64())), strict=True)], names=["block", "rows", "data", "gram"])

    return _multiplied(pieces, to, m).groupBy("block").applyInArrow(run, _WHOLE)


def half_pass_on(pieces: DataFrame, to: Side, m: np.ndarray | None = None) -> DataFrame:
    """As ``half_pass``, but the blocks' rows are sent on at once, as pieces for the way back."""

    def run(parts: pa.Table, routes: pa.Table) -> pa.Table:
        return _sent(parts["block"][0].as_py(), *_sum(parts), routes)

    return _multiplied(pieces, to, m).groupBy("block").cogroup(to.routes.groupBy("block")).applyInArrow(run, _PIECE)


def routed(whole: DataFrame, side: Side) -> DataFrame:
    """Blocks' rows as pieces along the routes of their ``side``. They are many times the rows, so they are made from
    the rows for each pass and never stored."""

    def run(own: pa.Table, routes: pa.Table) -> pa.Table:
        rows = _rows(own["rows"][0])
        return _sent(own["block"][0].as_py(), rows, _data(own["data"][0]).reshape(len(rows), -1), routes)

    given = whole.select("block", "rows", "data")
    return given.groupBy("block").cogroup(side.routes.groupBy("block")).applyInArrow(run, _PIECE)


def _gram(whole: DataFrame) -> np.ndarray:
    """XᵀX of the blocks' own rows, added up in the JVM."""
    g = whole.agg(Summarizer.sum(array_to_vector("gram")).alias("g")).first()["g"].toArray()
    n = round(len(g) ** 0.5)
    return g.reshape(n, n)


def _gram_of(whole: DataFrame, m: np.ndarray) -> np.ndarray:
    """(X m)ᵀ(X m) of the blocks' own rows."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, d in zip(batch.column(1), batch.column(2), strict=True):
                x = _data(d).reshape(len(_rows(r)), -1) @ m
                yield pa.RecordBatch.from_arrays([pa.array([(x.T @ x).ravel()], pa.list_(pa.float64()))], names=["gram"])

    grams = whole.select("block", "rows", "data").mapInArrow(run, "gram array<double>")
    return grams.agg(Summarizer.sum(array_to_vector("gram")).alias("g")).first()["g"].toArray().reshape(m.shape[1], m.shape[1])


def table(whole: DataFrame, m: np.ndarray, key: str) -> DataFrame:
    """(``key``, factors): the blocks' own rows times ``m``."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for src, r, d in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                rows = _rows(r)
                x = _data(d).reshape(len(rows), -1) @ m
                offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * m.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(src * BLOCK + rows.astype(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], names=[key, "factors"])

    return whole.select("block", "rows", "data").mapInArrow(run, f"{key} bigint, factors array<double>")


def whitening(g: np.ndarray) -> np.ndarray:
    """M such that X M has orthonormal columns, for g = XᵀX; directions without weight are left out."""
    w, v = np.linalg.eigh((g + g.T) / 2)
    kept = w > 1e-12 * max(w.max(), 1e-300)
    return v[:, kept] / np.sqrt(w[kept])


def _in_rounds(pieces: Callable[[int, int], DataFrame], to: Side, m: np.ndarray | None, rounds: int) -> tuple[DataFrame, Callable[[], None]]:
    """A half pass of the ``pieces`` of each round, stored: the blocks' rows, whole, and a function that removes them."""
    parts = []
    for i in range(rounds):
        parts.append(held(half_pass(pieces(i, rounds), to.receiving(i, rounds), m)))
        release(to.cells.sparkSession)
    return reduce(DataFrame.unionAll, [df for df, _ in parts]), lambda: [remove() for _, remove in parts] and None


def _rounds(sender: Side, width: int) -> int:
    """Rounds of a half pass from ``sender``, by the bytes that it sends."""
    rows = sender.routes.agg(F.sum(F.size("rows").cast("bigint"))).first()[0] or 0
    return min(ROUNDS, 1 + 8 * width * rows // PASS_BYTES)


def randomized_svd(cells: DataFrame, k: int, n_items: int, oversample: int = 10, n_iter: int = 5, seed: int = 42) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(u_row, factors of U.Sigma), (i_col, factors of V) and the singular values of ``cells`` (u_row, i_col, rating),
    whose rows and columns are numbered from 0. A sketch as wide as the matrix needs no test matrix and no iteration."""
    return factors_of(cells, k, n_items, oversample, n_iter, seed)[:3]


def factors_of(cells: DataFrame, k: int, n_items: int, oversample: int = 10, n_iter: int = 5, seed: int = 42) -> tuple:
    """``randomized_svd``, and a function that removes the stored rows that both tables are read from."""
    spark = cells.sparkSession
    users, items = sides(cells, int(spark.conf.get("spark.sql.shuffle.partitions")))
    width = min(k + oversample, n_items)
    test, m = seed if width < n_items else None, None
    there, back = _rounds(items, width), _rounds(users, width)  # to the users, and to the items
    whole, drop = None, lambda: None

    def pieces(i: int = 0, rounds: int = 1) -> DataFrame:
        sender = items.sending(i, rounds)
        return _test_matrix(sender, width, test) if whole is None else routed(whole, sender)

    for _ in range(n_iter if width < n_items else 0):
        if there == back == 1:
            whole = checkpoint(half_pass(half_pass_on(pieces(), users, m), items))
        else:
            y, drop_y = _in_rounds(pieces, users, m, there)
            drop()
            whole, drop = _in_rounds(lambda i, rounds: routed(y, users.sending(i, rounds)), items, None, back)
            drop_y()
        m = whitening(_gram(whole))
        release(spark)
    if m is not None:
        m = m @ whitening(_gram_of(whole, m))  # a second time for accuracy
    if there == back == 1:
        y = checkpoint(half_pass(pieces(), users, m))
        drop_y = lambda: None
    else:
        y, drop_y = _in_rounds(pieces, users, m, there)
        drop()
    m = whitening(_gram(y))
    m = m @ whitening(_gram_of(y, m))
    if there == back == 1:
        z = checkpoint(half_pass(routed(y, users), items, m))
        drop_z = lambda: None
    else:
        z, drop_z = _in_rounds(lambda i, rounds: routed(y, users.sending(i, rounds)), items, m, back)
    release(spark)
    users.unpersist()
    items.unpersist()
    w, v = np.linalg.eigh(_gram(z))
    kept = np.argsort(-w)[:k]
    sigma = np.sqrt(np.maximum(w[kept], 0))
    inverse = np.divide(1, sigma, out=np.zeros_like(sigma), where=sigma > 0)
    return table(y, m @ v[:, kept] * sigma, "u_row"), table(z, v[:, kept] * inverse, "i_col"), sigma, lambda: [drop_y(), drop_z()] and None
