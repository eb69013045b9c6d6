"""SimHash near-dedup with a tiled exact comparison.

Fingerprints: in Arrow batches, the hashes of a text's word shingles vote on 64 bits. Equal fingerprints are one node,
so copies collapse in a map-side combined aggregation before anything is compared.

Comparison: nodes are put in tiles by the population counts of the fingerprint's four 16-bit parts. Fingerprints within
``radius`` bits have population counts that differ, summed over the parts, by at most ``radius``; tile pairs beyond that
are never formed. A cell with many nodes is cut into tiles of about ``TILE``. Each remaining tile pair is one row of
an equi-join on the cell and a salt (of which a cell has one for every ``SHARE`` tiles), compared by numpy exclusive-or and bit counts, every fingerprint with every other. Of the
links found in a tile pair only a spanning forest goes on (at most as many rows as the two tiles have nodes), which
keeps the components and never writes out all pairs of a group.

A null text is empty; a text without words has fingerprint zero and is linked like any other. Rows with equal ids share
a fate; a null id is never the smallest of a component unless all of its ids are null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemine.llm import common
from tastemine.llm.components import components
from tastemine.session import checkpoint

SHINGLE = 3
RADIUS = 3
SEED = 42
TILE = 512
PARTS = 4
#: tiles of a cell that share a key of the join
SHARE = 16
_BITS = 64 // PARTS

#: spread[v] has bit k of the byte v in its k-th byte, so adding up to 255 of them counts eight bits at once
_SPREAD = sum(((np.arange(256, dtype=np.uint64) >> np.uint64(k)) & np.uint64(1)) << np.uint64(8 * k) for k in range(8)).astype(np.uint64)
_RUN = 255
_AT_ONCE = 50_000


def _add_votes(votes: np.ndarray, rows: list[int], sizes: list[int], hashes: list[int]) -> None:
    """Add the set bits of ``hashes`` (``sizes[i]`` of them belong to ``rows[i]``) to ``votes``."""
    spread = _SPREAD[np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)]
    starts, owners, at = [], [], 0
    for row, n in zip(rows, sizes, strict=True):
        cut = range(at, at + n, _RUN)
        starts.extend(cut)
        owners.extend(repeat(row, len(cut)))
        at += n
    lanes = np.add.reduceat(spread, np.array(starts), axis=0).astype("<u8").view(np.uint8).reshape(len(starts), 64)
    np.add.at(votes, np.array(owners), lanes.astype(np.int64))


def fingerprint_batch(texts: Iterable[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprints of UTF-8 texts."""
    from xxhash import xxh64_intdigest

    texts = list(texts)
    votes, total = np.zeros((len(texts), 64), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    rows: list[int] = []
    sizes: list[int] = []
    hashes: list[int] = []
    for row, text in enumerate(texts):
        own = text.lower().split()  # of bytes: A-Z, and the six ASCII white-space characters
        if not own:
            continue
        grams = map(b" ".join, zip(*[own[k:] for k in range(shingle)], strict=False)) if len(own) >= shingle else [b" ".join(own)]
        found = list(map(xxh64_intdigest, grams, repeat(SEED)))
        total[row] = len(found)
        for at in range(0, len(found), _AT_ONCE):
            some = found[at : at + _AT_ONCE]
            rows.append(row)
            sizes.append(len(some))
            hashes.extend(some)
            if len(hashes) >= _AT_ONCE:
                _add_votes(votes, rows, sizes, hashes)
                rows, sizes, hashes = [], [], []
    if hashes:
        _add_votes(votes, rows, sizes, hashes)
    return np.packbits(2 * votes > total[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(_id, _fp): the fingerprint of each row as a signed 64-bit number."""
    schema = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_fp", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = fingerprint_batch(some.column(1).to_pylist(), shingle)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(found.view(np.int64))], names=["_id", "_fp"])

    return common.packed(docs, False, _id=F.col(f"`{id_col}`"), _t=common.text_of(text_col).cast("binary")).mapInArrow(run, schema)


def _forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links between tiles ``a`` and ``b`` (None: within ``a``)."""
    near = np.bitwise_count(a[:, None] ^ (a if b is None else b)[None, :]) <= radius
    i, j = np.nonzero(np.triu(near, 1) if b is None else near)
    if b is None:
        nodes = a
    else:
        nodes, j = np.concatenate([a, b]), j + len(a)
    if len(i) < len(nodes):
        return nodes[i], nodes[j]
    label = nodes.view(np.int64).copy()
    while True:
        before = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        if (label == before).all():
            break
    moved = label != nodes.view(np.int64)
    return nodes[moved], label[moved].view(np.uint64)


def _compare(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = batch.column(0), batch.column(1)
            (x, xo), (y, yo) = [(np.asarray(c.values).view(np.uint64), np.asarray(c.offsets)) for c in (own, other)]
            same = batch.column(2).to_pylist()
            u, v = [], []
            for k in range(batch.num_rows):
                a, b = x[xo[k] : xo[k + 1]], y[yo[k] : yo[k + 1]]
                p, q = _forest(a, None if same[k] else b, radius)
                if len(p):
                    u.append(p)
                    v.append(q)
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in (u, v)], names=["u", "v"])

    return run


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): links between distinct fingerprints ``_fp`` that hold together what is within ``radius`` bits."""
    part = lambda k: F.bit_count(F.shiftrightunsigned("_fp", k * _BITS).bitwiseAND(F.lit((1 << _BITS) - 1)))
    counts = [f"_p{k}" for k in range(PARTS)]
    cells = nodes.select("_fp", *[part(k).cast("int").alias(c) for k, c in enumerate(counts)])
    # one row per cell: at most 17 ** 4, whatever the number of documents
    sizes = cells.groupBy(*counts).agg(F.ceil(F.count(F.lit(1)) / F.lit(TILE)).cast("int").alias("_tiles"))
    tiles = cells.join(F.broadcast(sizes), counts).withColumn("_tile", F.pmod(F.xxhash64("_fp"), F.col("_tiles")))
    tiles = checkpoint(tiles.groupBy(*counts, "_tile").agg(F.collect_list("_fp").alias("_own")))  # about TILE each
    zero = (0,) * PARTS
    steps = [d for d in product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, d)) <= radius and d >= zero]

    def moved(d: tuple[int, ...]) -> Column:
        return F.struct(*[(F.col(c) + F.lit(x)).alias(f"_q{k}") for k, (c, x) in enumerate(zip(counts, d, strict=True))], F.lit(d == zero).alias("_zero"))

    salts = F.ceil(F.col("_tiles") / SHARE).cast("int")
    targets = sizes.select(*[F.col(c).alias(f"_q{k}") for k, c in enumerate(counts)], salts.alias("_salts"))
    inside = lambda s: F.forall(F.array(*[s[f"_q{k}"] for k in range(PARTS)]), lambda q: (q >= 0) & (q <= _BITS))
    other = tiles.select(F.col("_own").alias("_other"), F.col("_tile").alias("_tile2"), F.explode(F.filter(F.array(*[moved(d) for d in steps]), inside)).alias("_to"))
    # a full cell's tiles are dealt out over salts, and what they meet is repeated for each
    other = other.select("_other", "_tile2", "_to.*").join(F.broadcast(targets), [f"_q{k}" for k in range(PARTS)])
    other = other.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    own = tiles.join(F.broadcast(sizes), counts).withColumn("_salt", (F.col("_tile") % salts).cast("int"))
    met = [F.col(c) == F.col(f"_q{k}") for k, c in enumerate(counts)] + [F.col("_salt") == F.col("_copy")]
    pairs = own.join(other, met).where(~F.col("_zero") | (F.col("_tile") <= F.col("_tile2")))
    pairs = pairs.select("_own", "_other", (F.col("_zero") & (F.col("_tile") == F.col("_tile2"))).alias("_same"))
    return pairs.mapInArrow(_compare(radius), "u bigint, v bigint")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hexadecimal digits), ``component_id``."""
    found = checkpoint(fingerprints(docs, id_col, text_col, shingle))
    nodes = checkpoint(found.groupBy("_fp").agg(F.min("_id").alias("_least")), few=True)
    roots = components(links(nodes, radius))
    rooted = nodes.join(roots, F.col("_fp") == F.col("node"), "left").select("_fp", "_least", F.coalesce("root", "_fp").alias("_root"))
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    classes = checkpoint(rooted.select("_fp", "_root").join(least, "_root").select(F.col("_fp").alias("_f"), "component_id"), few=True)
    out = found.join(classes, F.col("_fp") == F.col("_f"))
    return out.select(F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents with the smallest id of their component, as they are."""
    gone = near_dedup(docs, id_col).where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, F.col(f"`{id_col}`") == F.col("_gone"), "left_anti")


def query(spark, sf_dir):
    """op6: fingerprints and components of all documents."""
    return near_dedup(common.documents(spark, sf_dir))
