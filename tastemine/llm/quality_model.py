"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into at most ``BINS`` bins at quantiles of the training rows. Boosting goes round the
features in cycles and gives each a shallow tree on its bins, fitted to the logistic loss; all trees of a feature add up
to one lookup table. Then the ``PAIRS`` pairs of features whose four quadrants explain most of what is left are boosted
the same way into tables over two features. A score is the sum of a document's table entries, so scoring is a search for
bins and additions on whole columns.

Spark extracts the features of every document (the only pass over the texts) and scores them; the tables are fitted on
at most ``SAMPLE`` labelled rows, those with the smallest digests of their ids, and do not grow with the data.

A null text is empty; an empty text has zero for every feature and a score like any other. Without any training rows all
scores are 0.5. Null labels are not learned from; a null id is never held out. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemine.llm import common
from tastemine.session import checkpoint

SAMPLE = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
CYCLES = 120
PAIR_CYCLES = 40
RATE = 0.15
LEAST_ROWS = 8
RIDGE = 1.0
CUT = 0.7

FEATURES = (
    "log_words", "word_length", "symbols_per_word", "upper_share", "digit_share", "stops_per_word", "shouts_per_word",
    "distinct_words", "repeated_lines", "words_per_line", "short_words", "non_ascii_share", "top_word_share",
)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_CLASSES = np.stack([_class(b"#*$%&|<>"), _class(bytes(range(65, 91))), _class(bytes(range(48, 58))), _class(b".,;:?"), _class(b"!"), _class(bytes(range(97, 123))), _class(bytes(range(128, 256)))], axis=1)


def features(text: bytes) -> list[float]:
    """The features of a UTF-8 text, in the order of ``FEATURES``."""
    own = text.split()
    if not own:
        return [0.0] * len(FEATURES)
    symbols, upper, digits, stops, shouts, lower, wide = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES
    lines = [x for x in text.split(b"\n") if x.strip()]
    n, chars = len(own), sum(map(len, own))
    counts: dict[bytes, int] = {}
    for w in own:
        counts[w] = counts.get(w, 0) + 1
    return [
        float(np.log1p(n)), chars / n, symbols / n, upper / max(1.0, upper + lower), digits / chars, stops / n, shouts / n,
        len(counts) / n, 1 - len(set(lines)) / len(lines), n / len(lines), sum(len(w) <= 3 for w in own) / n, wide / chars, max(counts.values()) / n,
    ]


@dataclass
class Model:
    """Cuts and tables; ``pairs`` are (feature, feature, cuts, cuts, table)."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            out += table[np.searchsorted(cuts, x[:, f], side="right")]
        for f, g, a, b, table in self.pairs:
            out += table[np.searchsorted(a, x[:, f], side="right"), np.searchsorted(b, x[:, g], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="higher")) if len(values) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int) -> np.ndarray:
    """A tree over bins in order: per bin the Newton step of its leaf."""
    step = np.full(len(g), g.sum() / (h.sum() + RIDGE))
    if depth and len(g) > 1:
        lg, lh, ln = (np.cumsum(a)[:-1] for a in (g, h, n))
        gain = _gain(lg, lh) + _gain(g.sum() - lg, h.sum() - lh)
        gain[(ln < LEAST_ROWS) | (n.sum() - ln < LEAST_ROWS)] = -1
        k = int(np.argmax(gain)) + 1
        if gain[k - 1] > _gain(g.sum(), h.sum()):
            step = np.concatenate([_tree(a[0], a[1], a[2], depth - 1) for a in ((g[:k], h[:k], n[:k]), (g[k:], h[k:], n[k:]))])
    return step


def _quadrants(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cut of a table of bins into four quadrants: gain, and the step per cell."""
    best, out = 0.0, np.zeros_like(g)
    sums = [np.cumsum(np.cumsum(a, 0), 1) for a in (g, h, n)]
    base = float(_gain(g.sum(), h.sum()))
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            four = []
            for s in sums:
                a, up, left, whole = s[i - 1, j - 1], s[i - 1, -1], s[-1, j - 1], s[-1, -1]
                four.append(np.array([a, up - a, left - a, whole - up - left + a]))
            if four[2].min() < LEAST_ROWS:
                continue
            gain = float(_gain(four[0], four[1]).sum()) - base
            if gain > best:
                step = four[0] / (four[1] + RIDGE)
                best, out = gain, np.block([[np.full((i, j), step[0]), np.full((i, g.shape[1] - j), step[1])], [np.full((g.shape[0] - i, j), step[2]), np.full((g.shape[0] - i, g.shape[1] - j), step[3])]])
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of single features, then of the most useful pairs."""
    width = len(FEATURES)
    if not len(y):
        return Model(0.0, [np.zeros(0)] * width, [np.zeros(1)] * width, [])
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(float(np.log(share / (1 - share))), [_cuts(x[:, f], BINS) for f in range(width)], [], [])
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.cuts)]
    raw = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-raw))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(CYCLES):
        for f in range(width):
            size = len(model.tables[f])
            if size > 1:
                g, h = slopes()
                sums = [np.bincount(bins[f], w, size) for w in (g, h, None)]
                step = RATE * _tree(*sums, depth=2)
                model.tables[f] += step
                raw += step[bins[f]]

    coarse = [_cuts(x[:, f], PAIR_BINS) for f in range(width)]
    cells = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(coarse)]

    def table(f: int, k: int) -> tuple[float, np.ndarray]:
        shape = (len(coarse[f]) + 1, len(coarse[k]) + 1)
        g, h = slopes()
        at = cells[f] * shape[1] + cells[k]
        return _quadrants(*[np.bincount(at, w, shape[0] * shape[1]).astype(float).reshape(shape) for w in (g, h, None)])

    ranked = sorted(((table(f, k)[0], f, k) for f, k in combinations(range(width), 2)), reverse=True)
    chosen = [(f, k) for gain, f, k in ranked[:PAIRS] if gain > 0]
    tables = {p: np.zeros((len(coarse[p[0]]) + 1, len(coarse[p[1]]) + 1)) for p in chosen}
    for _ in range(PAIR_CYCLES):
        for f, k in chosen:
            step = RATE * table(f, k)[1]
            tables[f, k] += step
            raw += step[cells[f], cells[k]]
    model.pairs = [(f, k, coarse[f], coarse[k], t) for (f, k), t in tables.items()]
    return model


def featurise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _x): the features of each document."""
    schema = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                rows = [features(t) for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(rows, pa.list_(pa.float64()))], names=schema.names)

    return common.packed(docs, False, _id=F.col(f"`{id_col}`"), _t=common.text_of(text_col).cast("binary")).mapInArrow(run, schema)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def train(found: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled ids that are not held out. An id with both labels has none; of several rows with
    one id the one with the least features is read."""
    known = labels.select(F.col(f"`{id_col}`").alias("_l"), F.col(f"`{label_col}`").cast("double").alias("_y")).where("_y IN (0, 1) AND _l IS NOT NULL").where(~held_out(F.col("_l")))
    known = known.groupBy("_l").agg(F.min("_y").alias("_y"), F.max("_y").alias("_other")).where("_y = _other")
    chosen = known.orderBy(F.md5(F.col("_l").cast("string"))).limit(sample)
    rows = found.join(chosen, F.col("_id") == F.col("_l")).groupBy("_l").agg(F.min("_x").alias("_x"), F.min("_y").alias("_y")).select("_x", "_y").toArrow()
    x = np.asarray(rows.column(0).combine_chunks().flatten()).reshape(-1, len(FEATURES)) if rows.num_rows else np.zeros((0, len(FEATURES)))
    y = np.asarray(rows.column(1))
    order = np.lexsort((*x.T, y))  # the sums of a fit depend on the order of rows in the last digits
    return fit(x[order], y[order])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``score``."""
    found = checkpoint(featurise(docs, id_col, text_col))
    model = train(found, labels, id_col)
    schema = T.StructType([found.schema["_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=schema.names)

    return found.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def query(spark, sf_dir):
    """op3: the quality score of every document."""
    docs = common.documents(spark, sf_dir)
    df = score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return df.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
