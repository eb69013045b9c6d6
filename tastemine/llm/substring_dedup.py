"""Substring dedup by recompression: words that a window of ``WINDOW`` words repeats from earlier text are removed.

Recompression names the same words with the same symbols everywhere, without a dictionary: a round replaces runs of one
token, or pairs of neighbours, by the hash of what they stand for. In a pair round the hash of a symbol says whether it
is a left or a right one, and exactly the neighbours (left, right) become one symbol; nothing else in the text matters.
So of two equal windows all symbols are equal but for those near the ends, and how far from the ends that is can be told
from the window alone: each round loses at most one symbol at either end. A window's *anchor* is the longest run of three
neighbouring symbols of the last round that are safe in this sense, the least name deciding among equals (fewer symbols
if there are no three, and the hash of the window if there is none). Equal windows have equal anchors, so a window can only repeat text whose anchor occurs in
another document; neighbouring windows share anchors, so there are far fewer of them than words.

Spark's part, in this order:

1. Every document by itself: repeats within it, the digest of what is kept, and a digest that finds whole copies.
2. Anchors, dealt out by name; those that occur in different texts are gathered per document. Names that many documents
   of a bounded sample share are salted (they are known to repeat); of texts that many rows are copies of, only the
   first one's names are dealt out.
3. Texts of documents with such anchors are written once, with them. Their windows under these anchors are verified by
   two hashes of 64 bits each, that share nothing since every word has two independent ones: a map-side combined aggregation finds the first document of each window, and a join that Spark can
   split on hot keys tells later documents.
4. Documents that were told something are cut once more, with that.

A null or empty text has no words. Repeated rows are whole copies of each other only if their ids differ; rows that
share an id never count as earlier for each other. A null id is neither earlier nor later than anything, so such a row
only loses what it repeats itself. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemine.llm import common
from tastemine.session import checkpoint, ensure_checkpoint_dir

WINDOW = 20
ROUNDS = 3
#: words that are parsed at once; longer texts are parsed in pieces that overlap by a window
SEGMENT = 200_000
#: documents of the sample that finds hot anchors, and how many of them must have one
SAMPLE_DOCS = 5000
HOT_IN_SAMPLE = 10

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_S6, _S30, _S27, _S31, _S58, _S63 = (np.uint64(x) for x in (6, 30, 27, 31, 58, 63))


def _mix(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit name for (a, b)."""
    x = (a + np.uint64(salt)) * _M1
    x ^= x >> _S31
    x += b
    x *= _M2
    x ^= x >> _S27
    x *= _M3
    x ^= x >> _S30
    x *= _M1
    return x ^ (x >> _S31)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of all words of some texts (UTF-8), and where each text's words begin and end.

    Arrow cuts the texts at the six ASCII white-space characters and numbers the different words; each of those is
    hashed once, to 128 bits."""
    from xxhash import xxh3_128_digest

    large = pa.types.is_large_binary(texts.type)
    as_text = (pa.LargeStringArray if large else pa.StringArray).from_buffers(len(texts), texts.buffers()[1], texts.buffers()[2], None, 0, texts.offset)
    split = pc.ascii_split_whitespace(as_text)
    flat = split.flatten()
    given = np.asarray(pc.binary_length(flat)) > 0  # white space at an end leaves an empty part
    coded = flat.cast(pa.large_binary() if large else pa.binary()).dictionary_encode()
    names = np.frombuffer(b"".join(map(xxh3_128_digest, coded.dictionary.to_pylist())), dtype="<u8").reshape(-1, 2)
    word = np.asarray(coded.indices)[given]
    ends = np.cumsum(np.asarray(pc.list_value_length(split)))
    borders = np.concatenate([[0], np.concatenate([[0], np.cumsum(given)])[ends]]).astype(np.int64)
    return names[word, 0], names[word, 1], borders


def window_hashes(w: np.ndarray, salt: int = 1) -> np.ndarray:
    """A hash per window of ``WINDOW`` = 20 words, from hashes of 2, 4, 8 and 16."""
    if len(w) < WINDOW:
        return np.zeros(0, dtype=np.uint64)
    h2 = _mix(w[:-1], w[1:], salt)
    h4 = _mix(h2[:-2], h2[2:], salt)
    h8 = _mix(h4[:-4], h4[4:], salt)
    h16 = _mix(h8[:-8], h8[8:], salt)
    return _mix(h16[:-4], h4[16:], salt)


def anchors(w: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The anchors of the windows that start at ``at``; ``first`` marks the first word of each document."""
    # token runs
    new = np.ones(len(w), dtype=bool)
    new[1:] = (w[1:] != w[:-1]) | first[1:]
    starts = np.flatnonzero(new)
    symbol = np.cumsum(new) - 1
    size = np.diff(np.append(starts, len(w))).astype(np.uint64)
    name = np.where(size > 1, _mix(w[starts], size, 7), w[starts])
    head, begins = first[starts], starts
    n = len(name)
    # for a border before symbol k of the first round: the first safe symbol behind it, the last safe one before it
    behind, before = np.arange(n + 1), np.arange(-1, n)
    for k in range(ROUNDS):
        right = (_mix(name, name, 100 + k) >> _S63).astype(bool)
        pair = ~right[:-1] & right[1:] & ~head[1:]
        new = np.ones(n, dtype=bool)
        new[1:] = ~pair
        to = np.cumsum(new) - 1
        behind = np.append(to, to[-1] + 1)[behind + np.append(right, False)[behind]]
        before = np.append(-1, to)[before - np.append(False, ~right)[before + 1] + 1]
        kept = np.flatnonzero(new)
        merged = name[kept]
        merged[to[:-1][pair]] = _mix(name[:-1][pair], name[1:][pair], 200 + k)
        name, head, begins, n = merged, head[kept], begins[kept], len(kept)
    lo, hi = behind[symbol[at] + 1], before[symbol[at + WINDOW - 1]]
    # three neighbours between lo and hi, the longest first, by a table of minima over 1, 2, 4, 8, 16 of them
    place = np.append(begins, len(w))
    two = _mix(name[:-1], name[1:], 300)
    span = np.minimum(place[3:] - place[:-3], 63).astype(np.uint64)
    three = (np.uint64(63) - span) << _S58 | _mix(two[:-1], name[2:], 310) >> _S6
    least = [np.append(three, np.zeros(n - len(three), dtype=np.uint64))]
    for k in range(4):
        least.append(np.minimum(least[-1], np.append(least[-1][1 << k :], np.full(min(1 << k, n), least[-1][-1]))[:n]))
    table = np.stack(least)
    out = np.zeros(len(at), dtype=np.uint64)
    many = np.flatnonzero(hi >= lo + 2)
    count = (hi - lo)[many] - 1
    power = np.frexp(count)[1] - 1
    out[many] = np.minimum(table[power, lo[many]], table[power, lo[many] + count - (1 << power)])
    pair = np.flatnonzero(hi == lo + 1)
    out[pair] = two[lo[pair]]
    one = np.flatnonzero(hi == lo)
    out[one] = _mix(name[lo[one]], name[lo[one]], 400)
    none = np.flatnonzero(hi < lo)
    if len(none):
        out[none] = window_hashes(w, 500)[at[none]]
    return out


def document_anchors(docs: list[np.ndarray]) -> list[np.ndarray]:
    """The anchors of all windows of some documents (given by their words' hashes), parsed together or in pieces."""
    out: list[list[np.ndarray]] = [[] for _ in docs]
    parts: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if not parts:
            return
        w = np.concatenate([p for _, p in parts])
        sizes = np.array([len(p) for _, p in parts])
        begin = np.cumsum(sizes) - sizes
        first = np.zeros(len(w), dtype=bool)
        first[begin] = True
        at = np.concatenate([np.arange(b, b + s - WINDOW + 1) for b, s in zip(begin, sizes, strict=True)])
        found = anchors(w, first, at)
        end = 0
        for (k, _), s in zip(parts, sizes, strict=True):
            out[k].append(found[end : end + s - WINDOW + 1])
            end += s - WINDOW + 1
        parts.clear()

    held = 0
    for k, w in enumerate(docs):
        for lo in range(0, max(0, len(w) - WINDOW + 1), SEGMENT):
            part = w[lo : lo + SEGMENT + WINDOW - 1]
            parts.append((k, part))
            held += len(part)
            if held >= SEGMENT:
                flush()
                held = 0
    flush()
    return [np.concatenate(x) if x else np.zeros(0, dtype=np.uint64) for x in out]


def removed_words(w: np.ndarray, other: np.ndarray, borders: np.ndarray, told: list[tuple[np.ndarray, np.ndarray] | None] | None) -> np.ndarray:
    """Which words of some documents a repeated window covers: one seen earlier in its document, or one whose hashes the
    document was ``told``. Windows agree if both their hashes do, from the words' first (``w``) and second (``other``)."""
    gone = np.zeros(len(w), dtype=bool)
    doc = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    at = np.flatnonzero(np.arange(len(w)) + WINDOW <= borders[1:][doc])
    if not len(at):
        return gone
    owner = doc[at].astype(np.uint64)
    key = _mix(window_hashes(w)[at], owner, 21)  # a window within its document
    check = _mix(window_hashes(other)[at], owner, 22)
    again = np.zeros(len(at), dtype=bool)
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice):
        some = np.flatnonzero(np.isin(key, twice))
        some = some[np.lexsort((some, check[some], key[some]))]
        again[some[1:]] = (key[some[1:]] == key[some[:-1]]) & (check[some[1:]] == check[some[:-1]])
    if told is not None:
        marks = [(m, np.full(len(m[0]), k, dtype=np.uint64)) for k, m in enumerate(told) if m is not None]
        if marks:
            both = [np.concatenate([_mix(m[j], own, 21 + j) for m, own in marks]) for j in range(2)]
            again |= np.isin(key, both[0]) & np.isin(check, both[1])
    if again.any():
        depth = np.zeros(len(w) + 1, dtype=np.int64)
        depth[at[again]] += 1
        depth[at[again] + WINDOW] -= 1
        gone = np.cumsum(depth[:-1]) > 0
    return gone


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return common.packed(docs, False, _id=F.col(f"`{id_col}`"), _t=common.text_of(text_col).cast("binary"))


def _slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def alone(texts: DataFrame, told: bool = False) -> DataFrame:
    """Each document cut by itself (``told``: and by the window hashes in ``_told1`` and ``_told2``): _id, _dh (64-bit digest of the
    words), _all (128-bit digest), n_words, n_removed, kept_sha256."""
    schema = T.StructType([texts.schema["_id"], T.StructField("_dh", T.LongType()), T.StructField("_all", T.BinaryType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest, xxh3_128_digest

        for some in _slices(batches):
            rows: tuple[list, ...] = ([], [], [], [], [])
            marks = None
            if told:
                marks = [tuple(np.asarray(x.values).view(np.uint64) for x in both) if both[0].is_valid else None for both in zip(some.column(2), some.column(3), strict=True)]
            w, other, borders = hashed_words(some.column(1))
            gone = removed_words(w, other, borders, marks)
            removed = np.concatenate([[0], np.cumsum(gone)])[borders]
            for k, text in enumerate(some.column(1).to_pylist()):
                words = text.split()
                whole = kept = b" ".join(words)
                n = int(removed[k + 1] - removed[k])
                if n:
                    kept = b" ".join(compress(words, ~gone[borders[k] : borders[k + 1]]))
                for out, x in zip(rows, (xxh3_64_intdigest(w[borders[k] : borders[k + 1]].tobytes()), xxh3_128_digest(whole), len(words), n, hashlib.sha256(kept).hexdigest()), strict=True):
                    out.append(x)
            yield pa.RecordBatch.from_arrays([some.column(0), _long(np.array(rows[0], dtype=np.uint64)), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.string())], names=schema.names)

    return texts.mapInArrow(run, schema)


def anchor_rows(texts: DataFrame) -> DataFrame:
    """(_id, _dh, _sym): the distinct anchors of each document."""
    schema = T.StructType([texts.schema["_id"], T.StructField("_dh", T.LongType()), T.StructField("_sym", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for some in _slices(batches):
            w, _, borders = hashed_words(some.column(1))
            docs = [w[lo:hi] for lo, hi in zip(borders, borders[1:], strict=False)]
            found = [np.unique(a) for a in document_anchors(docs)]
            digest = np.array([xxh3_64_intdigest(d.tobytes()) for d in docs], dtype=np.uint64)
            row = np.repeat(np.arange(len(docs)), [len(a) for a in found])
            if len(row):
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(row)), _long(digest[row]), _long(np.concatenate(found))], names=schema.names)

    return texts.where("_id IS NOT NULL").mapInArrow(run, schema)


def window_rows(asked: DataFrame, only_asking: bool) -> DataFrame:
    """(_h1, _h2, _id): the distinct windows of each document under its shared anchors (``_tell``, ``_ask``: those that
    a later or an earlier document has)."""
    schema = T.StructType([T.StructField("_h1", T.LongType()), T.StructField("_h2", T.LongType()), asked.schema["_id"]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _slices(batches):
            w, other, borders = hashed_words(some.column(1))
            all1, all2 = window_hashes(w), window_hashes(other)
            h1, h2, row = [], [], []
            for k, a in enumerate(document_anchors([w[lo:hi] for lo, hi in zip(borders, borders[1:], strict=False)])):
                lists = [some.column(2)[k]] if only_asking else [some.column(2)[k], some.column(3)[k]]
                names = np.concatenate([np.asarray(x.values).view(np.uint64) for x in lists])
                at = borders[k] + np.flatnonzero(np.isin(a, names))
                if len(at):
                    one, keep = np.unique(all1[at], return_index=True)
                    h1.append(one)
                    h2.append(all2[at[keep]])
                    row.append(np.full(len(one), k))
            if row:
                yield pa.RecordBatch.from_arrays([_long(np.concatenate(h1)), _long(np.concatenate(h2)), some.column(0).take(pa.array(np.concatenate(row)))], names=schema.names)

    return asked.select("_id", "_t", "_ask", "_tell").mapInArrow(run, schema)


def placed_anchors(texts: DataFrame, copied: DataFrame) -> DataFrame:
    """(_sym, _id, _dh, _salt): the distinct anchors of each document, dealt out by (_sym, _salt); a salt above 0 is that
    of a hot anchor. Of the texts in ``copied`` (_hdh, _hfirst: digest, first id), only the first document takes part."""
    spark = texts.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    some = max(1, texts.select("_id").count() // SAMPLE_DOCS)

    def rows_of(some_texts: DataFrame) -> DataFrame:
        rows = anchor_rows(some_texts).join(F.broadcast(copied), F.col("_dh") == F.col("_hdh"), "left")
        return rows.where(F.col("_hdh").isNull() | (F.col("_id") <= F.col("_hfirst"))).select("_id", "_dh", "_sym")

    sample = rows_of(texts.where(F.pmod(F.xxhash64("_id"), F.lit(some)) == 0))
    share = F.count(F.lit(1)) / F.lit(SAMPLE_DOCS)
    # at most the sample's anchors / HOT_IN_SAMPLE rows
    hot = sample.groupBy(F.col("_sym").alias("_hot")).agg(F.ceil(F.lit(partitions) * share).cast("int").alias("_salts"), F.count(F.lit(1)).alias("_n"), F.min("_dh").alias("_a"), F.max("_dh").alias("_b"))
    hot = hot.where((F.col("_n") >= HOT_IN_SAMPLE) & (F.col("_a") != F.col("_b"))).select("_hot", "_salts")
    rows = rows_of(texts).join(F.broadcast(hot), F.col("_sym") == F.col("_hot"), "left")
    salt = F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("_id"), F.col("_salts")))
    return rows.select("_sym", "_id", "_dh", salt.cast("int").alias("_salt"))


def shared_anchors(texts: DataFrame, copied: DataFrame) -> DataFrame:
    """(_id, _dh, _ask, _tell): per document its anchors that an earlier, or a later, document with other text has."""
    rows = placed_anchors(texts, copied)
    one = Window.partitionBy("_sym", "_salt")
    rows = rows.select("_sym", "_id", "_dh", "_salt", F.min("_id").over(one).alias("_lo"), F.max("_id").over(one).alias("_hi"), (F.min("_dh").over(one) != F.max("_dh").over(one)).alias("_differ"))
    rows = rows.where(F.col("_differ") | (F.col("_salt") > 0))
    known = F.col("_salt") > 0
    ask, tell = (F.when(known | c, F.col("_sym")) for c in (F.col("_lo") < F.col("_id"), F.col("_hi") > F.col("_id")))
    return rows.groupBy("_id", "_dh").agg(F.collect_list(ask).alias("_ask"), F.collect_list(tell).alias("_tell"))


def hot_copies(groups: DataFrame, rows: int) -> DataFrame:
    """(_hdh, _hfirst): the texts that as large a share of all rows has as makes an anchor hot; at most ``SAMPLE_DOCS`` /
    ``HOT_IN_SAMPLE`` rows."""
    hot = groups.where(F.col("_n") * SAMPLE_DOCS >= rows * HOT_IN_SAMPLE)
    return hot.groupBy("_hdh").agg(F.max("_first").alias("_hfirst"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``kept_sha256``."""
    spark = docs.sparkSession
    base = f"{ensure_checkpoint_dir(spark)}/substrings-{uuid.uuid4().hex}"

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    texts = _texts(docs, id_col, text_col)
    own = written(alone(texts), "own")
    # whole copies: all their windows start earlier, in the first document with these words
    groups = own.where(f"n_words >= {WINDOW} AND _id IS NOT NULL").groupBy("_all", "n_words").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"), F.min("_dh").alias("_hdh")).where("_n > 1")
    groups = checkpoint(groups.select(F.col("_all").alias("_g"), F.col("n_words").alias("_gw"), "_first", "_n", "_hdh"))
    copied = hot_copies(groups, own.count())
    groups = groups.drop("_n", "_hdh")
    own = own.join(groups, (F.col("_all") == F.col("_g")) & (F.col("n_words") == F.col("_gw")), "left")
    own = written(own.withColumn("_copy", F.coalesce(F.col("_id") > F.col("_first"), F.lit(False))).drop("_g", "_gw", "_first", "_all"), "copies")

    copies = own.where("_copy").select(F.col("_id").alias("_c"), F.col("_dh").alias("_cdh")).distinct()
    shared = shared_anchors(texts, copied).join(copies, (F.col("_id") == F.col("_c")) & (F.col("_dh") == F.col("_cdh")), "left_anti")
    shared = checkpoint(shared.groupBy(F.col("_id").alias("_i")).agg(F.flatten(F.collect_list("_ask")).alias("_ask"), F.flatten(F.collect_list("_tell")).alias("_tell")))
    asked = texts.join(shared.hint("shuffle_hash"), F.col("_id") == F.col("_i")).select("_id", "_t", "_ask", "_tell")
    asked = written(asked, "asked")

    firsts = window_rows(asked, False).groupBy("_h1", "_h2").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    firsts = written(firsts.where(F.col("_first") < F.col("_last")).select(F.col("_h1").alias("_f1"), F.col("_h2").alias("_f2"), "_first"), "firsts")
    told = window_rows(asked.where(F.size("_ask") > 0), True).join(firsts, (F.col("_h1") == F.col("_f1")) & (F.col("_h2") == F.col("_f2")) & (F.col("_id") > F.col("_first")))
    told = told.groupBy(F.col("_id").alias("_i")).agg(F.collect_list("_h1").alias("_told1"), F.collect_list("_h2").alias("_told2"))
    again = alone(asked.select("_id", "_t").join(told, F.col("_id") == F.col("_i")).select("_id", "_t", "_told1", "_told2"), told=True)
    again = again.select(F.col("_id").alias("_i"), F.col("_dh").alias("_idh"), F.col("n_removed").alias("_removed"), F.col("kept_sha256").alias("_kept")).dropDuplicates(["_i", "_idh"])

    out = own.join(again, (F.col("_id") == F.col("_i")) & (F.col("_dh") == F.col("_idh")), "left")
    copy = F.col("_copy")
    removed = F.when(copy, F.col("n_words")).otherwise(F.coalesce("_removed", "n_removed"))
    kept = F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("_kept", "kept_sha256"))
    return out.select(F.col("_id").alias(id_col), "n_words", removed.alias("n_removed"), kept.alias("kept_sha256"))


def query(spark, sf_dir):
    """op2: what is left of every document."""
    return substring_dedup(common.documents(spark, sf_dir))


SQL = f"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w WHERE len(w) >= {WINDOW})
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM win) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS i FROM again
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t
  FROM (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id)
"""
