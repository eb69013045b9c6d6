"""Best-fit packing of documents into sequences, planned on the histogram of lengths.

Documents are tokenised, closed with id 0 and cut into pieces of at most ``SEQUENCE`` tokens (only longer documents are
cut). The plan needs nothing but the number of pieces of each length, at most ``SEQUENCE`` numbers: lengths go from
long to short, and all pieces of a length at once go to the open sequences with the least room that still holds them.
Sequences in the same state are a range of numbers, so the plan is a list of ranges whose length depends on the lengths
that occur, not on the documents. Pieces then take the planned slots by joining on (length, rank within the length).

Ranks come from one distributed sort; a length that most pieces have is split over many tasks like any other stretch of
the sort. Python only tokenises: a white-space delimited part of a text is looked up in bounded tables of parts seen
before, as the tokenizer drops white space and never joins what it separates.

A null text is empty; an empty text is one piece, id 0. Rows that agree in everything get a place each. Null ids are
kept. An empty table gives no pieces.
"""

from __future__ import annotations

import os
import zlib
from bisect import insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemine.llm import common
from tastemine.operators.indexing import dense_index
from tastemine.session import checkpoint

SEQUENCE = 2048
END = 0
#: bytes of stems and their ids that a worker remembers
REMEMBERED = 32 << 20
#: bytes of texts tokenised together; a longer text is alone
AT_ONCE = 6 << 20


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class PartIds:
    """Ids of texts as little-endian unsigned 32-bit numbers, through a table of parts' stems.

    Arrow cuts a batch of texts into white-space delimited parts and numbers the different ones. Each of those is looked
    up by its stem: without the punctuation behind an ASCII letter or digit, where the tokenizer always cuts, and in
    lower case, as the tokenizer folds case. New stems are tokenised many at a time: those of ASCII letters are one word
    each, and the last token of a word is one that ends words; others get a mark between them. The table
    holds ``REMEMBERED`` bytes: when half of it is full, the stems not asked for since it last was are forgotten."""

    _of: dict[str, PartIds] = {}
    MARK = b"\x01"
    WORD_END = "</w>"
    PUNCTUATION = ".,;:!?"
    ALNUM = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz0123456789"))
    #: stems tokenised in one text
    TOGETHER = 500
    #: of a table entry besides its characters and ids: two objects and a slot
    ENTRY = 160

    @classmethod
    def of(cls, path: str) -> PartIds:
        """The worker's table for a tokenizer; later tasks of the same worker find it filled."""
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.stems: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(self.WORD_END)]] = True
        self.mark = np.array(self.tokenizer.encode(self.MARK.decode(), add_special_tokens=False).ids, dtype="<u4")

    def _ids(self, texts: list[bytes], between: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([between.join(texts).decode()], add_special_tokens=False)[0].ids, dtype="<u4")

    def _encoded(self, new: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        words = [x for x in new if x.isalpha()]  # of bytes: ASCII letters
        rest = [x for x in new if not x.isalpha()]
        for i in range(0, len(words), self.TOGETHER):
            some = words[i : i + self.TOGETHER]
            ids = self._ids(some, b" ")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):  # not a vocabulary with word ends
                rest += some
                continue
            cuts = cuts.tolist()
            for stem, lo, hi in zip(some, [0, *cuts], cuts, strict=False):
                yield stem, ids[lo:hi].tobytes()
        plain = [x for x in rest if self.MARK not in x] if len(self.mark) == 1 else []
        for i in range(0, len(plain), self.TOGETHER):
            some = plain[i : i + self.TOGETHER]
            ids = self._ids(some, b" " + self.MARK + b" ")
            cuts = np.flatnonzero(ids == self.mark[0])
            starts, ends = np.append(0, cuts + 1).tolist(), np.append(cuts, len(ids)).tolist()
            for stem, lo, hi in zip(some, starts, ends, strict=True):
                yield stem, ids[lo:hi].tobytes()
        for x in rest if not plain else [x for x in rest if self.MARK in x]:
            yield x, np.array(self.tokenizer.encode(x.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _ids_of(self, stems: list[bytes]) -> list[bytes]:
        """Ids of different stems."""
        known = list(map(self.stems.get, stems))
        missing = [i for i, ids in enumerate(known) if ids is None]
        if missing:
            found = {stems[i]: self.old[stems[i]] for i in missing if stems[i] in self.old}
            found.update(self._encoded([stems[i] for i in missing if stems[i] not in found]))
            for i in missing:
                known[i] = found[stems[i]]
            for stem, ids in found.items():
                self.held += len(stem) + len(ids) + self.ENTRY
                if self.held > REMEMBERED // 2:
                    self.old, self.stems, self.held = self.stems, {}, len(stem) + len(ids) + self.ENTRY
                self.stems[stem] = ids
        return known

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts (an array of strings) in a row, and where each text's begin and end."""
        split = pc.ascii_split_whitespace(texts)  # at the six ASCII white-space characters
        flat = split.flatten().dictionary_encode()
        parts = flat.dictionary
        special = pc.match_substring(parts, "<|")  # may be a special token, which is one as it stands only
        lower = pc.if_else(special, parts, pc.ascii_lower(parts))
        stem = pc.ascii_rtrim(lower, characters=self.PUNCTUATION)
        size = np.asarray(pc.binary_length(stem))
        data = np.frombuffer(stem.buffers()[2] or b"", np.uint8)
        last = np.frombuffer(stem.buffers()[1], np.int64 if pa.types.is_large_string(stem.type) else np.int32)[stem.offset + 1 : stem.offset + 1 + len(stem)]
        cut = (size > 0) & ~np.asarray(special.fill_null(False).to_numpy(zero_copy_only=False))
        cut[cut] = self.ALNUM[data[last[cut] - 1]]
        stem = pc.if_else(pa.array(cut), stem, lower)
        rest = pc.struct_field(pc.extract_regex(lower, f"(?P<rest>[{self.PUNCTUATION}]*)$"), "rest")
        stem, rest = (x.dictionary_encode() for x in (stem, pc.if_else(pa.array(cut), rest, "")))
        known = [self._ids_of(x.dictionary.cast(pa.binary()).to_pylist()) for x in (stem, rest)]
        size = np.fromiter(map(len, known[0] + known[1]), np.int32) // 4
        table = np.frombuffer(b"".join(known[0] + known[1]), dtype="<u4")
        pair = np.column_stack([np.asarray(stem.indices), np.asarray(rest.indices) + len(known[0])]).astype(np.int32)
        both = pair[np.asarray(flat.indices)].reshape(-1)
        n = size[both]
        end = np.cumsum(n, dtype=np.int32)
        begin = (np.cumsum(size, dtype=np.int32) - size)[both]
        ids = table[np.repeat(begin - (end - n), n) + np.arange(end[-1] if len(end) else 0, dtype=np.int32)]
        words = np.cumsum(np.asarray(pc.list_value_length(split)))
        return ids, np.concatenate([[0], np.append(0, end)[2 * words]])


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, tokenizer: str | None = None) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32."""
    path = tokenizer or tokenizer_path()
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("_id", id_type)] + [T.StructField(c, T.LongType()) for c in ("piece", "start", "length", "ids_crc32")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = PartIds.of(path)
        end = np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            pa.default_memory_pool().release_unused()
            size = np.cumsum(np.asarray(pc.binary_length(batch.column(1))), dtype=np.int64) // AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                some = batch.slice(lo, hi - lo)
                ids, borders = parts.batch(some.column(1))
                rows, numbers = [], ([], [], [], [])
                for row in range(some.num_rows):
                    own = ids[borders[row] : borders[row + 1]].tobytes() + end
                    for k, at in enumerate(range(0, len(own), 4 * sequence)):
                        piece = own[at : at + 4 * sequence]
                        rows.append(row)
                        for out, x in zip(numbers, (k, at // 4, len(piece) // 4, zlib.crc32(piece)), strict=True):
                            out.append(x)
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in numbers)], names=schema.names)

    return common.packed(docs, False, _id=F.col(f"`{id_col}`"), _t=common.text_of(text_col)).mapInArrow(run, schema)


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Best fit over counts: rows (length, first rank, how many, first sequence, offset); sequences are consecutive."""
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> ranges of sequences with that much room
    open_rooms: list[int] = []
    out: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def put(free: int, first: int, n: int) -> None:
        if free:
            if free not in room:
                room[free] = []
                insort(open_rooms, free)
            room[free].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            free = next((x for x in open_rooms if x >= length), None)
            if free is None:
                # new sequences; each is filled with as many pieces of this length as it takes
                each = min(sequence // length, left)
                n = left // each
                for k in range(each):
                    out.append((length, rank + k * n, n, sequences, k * length))
                put(sequence - each * length, sequences, n)
                sequences, rank, left = sequences + n, rank + n * each, left - n * each
                continue
            first, n = room[free].pop()
            if not room[free]:
                del room[free]
                open_rooms.remove(free)
            used = min(n, left)
            if used < n:
                put(free, first + used, n - used)
            out.append((length, rank, used, first, sequence - free))
            put(free - length, first, used)
            rank, left = rank + used, left - used
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, tokenizer: str | None = None) -> DataFrame:
    """Per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    spark = docs.sparkSession
    found = checkpoint(pieces(docs, id_col, text_col, sequence, tokenizer))
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `sequence` rows
    first, starts = 0, []
    for length in range(sequence + 1):
        starts.append(first)
        first += counts.get(length, 0)
    ranked = dense_index(found, ["length", F.col("_id").asc_nulls_last(), "piece", "ids_crc32"], "_at")
    starts = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    ranked = ranked.withColumn("_rank", F.col("_at") - F.element_at(starts, (F.col("length") + 1).cast("int")))

    planned = spark.createDataFrame(plan(counts, sequence), "_length bigint, _first bigint, _n bigint, _seq bigint, offset bigint")
    step = 4096  # ranges are opened in two steps, so no task makes a long one alone
    planned = planned.withColumn("_lo", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(step).cast("bigint"))))
    planned = planned.repartition("_length", "_first", "_lo")
    planned = planned.withColumn("_i", F.explode(F.sequence(F.col("_lo"), F.least(F.col("_lo") + step, F.col("_n")) - 1)))
    slots = planned.select("_length", (F.col("_first") + F.col("_i")).alias("_slot"), (F.col("_seq") + F.col("_i")).alias("sequence_id"), "offset")
    out = ranked.join(slots, (F.col("length") == F.col("_length")) & (F.col("_rank") == F.col("_slot")))
    return out.select(F.col("_id").alias(id_col), F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


def query(spark, sf_dir):
    """op10: the place of every piece of every document."""
    return pack(common.documents(spark, sf_dir))
