"""Token counts by whole-token shortcut.

A byte-level BPE cuts a text into pre-tokens and merges the bytes of each on its own. Most pre-tokens of running text
are themselves in the vocabulary, and most of those merge back to that one token. Which ones do is proved beforehand,
without the corpus: every vocabulary string is encoded alone, and those that come back as one token are the *whole*
tokens. A pre-token that is a whole token counts one by a table lookup; only the others are merged, by the tokenizer.

Pre-tokens are cut by the tokenizer's published pattern. Whether the pattern's character classes and the tokenizer's
agree is proved too, per character that occurs: the classes come from different Unicode versions. A text with a
character on which they differ goes to the tokenizer whole. Special tokens inside a text count one each, as the
tokenizer takes them out before it cuts pre-tokens.

Memory: the whole tokens are bounded by the vocabulary, what is remembered of merged pre-tokens by ``REMEMBERED``
characters, and a long text is cut pre-token by pre-token, never into one list.

A null text is empty; an empty text has no tokens. Null and repeated ids are kept, one row each. Bytes that are not
UTF-8 count as the replacement character. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemine.llm import common

LIMIT = 1024
#: characters of merged pre-tokens that a worker remembers
REMEMBERED = 2_000_000
#: longest pre-token worth remembering
SHORT = 64
#: texts longer than this are cut piece by piece
LONG = 1_000_000
_AT_ONCE = 100_000


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable Latin-1 characters stand
    for themselves, the other bytes in turn for the characters from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def whole_tokens(path: str, pat: str) -> list[str]:
    """The vocabulary strings that are one pre-token and encode, alone, as one token."""
    import regex

    tokenizer, cut = _load(path), regex.compile(pat)
    byte = byte_alphabet()
    strings = []
    for shown in tokenizer.get_vocab(with_added_tokens=False):
        if all(c in byte for c in shown):
            try:
                strings.append(bytes(byte[c] for c in shown).decode())
            except UnicodeDecodeError:  # part of a character: never a pre-token
                continue
    strings = [s for s in strings if cut.findall(s) == [s]]
    found = tokenizer.encode_batch(strings, add_special_tokens=False)
    return sorted(s for s, e in zip(strings, found, strict=True) if len(e.ids) == 1)


class Counter:
    """Token counts of texts, exactly as the tokenizer gives them."""

    def __init__(self, path: str, pat: str, whole: Iterable[str]):
        import regex

        self.tokenizer = _load(path)
        self.cut = regex.compile(pat)
        self.whole = dict.fromkeys(whole, 1)
        self.cost = dict(self.whole)
        self.left = REMEMBERED
        self.agreed: set[str] = set()
        self.doubtful: set[str] = set()
        special = [regex.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(sorted(special, key=len, reverse=True))) if special else None

    def _agrees(self, c: str) -> bool:
        """Whether pattern and tokenizer class a character alike: beside a letter, a digit, a sign and a space."""
        probe = f"a{c}1{c}!{c} {c}"
        return [m.span() for m in self.cut.finditer(probe)] == [at for _, at in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]

    def _in_doubt(self, text: str) -> bool:
        new = set() if text.isascii() else set(text) - self.agreed
        for c in new - self.doubtful:
            (self.agreed if self._agrees(c) else self.doubtful).add(c)
        return not self.doubtful.isdisjoint(new)

    def _merged(self, pieces: set[str]) -> dict[str, int]:
        """Tokens of pre-tokens that are not whole."""
        some = list(pieces)
        return {p: len(e.ids) for p, e in zip(some, self.tokenizer.encode_batch(some, add_special_tokens=False), strict=True)}

    def _of_pieces(self, pieces: list[str]) -> int:
        cost = self.cost
        try:
            return sum(map(cost.__getitem__, pieces))
        except KeyError:
            new = self._merged(set(pieces).difference(cost))
        self.left -= sum(len(p) for p in new if len(p) <= SHORT)
        if self.left < 0:  # start again from what is proved
            self.cost, self.left = dict(self.whole), REMEMBERED
            cost = self.cost
            new |= self._merged(set(pieces).difference(cost, new))
        n = sum(new[p] if p in new else cost[p] for p in pieces)
        cost.update((p, k) for p, k in new.items() if len(p) <= SHORT)
        return n

    def _plain(self, text: str) -> int:
        """Tokens of a stretch without special tokens."""
        if len(text) <= LONG:
            return self._of_pieces(self.cut.findall(text))
        n, pieces = 0, (m.group() for m in self.cut.finditer(text))
        while some := list(islice(pieces, _AT_ONCE)):
            n += self._of_pieces(some)
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self._in_doubt(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self.special is None or not (specials := list(self.special.finditer(text))):
            return self._plain(text)
        n, at = len(specials), 0
        for m in [*specials, None]:
            end = len(text) if m is None else m.start()
            if end > at:
                n += self._plain(text[at:end])
            at = end if m is None else m.end()
        return n


def count_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, tokenizer: str | None = None, pat: str | None = None
) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens)."""
    path, pat = tokenizer or tokenizer_path(), pat or pattern()
    whole = whole_tokens(path, pat)  # at most the vocabulary
    schema = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, pat, whole)
        for batch in batches:
            counts = [counter.count(t.as_py().decode("utf-8", "replace")) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=schema.names)

    text = common.text_of(text_col)
    own = common.packed(docs, False, _id=F.col(f"`{id_col}`"), _n=F.octet_length(text).cast("bigint"), _t=text.cast("binary"))
    out = own.mapInArrow(run, schema)
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def query(spark, sf_dir):
    """op13: bytes and tokens of every document."""
    return count_tokens(common.documents(spark, sf_dir))
