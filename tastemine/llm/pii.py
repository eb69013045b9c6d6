"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over a text finds the anchors: at-signs, digits, ``://`` and identifier cues. A
local parser belongs to each anchor: it expands to the boundaries of the address, number or account, validates what it
has got (octets, Luhn, IBAN check digits, numbers of digits), and never looks at the rest of the text.

Kinds of the base: email, ip, card, phone. The method adds login (a URL with user and password), iban, account and ssn
behind their cues. Spans are in code points, ends exclusive, ordered by kind as listed and then by start.

A null text is empty; an empty text has no spans. Every row is scanned by itself, so repeated rows, null ids and hot
keys need no care, and nothing is shuffled. Long texts are scanned whole, in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemine.llm import common

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "iban", "account", "ssn")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_SCHEME = _LOCAL.replace("_", "").replace("%", "")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOGIN = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+@[A-Za-z0-9.-]+")
_IBAN = re.compile(r"[\s:#]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
_ACCOUNT = re.compile(r"(?:\x20?(?:number|no\.?|nr\.?|#))?[\x20:#=]{0,3}([0-9](?:[\x20-]?[0-9]){7,16})(?![0-9])", re.I)
_SSN = re.compile(r"[\x20:#=]{0,3}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])")
_CUES = {"iban": ("iban", _IBAN), "account": ("account", _ACCOUNT), "acct": ("account", _ACCOUNT), "ssn": ("ssn", _SSN), "social security number": ("ssn", _SSN)}

_FOLDED = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}


def _folded(text: str) -> str:
    """``text`` in lower case, in which cues are known, every character in its place. Only the Kelvin sign becomes an
    ASCII letter, one that no cue has; a text that gets longer is folded in A-Z alone."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_FOLDED)


def _luhn(digits: str) -> bool:
    back = [int(c) for c in reversed(digits)]
    return (sum(back[::2]) + sum(sum(divmod(2 * x, 10)) for x in back[1::2])) % 10 == 0


def _iban(value: str) -> bool:
    plain = value.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _iban_span(text: str, at: int) -> tuple[int, int] | None:
    """The longest IBAN that stands behind its cue at ``at``; what follows it may look like more of it."""
    if m := _IBAN.match(text, at):
        start, end = m.span(1)
        while end - start >= 15:
            if text[end - 1] != " " and not (text[end : end + 1].isascii() and text[end : end + 1].isalnum()) and _iban(text[start:end]):
                return start, end
            end -= 1
    return None


def _run_start(text: str, end: int, floor: int, chars: str) -> int:
    """Where the run of ``chars`` that ends at ``end`` begins, not before ``floor``."""
    step, at = 64, end
    while at > floor:
        low = max(floor, at - step)
        kept = len(text[low:at].rstrip(chars))
        if kept:
            return low + kept
        at, step = low, 2 * step
    return floor


class Scanner:
    def __init__(self):
        import ahocorasick

        self.anchors = ahocorasick.Automaton()
        for c in "0123456789":
            self.anchors.add_word(c, "digit")
        self.anchors.add_word("@", "@")
        self.anchors.add_word("://", "://")
        for cue in _CUES:
            self.anchors.add_word(cue, cue)
        self.anchors.make_automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        found: dict[str, list[tuple[int, int]]] = {}
        past = dict.fromkeys(("digits", "email", "ip", "card", "phone", "login"), 0)

        def put(kind: str, start: int, end: int) -> None:
            found.setdefault(kind, []).append((start, end))

        for at, anchor in self.anchors.iter(_folded(text)):
            if anchor == "digit":
                if at < past["digits"]:
                    continue  # inside a run of digits that is done
                past["digits"] = _DIGITS.match(text, at).end()
                if at >= past["ip"] and (m := _IP.match(text, at)):
                    past["ip"] = m.end()
                    if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m[0].split(".")):
                        put("ip", *m.span())
                if at >= past["card"] and (m := _CARD.match(text, at)):
                    past["card"] = m.end()
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and _luhn(digits):
                        put("card", *m.span())
                if at and text[at - 1] == "+" and at > past["phone"] and (m := _PHONE.match(text, at - 1)):
                    past["phone"] = m.end()
                    if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                        put("phone", *m.span())
            elif anchor == "@":
                if at >= past["email"]:
                    start = _run_start(text, at, past["email"], _LOCAL)
                    if start < at and (m := _DOMAIN.match(text, at + 1)):
                        past["email"] = m.end()
                        put("email", start, m.end())
            elif anchor == "://":
                start = _run_start(text, at - 2, past["login"], _SCHEME)
                if start < at - 2 and (m := _LOGIN.match(text, at + 1)):
                    past["login"] = m.end()
                    put("login", start, m.end())
            else:
                kind, parser = _CUES[anchor]
                start = at + 1 - len(anchor)
                if start and text[start - 1].isalnum():
                    continue
                if kind == "iban":
                    if span := _iban_span(text, at + 1):
                        put(kind, *span)
                elif m := parser.match(text, at + 1):
                    put(kind, *m.span(1))
        return [(kind, *span) for kind in KINDS for span in found.get(kind, ())]


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("value", T.StringType())])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``spans``, an array of (kind, start, end, value)."""
    schema = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), T.StructField("spans", T.ArrayType(SPAN))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                rows = [[{"kind": k, "start": s, "end": e, "value": text[s:e]} for k, s, e in scanner.spans(text)] for text in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(rows, arrow)], names=schema.names)

    df = common.packed(docs, False, _id=F.col(f"`{id_col}`"), _t=common.text_of(text_col)).mapInArrow(run, schema)
    return df.withColumnRenamed("_id", id_col)


def query(spark, sf_dir):
    """op7: counts and digests of the personal data in every document."""
    df = find(common.documents(spark, sf_dir))
    counts = [common.of_kind("spans", k).alias(f"n_{k}") for k in BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return df.select("doc_id", *counts, F.sha2(common.listed(base), 256).alias("base_sha256"), common.listed(F.col("spans")).alias("spans"))
