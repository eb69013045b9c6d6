"""Secret scan: three patterns, and random strings found by a likelihood ratio of two character Markov models.

Base spans come from three regular expressions. The method looks at every run of ``RUN`` or more characters that tokens
are made of and asks which of two first-order Markov models of characters explains it better: one of random strings or
one of ordinary identifiers. A run is a secret if the mean log-likelihood ratio per character is at least
``THRESHOLD``.

Both models are counted by Spark: the values in base spans are labelled random strings, all other token-like runs (of four
or more characters) of all documents are ordinary. Of the labelled values at most ``SAMPLE_SECRETS`` are read, a
parameter. Runs are counted first and their pairs with those counts, so what is counted are different runs. Letters are folded to lower case, as shouting is no secret. Pairs seen too seldom
fall back, in the ordinary model, on single characters and, in the random one, on a uniform choice, so every string has a
likelihood under both, also where nothing was counted. A model is a table over pairs of 128 characters.

Work and memory grow in proportion to a text, also to one of many spans: offsets are added up in groups, and a run that
a base span overlaps is told by its own characters (access and hex spans lie within one run) or by a mark in place of
the assignments.

Everything is column expressions. A null text is empty; an empty text has no spans. Rows are scanned one by one, so
repeated rows and null ids need no care; positions are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemine.llm import common

# The patterns of the base; the second group of the first one is the value.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE = ("assign", "access", "hex")
#: stands for a character of an assignment
MARK = "\x01"

RUN = 20
THRESHOLD = 1.5
SAMPLE_SECRETS = 5000
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_TOKEN = r"[A-Za-z0-9+/_=-]"
#: what a character's row in the ordinary model weighs beside its single characters, in pairs seen
BACKING = 20.0
#: share of the uniform choice in the random model
UNIFORM = 0.5


def _with_spans(df: DataFrame, out: str, pattern: str, kind: str, keep=lambda m: F.lit(True)) -> DataFrame:
    """Add ``out``: array of (start, kind, end, value) of the matches of ``pattern`` in ``_t`` that ``keep`` accepts."""
    m, gaps, steps = f"_{out}_m", f"_{out}_g", f"_{out}_s"
    df = df.withColumn(m, F.regexp_extract_all("_t", F.lit(pattern), F.lit(0)))
    df = df.withColumn(gaps, F.when(F.size(m) > 0, F.slice(F.split("_t", pattern, -1), F.lit(1), F.size(m))))
    none = F.array().cast("array<struct<start:bigint,kind:string,end:bigint,value:string>>")

    def step(before: Column, gap: Column) -> Column:
        return F.struct((before + F.length(gap)).alias("start"), F.length(gap).alias("gap"))

    def span(at: Column, value: Column) -> Column:
        start = at["start"]
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(value)).alias("end"), value.alias("value"))

    sizes = F.zip_with(gaps, m, lambda g, x: (F.length(g) + F.length(x)).cast("bigint"))
    df = df.withColumn(steps, F.zip_with(common.running(sizes), gaps, step))
    spans = F.filter(F.zip_with(steps, m, span), lambda s: keep(s["value"]))
    return df.withColumn(out, F.when(F.size(m) > 0, spans).otherwise(none)).drop(m, gaps, steps)


def with_base(df: DataFrame) -> DataFrame:
    """Add the base spans ``assign``, ``access`` and ``hex`` to a frame with the text in ``_t``."""
    df = _with_spans(df, "assign", ASSIGN, "assign", lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6)
    df = _with_spans(df, "access", ACCESS, "access")
    return _with_spans(df, "hex", HEX, "hex")


def _codes(value: Column) -> Column:
    """ASCII codes of a string's characters in lower case, with 0 before the first."""
    return F.concat(F.array(F.lit(0)), F.transform(F.split(F.lower(value), ""), lambda c: F.ascii(c)))


def _pair_counts(values: DataFrame) -> dict[tuple[int, int], int]:
    """Neighbouring characters of (value, n), in lower case, each n times; a first character follows 0. At most as many
    rows as there are pairs of symbols."""
    text = F.concat(F.lit(" "), F.lower("value"))
    at = values.where(F.length("value") > 0).select("n", text.alias("v"), F.explode(F.sequence(F.lit(1), F.length("value"))).alias("i"))
    counts = at.groupBy(F.substring("v", F.col("i"), F.lit(2)).alias("pair")).agg(F.sum("n").alias("n"))
    return {(0 if r["pair"][0] == " " else ord(r["pair"][0]), ord(r["pair"][1])): r["n"] for r in counts.collect()}


def ratio_table(random: dict[tuple[int, int], int], ordinary: dict[tuple[int, int], int]) -> list[float]:
    """Log-likelihood ratio of each pair (a, b) at 128 * a + b: how much likelier b is after a in a random string."""
    codes = [ord(c) for c in SYMBOLS]
    flat = 1 / len(codes)

    def totals(counts: dict[tuple[int, int], int], which: int) -> dict[int, int]:
        out: dict[int, int] = {}
        for pair, n in counts.items():
            out[pair[which]] = out.get(pair[which], 0) + n
        return out

    random_rows, ordinary_rows, single = totals(random, 0), totals(ordinary, 0), totals(ordinary, 1)
    seen = sum(single.values())
    out = [0.0] * (128 * 128)
    for a in [0, *codes]:
        for b in codes:
            trained = random.get((a, b), 0) / random_rows[a] if random_rows.get(a) else flat
            backing = (single.get(b, 0) + 1) / (seen + len(codes))
            q = (ordinary.get((a, b), 0) + BACKING * backing) / (ordinary_rows.get(a, 0) + BACKING)
            out[128 * a + b] = math.log((UNIFORM * flat + (1 - UNIFORM) * trained) / q)
    return out


def train(docs: DataFrame, text_col: str = "text", sample_secrets: int = SAMPLE_SECRETS) -> list[float]:
    """The ratio table, from a bounded sample of labelled values and all other runs."""
    text = common.text_of(text_col)
    # runs outside assignments, counted; access and hex spans lie within one run
    runs = F.regexp_extract_all(_marked(text, _has_assignment(text)), F.lit(_TOKEN.replace("[", "[" + MARK) + "{4,}"), F.lit(0))
    ordinary = docs.select(F.explode(runs).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    ordinary = ordinary.where(~(F.col("value").contains(MARK) | F.col("value").rlike(ACCESS) | F.col("value").rlike(HEX)))
    none = F.array().cast("array<string>")
    values = F.concat(
        F.when(_has_assignment(text), F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))).otherwise(none),
        F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
    )
    random = docs.select(F.explode(values).alias("value")).where(F.length("value") >= RUN).distinct()
    random = random.orderBy(F.md5("value")).limit(sample_secrets).withColumn("n", F.lit(1))
    return ratio_table(_pair_counts(random), _pair_counts(ordinary))


def _has_assignment(text: Column) -> Column:
    """A cheap test that every text with an assignment passes."""
    folded = F.lower(text)
    return folded.contains("passw") | folded.contains("secret") | folded.contains("token") | folded.contains("api")


def likelihood_ratio(value: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio per character of a string over ``SYMBOLS``."""
    ratios = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    codes = _codes(value)
    each = F.zip_with(F.slice(codes, F.lit(1), F.length(value)), F.slice(codes, F.lit(2), F.length(value)), lambda a, b: F.element_at(ratios, a * 128 + b + 1))
    return F.aggregate(each, F.lit(0.0), lambda s, x: s + x) / F.length(value)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table: list[float] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, ``base`` and ``random``: arrays of (start, kind, end, value), by start; ``random`` are
    the method's spans that no base span overlaps."""
    table = table or train(docs, text_col)
    df = with_base(common.packed(docs, False, _id=F.col(f"`{id_col}`"), _t=common.text_of(text_col)))
    order = F.create_map(*[F.lit(x) for k, kind in enumerate(BASE) for x in (kind, k)])
    ranked = F.transform(F.concat("assign", "access", "hex"), lambda s: F.struct(s["start"].alias("start"), F.element_at(order, s["kind"]).alias("rank"), s.alias("s")))
    df = df.withColumn("base", F.transform(F.array_sort(ranked), lambda x: x["s"]))
    df = df.withColumn("_t", _marked(F.col("_t"), F.size("assign") > 0))
    free = lambda r: ~(r.contains(MARK) | r.rlike(ACCESS) | r.rlike(HEX))
    df = _with_spans(df, "random", _TOKEN.replace("[", "[" + MARK) + f"{{{RUN},}}", "random", lambda m: F.when(free(m), likelihood_ratio(m, table) >= threshold))
    return df.select(F.col("_id").alias(id_col), "base", "random")


def _marked(text: Column, some: Column) -> Column:
    """``text`` with a mark in place of each character of its assignments, looked for where ``some``; nothing moves. Marks
    that stood in it are spaces."""
    plain = lambda c: F.translate(c, MARK, " ")
    found = F.concat(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)), F.array(F.lit("")))
    hidden = lambda x: F.when(F.length(F.regexp_extract(x, ASSIGN, 2)) >= 6, F.repeat(F.lit(MARK), F.length(x))).otherwise(x)
    pieces = F.zip_with(F.split(text, ASSIGN, -1), found, lambda gap, x: F.concat(plain(gap), hidden(x)))
    return F.when(some, F.array_join(pieces, "")).otherwise(plain(text))


def query(spark, sf_dir):
    """op1: counts, digest and spans of the secrets in every document."""
    df = scan(common.documents(spark, sf_dir))
    counts = [common.of_kind("base", k).alias(f"n_{k}") for k in BASE]
    merged = F.array_sort(F.concat("base", "random"), lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0))
    # spans that start together keep the order of their kinds: the sort is stable and base comes first
    return df.select("doc_id", *counts, F.sha2(common.listed(F.col("base")), 256).alias("base_sha256"), common.listed(merged).alias("spans"), F.size("random").cast("bigint").alias("n_random"))
