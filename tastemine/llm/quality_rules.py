"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and stores the measurements and one integer whose bit *i* is set
if rule *i* fails. A policy is a named set of rules, i.e. a mask: ``verdict`` is one bitwise *and*, and ``ablations``
says from the ledger alone, in one aggregation, what each rule of a policy rejects and what only it rejects. A new
policy needs no second look at the texts.

Everything is column expressions over one row; the ledger needs no shuffle. A null text counts as empty, an empty text
has zero in every measurement (and too few words); repeated rows are judged one by one; a null id is kept as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemine.llm import common

WINDOW = 8

# Rules in the order of their bits; each is (name, SQL condition under which a document fails). Plain SQL over the
# measurements, the same in any engine.
RULES = [
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("many_symbols", "100 * n_symbols > 20 * n_words"),
    ("shouting", "100 * n_upper > 60 * word_chars"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    ("duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 60 * n_lines"),
    ("mostly_digits", "100 * n_digits > 50 * word_chars"),
]
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A version of the filter: the rules that reject."""

    name: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << i for i, (name, _) in enumerate(RULES) if name in self.rules)


POLICIES = {
    "base": Policy("base", BASE),
    "v1": Policy("v1", (*BASE, "many_symbols", "shouting", "word_length")),
    "v2": Policy("v2", tuple(name for name, _ in RULES)),
}
CURRENT = "v2"


def _shifted(a: Column, by: int, n: Column) -> Column:
    return F.slice(a, F.lit(1 + by), n)


def _measured(df: DataFrame) -> DataFrame:
    """Add the measurements to a frame with the text in ``_t``."""
    t = F.col("_t")
    hashed = F.greatest(F.size("_w"), F.lit(1))
    pair = lambda a, b: F.xxhash64(a, b)
    df = (
        df.withColumn("_w", common.words(t))
        .withColumn("_l", F.filter(F.split(t, "\n", -1), lambda x: x.rlike(common.WORD)))
        .withColumn("n_words", F.size("_w").cast("bigint"))
        .withColumn("word_chars", F.length(F.array_join("_w", "")).cast("bigint"))
        .withColumn("n_symbols", F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("bigint"))
        .withColumn("n_upper", F.regexp_count(t, F.lit(r"[A-Z]")).cast("bigint"))
        .withColumn("n_digits", F.regexp_count(t, F.lit(r"[0-9]")).cast("bigint"))
        .withColumn("n_lines", F.size("_l").cast("bigint"))
        .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"))
    )
    # Hash of each 8-word window from hashes of 2 and 4 words; a window is named by where it starts.
    df = (
        df.withColumn("_h1", F.transform("_w", lambda w: F.xxhash64(w)))
        .withColumn("_h2", F.zip_with("_h1", _shifted(F.col("_h1"), 1, hashed), pair))
        .withColumn("_h4", F.zip_with("_h2", _shifted(F.col("_h2"), 2, hashed), pair))
        .withColumn("_h8", F.slice(F.zip_with("_h4", _shifted(F.col("_h4"), 4, hashed), pair), F.lit(1), F.greatest(F.size("_w") - (WINDOW - 1), F.lit(0))))
        .withColumn("_dup", F.size(F.array_distinct("_h8")) < F.size("_h8"))
    )
    # Only texts with a repeated window go on: sort (hash, start); a start counts if a neighbour has its hash.
    only = lambda c: F.when(F.col("_dup"), c)
    df = (
        df.withColumn("_e", only(F.sort_array(F.transform("_h8", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
        .withColumn("_s", F.transform("_e", lambda x: x["h"]))
        .withColumn("_next", F.zip_with("_s", F.slice("_s", F.lit(2), hashed), lambda a, b: F.coalesce(a == b, F.lit(False))))
        .withColumn("_same", F.zip_with("_next", F.concat(F.array(F.lit(False)), F.slice("_next", F.lit(1), F.greatest(F.size("_next") - 1, F.lit(0)))), lambda a, b: a | b))
        .withColumn("_at", F.sort_array(F.filter(F.zip_with("_e", "_same", lambda x, k: F.when(k, x["i"])), lambda x: x.isNotNull())))
        .withColumn("_new", F.zip_with("_at", F.slice("_at", F.lit(2), hashed), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))))
        .withColumn("n_repeat_words", F.coalesce(F.aggregate("_new", F.lit(0).cast("bigint"), lambda s, x: s + x), F.lit(0)).cast("bigint"))
    )
    return df


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits"]


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per document: id, measurements, ``failure_bits``; with ``carry`` also the whole row (``_row``)."""
    df = _measured(common.packed(docs, carry, _id=F.col(f"`{id_col}`"), _t=common.text_of(text_col)))
    bits = F.lit(0).cast("bigint")
    for i, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    keep = [F.col(common.ROW)] if carry else []
    return df.select(F.col("_id").alias(id_col), *MEASURES, bits.alias("failure_bits"), *keep)


def verdict(policy: Policy, bits: str = "failure_bits") -> Column:
    """True where no rule of the policy fails."""
    return F.col(bits).bitwiseAND(F.lit(policy.mask).cast("bigint")) == 0


def ablations(ledger_df: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and that would be kept without it.

    One aggregation over the ledger; no groups, so nothing can be skewed."""
    in_policy = F.col("failure_bits").bitwiseAND(F.lit(policy.mask).cast("bigint"))
    count = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    aggs = [F.count(F.lit(1)).alias("n_docs"), count(in_policy == 0).alias("n_kept")]
    names = [(i, name) for i, (name, _) in enumerate(RULES) if name in policy.rules]
    for i, _ in names:
        bit = F.lit(1 << i).cast("bigint")
        aggs += [count(in_policy.bitwiseAND(bit) != 0).alias(f"f{i}"), count(in_policy == bit).alias(f"o{i}")]
    one = ledger_df.agg(*aggs)
    each = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"f{i}").alias("n_failed"), F.col(f"o{i}").alias("n_failed_alone"), (F.col("n_kept") + F.col(f"o{i}")).alias("n_kept_without")) for i, name in names])
    return one.select("n_docs", "n_kept", F.explode(each).alias("r")).select(F.lit(policy.name).alias("policy"), "n_docs", "n_kept", "r.*")


def kept_documents(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that the policy keeps, as they are.

    Not a filter on the verdict: Spark would push that below the measurements and write their expressions out in it
    again and again. An array of no or one row is opened instead."""
    judged = ledger(docs, carry=True)
    row = F.when(verdict(POLICIES[policy]), F.array(F.col(common.ROW))).otherwise(F.array().cast(judged.select(F.array(common.ROW)).schema[0].dataType))
    return common.unpacked(judged.select(F.explode(row).alias(common.ROW)), docs)


def query(spark, sf_dir):
    """op8: the ledger of all documents with the base rules' and the current policy's verdicts."""
    df = ledger(common.documents(spark, sf_dir))
    base = F.col("failure_bits").bitwiseAND(F.lit(POLICIES["base"].mask).cast("bigint")) != 0
    return df.select("doc_id", *MEASURES, base.alias("base_failed"), (~base & verdict(POLICIES[CURRENT])).alias("kept"), "failure_bits")


_BITS = " + ".join(f"CASE WHEN {fails} THEN {1 << i} ELSE 0 END" for i, (_, fails) in enumerate(RULES))
SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM d
), win AS (
  SELECT doc_id, i, list_slice(w, i, i + 7) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS r
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
         CAST(length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_upper,
         CAST(length(regexp_replace(t, '[^0-9]+', '', 'g')) AS BIGINT) AS n_digits
  FROM w LEFT JOIN rep USING (doc_id)
), b AS (
  SELECT *, CAST({_BITS} AS BIGINT) AS failure_bits FROM m
)
SELECT doc_id, {", ".join(MEASURES)}, (failure_bits & {POLICIES["base"].mask}) <> 0 AS base_failed,
       (failure_bits & {POLICIES["base"].mask | POLICIES[CURRENT].mask}) = 0 AS kept, failure_bits
FROM b
"""
