"""What the document operators share: reading the table, words, and carrying whole rows.

An operator never relies on the names of other columns of its input: it works on a frame whose only input columns
are the ones it is told to read and, on request, the whole row in one struct column. Extra columns, whatever their
names, can therefore neither clash with the operator's own columns nor get lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The six ASCII white-space characters that separate words, and a word, as Java regular expressions.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: name of the struct that holds a whole input row while an operator works on it
ROW = "_row"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table; Spark reads it, so any store that Spark can open will do."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(col: str = "text") -> Column:
    """The text as a string, a null text being empty."""
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def packed(docs: DataFrame, carry: bool, **cols: Column) -> DataFrame:
    """``docs`` reduced to ``cols``, and to the whole row in ``_row`` if ``carry``."""
    own = [c.alias(name) for name, c in cols.items()]
    if carry:
        own.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))
    return docs.select(*own)


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """The carried rows as they came, columns in their first order."""
    return df.select(*[F.col(ROW).getField(c).alias(c) for c in like.columns])


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def words(text: Column) -> Column:
    """The words of a text, in order, unchanged."""
    return F.array_remove(F.split(text, SPACE + "+", -1), "")


#: elements added up at a time by ``running``
_GROUP = 64


def running(sizes: Column) -> Column:
    """The sum of the elements before each element of an array of longs.

    Appending to an array copies it, so elements are added up in groups, and the groups in turn: work in proportion to
    the elements for any number that a text can have, not to their square."""
    none = F.array().cast("array<bigint>")

    def add(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def starts(xs: Column) -> Column:
        return F.aggregate(xs, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out")), add)

    def of(xs: Column) -> Column:
        cuts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(xs), F.lit(1)), F.lit(_GROUP)), lambda k: k <= F.size(xs))
        groups = F.transform(cuts, lambda k: starts(F.slice(xs, k, F.lit(_GROUP))))
        return bound(groups, lambda gs: F.flatten(F.zip_with(gs, starts(F.transform(gs, lambda g: g["at"]))["out"], lambda g, at: F.transform(g["out"], lambda x: x + at))))

    return bound(sizes, of)


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` reads it; ``use`` returns an array."""
    return F.flatten(F.transform(F.array(value), use))


def of_kind(spans: str, kind: str) -> Column:
    """The number of spans of a kind in an array of spans."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def listed(spans: Column) -> Column:
    """kind:start:end of spans in their order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
