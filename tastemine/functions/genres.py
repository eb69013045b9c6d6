"""Genre parsing and normalisation as pure column expressions.

Every function here returns a ``Column``; nothing leaves the JVM, so the
expressions stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastemine.functions.text import collapse_whitespace, strip_unicode

# Fixed values that must equal the reference: the genre alias table.
GENRE_ALIASES = {
    "sci fi": "science fiction",
    "sci fi fantasy": "science fiction",
    "science fiction": "science fiction",
}
# Separators of free-text genre lists: comma, pipe, semicolon, slash.
SPLIT_PATTERN = r"[,|;/]"
# Notebook variant: pipe first, otherwise the other three.
NOTEBOOK_SPLIT_PATTERN = r"[,;/]"


def canonical_genre(name: Column) -> Column:
    """strip, lower, ``_``/``-`` to space, collapse whitespace, alias.

    A final strip is applied so that ``"-drama"`` and ``"drama"`` agree.
    """
    x = F.translate(F.lower(strip_unicode(name)), "_-", "  ")
    x = strip_unicode(collapse_whitespace(x))
    # the aliases of a target as one anchored pattern: no second evaluation of x
    for target in dict.fromkeys(GENRE_ALIASES.values()):
        keys = "|".join(k for k, v in GENRE_ALIASES.items() if v == target and k != v)
        if keys:
            x = F.regexp_replace(x, f"^(?:{keys})$", target)
    return x


def _list_json(raw: Column) -> Column:
    """JSON / Python-literal list -> array<string>; only bracketed text is
    handed to the JSON parser (a failed parse per row is expensive)."""
    return F.when(raw.startswith("["), F.from_json(raw, "array<string>"))


def _dict_name(e: Column) -> Column:
    # JSON text of a dict element -> its "name" (null when absent).
    return F.get_json_object(e, "$.name")


def _split_text(raw: Column, pattern: str = SPLIT_PATTERN) -> Column:
    parts = F.transform(F.split(raw, pattern), strip_unicode)
    return F.filter(parts, lambda p: p != "")


def parse_genres_clean(value: Column) -> Column:
    """F2 (cleaning variant).

    A JSON or Python-literal list keeps every truthy element (dicts by their
    ``name``; a dict without a name voids the list parse); anything else is
    split on ``, | ; /``. ``'[]'`` parses to an empty list.
    """
    raw = strip_unicode(value)
    return _clean_from(raw, _list_json(raw))


def _clean_from(raw: Column, arr: Column) -> Column:
    truthy = F.filter(arr, lambda e: e.isNotNull() & ~e.isin("", "{}", "[]"))
    nameless = F.exists(truthy, lambda e: e.startswith("{") & _dict_name(e).isNull())
    from_list = F.transform(
        truthy, lambda e: canonical_genre(F.when(e.startswith("{"), _dict_name(e)).otherwise(e))
    )
    from_text = F.transform(_split_text(raw), canonical_genre)
    empty = F.array().cast("array<string>")
    return (
        F.when(raw.isNull() | (raw == ""), empty)
        .when(arr.isNotNull() & ~F.coalesce(nameless, F.lit(False)), from_list)
        .otherwise(from_text)
    )


def parse_genres_transform(value: Column) -> Column:
    """F3 (transform variant, the engine default).

    List elements that are strings or dicts with a truthy ``name`` are kept
    (blank results dropped); when that leaves nothing, the text is stripped of
    brackets, split on ``, | ; /``, and each part stripped of quotes.
    """
    raw = strip_unicode(value)
    return _transform_from(raw, _list_json(raw))


def _transform_from(raw: Column, arr: Column) -> Column:
    names = F.transform(
        F.filter(arr, lambda e: e.isNotNull() & ~e.startswith("[")),
        lambda e: F.when(e.startswith("{"), _dict_name(e)).otherwise(e),
    )
    from_list = F.filter(F.transform(names, canonical_genre), lambda g: g.isNotNull() & (g != ""))
    text = F.regexp_replace(raw, r"^[\[\]]+|[\]\[]+$", "")
    parts = F.transform(
        F.split(text, SPLIT_PATTERN),
        lambda p: F.regexp_replace(strip_unicode(p), r"^[\"']+|[\"']+$", ""),
    )
    from_text = F.filter(F.transform(F.filter(parts, lambda p: p != ""), canonical_genre), lambda g: g != "")
    empty = F.array().cast("array<string>")
    return (
        F.when(raw.isNull() | (raw == ""), empty)
        .when(F.size(from_list) > 0, from_list)
        .otherwise(from_text)
    )


def parse_genres_notebook(value: Column) -> Column:
    """F4 (notebook variant): split on ``|`` when present, else on ``, ; /``."""
    raw = strip_unicode(value)
    parts = F.when(raw.contains("|"), _split_text(raw, r"\|")).otherwise(
        _split_text(raw, NOTEBOOK_SPLIT_PATTERN)
    )
    return F.when(raw.isNull() | (raw == ""), F.array().cast("array<string>")).otherwise(
        F.transform(parts, canonical_genre)
    )


PARSERS = {
    "clean": parse_genres_clean,
    "transform": parse_genres_transform,
    "notebook": parse_genres_notebook,
}


def with_parsed_genres(df, src: str, out: str, variant: str = "transform"):
    """Append ``out`` = parsed genre list of ``src``. The stripped text and its
    JSON parse are staged as columns first, so each is evaluated once per row
    (conditional branches get no common-subexpression elimination)."""
    if variant == "notebook":
        return df.withColumn(out, parse_genres_notebook(F.col(src).cast("string")))
    staged = df.withColumn("_graw", strip_unicode(F.col(src).cast("string")))
    staged = staged.withColumn("_garr", _list_json(F.col("_graw")))
    build = _clean_from if variant == "clean" else _transform_from
    return staged.withColumn(out, build(F.col("_graw"), F.col("_garr"))).drop("_graw", "_garr")


def genre_columns(genres_list: Column, missing: Column | None = None) -> dict[str, Column]:
    """First genre (``missing`` when empty) and the number of genres."""
    first = F.get(genres_list, 0)
    if missing is not None:
        first = F.coalesce(first, missing)
    return {"primary_genre": first, "genre_count": F.size(genres_list).cast("int")}


def to_json_list(arr: Column) -> Column:
    """F5 encode: array -> JSON text."""
    return F.to_json(arr)


def from_json_list(text: Column) -> Column:
    """F5 decode: JSON text -> array<string> (null text -> empty list)."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def display_genres(genres: Column, limit: int = 3) -> Column:
    """drop pseudo-genres ``count``/``count_scaled``, ``_`` -> space, title case, first N."""
    kept = F.filter(genres, lambda g: ~g.isin("count", "count_scaled"))
    pretty = F.transform(kept, lambda g: F.initcap(F.regexp_replace(g, "_", " ")))
    return F.slice(pretty, 1, limit)
