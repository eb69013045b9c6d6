"""Small scalar helpers (P1, P3, P4, F7-F9, F11, F12) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal Python's str.isspace(): the characters that
# str.strip() removes (ASCII controls 09-0D and 1C-1F, space, U+0085, U+00A0,
# U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
                 + "\u2028\u2029\u202f\u205f\u3000")
WS_CLASS = "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"
# Text that a lenient numeric parser accepts (pandas ``to_numeric``).
NUMERIC_RE = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))$"
# Fixed date formats tried, in order, when a year is not a bare number: year first, month first, day first, and with
# month names (in any case).
DATE_FORMATS = (
    "yyyy-M-d", "yyyy-M-d H:mm:ss", "yyyy-M-d H:mm", "yyyy-M-d'T'HH:mm:ss", "yyyy-M-d'T'HH:mm:ssXXX", "yyyy-M-d'T'HH:mm:ss.SSSXXX",
    "yyyy/M/d", "yyyy/M/d H:mm:ss", "yyyy.M.d", "yyyy-M",
    "M/d/yyyy", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M-d-yyyy",
    "d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "d.M.yyyy H:mm:ss",
    "MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy", "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy", "MMM yyyy", "MMMM yyyy",
)
YEAR_MIN, YEAR_MAX = 1870, 2100


def strip_unicode(c: Column) -> Column:
    """Python ``str.strip()`` semantics (Unicode white space); a plain
    character-set trim, no regular expression."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def collapse_whitespace(c: Column) -> Column:
    """Runs of (Python) white space -> one space."""
    return F.regexp_replace(c, WS_CLASS + "+", " ")


def lenient_double(c: Column, dtype: T.DataType | None = None) -> Column:
    """``to_numeric(errors='coerce')``: bad text -> null, NaN -> null."""
    if dtype is not None and isinstance(dtype, T.NumericType):
        v = c.cast("double")
    else:
        s = strip_unicode(c.cast("string"))
        v = F.when(s.rlike(NUMERIC_RE), s.try_cast("double"))
    return F.when(~F.isnan(v), v)


def standard_year(c: Column, dtype: T.DataType | None = None, date_fallback: bool = True) -> Column:
    """Numeric year in [1870, 2100], else the year of a parsed date, else null.

    Deviation (documented): out-of-range numbers are null instead of the
    epoch-nanosecond reading, and a fixed list of date formats is used.
    """
    num = lenient_double(c, dtype)
    year = F.when(num.between(YEAR_MIN, YEAR_MAX), num)
    if date_fallback:
        s = strip_unicode(c.cast("string"))
        parsed = F.coalesce(*[F.try_to_timestamp(s, F.lit(fmt)) for fmt in DATE_FORMATS])
        # only text with a date separator or a month's name can be a date
        year = F.coalesce(year, F.when(s.rlike("[-/.]|[A-Za-z]{3}"), F.year(parsed).cast("double")))
    return year.cast("int")


def is_blank(c: Column) -> Column:
    """null or only white space."""
    return c.isNull() | (strip_unicode(c.cast("string")) == "")


def is_unknown(c: Column) -> Column:
    """text equal to ``unknown`` ignoring case."""
    return F.lower(c.cast("string")) == "unknown"


def list_text(arr: Column, sep: str = ", ") -> Column:
    """list -> plain text without brackets or quotes."""
    return F.concat_ws(sep, arr)


def rule_label(antecedents: Column, consequents: Column) -> Column:
    """``A, B -> C``."""
    return F.concat(list_text(antecedents), F.lit(" -> "), list_text(consequents))


def quality_label(silhouette: Column) -> Column:
    """three-level label by silhouette (> 0.5 good, > 0.3 medium, else weak)."""
    return F.when(silhouette > 0.5, "good").when(silhouette > 0.3, "medium").otherwise("weak")


def infer_cluster_column(df: DataFrame) -> str:
    """first column whose name contains ``cluster`` or ``label``, else the last."""
    for c in df.columns:
        if "cluster" in c.lower() or "label" in c.lower():
            return c
    return df.columns[-1]


def columns_by_affix(
    columns: list[str], prefix: str = "", suffix: str = "", exclude: tuple[str, ...] = ()
) -> list[str]:
    """P20: columns selected by name prefix / suffix (driver-side, schema only)."""
    return [c for c in columns if c.startswith(prefix) and c.endswith(suffix) and c not in exclude]
