"""Text column functions.

All are Catalyst built-ins (regexp_replace, split, transform, concat_ws ...),
so they stay inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed value: the characters Python's ``str.strip()`` / ``str.split()`` treat
# as whitespace, written as a Java regex character class.
# ---------------------------------------------------------------------------
WS_CLASS = (
    "[\\t\\n\\x0B\\f\\r\\x1C\\x1D\\x1E\\x1F \\x85\\xA0\\u1680"
    "\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"
)
# The same characters as a plain string (a trim set).
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# Same class in RE2 syntax (DuckDB oracle SQL).
WS_CLASS_RE2 = (
    "[\\t\\n\\x0B\\f\\r\\x1C\\x1D\\x1E\\x1F \\x{85}\\x{A0}\\x{1680}"
    "\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
# Token separator of the search analyzer: anything but letters, digits and '_'.
TOKEN_SPLIT = "[^\\p{L}\\p{N}_]+"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Strip leading/trailing whitespace (tabs and Unicode spaces too).

    Plain ``trim`` only removes blanks; ``trim(str, chars)`` strips any
    character of a set natively (no regex per row). Null stays null.
    """
    return F.trim(_c(c), F.lit(WS_CHARS))


def join_nonnull(sep: str, *cols) -> Column:
    """C14: join columns with ``sep``, skipping nulls."""
    return F.concat_ws(sep, *[_c(c) for c in cols])


def truncate_words(c, n: int) -> Column:
    """Cut every whitespace-separated word to ``n`` characters and re-join
    with single blanks. The whole text is processed; null stays null."""
    words = F.split(strip_ws(c), f"{WS_CLASS}+")
    return F.array_join(F.transform(words, lambda w: F.substring(w, 1, n)), " ")


def search_text(*cols) -> Column:
    """Parts joined by single blanks, empty or missing parts kept
    as empty strings (the analyzer later drops the extra blanks)."""
    return F.concat_ws(" ", *[F.coalesce(_c(c), F.lit("")) for c in cols])


def analyze(c) -> Column:
    """C20: search analyzer - lower-cased distinct word tokens.

    Splits on every run of characters that are not letters, digits or '_'
    (a documented simplification of Unicode word segmentation) and drops
    empty pieces; the result is an array<string> (empty for blank text).
    """
    parts = F.split(F.lower(_c(c)), TOKEN_SPLIT)
    return F.array_distinct(F.array_remove(parts, ""))


def upper(c) -> Column:
    """C18 (upper)."""
    return F.upper(_c(c))


def lower(c) -> Column:
    """C18 (lower)."""
    return F.lower(_c(c))
