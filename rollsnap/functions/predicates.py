"""Row predicates (F1-F3, F5-F7) as boolean columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The sentinel id, and the homeless-address tests in their
# original order as (test, pattern). 'contains' ignores case, 'startswith'
# is case-sensitive.
# ---------------------------------------------------------------------------
SENTINEL_ID = "ACP"
HOMELESS_TESTS = [
    ("startswith", "00"),
    ("contains", "@"),
    ("contains", "PARKING "),
    ("contains", "Lot "),
    ("contains", "AROUND "),
    ("contains", " & "),
    ("contains", "SAFE CAMP"),
    ("contains", "CORNER OF "),
    ("contains", "BETWEEN "),
    ("startswith", "NEAR "),
    ("startswith", "0 "),
    ("startswith", "HOSELESS "),
    ("startswith", "HOMELESS "),
    ("startswith", "BEHIND "),
]
SECOND_LINE_LITERAL = " AND "
CONFIDENTIAL_VALUE = "Confidential"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_sentinel(c, sentinel: str = SENTINEL_ID) -> Column:
    """``id != sentinel`` keeping null ids (a plain ``<>`` drops them)."""
    return ~_c(c).eqNullSafe(F.lit(sentinel))


def in_codes(c, codes) -> Column:
    """membership in a code list; null is not a member (null in a
    filter drops the row). Kept a bare ``IN`` so it pushes into the scan."""
    return _c(c).isin(*codes)


def present(c) -> Column:
    """not null (an empty string passes)."""
    return _c(c).isNotNull()


def pattern_flag(cols, tests=HOMELESS_TESTS) -> Column:
    """OR of (startswith | contains) tests over several columns.

    'contains' tests ignore case. For ASCII-only text (byte length = char
    length) that is exactly ``lower(text)`` containing the lower-cased
    pattern - a plain byte search; any other text goes through one
    case-insensitive, Unicode-aware regular expression of all patterns.
    'startswith' tests stay case-sensitive prefix checks. Null never matches.
    """
    contains = [p for kind, p in tests if kind == "contains"]
    starts = [p for kind, p in tests if kind == "startswith"]
    # the byte-search path is exact only for plain ASCII literals
    ascii_ok = all(p.isascii() and not any(ch in p for ch in ".^$*+?{}[]\\|()") for p in contains)
    terms: list[Column] = []
    for c in cols:
        col = _c(c)
        if contains:
            regex = col.rlike("(?iu)" + "|".join(contains))
            if ascii_ok:
                low = F.lower(col)
                fast = reduce(lambda a, b: a | b, [low.contains(p.lower()) for p in contains])
                regex = F.when(F.octet_length(col) == F.length(col), fast).otherwise(regex)
            terms.append(regex)
        terms.extend(col.startswith(p) for p in starts)
    return F.coalesce(reduce(lambda a, b: a | b, terms), F.lit(False))


def contains_literal(c, text: str = SECOND_LINE_LITERAL) -> Column:
    """case-sensitive literal containment; null never matches."""
    return F.coalesce(_c(c).contains(text), F.lit(False))


def equals_flag(c, value: str = CONFIDENTIAL_VALUE) -> Column:
    """equality flag; null is false."""
    return F.coalesce(_c(c) == F.lit(value), F.lit(False))
