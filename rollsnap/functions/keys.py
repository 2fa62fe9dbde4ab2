"""Key, mark and number column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The mark meaning "ineligible to vote".
# ---------------------------------------------------------------------------
INELIGIBLE_MARK = "ITV"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def link_key(*cols, sep: str = "-") -> Column:
    """Composite key ``a-b-c``; null when any part is null.

    ``concat`` propagates nulls; ``concat_ws`` would silently skip them.
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_c(c))
    return F.concat(*parts)


def mail_key(address, zip_code) -> Column:
    """C17: ``address + ' ' + zip``."""
    return F.concat(_c(address), F.lit(" "), _c(zip_code))


def normalise_mark(c) -> Column:
    """C4: null or any value containing '-' -> 'ITV', otherwise upper case."""
    c = _c(c)
    return F.when(c.isNull() | c.contains("-"), F.lit(INELIGIBLE_MARK)).otherwise(F.upper(c))


def number_or_zero(c) -> Column:
    """C11 / R2: numeric coercion; unparseable, missing or NaN -> 0.0."""
    v = _c(c).cast("string").try_cast("double")
    return F.when(v.isNull() | F.isnan(v), F.lit(0.0)).otherwise(v)
