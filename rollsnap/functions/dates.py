"""Date column functions.

Parsing uses ``try_to_date`` so malformed text gives null instead of failing
the job (Spark 4 runs ANSI mode, where ``to_date`` throws).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values used by the birth-date rules.
# ---------------------------------------------------------------------------
GENERIC_BIRTH_YEAR = 1850
BIRTH_RULE_CUTOVER = _dt.date(2017, 3, 4)   # files before this use the date rule
CONFIDENTIAL_EXTRACT = "confidential"       # literal compared in the clean step
CONFIDENTIAL_RESOLVE = "Confidential"       # literal compared in pass 01
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reorder_mdy(c) -> Column:
    """``mm-dd-yyyy`` -> ``yyyy-mm-dd`` by splitting on '-'.

    Exactly three parts are required, parts are not validated; anything
    else (and null) gives null.
    """
    parts = F.split(_c(c), "-")
    return F.when(
        F.size(parts) == 3,
        F.concat_ws("-", parts.getItem(2), parts.getItem(0), parts.getItem(1)),
    )


def parse_mdy(c) -> Column:
    """Lenient ``month-day-year`` parse; padded or unpadded month/day,
    four-digit year. Failure gives null."""
    return F.try_to_date(_c(c), "M-d-yyyy")


def header_to_iso(header: str) -> str | None:
    """An election header ``M/D/YYYY`` (unpadded accepted) to ISO text,
    or None when the header is not a date. Runs on the driver over column
    names only."""
    try:
        return _dt.datetime.strptime(header, "%m/%d/%Y").strftime("%Y-%m-%d")
    except (TypeError, ValueError):
        return None


def lenient_date(c) -> Column:
    """Parse the common textual date layouts (ISO, M/D/YYYY, M-D-YYYY, YYYY)."""
    c = _c(c)
    return F.coalesce(
        F.try_to_date(c, "yyyy-M-d"),
        F.try_to_date(c, "M/d/yyyy"),
        F.try_to_date(c, "M-d-yyyy"),
        F.try_to_date(c, "yyyy"),
    )


def birth_by_date(c) -> Column:
    """C8 (files before the cut-over): lenient date, missing -> 1850-01-01."""
    return F.coalesce(lenient_date(c), F.make_date(F.lit(GENERIC_BIRTH_YEAR), F.lit(1), F.lit(1)))


def birth_year(c, confidential=None, confidential_literal: str = CONFIDENTIAL_EXTRACT) -> Column:
    """C9 (later files): integer birth year.

    Confidential rows, values holding 'X', unparseable or missing values and
    years before 1850 all become 1850. A total function: it never fails.
    """
    c = _c(c)
    year = F.coalesce(c.try_cast("int"), F.lit(GENERIC_BIRTH_YEAR))
    rule = F.when(c.contains("X"), F.lit(GENERIC_BIRTH_YEAR)).otherwise(
        F.greatest(year, F.lit(GENERIC_BIRTH_YEAR))
    )
    if confidential is not None:
        rule = F.when(_c(confidential) == F.lit(confidential_literal), F.lit(GENERIC_BIRTH_YEAR)).otherwise(rule)
    return F.coalesce(rule, F.lit(GENERIC_BIRTH_YEAR)).cast("int")


def age(birth_year_col, as_of_year: int) -> Column:
    """age = as-of year - birth year (as_of_year is explicit so
    re-runs are reproducible)."""
    return (F.lit(as_of_year) - _c(birth_year_col)).cast("int")


def year_only_to_date_text(c) -> Column:
    """A four-character birth value gets '-01-01' appended."""
    c = _c(c)
    return F.when(F.length(c) == 4, F.concat(c, F.lit("-01-01"))).otherwise(c)


def fill_date(c, file_date) -> Column:
    """A missing (unparseable) date becomes the file date."""
    fd = file_date if isinstance(file_date, Column) else F.lit(file_date).cast("date")
    return F.coalesce(_c(c), fd)


def year_of(c) -> Column:
    """Calendar year of a date, as int."""
    return F.year(_c(c)).cast("int")


def format_date(c, layout: str = "yyyy-MM-dd") -> Column:
    """Date to text: 'yyyy-MM-dd', 'yyyy_MM_dd' or 'yyyy.MM.dd'."""
    return F.date_format(_c(c), layout)
