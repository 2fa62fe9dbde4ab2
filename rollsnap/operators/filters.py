"""Row filters (F1-F4, F8, F9) over whole frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import VOTERS_ACTIVE_CODES
from ..functions.keys import INELIGIBLE_MARK
from ..functions.predicates import SENTINEL_ID, in_codes, not_sentinel, present


def drop_sentinel(df: DataFrame, id_col: str, sentinel: str = SENTINEL_ID) -> DataFrame:
    """remove sentinel ids, keep null ids."""
    return df.where(not_sentinel(id_col, sentinel))


def keep_codes(df: DataFrame, col: str, codes=VOTERS_ACTIVE_CODES) -> DataFrame:
    """keep rows whose code is in the list (null excluded)."""
    return df.where(in_codes(col, codes))


def keep_present(df: DataFrame, col: str) -> DataFrame:
    """keep rows where ``col`` is not null (empty string passes)."""
    return df.where(present(col))


def clean_roll(
    df: DataFrame,
    id_col: str = "state_voter_id",
    status_col: str = "voter_status",
    precinct_col: str = "precinct",
    codes=VOTERS_ACTIVE_CODES,
) -> DataFrame:
    """F1 + F2 + F3 in one filter (Catalyst pushes it into the scan)."""
    return df.where(not_sentinel(id_col) & in_codes(status_col, codes) & present(precinct_col))


def drop_ineligible(df: DataFrame, mark_col: str = "voted") -> DataFrame:
    """drop normalised 'ITV' marks."""
    return df.where(F.col(mark_col) != F.lit(INELIGIBLE_MARK))


def has_rows(df: DataFrame) -> bool:
    """empty-input guard; reads at most one row."""
    return not df.isEmpty()
