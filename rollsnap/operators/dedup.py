"""De-duplication and ranking.

Keep-first / keep-last / latest-per-key use ``row_number() == 1`` over a
window. Spark rewrites that filter into a ``WindowGroupLimit`` that also runs
*before* the shuffle, so each map task forwards at most one row per key: a
hot key is pre-reduced map-side instead of landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names) -> list[Column]:
    return [F.col(f"`{c}`") if isinstance(c, str) else c for c in names]


def distinct_rows(df: DataFrame) -> DataFrame:
    """A1: whole-row distinct (partial aggregation map-side)."""
    return df.distinct()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(col).distinct()


def first_by_order(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (a total order should
    be given; add tie-breakers)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def latest_per_key(
    df: DataFrame,
    key: str,
    date_col: str,
    tie_breakers: list[str] | None = None,
    bad_dates_last: bool = False,
) -> DataFrame:
    """A2 / O1: one row per key, newest date first.

    Unparseable (null) dates rank *above* every date by default, matching
    the source ordering where the text 'nan' sorts first; set
    ``bad_dates_last=True`` for the sane order. Remaining ties are broken by
    ``tie_breakers`` (default: every other column) so the pick is repeatable.
    """
    d = F.col(f"`{date_col}`")
    first = d.desc_nulls_last() if bad_dates_last else d.desc_nulls_first()
    ties = tie_breakers if tie_breakers is not None else [c for c in df.columns if c not in (key, date_col)]
    return first_by_order(df, [key], [first] + [F.col(f"`{c}`").asc_nulls_first() for c in ties])


def keep_last(df: DataFrame, subset: list[str], position: list[str]) -> DataFrame:
    """A3: keep the **last** row per ``subset`` in file order, where
    ``position`` (e.g. member number, line number) encodes file order."""
    return first_by_order(df, subset, [F.col(f"`{c}`").desc() for c in position])


def keep_first(df: DataFrame, subset: list[str], position: list[str]) -> DataFrame:
    """A4: keep the **first** row per ``subset`` in file order."""
    return first_by_order(df, subset, [F.col(f"`{c}`").asc() for c in position])
