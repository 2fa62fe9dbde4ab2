"""Insert-only diffs and ledgers.

A diff is a null-safe LEFT ANTI equi-join: Spark keeps it a shuffled
(or broadcast) hash / sort-merge join, never a nested loop. Only the key
columns of the existing side are read; an anti-join needs no de-duplication
of them.
AQE's skew-join handling splits a hot key on the new side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _null_safe_on(new: DataFrame, old: DataFrame, keys: list[str]):
    return reduce(lambda a, b: a & b, [new[f"`{k}`"].eqNullSafe(old[f"`{k}`"]) for k in keys])


def new_rows(new: DataFrame, existing: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Rows of ``new`` whose ``on`` values (default: all columns) are
    not in ``existing``. Null matches null; duplicates inside ``new`` are all
    kept (bag semantics on the new side)."""
    keys = on or new.columns
    old = existing.select(*[F.col(f"`{k}`") for k in keys])
    return new.join(old, _null_safe_on(new, old, keys), "left_anti")


def new_keys(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Like ``new_rows`` on a key subset; non-key columns of ``new``
    (e.g. its file date) survive unchanged."""
    return new_rows(new, existing, on=keys)


def first_seen(snapshots: DataFrame, keys: list[str], date_col: str = "file_date") -> DataFrame:
    """A9 (batch form): the first snapshot date each key appears in - the
    ledger an ordered sequence of J2 appends produces. Partial aggregation
    collapses hot keys before the shuffle."""
    return snapshots.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(date_col).alias(date_col))

