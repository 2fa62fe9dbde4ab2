"""Reshaping (P4, P5, U1): wide election columns to long form, unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import header_to_iso
from ..functions.keys import normalise_mark


def election_headers(df: DataFrame, id_col: str = "state_voter_id") -> DataFrame:
    """P4 + C4: keep the id plus every ``M/D/YYYY`` column renamed to its ISO
    date, with marks normalised; every other column is dropped.

    Only the header list is inspected (driver side); the data work is one
    projection.
    """
    cols = [F.col(f"`{id_col}`")]
    for h in df.columns:
        if h == id_col:
            continue
        iso = header_to_iso(h)
        if iso is not None:
            cols.append(normalise_mark(F.col(f"`{h}`")).alias(iso))
    return df.select(*cols)


def unpivot_marks(
    df: DataFrame, id_col: str = "state_voter_id", var: str = "election_date", val: str = "voted"
) -> DataFrame:
    """P5: wide -> long ``(id, election_date, voted)``; planned as ``Expand``
    (no shuffle). The header text becomes a DATE."""
    values = [c for c in df.columns if c != id_col]
    if not values:
        return df.select(
            F.col(f"`{id_col}`"), F.lit(None).cast("date").alias(var), F.lit(None).cast("string").alias(val)
        ).limit(0)
    long = df.unpivot([id_col], values, var, val)
    return long.withColumn(var, F.to_date(F.col(var)))


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union of same-feed tables whose columns may differ."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
