"""Projections (P1-P3, P6-P8) and blank filling.

Contract resolution runs on the driver over column *names* only; the data
plan is a single ``select`` that Catalyst can prune and push through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_ws


class BrokenContract(ValueError):
    """A contract target has none of its aliases in the frame's header."""


def resolve_contract(columns: list[str], contract: dict[str, list[str]]) -> dict[str, str]:
    """Map every contract target to the first matching header **in file
    column order** (not alias order); raise when a target has no match."""
    resolved: dict[str, str] = {}
    for target, aliases in contract.items():
        wanted = set(aliases)
        hits = [c for c in columns if c in wanted]
        if not hits:
            raise BrokenContract(
                f"no header among {columns} serves {target} (one of {aliases})"
            )
        resolved[target] = hits[0]
    return resolved


def contract_project(df: DataFrame, contract: dict[str, list[str]], strip: bool = True) -> DataFrame:
    """Keep one stripped column per contract target, drop the rest."""
    mapping = resolve_contract(df.columns, contract)
    cols = []
    for target, source in mapping.items():
        c = F.col(f"`{source}`")
        cols.append((strip_ws(c) if strip else c).alias(target))
    return df.select(*cols)


def final_projection(df: DataFrame, columns: list[str]) -> DataFrame:
    """Ordered final projection."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Column rename (missing sources are ignored)."""
    return df.withColumnsRenamed(mapping)


def with_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Constant columns (state code, file date, election date ...).
    ``datetime.date`` values become DATE literals."""
    cols: dict[str, Column] = {}
    for name, v in values.items():
        cols[name] = v if isinstance(v, Column) else F.lit(v)
    return df.withColumns(cols)


def fill_blank(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing text becomes '' (string columns only)."""
    return df.na.fill("", subset=columns) if columns else df.na.fill("")


def typed_projection(
    df: DataFrame, types: dict[str, tuple[str, int | None]], columns: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Cast to the output SQL types and check string lengths.

    Returns ``(good, rejects)``; a row is rejected when a non-null value does
    not cast or a string exceeds its declared length. ``rejects`` carries the
    raw values plus a ``reject_reason`` column. Both come from one scan when
    the caller caches or writes them together.
    """
    typed, problems = [], []
    for c in columns:
        kind, length = types[c]
        raw = F.col(f"`{c}`")
        if kind == "string":
            v = raw.cast("string")
            if length:
                problems.append(F.when(F.length(v) > length, F.lit(f"{c}: longer than {length}")))
        else:
            v = raw.try_cast(kind)
            problems.append(F.when(raw.isNotNull() & v.isNull(), F.lit(f"{c}: not a {kind}")))
        typed.append(v.alias(c))
    reason = F.concat_ws("; ", *problems) if problems else F.lit("")
    checked = df.select(*[F.col(f"`{c}`") for c in columns]).withColumn("reject_reason", reason)
    good = checked.where(F.col("reject_reason") == "").select(*typed)
    rejects = checked.where(F.col("reject_reason") != "")
    return good, rejects


def fixed_sample(df: DataFrame, n: int, seed: int = 42, keys: list[str] | None = None,
                 rank: Column | None = None) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), repeatable for a seed.

    Rows are ranked by a seeded 64-bit hash of their key columns (or by the
    given ``rank`` expression), ties broken by the keys; Spark plans
    ``orderBy(...).limit(n)`` as a per-partition top-n followed by a single
    merge of n-row lists, so only n rows per partition move.
    """
    keys = keys or df.columns
    h = rank if rank is not None else F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit(seed))
    return df.orderBy(h, *[F.col(f"`{k}`").asc_nulls_first() for k in keys]).limit(n)


def integer_rank(key, seed: int = 42) -> Column:
    """Seeded multiplicative (Knuth) hash of a non-negative integer key, mod
    2**32 - plain integer arithmetic, so any SQL engine ranks rows alike."""
    c = F.col(key) if isinstance(key, str) else key
    return (c.cast("long") * F.lit(2654435761) + F.lit(seed)) % F.lit(4294967296)
