"""Sharding by jump consistent hashing: a stable key and the number of shards
decide a row's shard, without a table of the ring; appending a shard moves
only the rows that the new shard takes.

Defined cases: a null key counts as 0; a null text has no bytes; repeated
rows share a shard and take slots of their own; an empty table gives no rows;
string keys are hashed to 64 bits first; extra columns are ignored (or
carried along by ``to_shards``)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, in_order, running_total, text_crc

#: multiplier of the published linear congruential generator (fixed value)
_STEP = np.uint64(2862933555777941757)


def jump(key: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key."""
    key = key.astype(np.int64).view(np.uint64).copy()
    shard, ahead = np.full(len(key), -1, np.int64), np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        shard[live] = ahead[live]
        key[live] = key[live] * _STEP + np.uint64(1)
        leap = (shard[live] + 1) * (float(1 << 31) / ((key[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64))
        ahead[live] = leap.astype(np.int64)
        live = live[ahead[live] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Jump hash of a whole-number column (null counts as 0)."""

    @F.pandas_udf("int")
    def assign(k: pd.Series) -> pd.Series:
        return pd.Series(jump(k.to_numpy(np.int64), shards).astype(np.int32))

    return assign(F.coalesce(key.cast("long"), F.lit(0)))


def stable_key(df: DataFrame, name: str) -> Column:
    """Whole numbers as they are, anything else by its 64-bit hash."""
    return F.col(name) if dict(df.dtypes)[name] in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(name)


def to_shards(docs: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """The documents with their ``shard`` (a column of that name is
    replaced); write it with ``partitionBy("shard")`` for a folder a shard."""
    return docs.withColumn("shard", shard_of(stable_key(docs, key), shards))


def shard_table(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus one), text_crc32, shard, grown_shard
    (with one shard more) and slot (gapless from 0 in each shard, by doc_id)."""
    key = stable_key(docs, "doc_id")
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"), text_crc("text").alias("text_crc32"),
        shard_of(key, shards).alias("shard"), shard_of(key, shards + 1).alias("grown_shard"))
    placed = in_order(rows, Scratch(docs.sparkSession, "shards"), "rows", ["shard"], ["doc_id", "text_crc32", "size"])
    placed = running_total(placed.withColumn("one", F.lit(1).cast("long")), "shard", "one", "place")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("place") - 1).alias("slot"), "grown_shard")
