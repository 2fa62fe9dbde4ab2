"""Corpus pipeline: quality rules, near-copy removal, benchmark
decontamination, mixing and sharding of ``documents``.

Every stage takes (spark, docs, sf_dir), reads whatever the stage before kept
and returns a DataFrame that is written as Parquet and read again as the next
one's documents. All but the last return the columns of ``documents``; the
last adds the shard."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollsnap.llm import jaccard, mixing, positional, quality_rules, sharding
from rollsnap.llm.common import Scratch, table
from rollsnap.session import ship_package

SHARDS = 16


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep (operator 10)."""
    ship_package(spark)
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 9)."""
    ship_package(spark)
    return jaccard.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark (operator 7)."""
    ship_package(spark)
    return positional.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (operator 5)."""
    ship_package(spark)
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard (operator 2)."""
    ship_package(spark)
    return sharding.to_shards(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good),
    ("ngram_jaccard", unique),
    ("decontamination", clean),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: trees fitted to labels decide the first stage: no SQL gives its rows
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables are deleted once the
    next stage is written."""
    scratch, docs, last = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if last:
            scratch.drop(last)
        last = name
    return docs
