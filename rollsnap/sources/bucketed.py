"""Bucketed tables that live in a folder: Spark's own bucketing (files named
by bucket), made known to whichever session opens the folder.

Rows of equal keys lie in one bucket, so joins and aggregations on the key of
tables of one bucket number need no shuffle."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def known(spark: SparkSession, path: str, schema: T.StructType, key: list[str], buckets: int) -> str:
    """The name under which this session's catalog knows the table in ``path``."""
    name = f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{k}`" for k in key)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def add(df: DataFrame, path: str, schema: T.StructType, key: list[str], buckets: int, dealt: bool = False) -> None:
    """Append rows. They are dealt as the buckets are, so a bucket gets one
    file; a bucket without new rows gets none. ``dealt`` says that ``df`` is
    partitioned by the key already."""
    rows = df.select(*[f"`{f.name}`" for f in schema.fields])
    if not dealt:
        rows = rows.repartition(buckets, *[f"`{k}`" for k in key])
    rows.write.insertInto(known(df.sparkSession, path, schema, key, buckets))


def rows_of(spark: SparkSession, path: str, schema: T.StructType, key: list[str], buckets: int) -> DataFrame:
    """The table, with the files that are there now."""
    name = known(spark, path, schema, key, buckets)
    spark.catalog.refreshTable(name)
    return spark.table(name)
