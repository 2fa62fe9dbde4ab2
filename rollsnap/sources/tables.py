"""Table scans.

Tables are parquet folders (optionally partitioned by a date column) or
catalog tables; column pruning, predicate pushdown and partition pruning are
Catalyst's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _is_path(name: str) -> bool:
    return "/" in name or ":" in name


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A processed / working / final parquet layer."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None,
               date_cols: tuple[str, ...] = ("election_date", "voted_on_date")) -> DataFrame:
    """An existing table with a column list; named date columns are
    returned as DATE whatever their stored type."""
    df = spark.read.parquet(name) if _is_path(name) else spark.table(name)
    if columns:
        df = df.select(*columns)
    casts = {c: F.col(c).cast("string").try_cast("date") for c in date_cols if c in df.columns}
    return df.withColumns(casts) if casts else df


def read_where(spark: SparkSession, name: str, col: str, value) -> DataFrame:
    """Filtered scan (``WHERE col = value``); prunes partitions when the
    table is partitioned by ``col``."""
    df = spark.read.parquet(name) if _is_path(name) else spark.table(name)
    return df.where(F.col(col) == F.lit(value))


def table_exists(spark: SparkSession, name: str) -> bool:
    """Catalog table or storage path exists."""
    if not _is_path(name):
        return spark.catalog.tableExists(name)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(name)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
