"""Sinks (K1-K9).

Snapshot tables are parquet folders partitioned by their date column:
replacing a dated table is a dynamic partition overwrite, routing rows to
per-election tables is ``partitionBy``, and insert-only loads are appends of
an anti-join result. Every write is a normal Spark job, so a lost executor
only re-runs its tasks.
"""

from __future__ import annotations

import datetime as _dt
import functools
import os
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.diff import new_rows
from ..operators.metrics import observe_rows, observed_rows
from ..session import stage
from .manifest import Manifest
from .tables import table_exists


def write_layer(df: DataFrame, path: str, compression: str = "gzip") -> DataFrame:
    """K1: gzip parquet to a processed / final / working layer; returns the
    written data re-read (so later stages start from the file)."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_snapshot(df: DataFrame, path: str, partition_col: str = "file_date", compression: str = "snappy") -> None:
    """K2: replace the dated table(s) present in ``df``; other dates stay
    untouched (dynamic partition overwrite). Rows are dealt by date first, so
    a date is a few files, not one per task."""
    (
        df.hint("rebalance", F.col(partition_col)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(partition_col)
        .parquet(path)
    )


def append_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K3 / K4: append rows; with ``partition_by`` rows are routed to one
    partition per value (e.g. one per election date), dealt by it first."""
    if partition_by:
        df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("append").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("append").parquet(path)


def read_existing(df: DataFrame, path: str) -> DataFrame | None:
    """The table at ``path`` in the schema of ``df``, also where it has no
    rows (and so no files) yet; None if there is no table."""
    spark = df.sparkSession
    return spark.read.schema(df.schema).parquet(path) if table_exists(spark, path) else None


def append_unseen(new: DataFrame, path: str, on: list[str] | None = None,
                  partition_by: list[str] | None = None) -> int:
    """J1 + K3/K4: append only rows of ``new`` not yet in the table at
    ``path`` (null-safe on ``on``, default all columns). ``new`` is evaluated
    once; of a partitioned table only the touched partitions are read. Returns
    the rows appended."""
    old = read_existing(new, path)
    if old is not None and partition_by:
        new = stage(new, "append")
        old = touched_partitions(old, new, partition_by)
    todo = new if old is None else new_rows(new, old, on)
    todo, obs = observe_rows(todo, "appended")
    append_rows(todo, path, partition_by)
    return observed_rows(obs)


def touched_partitions(old: DataFrame, new: DataFrame, partition_by: list[str]) -> DataFrame:
    """The existing table restricted to the partitions ``new`` writes into: a
    semi-join on the distinct values, by which Spark prunes partitions."""
    t = new.select(*partition_by).distinct().alias("__t")
    cond = [F.col(f"__o.`{c}`").eqNullSafe(F.col(f"__t.`{c}`")) for c in partition_by]
    return old.alias("__o").join(t, cond, "left_semi")


def timestamp() -> str:
    """Seconds since 1970, the name of a drop."""
    return str(int(_dt.datetime.now(_dt.timezone.utc).timestamp()))


def csv_drop(df: DataFrame, folder: str, name: str | None = None) -> str:
    """K5: header-less CSV drop in a timestamp-named subfolder; quotes inside
    a quoted field are doubled."""
    name = name or timestamp()
    out = os.path.join(folder, name)
    df.write.mode("overwrite").option("header", False).option("escape", '"').csv(out)
    return out


def json_lines(df: DataFrame, path: str) -> None:
    """K6: one JSON document per row; null fields are written, not dropped."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def point_current(spark: SparkSession, path: str, date) -> None:
    """K7: make one dated snapshot the current one. The choice is a numbered
    record beside the table (``<path>__current``), so it outlives the session;
    until the new record is whole, readers take the one before."""
    Manifest(spark, f"{path}__current").commit({"date": str(date)})


def current_view(spark: SparkSession, path: str, view: str | None = None, date=None, date_col: str = "file_date") -> DataFrame:
    """K7: the current snapshot. With ``date`` that date becomes current
    first; without, the recorded one is read, or the newest if none ever was.
    ``view`` also names it for this session's SQL."""
    if date is not None:
        point_current(spark, path, date)
    df = spark.read.parquet(path)
    chosen = Manifest(spark, f"{path}__current").newest()
    date = chosen["date"] if chosen else df.agg(F.max(date_col)).first()[0]
    cur = df.where(F.col(date_col) == F.lit(str(date)).cast("date"))
    if view:
        cur.createOrReplaceTempView(view)
    return cur


def keyed_upsert(existing: DataFrame | None, new: DataFrame, key: list[str] | Column, order: list[str]) -> DataFrame:
    """K8: keyed document store semantics - one document per key, the later
    write wins: ``new`` over ``existing``, and within ``new`` the last row in
    ``order`` (columns that tell the order of writing, e.g. member and line
    number; they are not stored). Rows without a key are all kept: they are
    no document's later version. Partial window limits keep one row per key
    per task before the shuffle."""
    keys = [F.col(f"`{k}`") for k in key] if isinstance(key, list) else [key]
    tagged = new.withColumn("__v", F.lit(1)).withColumn("__o", F.struct(*[F.col(f"`{c}`") for c in order], F.lit(0))).drop(*order)
    if existing is not None:
        kind = tagged.schema["__o"].dataType
        tagged = existing.withColumn("__v", F.lit(0)).withColumn("__o", F.lit(None).cast(kind)).unionByName(tagged, allowMissingColumns=True)
    nameless = functools.reduce(lambda a, b: a | b, [k.isNull() for k in keys])
    w = Window.partitionBy(*keys).orderBy(F.col("__v").desc(), F.col("__o").desc())
    named = tagged.where(~nameless).withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    return named.unionByName(tagged.where(nameless)).drop("__v", "__o")


def store_versions(spark: SparkSession, store_root: str) -> list[int]:
    """Complete versions of a store, ascending: folders ``v<number>`` with
    the marker Spark writes when a job has ended."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(store_root)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in (fs.listStatus(root) if fs.exists(root) else []) if st.isDirectory()]
    return sorted(int(n[1:]) for n in names if re.fullmatch(r"v\d+", n) and table_exists(spark, f"{store_root}/{n}/_SUCCESS"))


def read_store(spark: SparkSession, store_root: str) -> DataFrame | None:
    """The newest complete version of a store."""
    versions = store_versions(spark, store_root)
    return spark.read.parquet(f"{store_root}/v{versions[-1]:06d}") if versions else None


def upsert_store(new: DataFrame, store_root: str, key: list[str], order: list[str]) -> DataFrame:
    """K8 as a versioned keyed store: merge ``new`` into the newest complete
    version (later write wins per key) and write the result as the next
    version; a reader of the previous version is never disturbed, and what a
    broken run left behind is overwritten. Returns the new version."""
    spark = new.sparkSession
    versions = store_versions(spark, store_root)
    merged = keyed_upsert(read_store(spark, store_root), new, key, order)
    path = f"{store_root}/v{(versions[-1] if versions else 0) + 1:06d}"
    merged.write.mode("overwrite").parquet(path)
    return spark.read.schema(merged.schema).parquet(path)


def split_rejects(df: DataFrame, valid: Column, quarantine: str) -> tuple[DataFrame, dict[str, int]]:
    """K9: rows failing ``valid`` go to a quarantine folder (JSON lines);
    returns the good rows and the counts ``{"good": n, "rejected": m}``. The
    input is evaluated once."""
    checked = stage(df.withColumn("__ok", F.coalesce(valid, F.lit(False))), "checked")
    bad, rejected = observe_rows(checked.where("NOT __ok").drop("__ok"), "rejected")
    json_lines(bad, quarantine)
    n = observed_rows(rejected)
    return checked.where("__ok").drop("__ok"), {"good": checked.count() - n, "rejected": n}
