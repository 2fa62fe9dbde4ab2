"""Delimited-file scans.

Raw extracts are read as all-string tables straight from their header line:
no schema inference, so ids and ZIP codes keep their leading zeros. Spark's
CSV reader takes the column names from *one* file and binds every other file
by position; files of one folder whose headers differ would silently swap
columns. So files are grouped by header line, each group is read on its own,
and the groups are combined with ``unionByName(allowMissingColumns=True)``.
"""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_ws
from ..operators.project import resolve_contract
from ..operators.reshape import union_by_name

# ---------------------------------------------------------------------------
# Fixed value: the name of a snapshot folder (2024_01_02 or 2024-01-02, also
# as the value of a partition folder).
# ---------------------------------------------------------------------------
SNAPSHOT_DATE = r"/(?:[^/=]+=)?(\d{4}[_-]\d{2}[_-]\d{2})(?=/)"
# ---------------------------------------------------------------------------
PEEK_THREADS = 16


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Expand a glob to data files (hidden and ``_`` files skipped); only
    file *names* reach the driver."""
    fs, p = _hadoop_fs(spark, pattern)
    stats = fs.globStatus(p) or []
    out: list[str] = []
    for st in stats:
        if st.isDirectory():
            for child in fs.listStatus(st.getPath()):
                name = child.getPath().getName()
                if child.isFile() and not name.startswith((".", "_")):
                    out.append(child.getPath().toString())
        elif not st.getPath().getName().startswith((".", "_")):
            out.append(st.getPath().toString())
    return sorted(out)


def header_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    """First line of one file (reads a few bytes, never the file)."""
    jvm = spark.sparkContext._jvm
    fs, p = _hadoop_fs(spark, path)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding))
        line = reader.readLine() or ""
    finally:
        stream.close()
    return line.lstrip("﻿").rstrip("\r")


def header_lines(spark: SparkSession, files: list[str], encoding: str = "UTF-8") -> dict[str, str]:
    """Header line of every file, peeked through Spark's file system by a few
    threads (an object store answers each open slowly); only (path, header)
    pairs are held, one per raw file."""
    with ThreadPoolExecutor(PEEK_THREADS) as pool:
        return dict(zip(files, pool.map(lambda f: header_line(spark, f, encoding), files)))


def read_delimited(
    spark: SparkSession,
    paths: list[str] | str,
    sep: str = ",",
    encoding: str = "UTF-8",
    with_path: bool = False,
    contract: dict[str, list[str]] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All files of one (or many) snapshot folders as one all-string
    table, bound by header name. With ``contract`` (P1) each header group is
    projected on its own, so the alias chosen follows each file's order.
    Quoted fields may hold the separator and doubled quotes; with
    ``multi_line`` also line ends (such files are read whole by one task)."""
    files = list_files(spark, paths) if isinstance(paths, str) else list(paths)
    if not files:
        raise FileNotFoundError(f"no files under {paths}")
    groups: dict[str, list[str]] = defaultdict(list)
    for f, h in header_lines(spark, files, encoding).items():
        groups[h].append(f)
    frames = []
    for files_ in groups.values():
        df = (
            spark.read.option("header", True)
            .option("sep", sep)
            .option("encoding", encoding)
            .option("inferSchema", False)
            .option("mode", "PERMISSIVE")
            .option("quote", '"')
            .option("escape", '"')
            .option("multiLine", multi_line)
            .csv(files_)
        )
        path_col = F.col("_metadata.file_path")
        if contract:
            df = _project_with_path(df, contract, with_path)
        elif with_path:
            df = df.withColumn("_source_path", path_col)
        frames.append(df)
    return union_by_name(frames)


def _project_with_path(df: DataFrame, contract, with_path: bool) -> DataFrame:
    mapping = resolve_contract(df.columns, contract)
    cols = [strip_ws(F.col(f"`{src}`")).alias(t) for t, src in mapping.items()]
    if with_path:
        cols.append(F.col("_metadata.file_path").alias("_source_path"))
    return df.select(*cols)


def snapshot_date(path_col) -> "F.Column":
    """The date of the snapshot folder of a file (``2024_01_02`` or
    ``2024-01-02``; the innermost one) as DATE, null without such a folder."""
    c = F.col(path_col) if isinstance(path_col, str) else path_col
    txt = F.regexp_replace(F.get(F.reverse(F.regexp_extract_all(c, F.lit(SNAPSHOT_DATE), F.lit(1))), F.lit(0)), "_", "-")
    return F.try_to_date(txt, "yyyy-MM-dd")


def read_snapshots(spark: SparkSession, root_glob: str | list[str], sep: str = ",", encoding: str = "UTF-8",
                   contract: dict[str, list[str]] | None = None) -> DataFrame:
    """Every dated snapshot under ``root_glob`` (e.g. ``raw/*/omv``, or
    a list of files) in **one** job, each row tagged with ``file_date`` from its folder name.
    Files outside a dated folder belong to no snapshot and are skipped."""
    df = read_delimited(spark, root_glob, sep, encoding, with_path=True, contract=contract)
    return df.withColumn("file_date", snapshot_date("_source_path")).where("file_date IS NOT NULL").drop("_source_path")
