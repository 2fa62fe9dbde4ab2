"""Which raw files a feed has loaded already.

A feed's folder grows by one dated snapshot after another. ``Deliveries``
keeps a table of the files that were loaded (path, length, modification time)
and a manifest of the runs that count. ``pending`` lists the files that no
such run has loaded; only names and sizes are listed, no content is read. A
file that was written anew has another length or time and is pending again.
``done`` records a run's files after its load; a run that fails before that
records nothing, so the next one takes the same files again, once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.diff import new_rows
from .delimited import SNAPSHOT_DATE, snapshot_date
from .manifest import Manifest
from .tables import table_exists

_FILES = "path string, length long, modified timestamp"


class Deliveries:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._runs = Manifest(spark, f"{self.folder}/_runs")

    def loaded(self) -> DataFrame:
        """(path, length, modified) of the files that count as loaded."""
        runs = [r["run"] for r in self._runs.records()]
        table = f"{self.folder}/files"
        if not runs or not table_exists(self.spark, table):
            return self.spark.createDataFrame([], _FILES)
        return self.spark.read.schema(f"{_FILES}, run int").parquet(table).where(F.col("run").isin(runs)).drop("run")

    def pending(self, root: str, glob: str = "*") -> DataFrame:
        """(path, length, modified, file_date) of the files below ``root`` in
        dated folders that no run has loaded. Hidden files are skipped."""
        files = (
            self.spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
            .select("path", "length", F.col("modificationTime").alias("modified"))
        )
        dated = files.where(F.col("path").rlike(SNAPSHOT_DATE) & F.col("path").rlike(r"/[^/._][^/]*$"))
        return new_rows(dated, self.loaded(), ["path", "length", "modified"]).withColumn("file_date", snapshot_date("path"))

    def done(self, files: DataFrame) -> int:
        """Record the files of a run whose load has ended; returns its number."""
        run = Manifest(self.spark, f"{self.folder}/_attempts").commit({})
        files.select("path", "length", "modified", F.lit(run).alias("run")).coalesce(1).write.mode("append").partitionBy("run").parquet(f"{self.folder}/files")
        self._runs.commit({"run": run})
        return run

    def load(self, root: str, action, glob: str = "*"):
        """Run ``action(paths)`` on the pending files and record them once it
        returns. Without pending files nothing is run and None is returned. A
        run's file names are on the driver: one delivery's files."""
        if not table_exists(self.spark, root):
            return None
        rows = self.pending(root, glob).select("path", "length", "modified").collect()
        if not rows:
            return None
        result = action([r.path for r in rows])
        self.done(self.spark.createDataFrame(rows, _FILES))
        return result
