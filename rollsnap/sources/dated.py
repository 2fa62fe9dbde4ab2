"""K2-K4: a dated table whose dates change atomically.

Every write goes to a folder of its own, ``run=<n>/<date column>=<date>/``; a
manifest says which runs make up each date. Appending adds a run to the dates
it touches, replacing puts one in place of them, ``compact`` rewrites the many
small files of a date as a few. A reader sees the files that its manifest
record names, all of one state: never a date half replaced, never rows both
before and after compaction, and nothing of a run that died. Files that no
newest record names stay until ``vacuum``.

The manifest holds one entry per date and run: dates of elections or
deliveries, thousands at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.diff import new_rows
from ..operators.metrics import observe_rows, observed_rows
from ..session import delete_path, stage
from .manifest import Manifest


class DatedTable:
    def __init__(self, spark: SparkSession, root: str, date_col: str = "file_date"):
        self.spark, self.root, self.date_col = spark, root.rstrip("/"), date_col
        self._manifest = Manifest(spark, f"{self.root}/_state")

    def state(self) -> dict:
        """{"schema": ..., "dates": {date: [runs]}} of now."""
        return self._manifest.newest() or {"schema": None, "dates": {}}

    def read(self, dates: list[str] | None = None) -> DataFrame | None:
        """The rows of the given dates (default all); None if nothing was
        ever written."""
        state = self.state()
        if state["schema"] is None:
            return None
        schema = T.StructType.fromJson(state["schema"])
        wanted = state["dates"] if dates is None else {d: state["dates"][d] for d in dates if d in state["dates"]}
        return self._rows(schema, [(run, d) for d, runs in wanted.items() for run in runs])

    def _rows(self, schema: T.StructType, parts: list[tuple[int, str]]) -> DataFrame:
        names = [f"`{f.name}`" for f in schema.fields]
        if not parts:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/run={run}/{self.date_col}={d}" for run, d in parts]
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths).select(*names)

    def _write(self, df: DataFrame) -> tuple[int, list[str], int]:
        """Write a run: (its number, the dates it holds, rows)."""
        run = Manifest(self.spark, f"{self.root}/_attempts").commit({})
        counted, seen = observe_rows(df, f"run-{run}")
        # rows are dealt by date, so a date is a few files, not one per task
        counted.hint("rebalance", F.col(self.date_col)).write.partitionBy(self.date_col).parquet(f"{self.root}/run={run}")
        written = self.spark.read.option("basePath", f"{self.root}/run={run}").schema(df.schema).parquet(f"{self.root}/run={run}")
        dates = [str(r[0]) if r[0] is not None else "__HIVE_DEFAULT_PARTITION__" for r in written.select(self.date_col).distinct().collect()]
        return run, dates, observed_rows(seen)

    def append(self, df: DataFrame) -> int:
        """K3 / K4: add rows to their dates. Returns the rows added."""
        run, dates, n = self._write(df)
        state = self.state()
        self._manifest.commit({"schema": df.schema.jsonValue(), "dates": {**state["dates"], **{d: [*state["dates"].get(d, []), run] for d in dates}}})
        return n

    def replace(self, df: DataFrame) -> int:
        """K2: the rows become all that their dates hold. Returns their number."""
        run, dates, n = self._write(df)
        self._manifest.commit({"schema": df.schema.jsonValue(), "dates": {**self.state()["dates"], **{d: [run] for d in dates}}})
        return n

    def append_unseen(self, df: DataFrame) -> int:
        """J1 + K4: append the rows that their dates do not hold yet; only
        those dates are read."""
        df = stage(df, "unseen")
        touched = [str(r[0]) if r[0] is not None else "__HIVE_DEFAULT_PARTITION__" for r in df.select(self.date_col).distinct().collect()]
        old = self.read(touched)
        return self.append(df if old is None else new_rows(df, old.select(*df.columns)))

    def compact(self, min_runs: int = 2) -> list[str]:
        """Rewrite the dates that at least ``min_runs`` runs make up, as one
        run. Returns them; rows and readers are the same before and after."""
        state = self.state()
        many = sorted(d for d, runs in state["dates"].items() if len(runs) >= min_runs)
        if many:
            run, _, _ = self._write(self.read(many))
            self._manifest.commit({**state, "dates": {**state["dates"], **{d: [run] for d in many}}})
        return many

    def vacuum(self) -> None:
        """Delete date folders that the newest record no longer names: no
        reader may still hold an earlier one."""
        held = {(run, d) for d, runs in self.state()["dates"].items() for run in runs}
        for record in self._manifest.records():
            for run, d in {(run, d) for d, runs in record["dates"].items() for run in runs} - held:
                delete_path(self.spark, f"{self.root}/run={run}/{self.date_col}={d}")
