"""A keyed store of a base and deltas.

A store is a folder: a bucketed ``base`` table with one row per key, a
bucketed ``deltas`` table to which every delivery adds only what it changes,
and a manifest that names the deliveries that count. A reader merges on read:
base rows whose key no delta holds, and per key the winner of the deltas. Both
tables are bucketed by the key, so the merge shuffles nothing, whatever the
base's size; a delivery that touches one row in a hundred writes about one
row in a hundred. ``compact`` folds the deltas into a new base on demand.

Two rules say which row of a key wins:

* ``last``: the row of the latest delivery, within one the last in ``order``;
* ``least``: the row with the smallest value of ``by`` (a date), whatever the
  order of deliveries, so a late back-fill of an older snapshot corrects the
  ledger. Only rows that improve on the store are written.

Rows without a key (a null in it) are no document's later version: under
``last`` all are kept; under ``least`` nulls in the key match nulls, as a
grouped minimum treats them.

A delivery counts once its manifest record is there. One that died leaves
rows whose number no record names; it can simply be run again.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.metrics import observe_rows, observed_rows
from ..session import delete_path
from . import bucketed
from .manifest import Manifest
from .sinks import keyed_upsert

#: number of the delivery that wrote a row
RUN = "__run"


class KeyedStore:
    def __init__(self, spark: SparkSession, root: str, state: dict):
        self.spark, self.root, self.state = spark, root.rstrip("/"), state
        self.key, self.schema = state["key"], T.StructType.fromJson(state["schema"])

    @classmethod
    def create(cls, spark: SparkSession, root: str, schema: T.StructType, key: list[str], least: str | None = None,
               buckets: int | None = None) -> KeyedStore:
        """A new, empty store of rows of ``schema``. ``least`` names the
        column whose smallest value wins; without it the last row wins."""
        n = int(buckets or spark.conf.get("spark.sql.shuffle.partitions"))
        state = {"key": list(key), "least": least, "buckets": n, "schema": schema.jsonValue(), "base": None, "deltas": "deltas-0", "runs": []}
        if Manifest(spark, f"{root.rstrip('/')}/_state").newest() is not None:
            raise ValueError(f"there is a store in {root} already")
        Manifest(spark, f"{root.rstrip('/')}/_state").commit(state)
        return cls(spark, root, state)

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> KeyedStore | None:
        """The store in ``root`` as it stands now; None if there is none."""
        state = Manifest(spark, f"{root.rstrip('/')}/_state").newest()
        return cls(spark, root, state) if state else None

    @classmethod
    def of(cls, df: DataFrame, root: str, key: list[str], least: str | None = None) -> KeyedStore:
        """The store in ``root``, created for rows like ``df`` if there is none."""
        return cls.open(df.sparkSession, root) or cls.create(df.sparkSession, root, df.schema, key, least)

    # ------------------------------------------------------------------ tables
    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(RUN, T.IntegerType())])

    def _part(self, name: str) -> tuple:
        return f"{self.root}/{name}", self._stored(), self.key, self.state["buckets"]

    def _base(self) -> DataFrame | None:
        return bucketed.rows_of(self.spark, *self._part(self.state["base"])) if self.state["base"] else None

    def _deltas(self) -> DataFrame:
        return bucketed.rows_of(self.spark, *self._part(self.state["deltas"])).where(F.col(RUN).isin(self.state["runs"]))

    def _keys(self) -> list[Column]:
        return [F.col(f"`{k}`") for k in self.key]

    def _winners(self, rows: DataFrame) -> DataFrame:
        """One row per key of ``rows`` (with their run)."""
        least = self.state["least"]
        rest = [F.col(f"`{f.name}`").asc_nulls_last() for f in self.schema.fields if f.name not in self.key]
        order = [F.col(f"`{least}`").asc_nulls_last(), F.col(RUN)] if least else [F.col(RUN).desc()]
        w = Window.partitionBy(*self._keys()).orderBy(*order, *rest)
        first = rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
        if least:
            return first
        nameless = functools.reduce(lambda a, b: a | b, [k.isNull() for k in self._keys()])
        return first.where(~nameless).unionByName(rows.where(nameless))

    def _merged(self) -> DataFrame:
        """All rows that hold, with their run."""
        base, top = self._base(), self._winners(self._deltas())
        if base is None:
            return top
        if not self.state["runs"]:
            return base
        if self.state["least"]:
            return self._winners(base.unionByName(self._deltas()))
        newer = self._deltas().select(*[k.alias(f"__k{i}") for i, k in enumerate(self._keys())])
        same = functools.reduce(lambda a, b: a & b, [k == F.col(f"__k{i}") for i, k in enumerate(self._keys())])
        return base.join(newer, same, "left_anti").unionByName(top)

    def read(self) -> DataFrame:
        """The store's rows, merged."""
        return self._merged().select(*[f"`{f.name}`" for f in self.schema.fields])

    # ------------------------------------------------------------------ deliveries
    def upsert(self, new: DataFrame, order: list[str] | None = None) -> int:
        """Add one delivery. ``order`` (rule ``last``) names the columns that
        tell which row of a key is the later one; they are not stored. Returns
        the rows written."""
        run = Manifest(self.spark, f"{self.root}/_attempts").commit({})
        if self.state["least"]:
            change = self._improving(new.select(*[f"`{f.name}`" for f in self.schema.fields]))
        else:
            change = keyed_upsert(None, new, self.key, order or [])
        change, seen = observe_rows(change.withColumn(RUN, F.lit(run)), f"store-{run}")
        bucketed.add(change, *self._part(self.state["deltas"]))
        self._commit({**self.state, "runs": [*self.state["runs"], run]})
        return observed_rows(seen)

    def _improving(self, new: DataFrame) -> DataFrame:
        """Per key the least row of ``new``, where the store has none as small."""
        first = self._winners(new.withColumn(RUN, F.lit(0))).drop(RUN)
        if not (self.state["runs"] or self.state["base"]):
            return first
        least = f"`{self.state['least']}`"
        old = self.read().select(*[k.alias(f"__k{i}") for i, k in enumerate(self._keys())], F.col(least).alias("__least"))
        same = functools.reduce(lambda a, b: a & b, [k.eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(self._keys())])
        no_worse = F.col("__least") <= F.col(least)
        return first.join(old, same & (no_worse | F.col(least).isNull()), "left_anti")

    # ------------------------------------------------------------------ upkeep
    def compact(self) -> None:
        """Fold the deltas into a new base. Readers of the old tables are
        not disturbed; ``vacuum`` deletes them later."""
        run = Manifest(self.spark, f"{self.root}/_attempts").commit({})
        bucketed.add(self._merged(), *self._part(f"base-{run}"))
        self._commit({**self.state, "base": f"base-{run}", "deltas": f"deltas-{run}", "runs": []})

    def vacuum(self) -> None:
        """Delete the tables of earlier bases: no reader may still hold one."""
        keep = {self.state["base"], self.state["deltas"]}
        for state in Manifest(self.spark, f"{self.root}/_state").records():
            for name in {state["base"], state["deltas"]} - keep - {None}:
                delete_path(self.spark, f"{self.root}/{name}")

    def _commit(self, state: dict) -> None:
        Manifest(self.spark, f"{self.root}/_state").commit(state)
        self.state = state
