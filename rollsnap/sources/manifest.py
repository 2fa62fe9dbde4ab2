"""Numbered manifests: how a folder's state moves from one complete version to
the next.

A manifest is a folder of small numbered JSON records. A record is written
under a hidden name and renamed to its number when it is whole, so a reader
sees either the old newest record or the new one, never half of one and never
none. Whatever a run wrote before its record counts only once the record is
there; a run that died leaves files that no record names. Writers of one
folder take turns (one job per table), readers need no turn.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

_RECORD = re.compile(r"(\d{9})\.json")


class Manifest:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def numbers(self) -> list[int]:
        """Numbers of all records, ascending."""
        if not self._fs.exists(self._root):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(self._root))
        return sorted(int(m[1]) for n in names if (m := _RECORD.fullmatch(n)))

    def read(self, number: int) -> dict | None:
        """One record; None if it is not whole (a file system whose rename
        is a copy can leave such a file behind)."""
        stream = self._fs.open(self._path(f"{number:09d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def newest(self) -> dict | None:
        """The newest whole record."""
        for n in reversed(self.numbers()):
            if (record := self.read(n)) is not None:
                return record
        return None

    def records(self) -> list[dict]:
        """All whole records, oldest first."""
        return [r for n in self.numbers() if (r := self.read(n)) is not None]

    def commit(self, record: dict) -> int:
        """Add ``record`` as the newest one; returns its number."""
        number = max(self.numbers(), default=0) + 1
        draft, final = self._path(f".draft-{uuid.uuid4().hex}"), self._path(f"{number:09d}.json")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(record), "utf-8"))
        finally:
            stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise RuntimeError(f"record {number} of {self.folder} was taken by another writer")
        return number
