"""Zip-bundle TSV scans.

A zip is a row of entries, each behind the mark ``PK\\3\\4``. Spark's text
source reads any file in byte ranges, through its own file system, and cuts it
at a given separator; with that mark as separator its records are the entries.
So the members of one bundle are dealt to as many tasks as the bundle has
ranges, whatever its size, and nothing reads a bundle whole. A ``mapInArrow``
helper inflates an entry as a stream and emits one row per record. Everything
after that - binding columns by header name, county, union - is Spark SQL.

The mark can also occur by chance inside an entry's bytes. An entry that then
does not inflate to its end, or a bundle whose entries are not as many as its
directory says, is noticed, and that bundle is read again through its
directory (``binaryFile``, at most 2 GiB).
"""

from __future__ import annotations

import hashlib
import io
import itertools
import struct
import zipfile
import zlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

#: one row per record, and one per entry (line_no -1: its header's fields,
#: the number of entries in its directory if it is the last one)
RECORDS = ("zip_path string, member string, member_no long, line_no int, county string, header_id long, "
           "open_quote boolean, fields array<string>, whole boolean, entries long")
#: fixed values: the mark of an entry, of the directory's end (plain and 64-bit)
ENTRY, END, END_64 = b"PK\x03\x04", b"PK\x05\x06", b"PK\x06\x06"
# Members whose name holds this text are documentation, not data.
README_MARK = "readme"
# Records of one Arrow batch.
RECORDS_PER_BATCH = 20_000
#: a quote still open after so many characters opens no field
OPEN_QUOTE_LIMIT = 1 << 20
INFLATE_STEP = 1 << 18


def newest_per_folder(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """S3: per folder, the bundle with the latest modification time (only
    path and mtime are read - the binary content column is pruned)."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
        .load(root).select("path", "modificationTime")
    )
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return files.groupBy(folder.alias("folder")).agg(
        F.max_by("path", F.struct("modificationTime", "path")).alias("path")
    )


def member_county(name: str) -> str:
    """Text after the last '_' and before the first '.' of the base name."""
    return name.rsplit("/", 1)[-1].rsplit("_", 1)[-1].split(".", 1)[0]


# --------------------------------------------------------------------------- records of a member
def _lines(raw) -> Iterator[str]:
    """Text lines of a member, ended by CR LF, LF or CR and nothing else."""
    for line in io.TextIOWrapper(raw, encoding="utf-8-sig", errors="replace", newline=None):
        yield line[:-1] if line.endswith("\n") else line


def split_fields(text: str, literal: bool = False) -> list[str] | None:
    """Fields of a record; None if a quoted field is still open. A quote opens
    a field only at its start, a doubled quote is one quote, and what follows
    the closing quote belongs to the field. With ``literal`` a quote that
    nothing closes is a character like any other."""
    out, at = [], 0
    while True:
        held, tail = "", at
        if text.startswith('"', at):
            tail = at + 1
            while (q := text.find('"', tail)) >= 0 and text.startswith('"', q + 1):
                held, tail = held + text[tail:q + 1], q + 2
            if q >= 0:
                held, tail = held + text[tail:q], q + 1
            elif literal:
                held, tail = "", at
            else:
                return None
        end = text.find("\t", tail)
        out.append(held + (text[tail:] if end < 0 else text[tail:end]))
        if end < 0:
            return out
        at = end + 1


def _held(source: Iterator[str], ahead: deque) -> str | None:
    """The next line, which is also kept to be read again."""
    if (line := next(source, None)) is not None:
        ahead.append(line)
    return line


def read_records(raw) -> Iterator[tuple[int, list[str], list[str | None], bool]]:
    """(record number, header, fields, open quote) of a tab-separated member.
    Quoted fields may hold tabs and line ends. A quote that nothing closes,
    up to the member's end or ``OPEN_QUOTE_LIMIT`` characters on, is a
    character like any other and its record ends with its line; the lines
    after it are records of their own. Blank lines and records with more
    fields than the header are left out; short records are padded with nulls
    and empty fields are null."""
    source, ahead = _lines(raw), deque()
    header: list[str] | None = None
    no = -1
    while True:
        line = ahead.popleft() if ahead else next(source, None)
        if line is None:
            return
        no += 1
        open_quote, row = False, line.split("\t") if '"' not in line else split_fields(line)
        if row is None:
            parts, size = [line], len(line)
            for more in itertools.chain(list(ahead), iter(lambda: _held(source, ahead), None)):
                parts.append(more)
                size += len(more) + 1
                if '"' in more and (row := split_fields("\n".join(parts))) is not None or size > OPEN_QUOTE_LIMIT:
                    break
            if row is None:
                open_quote, row = True, split_fields(line, literal=True)
            else:
                for _ in parts[1:]:
                    ahead.popleft()
        if not any(row):
            continue
        if header is None:
            header = row
        elif len(row) <= len(header):
            yield no, header, [f or None for f in row] + [None] * (len(header) - len(row)), open_quote


def header_number(header: list[str]) -> int:
    return int.from_bytes(hashlib.blake2b("\t".join(header).encode(), digest_size=8).digest(), "big", signed=True)


_NAMES = [f.split()[0] for f in RECORDS.split(", ")]
_KINDS = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.bool_(), pa.int64()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _NAMES)


def _member_rows(path: str, name: str, member_no: int, raw, entries: int | None, ended) -> Iterator[pa.RecordBatch]:
    """Records of one entry, then the entry's own row; ``ended()`` tells
    whether its bytes were whole."""
    held, header, county, number = [], None, member_county(name), None
    if name.rsplit("/", 1)[-1] and README_MARK not in name:
        try:
            for no, header, fields, open_quote in read_records(raw):
                number = header_number(header) if number is None else number
                held.append((path, name, member_no, no, county, number, open_quote, fields, None, None))
                if len(held) == RECORDS_PER_BATCH:
                    yield _batch(held)
                    held = []
        except (zlib.error, EOFError):
            pass                                         # not whole: the bundle is read again
    held.append((path, name, member_no, -1, county, number, None, header, ended(), entries))
    yield _batch(held)


# --------------------------------------------------------------------------- entries of a bundle
class _Entry(io.RawIOBase):
    """The content of one entry, inflated as it is read. ``data`` starts
    behind the entry's mark and may go on behind the entry."""

    def __init__(self, data: bytes):
        self.name, self.known = "", False
        self._left = self._done = 0
        if len(data) < 26:
            return
        _, flags, self._method, _, _, self._crc, size, full, n_name, n_extra = struct.unpack("<HHHHHIIIHH", data[:26])
        self.name = data[26:26 + n_name].decode("utf-8" if flags & 0x800 else "cp437", "replace")
        self._data, self._at = memoryview(data), 26 + n_name + n_extra
        self._sized, self._size, self._full = not flags & 8 and 0xFFFFFFFF not in (size, full), size, full
        self.known = not flags & 1 and (self._method == 8 or self._method == 0 and self._sized)
        self._inflate = zlib.decompressobj(-15) if self._method == 8 else None
        self._sum, self._ready = 0, b""

    def readable(self) -> bool:
        return True

    def close(self) -> None:
        """Text wrappers close what they read; the entry is read on by ``whole``."""

    def readinto(self, buffer) -> int:
        while not self._ready and not self.ended_stream():
            step = self._data[self._at:self._at + INFLATE_STEP]
            if self._inflate is None:
                step = step[:self._size - self._done]
            if not len(step):
                return 0
            self._at += len(step)
            self._ready = self._inflate.decompress(step) if self._inflate else bytes(step)
            self._done += len(self._ready)
            self._sum = zlib.crc32(self._ready, self._sum)
        n = min(len(buffer), len(self._ready))
        buffer[:n], self._ready = self._ready[:n], self._ready[n:]
        return n

    def ended_stream(self) -> bool:
        return self._inflate.eof if self._inflate else self._done >= self._size

    def whole(self) -> bool:
        """Whether the entry ended where it should, read to its end."""
        if not self.known:
            return False
        try:
            while self.read(INFLATE_STEP):
                pass
        except zlib.error:
            return False
        return self.ended_stream() and (not self._sized or (self._sum == self._crc and self._done == self._full))


def _entries_told(data: bytes) -> int | None:
    """Number of entries told by the directory's end, if ``data`` holds it."""
    at = data.rfind(END)
    if at < 0 or len(data) < at + 22:
        return None
    n = struct.unpack("<H", data[at + 10:at + 12])[0]
    big = data.rfind(END_64, 0, at)
    return struct.unpack("<Q", data[big + 32:big + 40])[0] if n == 0xFFFF and big >= 0 else n


def _read_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: the entries of byte ranges (value, path, start of the range)."""
    last, seq = None, 0
    for batch in batches:
        for value, path, start in zip(*(batch.column(i).to_pylist() for i in range(3))):
            seq = seq + 1 if (path, start) == last else 0
            last = (path, start)
            if start == 0 and seq == 0:
                # what stands before the first mark; of a bundle without entries, its directory
                yield _batch([(path, "", 0, -1, None, None, None, None, True, _entries_told(value))])
                continue
            entry = _Entry(value)
            raw = io.BufferedReader(entry) if entry.known else io.BytesIO()
            yield from _member_rows(path, entry.name, start + seq, raw, _entries_told(value), entry.whole)


def _read_bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: whole bundles through their directories (value, path)."""
    for batch in batches:
        for value, path in zip(batch.column(0), batch.column(1).to_pylist()):
            with zipfile.ZipFile(io.BytesIO(value.as_py())) as zf:
                for no, info in enumerate(sorted(zf.infolist(), key=lambda i: i.header_offset)):
                    with zf.open(info) as raw:
                        yield from _member_rows(path, info.filename, no, raw, None, lambda: True)


def zip_records(spark: SparkSession, paths: list[str] | DataFrame) -> DataFrame:
    """S2 (raw): records of every data member of the given bundles, written
    once to the shared folder: the unpacking runs once, later stages re-read
    columnar data, and the lineage is cut before the heavy work."""
    ship_package(spark)
    if isinstance(paths, DataFrame):
        # only file names reach the driver (one row per bundle)
        paths = [r.path for r in paths.select("path").collect()]
    out = scratch_path(spark, "zip-records")
    read = lambda: spark.read.schema(RECORDS).parquet(out)
    if not paths:
        return spark.createDataFrame([], RECORDS)
    at = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]
    pieces = spark.read.format("text").option("lineSep", ENTRY.decode()).load(paths).select(F.col("value").cast("binary"), *at)
    pieces.mapInArrow(_read_entries, RECORDS).write.parquet(out)
    told = read().where("line_no = -1").groupBy("zip_path").agg(
        F.count(F.when(F.col("member") != "", 1)).alias("n"), F.max("entries").alias("told"), F.min("whole").alias("whole"))
    again = [r.zip_path for r in told.where("NOT whole OR n <> coalesce(told, -1)").collect()]
    if again:
        whole = spark.read.format("binaryFile").load(paths).where(at[0].isin(again)).select("content", at[0])
        good = read().where(~F.col("zip_path").isin(again))
        out2 = scratch_path(spark, "zip-records")
        good.unionAll(whole.mapInArrow(_read_bundles, RECORDS)).write.parquet(out2)
        out = out2
    return read()


def column_names(headers: list[list[str]], taken: tuple[str, ...]) -> dict[str, tuple[str, int]]:
    """Output column -> (header name, which occurrence of it). A name that
    repeats in one header, or that equals another one but for case, gets a
    numbered suffix; a header column named exactly like one of ``taken`` is
    replaced by it."""
    out: dict[str, tuple[str, int]] = {}
    used = {t.lower() for t in taken}
    for header in headers:
        seen: dict[str, int] = {}
        for name in header:
            seen[name] = seen.get(name, 0) + 1
            if name in taken or (name, seen[name]) in out.values():
                continue
            label, k = name, 0
            while label.lower() in used:
                k += 1
                label = f"{name}.{k}"
            used.add(label.lower())
            out[label] = (name, seen[name])
    return out


def read_zip_tsv(spark: SparkSession, paths, county_col: str = "county") -> DataFrame:
    """S2 + S4 + S5 + U1: members of the bundles as one all-string table.

    * columns are bound by header name, whatever each member's own header is;
      a column that a member lacks is null;
    * records with **more** fields than the header are dropped, shorter ones
      null-padded, blank lines skipped (the source's skip-bad-lines rule);
    * ``county`` comes from the member's name;
    * ``member_no`` / ``line_no`` keep file order for keep-last de-dup;
    * ``open_quote`` marks records with a quote that nothing closes.
    """
    records = zip_records(spark, paths)
    # the distinct headers, one row each
    headers = sorted((r.fields, r.header_id) for r in records.where("line_no = -1 AND fields IS NOT NULL").select("header_id", "fields").distinct().collect())
    taken = ("zip_path", "member_no", "line_no", "open_quote", county_col)
    columns = []
    for label, (name, nth) in column_names([h for h, _ in headers], taken).items():
        value = F.lit(None).cast("string")
        for header, number in headers:
            if (places := [i for i, h in enumerate(header) if h == name])[nth - 1:]:
                value = F.when(F.col("header_id") == number, F.col("fields")[places[nth - 1]]).otherwise(value)
        columns.append(value.alias(label))
    return records.where("line_no >= 0").select("zip_path", "member_no", "line_no", "open_quote", F.col("county").alias(county_col), *columns)
