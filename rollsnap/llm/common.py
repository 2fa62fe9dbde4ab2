"""Shared helpers of the training-data operators: scratch tables, folds,
bounded label samples and vectorised word kernels over Arrow text columns."""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from ..sources import bucketed

#: bytes of text handled by one numpy pass (a longer document is a pass of its own)
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Tables an operator writes under ``spark.checkpoint.dir``.

    A written table cuts the lineage: a lost executor re-reads shared files
    instead of recomputing. ``drop`` deletes tables that nothing reads again."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, f"{name}-{uuid.uuid4().hex[:8]}"
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, part: str) -> DataFrame:
        ship_package(self.spark)
        path = scratch_path(self.spark, f"{self.name}-{part}")
        df.write.parquet(path)
        self.paths[part] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, part: str, key: str, dealt: bool = False) -> DataFrame:
        """Like ``write``, in buckets of ``key``: joins on it do not shuffle
        the table again. ``dealt``: ``df`` is partitioned by the key already."""
        ship_package(self.spark)
        path = scratch_path(self.spark, f"{self.name}-{part}")
        place = (path, df.schema, [key], int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        bucketed.add(df, *place, dealt=dealt)
        self.paths[part] = path
        return bucketed.rows_of(self.spark, *place)

    def clear(self, *keep: str) -> None:
        """Delete all tables but those named, and let Spark's cleaner find
        the shuffles of the plans that nothing holds any more: it learns of
        them when the driver collects garbage."""
        self.drop(*[p for p in self.paths if p not in keep])
        self.spark._jvm.System.gc()

    def drop(self, *parts: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for part in parts:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(part))
            path.getFileSystem(conf).delete(path, True)


def boxed(df: DataFrame, *cols: str) -> DataFrame:
    """All columns as one struct ``row`` beside copies of the named ones, so
    names of the input never clash with those an operator adds."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *cols)


def unboxed(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit hash of a document's id and text, by which it is met again."""
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), text)


def text_crc(c: str | Column) -> Column:
    """Unsigned CRC-32 of a text's UTF-8 bytes; null counts as empty text."""
    return F.crc32(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("binary"))


def fold(doc_id: str, folds: int) -> Column:
    """crc32(doc_id as text) mod ``folds``; a null id counts as empty text."""
    return (text_crc(F.col(doc_id).cast("string")) % folds).cast("int")


def label_sample(docs: DataFrame, labels: DataFrame, target: str, max_rows: int, where: Column | None = None) -> DataFrame:
    """At most ``max_rows`` labelled documents (doc_id, text, y), the same on
    every run: ids in the order of their hash, of repeated rows one. Ids
    labelled twice with different values and null labels are left out. The
    bound holds for ids, which makes the broadcast of their list safe, and for
    rows, however often an id or its text is repeated."""
    lab = labels.select("doc_id", F.col(target).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
    if where is not None:
        lab = lab.where(where)
    lab = lab.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("__hi")).where("y = __hi").drop("__hi")
    lab = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(lab), "doc_id").dropDuplicates(["doc_id", "text"])
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text").limit(max_rows)


# --------------------------------------------------------------------------
# Arrow text columns as one byte buffer
# --------------------------------------------------------------------------

def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    n = len(col)
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(off, np.int64 if big else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES, text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut the batches of a task into runs of whole rows of about ``size``
    text bytes: (rows, bytes, offsets). No row is split or dropped."""
    for batch in batches:
        data, off = text_bytes(batch.column(batch.schema.get_field_index(text)))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = int(np.searchsorted(off, off[lo] + size, side="right")) - 1
            hi = min(n, max(hi, lo + 1))
            yield batch.slice(lo, hi - lo), data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            lo = hi


def byte_set(spec: bytes) -> np.ndarray:
    lut = np.zeros(256, bool)
    lut[np.frombuffer(spec, np.uint8)] = True
    return lut


SPACE = byte_set(b" \t\n\v\f\r")
#: words `[^\x20\x09-\x0D]+`
PLAIN_WORD = ~SPACE
#: words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` once A-Z are lower-cased
ALNUM_WORD = byte_set(bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))


def runs(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes of ``inside`` that stay in one row: (starts,
    ends, index) where ``index[d]:index[d+1]`` are the runs of row ``d``."""
    n = len(data)
    mask = inside[data]
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    edge = off[off < n]
    before[edge] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    edge = off[off > 0] - 1
    after[edge] = False
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


# --------------------------------------------------------------------------
# Polynomial (Rabin-Karp) hashes modulo 2^64
# --------------------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C55)     # odd: invertible modulo 2^64
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))


@functools.lru_cache(maxsize=1)
def _byte_codes() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@functools.lru_cache(maxsize=1)
def _folded_codes() -> np.ndarray:
    codes = _byte_codes().copy()
    codes[65:91] = codes[97:123]
    return codes


_POWERS: dict[bool, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64 (or of its inverse)."""
    have = _POWERS.get(inverse)
    if have is None or len(have) < n:
        size = max(n + n // 8, CHUNK_BYTES + (1 << 17))
        steps = np.full(size, _BASE_INV if inverse else _BASE, np.uint64)
        steps[0] = 1
        have = _POWERS[inverse] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads a hash over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: spans of more bytes are hashed by BLAKE2: sums modulo 2^64 agree for some
#: pairs of long words (Thue-Morse words, from 1,024 bytes on), whatever the base
LONG_SPAN = 256


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = False) -> np.ndarray:
    """Hash of each byte span: prefix sums of code(b_i)*base^i, shifted back
    to the span's start, so equal spans hash alike wherever they stand."""
    codes = _folded_codes() if fold_case else _byte_codes()
    pre = np.empty(len(data) + 1, np.uint64)
    pre[0] = 0
    np.cumsum(codes[data] * powers(len(data)), out=pre[1:])
    out = mix((pre[ends] - pre[starts]) * powers(len(data) + 1, True)[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_SPAN):
        span = data[starts[i]:ends[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(span.lower() if fold_case else span, digest_size=8).digest(), "big")
    return out


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Rolling hash of every ``width`` consecutive values (all positions;
    the caller masks windows that leave a document)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    pre = np.empty(len(h) + 1, np.uint64)
    pre[0] = 0
    np.cumsum(h * powers(len(h)), out=pre[1:])
    return mix((pre[width:] - pre[:n]) * powers(n, True))


def rows_of(index: np.ndarray) -> np.ndarray:
    """Row number of every run, from the index of ``runs``."""
    return np.repeat(np.arange(len(index) - 1), np.diff(index))


def per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``mask`` over each row's slice."""
    pre = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=pre[1:])
    return pre[off[1:]] - pre[off[:-1]]


def ids(batch: pa.RecordBatch, name: str = "doc_id") -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def in_order(df: DataFrame, scratch: Scratch, name: str, group: list[str], order: list[str]) -> DataFrame:
    """``df`` written in the order of (group, order), nulls last, with
    ``part`` (number of the sorted range) and ``row`` (place in the range).
    Equal rows are spread by a random key, so no key is too hot for a range;
    such rows are interchangeable."""
    keys = [F.col(c).asc_nulls_last() for c in (*group, *order)]
    dealt = df.withColumn("__deal", F.rand(11)).repartitionByRange(*keys, "__deal").sortWithinPartitions(*keys)
    out = scratch.write(dealt.drop("__deal").withColumn("part", F.spark_partition_id()), name)
    return out.select("*", F.col("_metadata.row_index").alias("row"))


def running_total(ordered: DataFrame, group: str, amount: str, total: str) -> DataFrame:
    """Adds ``total``: the sum of the whole number ``amount`` over the rows of
    the same group up to and including this one, in the order of
    ``in_order``. Windows stay within one sorted range; the ranges' own sums
    are one row per range and group."""
    inner = ordered.withColumn("__run", F.sum(amount).over(Window.partitionBy("part", group).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)))
    sums = ordered.groupBy("part", group).agg(F.sum(amount).alias("__sum"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("part").alias("__part"), F.col(group).alias("__group"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    joined = inner.join(sums, (F.col("part") == F.col("__part")) & (F.col(group).eqNullSafe(F.col("__group"))))
    return joined.withColumn(total, F.col("__run") + F.col("__before")).drop("__run", "__before", "__part", "__group")
