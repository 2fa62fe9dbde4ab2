"""Substring dedup: words covered by a window of tokens that already occurred
earlier in the corpus.

Every task computes Rabin-Karp hashes of all its windows and packs them into
blocks, one per hash bucket: the window's word number inside the block's run
of documents (as a gap, about one byte) and its hash. Spark shuffles blocks
to buckets, where equal hashes meet and every occurrence but the first (by
doc_id, then start) is marked. Marks travel back as merged word intervals per
document, and a join with the documents removes them.

A bucket's number of windows is set by ``bucket_windows`` whatever the input's
size: the number of buckets follows from the corpus' bytes. A window that
occurs very often does not swell its bucket: each run of documents marks its
own later occurrences before the shuffle and sends only its first one.

Window identity is the 64-bit hash of 20 word hashes.

Defined cases: null texts and texts of fewer words than a window lose
nothing; a null id counts as the smallest; rows of one id are ordered among
themselves arbitrarily, and of equal rows exactly one keeps its words; an
empty table gives no rows; extra columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import PLAIN_WORD, Scratch, chunks, ids, runs, span_hashes, window_hashes

#: words of a window
WIDTH = 20
#: windows of one bucket, about
BUCKET_WINDOWS = 2_000_000
#: text bytes a task packs into one set of blocks
RUN_BYTES = 16 << 20

_NULL_ID = np.iinfo(np.int64).min

_BLOCK = "bucket int, run long, at binary, hashes binary, doc_ids binary, first_word binary, k1 binary, k2 binary"
_MARKS = "run long, at binary, first_word binary, k1 binary, k2 binary"
_SPANS = "k1 long, k2 long, run long, doc_no long, spans binary"


def _records(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [f.split() for f in ddl.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], [n for n, _ in fields])


def bucket_count(docs: DataFrame, per_bucket: int = BUCKET_WINDOWS) -> int:
    """Buckets for the corpus: its text bytes at six bytes a word."""
    total = docs.select(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(8, -(-total // (6 * per_bucket)))


def _leb(a: np.ndarray) -> bytes:
    """Unsigned numbers as LEB128; small ones take one byte."""
    rest = a.astype(np.uint64)
    digits, used = [], []
    more = np.ones(len(rest), bool)
    while more.any():
        digit = (rest & np.uint64(127)).astype(np.uint8)
        rest = rest >> np.uint64(7)
        used.append(more)
        more = more & (rest > 0)
        digits.append(digit | (more.astype(np.uint8) << 7))
    return np.stack(digits, 1)[np.stack(used, 1)].tobytes() if digits else b""


def _unleb(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    last = np.flatnonzero(b < 128)
    first = np.append(0, last[:-1] + 1)
    place = np.arange(len(b)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((b & 127).astype(np.uint64) << (7 * place).astype(np.uint64), first)


def pack(a: np.ndarray) -> bytes:
    """Whole numbers as zigzag LEB128 of their differences."""
    d = np.diff(a.astype(np.int64), prepend=np.int64(0))
    return _leb(((d << 1) ^ (d >> 63)).view(np.uint64))


def unpack(raw: bytes) -> np.ndarray:
    z = _unleb(raw)
    return np.cumsum(((z >> np.uint64(1)) ^ (np.uint64(0) - (z & np.uint64(1)))).view(np.int64))


def _new_group(keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return new


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and two hashes of both, by which a row is met again."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(name, "text").alias("k1"), F.xxhash64(F.lit(1), name, "text").alias("k2"))


def _gathered(batches: Iterator[pa.RecordBatch], run_bytes: int):
    """Runs of documents: their ids, keys, words per document, word hashes."""
    got, size = [], 0
    for rows, data, off in chunks(batches):
        starts, ends, index = runs(data, off, PLAIN_WORD)
        key = ids(rows).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
        got.append((key, *(ids(rows, k).to_numpy(zero_copy_only=False) for k in ("k1", "k2")), np.diff(index), span_hashes(data, starts, ends)))
        size += len(data)
        if size >= run_bytes:
            yield tuple(np.concatenate(x) for x in zip(*got))
            got, size = [], 0
    if got:
        yield tuple(np.concatenate(x) for x in zip(*got))


def window_blocks(docs: DataFrame, buckets: int, width: int = WIDTH, run_bytes: int = RUN_BYTES) -> DataFrame:
    """One row per bucket and run of documents with the first occurrence in
    the run of each of its windows, and one row (a negative bucket) per run
    with its documents and the windows that repeat an earlier one of it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (doc_ids, k1, k2, n_words, words) in enumerate(_gathered(batches, run_bytes)):
            first_word = np.append(0, np.cumsum(n_words))
            row = np.repeat(np.arange(len(n_words)), n_words)
            h = window_hashes(words, width)
            at = np.flatnonzero(row[width - 1:] == row[:len(h)]) if len(h) else np.zeros(0, np.int64)
            h = h[at]
            order = np.argsort(h, kind="stable")
            if (doc_ids[1:] < doc_ids[:-1]).any():      # rows do not come in the order of their ids
                order = order[np.lexsort((at[order], doc_ids[row[at[order]]], h[order]))]
            new = _new_group(h[order])
            # the same when a lost executor's task runs again; a run of other rows would have another name
            place = f"{TaskContext.get().partitionId()} {number} ".encode()
            name = int.from_bytes(hashlib.blake2b(place + k1.tobytes() + k2.tobytes(), digest_size=8).digest(), "little") >> 1
            later = np.sort(at[order[~new]])
            firsts = np.sort(order[new])
            at, h = at[firsts], h[firsts]
            bucket = (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            edge = np.searchsorted(bucket[by], np.arange(buckets + 1))
            packed_ids, packed_first = pack(doc_ids), pack(first_word)
            out = [(-1 - name % buckets, name, pack(later), b"", b"", packed_first, k1.tobytes(), k2.tobytes())]
            for b in np.flatnonzero(np.diff(edge)):
                part = by[edge[b]:edge[b + 1]]
                out.append((int(b), name, pack(at[part]), h[part].tobytes(), packed_ids, packed_first, None, None))
                if len(out) == 16:
                    yield _records(out, _BLOCK)
                    out = []
            if out:
                yield _records(out, _BLOCK)

    return _keyed(docs).mapInArrow(cut, _BLOCK)


def _mark(block: pa.Table) -> pa.Table:
    """Windows of one bucket that are not the corpus' first occurrence."""
    rows = block.to_pylist()
    if rows[0]["bucket"] < 0:
        return pa.Table.from_batches([_records([(r["run"], r["at"], r["first_word"], r["k1"], r["k2"]) for r in rows], _MARKS)])
    at = [unpack(r["at"]) for r in rows]
    edge = np.append(0, np.cumsum([len(a) for a in at]))
    at = np.concatenate(at)
    h = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in rows])
    order = np.argsort(h, kind="stable")
    new = _new_group(h[order])
    many = ~new
    many[:-1] |= ~new[1:]
    entry, group = order[many], np.cumsum(new)[many]
    source = np.searchsorted(edge, entry, side="right") - 1
    owner = np.empty(len(entry), np.int64)
    by = np.argsort(source, kind="stable")
    for s, e in _slices(source[by]):
        r = rows[source[by[s]]]
        owner[by[s:e]] = unpack(r["doc_ids"])[np.searchsorted(unpack(r["first_word"]), at[entry[by[s:e]]], side="right") - 1]
    rank = np.lexsort((source, owner, group))
    repeat = rank[~_new_group(group[rank])]
    source, at = source[repeat], at[entry[repeat]]
    by = np.lexsort((at, source))
    out = [(rows[source[by[s]]]["run"], pack(at[by[s:e]]), None, None, None) for s, e in _slices(source[by])]
    return pa.Table.from_batches([_records(out, _MARKS)])


def _slices(keys: np.ndarray) -> list[tuple[int, int]]:
    edge = np.append(np.flatnonzero(_new_group(keys)), len(keys)).tolist()
    return list(zip(edge[:-1], edge[1:]))


def _merge(width: int):
    def merge(marks: pa.Table) -> pa.Table:
        """Marked windows of one run as maximal word intervals per document."""
        rows = marks.to_pylist()
        head = next(r for r in rows if r["k1"] is not None)
        at = np.unique(np.concatenate([unpack(r["at"]) for r in rows]))
        if not len(at):
            return pa.Table.from_batches([_records([], _SPANS)])
        first_word = unpack(head["first_word"])
        doc = np.searchsorted(first_word, at, side="right") - 1
        new = _new_group(doc)
        new[1:] |= at[1:] > at[:-1] + width
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        doc = doc[first]
        lo, hi = at[first] - first_word[doc], at[last] + width - first_word[doc]
        k1, k2 = (np.frombuffer(head[k], np.int64) for k in ("k1", "k2"))
        return pa.Table.from_batches([_records([
            (int(k1[d]), int(k2[d]), head["run"], int(d), pack(np.stack([lo[s:e], hi[s:e]], 1).ravel()))
            for s, e in _slices(doc) for d in [doc[s]]], _SPANS)])

    return merge


def repeat_spans(docs: DataFrame, width: int = WIDTH, per_bucket: int = BUCKET_WINDOWS, run_bytes: int = RUN_BYTES) -> DataFrame:
    """(k1, k2, nth, spans) of every document with a repeated window; spans
    are packed [from, to) word intervals, maximal and ascending."""
    blocks = window_blocks(docs, bucket_count(docs, per_bucket), width, run_bytes)
    marks = blocks.groupBy("bucket").applyInArrow(_mark, _MARKS)
    spans = marks.groupBy("run").applyInArrow(_merge(width), _SPANS)
    nth = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("run", "doc_no"))
    return spans.select("k1", "k2", nth.alias("nth"), "spans")


def remove_repeats(docs: DataFrame, width: int = WIDTH, per_bucket: int = BUCKET_WINDOWS, run_bytes: int = RUN_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, text (kept words joined by one space) and
    spans (removed word intervals) of every document."""
    spans = Scratch(docs.sparkSession, "repeats").write(repeat_spans(docs, width, per_bucket, run_bytes), "spans")
    nth = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.lit(0)))
    whole = _keyed(docs).withColumn("nth", nth).join(spans, ["k1", "k2", "nth"], "left").select("doc_id", "text", "spans")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in chunks(batches):
            raw, n_words, n_removed, text, spans = data.tobytes(), [], [], [], []
            for lo, hi, packed in zip(off[:-1].tolist(), off[1:].tolist(), ids(rows, "spans").to_pylist()):
                words = raw[lo:hi].split()
                cuts = unpack(packed).tolist() if packed else []
                kept, done = [], 0
                for a, b in zip(cuts[::2], cuts[1::2]):
                    kept += words[done:a]
                    done = b
                kept += words[done:]
                n_words.append(len(words)), n_removed.append(len(words) - len(kept))
                text.append(b" ".join(kept)), spans.append([{"lo": a, "hi": b} for a, b in zip(cuts[::2], cuts[1::2])])
            yield pa.RecordBatch.from_arrays([
                ids(rows), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(text, pa.binary()).cast(pa.string()),
                pa.array(spans, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))], ["doc_id", "n_words", "n_removed", "text", "spans"])

    return whole.mapInArrow(apply, "doc_id long, n_words long, n_removed long, text string, spans array<struct<lo: long, hi: long>>")
