"""Filter interaction audit: what each of five filters removes in every order
of applying them.

One pass of a byte transducer reads every text. A table gives each of the 256
byte values its outputs (word byte, capital, first byte of a code point,
symbol); the two states of the machine, inside and outside a word, follow from
the byte just read, so whole buffers go through the table at once and the
changes of state are the word spans. Spans are inserted into an open-addressing
hash table of their document. A span that meets a slot with its own hash is
compared byte for byte with the occupant; unequal ones go on to the next slot,
so a collision never loses a word. The occupied slots are the distinct words.

Spark then counts documents per part and set of failed filters (a few dozen
rows a part), from which every order's steps follow.

Defined cases: a null text is an empty one, a null source the part ''; a row
without doc_id is identical to no smaller one and makes no other fail; rows of
one doc_id are not smaller than each other; a document is good (toxic) if any
of its labels says so; an empty table gives no rows; other columns are ignored.
Identity of whole texts is that of their 256-bit SHA-2 digests."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import PLAIN_WORD, Scratch, byte_set, chunks, ids, per_row, rows_of, span_hashes

#: fixed values of the audit: fewest words, least percentage of distinct words, largest of capitals, symbols
WORDS, DISTINCT, CAPITALS, SYMBOLS = 50, 65, 5, b"#$%&*|"
FILTERS = "ABCDE"
#: parts expanded at once
PARTS = 256

_WORD, _CAPITAL, _POINT, _SYMBOL = 1, 2, 4, 8


def _transducer() -> np.ndarray:
    """Outputs of each byte value, as bits."""
    every = np.arange(256)
    return (PLAIN_WORD * _WORD + byte_set(bytes(range(65, 91))) * _CAPITAL + ((every & 0xC0) != 0x80) * _POINT + byte_set(SYMBOLS) * _SYMBOL).astype(np.uint8)


OUTPUTS = _transducer()


def _equal(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Byte comparison of the spans a and b (numbers of spans), pair by pair."""
    size = ends[a] - starts[a]
    same = size == ends[b] - starts[b]
    at, size = np.flatnonzero(same), size[same]
    first = np.cumsum(size) - size
    step = np.arange(int(size.sum())) - np.repeat(first, size)
    unlike = data[np.repeat(starts[a[at]], size) + step] != data[np.repeat(starts[b[at]], size) + step]
    if len(at):
        same[at] = ~np.logical_or.reduceat(unlike, first) if len(unlike) else True
    return same


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, index: np.ndarray, hashes: np.ndarray | None = None) -> np.ndarray:
    """Number of different words of each row, by insertion into one open
    hash table a row (a power of two of at least twice its words)."""
    n = np.diff(index)
    size = 1 << np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64)
    base = np.cumsum(size) - size
    slots = np.full(int(size.sum()), -1, np.int64)
    row = rows_of(index)
    h = span_hashes(data, starts, ends) if hashes is None else hashes
    mask, probe = size[row] - 1, (h & np.uint64((1 << 62) - 1)).astype(np.int64)
    word = np.arange(len(starts))
    while len(word):
        slot = base[row[word]] + (probe[word] & mask[word])
        free = slots[slot] < 0
        slots[slot[free]] = word[free]                   # one of the words that meet at a free slot stays
        holder = slots[slot]
        done = holder == word
        alike = ~done & (h[holder] == h[word])
        at = np.flatnonzero(alike)
        done[at] = _equal(data, starts, ends, word[at], holder[at])
        word = word[~done]
        probe[word] += 1
    return per_row(slots >= 0, np.append(base, len(slots)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: the filters A to D that every text fails, as bits 0 to 3."""
    for rows, data, off in chunks(batches):
        out = OUTPUTS[data]
        inside = (out & _WORD).astype(bool)
        before, after = np.concatenate([[False], inside[:-1]]), np.concatenate([inside[1:], [False]])
        before[off[off < len(data)]] = False             # a text starts outside a word
        after[off[off > 0] - 1] = False
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        index = np.searchsorted(starts, off)
        n = np.diff(index)
        capitals, points, symbols = (per_row((out & bit) > 0, off) for bit in (_CAPITAL, _POINT, _SYMBOL))
        failed = [n < WORDS, 100 * distinct_words(data, starts, ends, index) < DISTINCT * n, 100 * capitals > CAPITALS * points, symbols > 0]
        bits = sum(f.astype(np.int32) << i for i, f in enumerate(failed))
        yield pa.RecordBatch.from_arrays([ids(rows), ids(rows, "part"), ids(rows, "digest"), pa.array(bits.astype(np.int32))], names=["doc_id", "part", "digest", "failed"])


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest and failed (bits of A to D) of every document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text.alias("text"))
    return rows.mapInArrow(_read, "doc_id long, part string, digest binary, failed int")


def tally(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failed (bits of A to E), good, toxic and n: documents per part,
    set of failed filters and labels.

    Copies are counted before they meet: first rows of one id, then rows of
    one text per part and label with their smallest id, so a text's group is a
    few rows when its smallest id of all is sought."""
    lab = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    no = F.lit(False)
    # written once: both branches below read it, and the texts are read once
    one = Scratch(docs.sparkSession, "audit").write(failures(docs), "failures")
    one = one.groupBy("doc_id", "part", "digest", "failed").agg(F.count(F.lit(1)).alias("n"))
    named = one.where("doc_id IS NOT NULL").join(lab, "doc_id", "left").withColumn("good", F.coalesce("good", no)).withColumn("toxic", F.coalesce("toxic", no))
    kind = ["part", "digest", "failed", "good", "toxic"]
    named = named.groupBy(*kind).agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))       # a few rows a text by now
    named = named.withColumn("head", F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(F.lit(0)))
    split = F.explode(F.array(F.struct(F.col("failed").alias("failed"), F.col("head").alias("n")), F.struct((F.col("failed") + 16).alias("failed"), (F.col("n") - F.col("head")).alias("n"))))
    named = named.select("part", "good", "toxic", split.alias("x")).select("part", "x.failed", "good", "toxic", "x.n")
    nameless = one.where("doc_id IS NULL").select("part", "failed", no.alias("good"), no.alias("toxic"), "n")
    return named.unionAll(nameless).groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))


def _steps() -> tuple[list[str], list[int], dict[str, np.ndarray]]:
    """(order, step) of all permutations and, per measure, which of the 32
    sets of failed filters count at each step."""
    orders = ["".join(p) for p in itertools.permutations(FILTERS)]
    sets = np.arange(1 << len(FILTERS))
    met = {name: [] for name in ("kept", "removed", "redundant", "unique_fails", "shapley")}
    turns = np.zeros((len(FILTERS), len(sets)), np.int64)
    for order in orders:
        gone = np.zeros(len(sets), bool)
        for letter in order:
            f = FILTERS.index(letter)
            fails = (sets >> f & 1).astype(bool)
            met["removed"].append(fails & ~gone)
            met["redundant"].append(fails & gone)
            met["unique_fails"].append(sets == 1 << f)
            turns[f] += fails & ~gone
            gone = gone | fails
            met["kept"].append(~gone)
    met["shapley"] = [turns[FILTERS.index(letter)] for order in orders for letter in order]
    return [o for o in orders for _ in o], [i for o in orders for i in range(1, len(o) + 1)], {k: np.array(v, np.int64) for k, v in met.items()}


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: a part's counts by set -> its rows for all orders and steps."""
    orders, steps, met = _steps()
    for b in batches:
        for lo in range(0, b.num_rows, PARTS):
            p = b.slice(lo, PARTS)
            n, good, toxic = (np.asarray(p.column(i).flatten()).reshape(p.num_rows, -1).T for i in (1, 2, 3))
            all_, rows = len(orders), p.num_rows
            cols = {"kept": met["kept"] @ n, "removed": met["removed"] @ n, "redundant": met["redundant"] @ n, "unique_fails": met["unique_fails"] @ n,
                    "good_lost": met["removed"] @ good, "toxic_lost": met["removed"] @ toxic, "shapley": met["shapley"] @ n}
            yield pa.RecordBatch.from_arrays(
                [p.column(0).take(pa.array(np.repeat(np.arange(rows), all_))), pa.array(orders * rows), pa.array(np.tile(np.array(steps, np.int32), rows)), *[pa.array(c.T.reshape(-1)) for c in cols.values()]],
                names=["part", "filter_order", "step", *cols])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    sets = range(1 << len(FILTERS))
    count = lambda name, where: F.array(*[F.coalesce(F.sum(F.when((F.col("failed") == s) & where, F.col("n"))), F.lit(0)) for s in sets]).alias(name)
    parts = tally(docs, labels).groupBy("part").agg(count("n", F.lit(True)), count("good", F.col("good")), count("toxic", F.col("toxic")))
    measures = ", ".join(f"{m} long" for m in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
    return parts.mapInArrow(_expand, f"part string, filter_order string, step int, {measures}")
