"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document: a shard is a run of whole documents of
one task, stored as sorted terms, where each term's posting list begins, and
the ascending positions of all lists. Positions number the words of the
shard; a document owns a contiguous range. Test phrases go to every shard in
blocks of a fixed size, so any number of them can be searched without holding
all at once and without shuffling a posting.

A phrase is found by taking the posting list of its rarest term in the shard,
moved back by the term's offset, and intersecting it with the other terms'
offset-adjusted lists from the next rarest on. Terms are 64-bit hashes of
lower-cased words.

Defined cases: null or empty texts have no words and match nothing; documents
without id keep a row with null id; items without words are ignored; the words
of items without id are hits, but name no item; repeated items count once (by
id); repeated documents are matched one by one;
extra columns are ignored."""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORD, Scratch, boxed, chunks, ids, row_key, runs, span_hashes, unboxed

#: words of a window
WIDTH = 10
#: phrases sent to the shards at a time: at most this many windows of WIDTH
#: 64-bit terms, 5 MB
BLOCK_WINDOWS = 65_536

INDEX_DDL = "shard long, doc_ids array<long>, first_word array<long>, terms binary, list_start binary, positions binary"


def _packed(a: np.ndarray) -> bytes:
    return a.tobytes()


def build_index(docs: DataFrame, word: np.ndarray = ALNUM_WORD, fold_case: bool = True) -> DataFrame:
    """One row per shard: a random number, its documents, and for each
    distinct term the ascending positions where it stands. Store it before
    searching: the shard numbers are drawn when the index is made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in chunks(batches):
            starts, ends, index = runs(data, off, word)
            h = span_hashes(data, starts, ends, fold_case)
            order = np.argsort(h, kind="stable").astype(np.uint32)
            terms, first = np.unique(h[order], return_index=True) if len(h) else (h, np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([
                pa.array([secrets.randbits(63)], pa.int64()), pa.array([ids(rows).cast(pa.int64()).to_pylist()], pa.list_(pa.int64())), pa.array([index.tolist()], pa.list_(pa.int64())),
                *(pa.array([_packed(a)], pa.binary()) for a in (terms, first.astype(np.uint32), order))],
                ["shard", "doc_ids", "first_word", "terms", "list_start", "positions"])

    return docs.select("doc_id", "text").mapInArrow(run, INDEX_DDL)


@dataclass
class Shard:
    shard: int
    doc_ids: list
    first_word: np.ndarray
    terms: np.ndarray
    list_start: np.ndarray     # one more entry than terms
    positions: np.ndarray

    def __post_init__(self):
        self.size = np.int64(len(self.positions) + 1)
        # (term number, position) of every posting in one ascending array
        self.keys = np.repeat(np.arange(len(self.terms)), np.diff(self.list_start)) * self.size + self.positions

    def lookup(self, terms: np.ndarray) -> np.ndarray:
        """Term number of each 64-bit term, -1 if the shard has none."""
        if not len(self.terms):
            return np.full(terms.shape, -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def holds(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether each term stands at its position."""
        key = term * self.size + position
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (self.keys[at] == key) & (position >= 0) & (position < self.size)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first_word, position, side="right") - 1

    def postings(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All postings of each term: (which term of the list, position)."""
        lo, n = self.list_start[term], self.list_start[term + 1] - self.list_start[term]
        which = np.repeat(np.arange(len(term)), n)
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return which, self.positions[lo[which] + inner]


def read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for r in batch.to_pylist():
            positions = np.frombuffer(r["positions"], np.uint32).astype(np.int64)
            starts = np.append(np.frombuffer(r["list_start"], np.uint32).astype(np.int64), len(positions))
            yield Shard(r["shard"], r["doc_ids"], np.asarray(r["first_word"], np.int64), np.frombuffer(r["terms"], np.uint64), starts, positions)


def find_phrases(shard: Shard, terms: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, first position) of every exact occurrence within one
    document. ``terms`` is (phrases, width), padded beyond ``length``."""
    used = np.arange(terms.shape[1]) < length[:, None]
    number = shard.lookup(terms)
    at = np.flatnonzero(((number >= 0) | ~used).all(1) & (length > 0))
    number, used = number[at], used[at]
    count = np.where(used, (shard.list_start[1:] - shard.list_start[:-1])[np.maximum(number, 0)] if len(shard.terms) else 0, np.iinfo(np.int64).max)
    rank = np.argsort(count, axis=1, kind="stable")     # rarest term first, padding last
    line = np.arange(len(at))
    if not len(at):
        return at, at
    which, pos = shard.postings(number[line, rank[:, 0]])
    start = pos - rank[which, 0]
    for k in range(1, terms.shape[1]):
        offset = rank[which, k]
        padding = k >= length[at][which]
        ok = padding | shard.holds(np.maximum(number[which, offset], 0), start + offset)
        which, start = which[ok], start[ok]
    ok = start >= 0
    which, start = which[ok], start[ok]
    whole = shard.doc_of(start) == shard.doc_of(start + length[at][which] - 1)
    return at[which[whole]], start[whole]


def find_near(shard: Shard, terms: np.ndarray, length: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, position of its rarest term) where every term of the phrase
    stands within ``span`` words of that position, in one document."""
    used = np.arange(terms.shape[1]) < length[:, None]
    number = shard.lookup(terms)
    at = np.flatnonzero(((number >= 0) | ~used).all(1) & (length > 0))
    if not len(at):
        return at, at
    number, used = number[at], used[at]
    count = np.where(used, (shard.list_start[1:] - shard.list_start[:-1])[np.maximum(number, 0)], np.iinfo(np.int64).max)
    rank = np.argsort(count, axis=1, kind="stable")
    which, pos = shard.postings(number[np.arange(len(at)), rank[:, 0]])
    for k in range(1, terms.shape[1]):
        padding = k >= length[at][which]
        term = np.maximum(number[which, rank[which, k]], 0)
        doc = shard.doc_of(pos)
        lo = np.maximum(pos - span, shard.first_word[doc])
        hi = np.minimum(pos + span, shard.first_word[doc + 1] - 1)
        first = np.searchsorted(shard.keys, term * shard.size + lo)
        ok = padding | ((first < len(shard.keys)) & (shard.keys[np.minimum(first, len(shard.keys) - 1)] <= term * shard.size + hi))
        which, pos = which[ok], pos[ok]
    return at[which], pos


def item_windows(items: DataFrame, width: int = WIDTH, word: np.ndarray = ALNUM_WORD, fold_case: bool = True) -> DataFrame:
    """(item_id, terms) of every window of ``width`` consecutive words; an
    item of fewer words is one window. Those of items without id have a null
    name."""

    def run(batches):
        for rows, data, off in chunks(batches):
            starts, ends, index = runs(data, off, word)
            h = span_hashes(data, starts, ends, fold_case).view(np.int64)
            name, terms = [], []
            for item, lo, hi in zip(ids(rows, "item_id").to_pylist(), index[:-1], index[1:]):
                for s in range(lo, max(lo + 1, hi - width + 1) if hi > lo else lo):
                    name.append(item), terms.append(h[s:min(s + width, hi)].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(name, pa.string()), pa.array(terms, pa.list_(pa.int64()))], ["item_id", "terms"])

    return items.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(run, "item_id string, terms array<long>").distinct()


def phrase_blocks(windows: DataFrame, size: int = BLOCK_WINDOWS) -> Iterator[tuple[list[str | None], np.ndarray, np.ndarray]]:
    """The windows, at most ``size`` of them at a time on the driver."""
    block: list = []

    def packed(rows):
        width = max(len(r.terms) for r in rows)
        terms, length = np.zeros((len(rows), width), np.int64), np.array([len(r.terms) for r in rows])
        for i, r in enumerate(rows):
            terms[i, :len(r.terms)] = r.terms
        return [r.item_id for r in rows], terms.view(np.uint64), length

    for r in windows.toLocalIterator(prefetchPartitions=True):
        block.append(r)
        if len(block) == size:
            yield packed(block)
            block = []
    if block:
        yield packed(block)


def search(index: DataFrame, windows: DataFrame, near: int | None = None, size: int = BLOCK_WINDOWS) -> DataFrame:
    """Matches of every document, one row per document and phrase block:
    shard and doc_no (which together name a row of the documents), doc_id, the
    distinct items found, and the ranges of words that they cover ([lo, hi),
    merged). With ``near``, proximity matches instead: the range is the
    position of the rarest term."""
    sc = index.sparkSession.sparkContext
    ddl = "shard long, doc_no long, doc_id long, items array<string>, ranges array<struct<lo: long, hi: long>>"
    parts = []
    for names, terms, length in phrase_blocks(windows, size):
        sent = sc.broadcast((names, terms, length))

        def run(batches, sent=sent):
            names, terms, length = sent.value
            known = sorted({n for n in names if n is not None})
            place = {n: i for i, n in enumerate([*known, None])}
            number = np.asarray(known, object), np.array([place[n] for n in names])
            for shard in read_shards(batches):
                if near is None:
                    which, start = find_phrases(shard, terms, length)
                    stop = start + length[which]
                else:
                    which, start = find_near(shard, terms, length, near)
                    stop = start + 1
                yield _matches(shard, which, start, stop, *number)

        parts.append(index.mapInArrow(run, ddl))
    if not parts:
        return index.sparkSession.createDataFrame([], ddl)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def _matches(shard: Shard, which, start, stop, names, number) -> pa.RecordBatch:
    """One row per document with a match; ``number`` is one past the last of
    ``names`` where the item has none."""
    doc = shard.doc_of(start)
    pair = np.unique(np.stack([doc, number[which]]), axis=1) if len(doc) else np.zeros((2, 0), np.int64)
    pair = pair[:, pair[1] < len(names)]
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    # ranges of a document in ascending order; a gap before the next begins a new one
    reach = np.maximum.accumulate(stop) if len(stop) else stop
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    rdoc, rlo, rhi = doc[first], start[first], reach[last] if len(doc) else reach
    found, at = np.unique(rdoc, return_index=True)
    rlo, rhi = rlo - shard.first_word[rdoc], rhi - shard.first_word[rdoc]
    edges = np.append(at, len(rdoc)).astype(np.int32)
    item_at = np.searchsorted(pair[0], np.append(found, np.iinfo(np.int64).max)).astype(np.int32)
    return pa.RecordBatch.from_arrays([
        pa.array([shard.shard] * len(found), pa.int64()), pa.array(found, pa.int64()), pa.array([shard.doc_ids[d] for d in found], pa.int64()),
        pa.ListArray.from_arrays(pa.array(item_at), pa.array(names[pair[1]].tolist(), pa.string())),
        pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays([pa.array(rlo, pa.int64()), pa.array(rhi, pa.int64())], ["lo", "hi"]))],
        ["shard", "doc_no", "doc_id", "items", "ranges"])


def doc_lengths(index: DataFrame) -> DataFrame:
    """shard, doc_no, doc_id and number of words of every document."""
    n = F.size("doc_ids")
    docs = F.arrays_zip(F.col("doc_ids").alias("d"), F.slice("first_word", F.lit(1), n).alias("a"), F.slice("first_word", F.lit(2), n).alias("b"))
    one = index.select("shard", F.posexplode(docs).alias("doc_no", "p"))
    return one.select("shard", F.col("doc_no").cast("long").alias("doc_no"), F.col("p.d").alias("doc_id"), (F.col("p.b") - F.col("p.a")).alias("n_words"))


def contaminated_words(index: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document of the index: doc_id, n_words, n_hit (its words
    inside an occurrence of a window) and the distinct items found."""
    found = search(index, item_windows(items)).groupBy("shard", "doc_no").agg(
        F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("ranges")).alias("ranges"))
    words = F.flatten(F.transform("ranges", lambda r: F.sequence(r["lo"], r["hi"] - 1)))
    found = found.select("shard", "doc_no", F.array_distinct("items").alias("items"), F.size(F.array_distinct(words)).cast("long").alias("n_hit"))
    return doc_lengths(index).join(found, ["shard", "doc_no"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no window of an item occurs."""
    whole = boxed(docs, "text", row_key().alias("k"))
    index = Scratch(docs.sparkSession, "clean").write(build_index(whole.select(F.col("k").alias("doc_id"), "text")), "index")
    hit = search(index, item_windows(items)).select(F.col("doc_id").alias("k")).distinct()
    return unboxed(whole.join(hit, "k", "left_anti"))
