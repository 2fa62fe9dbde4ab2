"""N-gram Jaccard join: documents whose sets of word shingles overlap by a
Jaccard similarity of 0.8 or more, and their groups.

The join is exact. Equal sets become one class. Shingles are put in one
global order, rare ones first (by a table of hashed shingle counts of fixed
size, which only affects speed), and a class enters the posting lists of the
first shingles of its set only: two similar sets share one of them. A list
entry carries the set's size and the shingle's position, so that a list is
skipped over by size and by the overlap still possible behind the position.

Of several lists with the same classes only the first in the global order
is kept: a pair's first common shingle is never in another of them.

A set has a sketch: how many of its shingles fall to each of about a quarter
as many counters. The lesser counts of two sketches add up to at least the
overlap of the sets, so an entry of a list none of whose partners there can
reach the threshold leaves it, before any shingles are sent.

A set's answers are derived from those of a similar set: in a few rounds
every class outside the largest component of one of its lists is compared
with some leaders out of that component, with 1, 4, 16, 64 of them as rounds
go on. The first leader is the least signature, then come the classes most
similar to their own hub before (in a group of copies, soon their common
original), then any. Classes that end up connected are never compared again,
and two classes that met the same hub are ruled out by the triangle
inequality of the Jaccard distance where it can be. All pairs that remain are
compared at the end: no link between different groups is lost, and large
groups of near copies cost a few comparisons per member, not all pairs.

Defined cases: null texts and texts without words have an empty set and no
links; a text of fewer words than a shingle is one shingle; a null id takes
part in links but never names a group (a group of null ids only has a null
component); repeated rows each get a row; an empty table gives no rows; extra
columns are ignored."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import PLAIN_WORD, Scratch, chunks, ids, boxed, row_key, text_bytes, unboxed, mix, powers, rows_of, runs, span_hashes, window_hashes
from .graph import components
from .repeats import _new_group, _records, _slices, pack, unpack

#: words of a shingle
WIDTH = 5
#: counters of the fixed-size table of shingle counts (and the blocks it travels in)
COUNTERS, COUNTER_BLOCKS = 1 << 20, 64
#: posting entries of one bucket, about
BUCKET_ENTRIES = 1_000_000
#: text bytes whose entries a task packs into one set of blocks
RUN_BYTES = 32 << 20
#: rounds of comparison with leaders before all remaining pairs
ROUNDS = 4
#: a round compares a class with at most this many leaders to the power of the round
LEADERS = 4
#: pairs looked at in one numpy pass
PAIR_CHUNK = 1_000_000
#: an entry with more partners near in size stays in its list without a look at their sketches
PARTNERS = 64
#: counters of sketches looked at in one numpy pass
SKETCH_CHUNK = 4 << 20

_KEY_BITS = np.uint64(58)


# --------------------------------------------------------------------------
# Sets
# --------------------------------------------------------------------------

def shingle_sets(data: np.ndarray, off: np.ndarray, rank: np.ndarray | None = None, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(keys, index): ``keys[index[d]:index[d+1]]`` are the distinct shingles
    of text d, ascending. A key is a 58-bit hash below 6 bits of ``rank``."""
    starts, ends, index = runs(data, off, PLAIN_WORD)
    words = span_hashes(data, starts, ends, fold_case=True)
    row = rows_of(index)
    n = len(index) - 1
    h = window_hashes(words, width)
    at = np.flatnonzero(row[width - 1:] == row[:len(h)]) if len(h) else np.zeros(0, np.int64)
    h, row = h[at], row[at]
    count = np.diff(index)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):      # the whole sequence as one shingle, its length mixed in
        pre = np.append(np.uint64(0), np.cumsum(words * powers(len(words)), dtype=np.uint64))
        lo, hi = index[short], index[short + 1]
        h = np.append(h, mix((pre[hi] - pre[lo]) * powers(len(words) + 1, True)[lo] ^ mix(count[short].astype(np.uint64))))
        row = np.append(row, short)
    key = h >> np.uint64(6)
    if rank is not None:
        key |= rank[key & np.uint64(len(rank) - 1)].astype(np.uint64) << _KEY_BITS
    order = np.argsort(key, kind="stable")
    order = order[np.argsort(row[order].astype(np.uint16 if n < 1 << 16 else np.int64), kind="stable")]
    key, row = key[order], row[order]
    if len(key):
        new = _new_group(key)
        new[1:] |= row[1:] != row[:-1]
        key, row = key[new], row[new]
    return key, np.searchsorted(row, np.arange(n + 1))


def signatures(key: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Order-free 64-bit signature of each set (rank bits left out)."""
    plain = key & np.uint64((1 << 58) - 1)
    pre = np.append(np.uint64(0), np.cumsum(mix(plain + np.uint64(0x51ED270B)), dtype=np.uint64))
    return mix(pre[index[1:]] - pre[index[:-1]] ^ np.diff(index).astype(np.uint64)).view(np.int64)


def sketches(key: np.ndarray, index: np.ndarray) -> pa.Array:
    """One byte a counter of each set: its shingles by their lowest bits. A
    set with a counter that a byte cannot hold has an empty sketch."""
    n = np.diff(index)
    width = 1 << np.ceil(np.log2(np.maximum(n, 32) / 4)).astype(np.int64)
    edge = np.append(0, np.cumsum(width))
    owner = rows_of(index)
    counts = np.bincount(edge[owner] + (key & (width[owner] - 1).astype(np.uint64)).astype(np.int64), minlength=edge[-1])
    held = np.maximum.reduceat(counts, edge[:-1]) < 256 if len(n) else n > 0
    raw = counts.astype(np.uint8).tobytes()
    return pa.array([raw[a:b] if ok else b"" for a, b, ok in zip(edge[:-1].tolist(), edge[1:].tolist(), held.tolist())], pa.binary())


def most_shared(data: np.ndarray, start: np.ndarray, width: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What the sets a and b can share at most by their sketches; a wide
    sketch is folded to the width of the other."""
    def counts(i: np.ndarray, wide: int, w: int) -> np.ndarray:
        return data[start[i][:, None] + np.arange(wide)].reshape(len(i), wide // w, w).sum(1, dtype=np.uint16)

    out = np.full(len(a), np.iinfo(np.int64).max // 16)
    by = np.lexsort((width[b], width[a]))
    for s, e in _slices((width[a] << 32 | width[b])[by]):
        wa, wb = int(width[a[by[s]]]), int(width[b[by[s]]])
        if wa and wb:
            step = max(1, SKETCH_CHUNK // max(wa, wb))
            for at in range(s, e, step):
                i = by[at:min(e, at + step)]
                out[i] = np.minimum(counts(a[i], wa, min(wa, wb)), counts(b[i], wb, min(wa, wb))).sum(1, dtype=np.int64)
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("k"))


_SETS = "doc_id long, k long, n long, sig long, sketch binary, block int, counts binary"


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, signature and sketch of every set; at the end the task's part of the
    table of shingle counts."""
    counts = np.zeros(COUNTERS, np.int64)
    for rows, data, off in chunks(batches):
        key, index = shingle_sets(data, off)
        counts += np.bincount((key & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        n = rows.num_rows
        yield pa.RecordBatch.from_arrays([
            ids(rows), ids(rows, "k"), pa.array(np.diff(index)), pa.array(signatures(key, index)), sketches(key, index), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
            ["doc_id", "k", "n", "sig", "sketch", "block", "counts"])
    for b, part in enumerate(np.split(counts.astype(np.uint32), COUNTER_BLOCKS)):
        if part.any():
            yield _records([(None, None, None, None, None, b, zlib.compress(part.tobytes(), 1))], _SETS)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for r in batch.to_pylist():
            part = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
            total[r["block"]] = total.get(r["block"], 0) + part.astype(np.int64)
    for b, part in total.items():
        grade = np.minimum(63, 2 * np.log2(1 + part)).astype(np.uint8)
        yield _records([(b, grade.tobytes())], "block int, grade binary")


def count_grades(measured: DataFrame) -> np.ndarray:
    """Logarithmic grade of each counter: COUNTERS bytes on the driver."""
    rank = np.zeros((COUNTER_BLOCKS, COUNTERS // COUNTER_BLOCKS), np.uint8)
    parts = measured.where("block IS NOT NULL").select("block", "counts").repartition("block")
    for r in parts.mapInArrow(_add_up, "block int, grade binary").toLocalIterator():
        rank[r.block] = np.frombuffer(r.grade, np.uint8)
    return rank.ravel()


# --------------------------------------------------------------------------
# Posting lists of the first shingles of each set
# --------------------------------------------------------------------------

def prefix_length(n: np.ndarray) -> np.ndarray:
    """Shingles of a set of n of which a similar set must have one."""
    return n - (4 * n + 4) // 5 + 1


def may_link(n1, p1, n2, p2) -> np.ndarray:
    """Whether two sets can be similar if their first common shingle stands
    at positions p1 and p2: the overlap still possible against the needed."""
    needed = -((-4 * (n1 + n2)) // 9)
    return np.minimum(n1 - p1, n2 - p2) >= needed


_BLOCK = "bucket int, keys binary, entries binary, positions binary, sigs binary, sizes binary"


def posting_blocks(docs: DataFrame, rank: np.ndarray, buckets: int, run_bytes: int = RUN_BYTES) -> DataFrame:
    """One row per bucket of shingles and run of documents: the keys, and
    for every set with keys in the bucket its signature, size, number of keys
    and their positions. A task sends equal sets once."""
    sent = docs.sparkSession.sparkContext.broadcast(rank)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grades, seen, got, size = sent.value, np.zeros(0, np.int64), [], 0
        for _, data, off in chunks(batches):
            key, index = shingle_sets(data, off, grades)
            sig, n = signatures(key, index), np.diff(index)
            sets = np.unique(np.where(n > 0, sig, 0), return_index=True)[1]
            sets = np.sort(sets[(n[sets] > 0) & ~np.isin(sig[sets], seen)])
            seen = np.append(seen, sig[sets])
            p = prefix_length(n[sets])
            owner = np.repeat(np.arange(len(sets)), p)
            pos = np.arange(len(owner)) - np.repeat(np.cumsum(p) - p, p)
            got.append((key[index[sets][owner] + pos], sig[sets], n[sets], p, pos))
            size += len(data)
            if size >= run_bytes:
                yield from _blocks(got, buckets)
                got, size = [], 0
        if got:
            yield from _blocks(got, buckets)

    return docs.select("text").mapInArrow(cut, _BLOCK)


def _blocks(got: list, buckets: int) -> Iterator[pa.RecordBatch]:
    key, sig, n, p, pos = (np.concatenate(x) for x in zip(*got))
    owner = np.repeat(np.arange(len(sig)), p)
    spread = mix(key) >> np.uint64(32)
    bucket = ((spread * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    out = []
    for s, e in _slices(bucket[by]):
        part = by[s:e]
        own = owner[part]
        sets = own[_new_group(own)]
        entries = np.diff(np.append(np.flatnonzero(_new_group(own)), len(own)))
        out.append((int(bucket[part[0]]), key[part].tobytes(), pack(entries), pack(pos[part]), sig[sets].tobytes(), pack(n[sets])))
        if len(out) == 16:
            yield _records(out, _BLOCK)
            out = []
    if out:
        yield _records(out, _BLOCK)


_LISTS = "members long, key long, sig array<long>, n array<int>, pos array<int>"


def _lists(block: pa.Table) -> pa.Table:
    """Lists in which some two sets agree in size: their classes by size, and
    a hash of the set of classes. Of equal sets the least key stays."""
    rows = block.to_pylist()
    key = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])
    pos = np.concatenate([unpack(r["positions"]) for r in rows])
    entries = [unpack(r["entries"]) for r in rows]
    sig = np.concatenate([np.repeat(np.frombuffer(r["sigs"], np.int64), e) for r, e in zip(rows, entries)])
    n = np.concatenate([np.repeat(unpack(r["sizes"]), e) for r, e in zip(rows, entries)])
    many = np.zeros(len(key), bool)
    order = np.argsort(key, kind="stable")
    same = ~_new_group(key[order])
    many[order[same]] = True
    many[order[:-1][same[1:]]] = True
    at = np.flatnonzero(many)
    order = at[np.lexsort((sig[at], n[at], key[at]))]
    key, sig, n, pos = key[order], sig[order], n[order], pos[order]
    once = _new_group(key)              # equal sets sent by several tasks
    once[1:] |= (sig[1:] != sig[:-1]) | (n[1:] != n[:-1])
    key, sig, n, pos = key[once], sig[once], n[once], pos[once]
    close = (key[1:] == key[:-1]) & (5 * n[:-1] >= 4 * n[1:])    # the next larger set is near enough in size
    keep = np.zeros(len(key), bool)
    keep[1:] |= close
    keep[:-1] |= close
    key, sig, n, pos = key[keep], sig[keep], n[keep], pos[keep]
    edge = np.append(np.flatnonzero(_new_group(key)), len(key)) if len(key) else np.zeros(1, np.int64)
    members = np.add.reduceat(mix(sig.view(np.uint64)), edge[:-1]) if len(key) else key
    head = key[edge[:-1]]
    by = np.lexsort((head, members))
    least = np.sort(by[_new_group(members[by])])
    size = np.diff(edge)[least]
    part = np.repeat(edge[:-1][least] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    cut = pa.array(np.append(0, np.cumsum(size)).astype(np.int32))
    ascending = (head[least] ^ np.uint64(1 << 63)).view(np.int64)       # signed in the order of the unsigned key
    return pa.table([
        pa.array(members[least].view(np.int64)), pa.array(ascending), pa.ListArray.from_arrays(cut, pa.array(sig[part])),
        pa.ListArray.from_arrays(cut, pa.array(n[part].astype(np.int32))), pa.ListArray.from_arrays(cut, pa.array(pos[part].astype(np.int32)))],
        ["members", "key", "sig", "n", "pos"])


def posting_lists(blocks: DataFrame) -> DataFrame:
    """(key, sig, n, pos): the entries of the lists that are needed."""
    lists = blocks.groupBy("bucket").applyInArrow(_lists, _LISTS)
    lists = lists.groupBy("members").agg(F.min_by(F.struct("key", "sig", "n", "pos"), "key").alias("l"))
    return lists.select("l.key", F.inline(F.arrays_zip("l.sig", "l.n", "l.pos")))


def _plausible(block: pa.Table) -> pa.Table:
    """Entries with a partner in their list that their sketches do not rule
    out. Those with more than ``PARTNERS`` near in size stay unseen."""
    key, sig, n, pos = (block.column(c).to_numpy() for c in ("key", "sig", "n", "pos"))
    order = np.lexsort((sig, n, key))
    key, sig, n, pos = key[order], sig[order], n[order].astype(np.int64), pos[order]
    data, off = text_bytes(block.column("sketch").combine_chunks())
    start, width = off[:-1][order], np.diff(off)[order]
    group, base = np.cumsum(_new_group(key)) - 1, np.int64(1) << 32
    place = group * base + n
    lo = np.searchsorted(place, group * base + (4 * n + 4) // 5)
    hi = np.searchsorted(place, group * base + 5 * n // 4, side="right")
    reach = hi - lo
    keep = reach > PARTNERS
    i = np.flatnonzero(~keep)
    unseen = keep.copy()
    for s, e in _spans(reach[i], PAIR_CHUNK):
        r = reach[i[s:e]]
        a = np.repeat(i[s:e], r)
        b = np.arange(len(a)) - np.repeat(np.cumsum(r) - r, r) + np.repeat(lo[i[s:e]], r)
        ok = ((a < b) | unseen[b]) & (a != b) & may_link(n[a], pos[a], n[b], pos[b])
        a, b = a[ok], b[ok]
        ok = 9 * most_shared(data, start, width, a, b) >= 4 * (n[a] + n[b])
        keep[a[ok]] = True
        keep[b[ok]] = True
    return pa.table([pa.array(key[keep]), pa.array(sig[keep]), pa.array(n[keep].astype(np.int32)), pa.array(pos[keep])], ["key", "sig", "n", "pos"])


def plausible(entries: DataFrame, classes: DataFrame, buckets: int) -> DataFrame:
    """The entries (key, sig, n, pos) that sketches of their classes (sig,
    sketch) leave in their lists."""
    each = entries.join(classes.select("sig", "sketch"), "sig").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return each.groupBy("bucket").applyInArrow(_plausible, "key long, sig long, n int, pos int")


# --------------------------------------------------------------------------
# Comparison
# --------------------------------------------------------------------------

def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signature and shingles (58 bits, six bytes of them) of each text."""
    for _, data, off in chunks(batches):
        key, index = shingle_sets(data, off)
        sig = signatures(key, index)
        raw = np.ascontiguousarray(np.ascontiguousarray(key).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
        index = (6 * index).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array([raw[a:b] for a, b in zip(index[:-1], index[1:])], pa.binary())], ["sig", "members"])


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def numbers(raw: bytes) -> np.ndarray:
        wide = np.zeros((len(raw) // 6, 8), np.uint8)
        wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
        return wide.view(np.uint64).ravel()

    for batch in batches:
        shared, size = [], []
        held, last = None, None
        for a, x, y in zip(ids(batch, "u").to_pylist(), ids(batch, "mu"), ids(batch, "mv")):
            if a != last:
                held, last = numbers(x.as_py()), a
            other = numbers(y.as_py())
            both = np.sort(np.concatenate([held, other]))
            common = int((both[1:] == both[:-1]).sum())
            shared.append(common)
            size.append(len(both) - common)
        yield pa.RecordBatch.from_arrays([ids(batch, "u"), ids(batch, "v"), pa.array(shared, pa.int64()), pa.array(size, pa.int64())], ["u", "v", "shared", "joint"])


def compare(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(u, v, shared, joint): sizes of intersection and union of each pair."""
    far = pairs.join(members.select(F.col("sig").alias("v"), F.col("members").alias("mv")), "v")
    both = far.join(members.select(F.col("sig").alias("u"), F.col("members").alias("mu")), "u")
    return both.select("u", "v", "mu", "mv").mapInArrow(_overlap, "u long, v long, shared long, joint long")


class _Open:
    """The lists of one bucket, by size; ``other``: entries outside the
    largest component of their list. ``hub`` and ``far`` hold, per round, the
    class that an entry's class was compared with and their distance."""

    def __init__(self, block: pa.Table):
        key, sig, n, pos, comp = (block.column(c).to_numpy() for c in ("key", "sig", "n", "pos", "comp"))
        order = np.lexsort((sig, n, key))
        self.key, self.sig, self.n, self.pos, self.comp = (x[order] for x in (key, sig, n, pos, comp))
        met = block.column("met").combine_chunks()
        rounds = len(met) and len(met[0])
        flat = met.flatten()
        self.hub = flat.field("hub").to_numpy(zero_copy_only=False).reshape(len(order), rounds)[order]
        self.far = flat.field("far").to_numpy(zero_copy_only=False).reshape(len(order), rounds)[order]
        self.group = np.cumsum(_new_group(self.key)) - 1
        by = np.lexsort((self.comp, self.group))
        part = _new_group(self.group[by])
        part[1:] |= self.comp[by][1:] != self.comp[by][:-1]
        first = np.flatnonzero(part)
        count = np.diff(np.append(first, len(by)))
        best = np.lexsort((-count, self.group[by[first]]))
        best = best[_new_group(self.group[by[first[best]]])]
        main = self.comp[by[first[best]]]
        self.other = self.comp != main[self.group]
        self.open = np.isin(self.group, self.group[self.other])      # lists of more than one component

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a common hub shows that two entries cannot be similar."""
        return ((self.hub[a] == self.hub[b]) & (np.abs(self.far[a] - self.far[b]) > 0.2 + 1e-9)).any(1)


_MET = "array<struct<hub: long, far: double>>"
_ASKS = "lead long, sig long, score long"


def _asks(k: int):
    def asks(block: pa.Table) -> pa.Table:
        """(lead, sig, score) of round k: entries outside the largest
        component of their list and its leaders; for each class of the bucket
        the ``LEADERS ** k`` best scores at most, which bounds the round."""
        x = _Open(block)
        most = LEADERS ** k
        code = mix(x.sig.view(np.uint64) + np.uint64(k)) >> np.uint64(1)
        near = code if k != 1 else (x.far[:, -1] * 1e6).astype(np.uint64)       # 0 for the hub itself
        if not k:
            near = x.sig.view(np.uint64) ^ np.uint64(1 << 63)                    # the least signature
        shut = np.zeros(len(x.key), bool) if not k else x.other
        by = np.lexsort((x.sig, near, shut, x.group))
        start = np.append(np.flatnonzero(_new_group(x.group[by])), len(by))
        inside = np.bincount(x.group[~shut], minlength=len(start) - 1)
        leaders = np.minimum(inside, most)
        i = np.flatnonzero(x.open & (x.other if k else True))
        found = [np.zeros((3, 0), np.int64)]
        for s, e in _spans(leaders[x.group[i]], PAIR_CHUNK):
            n = leaders[x.group[i[s:e]]]
            a = np.repeat(i[s:e], n)
            b = by[np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + start[x.group[a]]]
            small, large = np.minimum(x.n[a], x.n[b]), np.maximum(x.n[a], x.n[b])
            ok = (x.comp[a] != x.comp[b]) & (5 * small >= 4 * large) & may_link(x.n[a], x.pos[a], x.n[b], x.pos[b]) & ~x.apart(a, b)
            a, b = a[ok], b[ok]
            found.append(np.unique(np.stack([x.sig[a], (near[b] >> np.uint64(1)).view(np.int64), x.sig[b]]), axis=1))
        sig, score, lead = np.unique(np.concatenate(found, axis=1), axis=1)      # by class, best score first
        first = _new_group(sig)
        place = np.arange(len(sig)) - np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0)) if len(sig) else sig
        ok = place < most
        return pa.table([pa.array(lead[ok]), pa.array(sig[ok]), pa.array(score[ok])], ["lead", "sig", "score"])

    return asks


def _open_pairs(block: pa.Table) -> pa.Table:
    """All pairs of different components that the rounds left open."""
    x = _Open(block)
    n, base = x.n.astype(np.int64), np.int64(1) << 32
    place = x.group * base + n
    lo = np.searchsorted(place, x.group * base + (4 * n + 4) // 5)
    hi = np.searchsorted(place, x.group * base + 5 * n // 4, side="right")
    i = np.flatnonzero(x.other)         # members of the largest component do not meet each other
    reach = hi[i] - lo[i]
    found = [np.zeros((2, 0), np.int64)]
    for s, e in _spans(reach, PAIR_CHUNK):
        a = np.repeat(i[s:e], reach[s:e])
        b = np.arange(len(a)) - np.repeat(np.cumsum(reach[s:e]) - reach[s:e], reach[s:e]) + lo[a]
        ok = (x.comp[a] != x.comp[b]) & (~x.other[b] | (a < b)) & may_link(n[a], x.pos[a], n[b], x.pos[b])
        a, b = a[ok], b[ok]
        ok = ~x.apart(a, b)
        a, b = a[ok], b[ok]
        found.append(np.unique(np.stack([np.minimum(x.sig[a], x.sig[b]), np.maximum(x.sig[a], x.sig[b])]), axis=1))
    u, v = np.unique(np.concatenate(found, axis=1), axis=1)
    return pa.table([pa.array(u), pa.array(v)], ["u", "v"])


def _spans(size: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Cut a list of sizes into runs of about ``most`` in sum."""
    cut = np.cumsum(size) // most
    return _slices(cut) if len(cut) else []


def link_groups(docs: DataFrame, per_bucket: int = BUCKET_ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_shingles, component_id, k (a hash of the row) and root (names
    the group; null without shingles) of every document; component_id is the
    smallest doc_id reachable by links."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    measured = scratch.write(_keyed(docs).mapInArrow(_measure, _SETS), "sets")
    sets = measured.where("block IS NULL").select("doc_id", "k", "n", "sig")
    shingles = sets.agg(F.sum("n")).first()[0] or 0
    buckets = max(8, -(-shingles // (5 * per_bucket)))

    blocks = posting_blocks(docs, count_grades(measured), buckets)
    entries = scratch.write(posting_lists(blocks), "entries")
    scratch.clear(*scratch.paths)       # the blocks' shuffle is not read again
    # one text for every class that stands in a list
    classes = measured.where("n > 0").groupBy("sig").agg(F.min("k").alias("k"), F.first("sketch").alias("sketch"))
    classes = scratch.write(classes.join(entries.select("sig").distinct(), "sig", "left_semi"), "classes")
    # read in every round: lists and members lie in buckets of the class, so the rounds do not deal them anew
    lists = scratch.bucketed(plausible(entries, classes, 4 * buckets), "lists", "sig")
    one = scratch.write(classes.join(lists.select("sig").distinct(), "sig", "left_semi").select("k"), "one")
    scratch.clear(*[p for p in scratch.paths if p not in ("entries", "classes")])
    texts = _keyed(docs).select("k", "text").join(one, "k", "left_semi").select("text")
    members = scratch.bucketed(texts.mapInArrow(_members, "sig long, members binary").dropDuplicates(["sig"]), "members", "sig", dealt=True)
    scratch.clear(*[p for p in scratch.paths if p != "one"])

    comp = seen = None
    hubs = scratch.write(lists.select("sig").distinct().withColumn("met", F.array().cast(_MET)), "hubs")
    for k in range(rounds + 1):
        named = lists.join(hubs, "sig").withColumn("comp", F.col("sig"))
        if comp is not None:
            named = lists.join(hubs, "sig").join(comp.withColumnRenamed("node", "sig"), "sig", "left").withColumn("comp", F.coalesce("root", "sig")).drop("root")
            mixed = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
            named = named.join(mixed, "key", "left_semi")
        dealt = named.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).groupBy("bucket")
        if k < rounds:
            asked = dealt.applyInArrow(_asks(k), _ASKS).groupBy("lead", "sig").agg(F.min("score").alias("score"))
            pairs = asked.select(F.col("lead").alias("u"), F.col("sig").alias("v"), "score")
        else:
            pairs = dealt.applyInArrow(_open_pairs, "u long, v long").distinct()
        if seen is not None:        # never compare twice
            for u, v in (("u", "v"), ("v", "u")):
                pairs = pairs.join(seen.select(F.col("u").alias(u), F.col("v").alias(v)), ["u", "v"], "left_anti")
        if k < rounds:
            turn = F.row_number().over(Window.partitionBy("v").orderBy("score", "u"))
            pairs = pairs.withColumn("turn", turn).where(F.col("turn") <= LEADERS ** k)
        now = scratch.write(compare(pairs.select("u", "v"), members), f"seen{k}")
        links = now.where("100 * shared >= 80 * joint").select("u", "v")
        if comp is not None:
            links = links.unionAll(comp.select(F.col("node").alias("u"), F.col("root").alias("v")))
        comp = components(links, scratch, f"round{k}")
        if k < rounds:
            seen = now if seen is None else seen.unionAll(now)
            # the nearest leader met in a round is a class's hub; one that met nobody is its own
            hub = now.groupBy(F.col("v").alias("sig")).agg(F.min(F.struct((1 - F.col("shared") / F.col("joint")).alias("far"), "u")).alias("b"))
            here = F.struct(F.coalesce("b.u", "sig").alias("hub"), F.coalesce("b.far", F.lit(0.0)).alias("far"))
            hubs = scratch.write(hubs.join(hub, "sig", "left").select("sig", F.concat("met", F.array(here)).alias("met")), f"hubs{k}")
            scratch.drop(f"hubs{k - 1}" if k else "hubs")

    classes = sets.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("low")).join(comp.withColumnRenamed("node", "sig"), "sig", "left")
    classes = classes.select("sig", "low", F.coalesce("root", "sig").alias("root"))
    least = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = classes.select("sig", "root").join(least, "root")
    out = sets.join(classes, (sets["sig"] == classes["sig"]) & (sets["n"] > 0), "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "k", "root")
    out = scratch.write(out, "groups")
    scratch.clear("groups")
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without near copies: of each group the row with the
    smallest doc_id (null last) stays, and of repeated rows one; documents
    without words, which are linked with nothing, all stay."""
    scratch = Scratch(docs.sparkSession, "one")
    groups = scratch.write(link_groups(docs).select("doc_id", "k", "root"), "groups").where("root IS NOT NULL")
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")).alias("first"))
    whole = boxed(docs, "text", row_key().alias("k"))
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = whole.where(~wordless).join(first.select(F.col("first.k").alias("k")), "k", "left_semi").dropDuplicates(["k"])
    return unboxed(kept.select("row").unionAll(whole.where(wordless).select("row")))
