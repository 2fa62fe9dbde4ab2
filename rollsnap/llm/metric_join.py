"""Embedding near-dedup: exact metric range join of the vectors of one label.

On unit vectors cosine >= t means Euclidean distance <= eps = sqrt(2 - 2t), so
links are a range join in a metric space. Pivots (a bounded sample, no two of
a label within eps/2) cut the vectors of a label into cells of the nearest
pivot. The triangle inequality then decides everything but the comparisons:

* members within eps/2 of their pivot (the *core* of a cell) are linked with
  each other for certain. They are counted, never compared; a large group of
  near copies costs one row each.
* a vector visits a later cell only if some member could be within eps: not
  if it is farther from the pivot than the cell's radius plus eps, and not if
  it is farther than eps from the half space nearer to that pivot.
* inside a cell only pairs whose distances to the pivot differ by at most eps
  are compared.

Cells join independently. A cell above ``BLOCK`` members or visitors is dealt
as blocks, one task per pair of blocks, so memory is bounded whatever the
cell's size. A task returns one row per linked vector (number of links and
the smallest id it reaches there), never pairs; union-find joins the rest.
Equal vectors are one row with a weight from the first shuffle on.

The sample decides only speed: any pivots give the same links. Where distances
are all alike (random directions in many dimensions) the inequality spares
little and the work is that of comparing all blocks.

Defined cases: a null label, null or zero vectors and vectors with null or
non-finite components link with nothing; so do rows without vec_id (their
component is null, kept is false) and vectors of unlike lengths. Rows of one
vec_id are one node of the link graph; each counts its own links. An empty
table gives no rows; other columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .graph import components

#: vectors a pivot stands for
CELL = 4096
#: at most so many components of pivots are broadcast (16 MB as doubles)
PIVOT_VALUES = 1 << 21
#: members or visitors of a cell in one task
BLOCK = 2048
#: rows compared in one numpy step
STRIP = 256
#: slack of every decision by the triangle inequality
SLACK = 1e-9

_PREPARED = "vec_id long, label string, dim int, raw binary"
_DEALT = "label string, dim int, cell int, core boolean, visits boolean, id long, key binary, weight long, dist double, raw binary, bonus long, root long"


def floats(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, starts, lengths) of a list column; null lists have length 0,
    null components are NaN."""
    off = np.asarray(col.offsets).astype(np.int64)
    values = col.values
    if values.null_count:
        values = values.fill_null(float("nan"))
    size = np.diff(off)
    if col.null_count:
        size = np.where(np.asarray(col.is_null()), 0, size)
    return np.asarray(values), off[:-1], size


def rows_of_length(values: np.ndarray, starts: np.ndarray, rows: np.ndarray, dim: int) -> np.ndarray:
    return values[starts[rows][:, None] + np.arange(dim)]


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row, with its vector as bytes of its own float type if it can link, else null."""
    for b in batches:
        values, starts, size = floats(b.column(2))
        known = np.asarray(b.column(0).is_valid()) & np.asarray(b.column(1).is_valid())
        raw: list[bytes | None] = [None] * b.num_rows
        for dim in np.unique(size[known & (size > 0)]):
            rows = np.flatnonzero(known & (size == dim))
            x = np.ascontiguousarray(rows_of_length(values, starts, rows, dim) + values.dtype.type(0))      # -0.0 becomes 0.0
            good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            for i in np.flatnonzero(good):
                raw[rows[i]] = x[i].tobytes()
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size.astype(np.int32)), pa.array(raw, pa.binary())], names=["vec_id", "label", "dim", "raw"])


def _units(raw: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors in double precision of vectors of one length."""
    flat = b"".join(raw.to_pylist())
    x = np.frombuffer(flat, np.float32 if len(flat) == 4 * dim * len(raw) else np.float64).reshape(len(raw), dim).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)          # no square overflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distances(u: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (u @ p.T), 0))


class Cells:
    """The pivots of every (label, length), with their cells' figures once known."""

    def __init__(self, pivots: dict[tuple[str, int], np.ndarray], eps: float):
        self.pivots, self.eps = pivots, eps
        #: (label, dim, cell, core) -> (largest distance, weight, smallest id)
        self.figures: dict[tuple[str, int, int, bool], tuple[float, int, int]] = {}

    def home(self, u: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        d = _distances(u, p)
        cell = d.argmin(axis=1)
        dist = d[np.arange(len(u)), cell]
        return d, cell, dist, dist <= self.eps / 2 - SLACK

    def visits(self, label: str, dim: int, d: np.ndarray, cell: np.ndarray, dist: np.ndarray, core: np.ndarray, p: np.ndarray):
        """(rows, cell, ring) that members of other cells, or of the same
        cell's outer ring, have to visit. Each pair of rings meets once: the
        vector of the earlier cell visits the later one, and the outer ring
        visits the core of its own cell."""
        k = len(p)
        apart = _distances(p, p)
        for q in range(k):
            with np.errstate(divide="ignore", invalid="ignore"):
                beyond = (d[:, q] ** 2 - dist ** 2) / (2 * apart[cell, q])      # distance to the half space of q
            near = (cell < q) & ~(beyond > self.eps + SLACK)
            for ring in (True, False):
                if (known := self.figures.get((label, dim, q, ring))) is None:
                    continue
                own = (cell == q) & ~core if ring else np.zeros(len(cell), bool)
                yield np.flatnonzero((near | own) & (d[:, q] <= known[0] + self.eps + SLACK)), q, ring


def _by_space(b: pa.RecordBatch) -> Iterator[tuple[str, int, np.ndarray]]:
    """Rows of one (label, dim) in a batch."""
    label = b.column(b.schema.get_field_index("label")).dictionary_encode()
    code, dim = np.asarray(label.indices), np.asarray(b.column(b.schema.get_field_index("dim")))
    for c, d in sorted({*zip(code.tolist(), dim.tolist())}):
        yield label.dictionary[c].as_py(), d, np.flatnonzero((code == c) & (dim == d))


def _measure(cells) -> object:
    """Task: distance of every vector to its pivot (label, dim, cell, core, dist, weight, id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for label, dim, rows in _by_space(b):
                if (p := cells.value.pivots.get((label, dim))) is None:
                    continue
                part = b.take(pa.array(rows))
                _, cell, dist, core = cells.value.home(_units(part.column("raw"), dim), p)
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), part.column("dim"), pa.array(cell.astype(np.int32)), pa.array(core), pa.array(dist), part.column("weight"), part.column("id")],
                    names=["label", "dim", "cell", "core", "dist", "weight", "id"])
    return run


def _deal(cells) -> object:
    """Task: every vector as a member of its cell and as a visitor of others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(part, cell, core, visits, dist, bonus, root):
            n = part.num_rows
            fixed = [part.column("label"), part.column("dim"), pa.array(np.asarray(cell, np.int32)), pa.array(np.asarray(core, bool)), pa.array(np.full(n, visits))]
            return pa.RecordBatch.from_arrays(
                [*fixed, part.column("id"), part.column("key"), part.column("weight"), pa.array(dist), part.column("raw"), pa.array(bonus), pa.array(root)],
                names=[c.split()[0] for c in _DEALT.split(", ")])

        for b in batches:
            for label, dim, rows in _by_space(b):
                part = b.take(pa.array(rows))
                n, ids, weight = len(rows), np.asarray(part.column("id")), np.asarray(part.column("weight"))
                if (p := cells.value.pivots.get((label, dim))) is None:
                    yield out(part, np.zeros(n), np.zeros(n, bool), False, np.zeros(n), np.zeros(n, np.int64), ids)
                    continue
                d, cell, dist, core = cells.value.home(_units(part.column("raw"), dim), p)
                whole = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
                for q in range(len(p)):
                    if (known := cells.value.figures.get((label, dim, q, True))) is not None:
                        whole[0][q], whole[1][q] = known[1], known[2]
                yield out(part, cell, core, False, dist, np.where(core, whole[0][cell] - weight, 0), np.where(core, whole[1][cell], ids))
                for at, q, ring in cells.value.visits(label, dim, d, cell, dist, core, p):
                    if len(at):
                        yield out(part.take(pa.array(at)), np.full(len(at), q), np.full(len(at), ring), True, d[at, q], np.zeros(len(at), np.int64), ids[at])
    return run


def _exact(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of two vectors in extended precision, for pairs at the threshold."""
    a, b = a.astype(np.longdouble), b.astype(np.longdouble)
    return float((a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum()))


def _pairs(left: np.ndarray, dl: np.ndarray, right: np.ndarray, dr: np.ndarray, same: bool, threshold: float, eps: float):
    """Linked (left, right) positions. Both sides are in the order of their
    distance to the pivot; the same side is met above the diagonal only."""
    for lo in range(0, len(left), STRIP):
        hi = min(lo + STRIP, len(left))
        a = int(np.searchsorted(dr, dl[lo] - eps - SLACK, side="left"))
        b = int(np.searchsorted(dr, dl[hi - 1] + eps + SLACK, side="right"))
        if same:
            a = max(a, lo)
        if a >= b:
            continue
        s = left[lo:hi] @ right[a:b].T
        hit = s >= threshold
        for i, j in zip(*np.nonzero(np.abs(s - threshold) < 1e-13)):
            hit[i, j] = _exact(left[lo + i], right[a + j]) >= threshold
        i, j = np.nonzero(hit)
        i, j = i + lo, j + a
        yield (i[i < j], j[i < j]) if same else (i, j)


def _reach(ids: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest id that each position reaches over the pairs (u, v)."""
    low = ids.copy()
    while True:
        m = np.minimum(low[u], low[v])
        new = low.copy()
        np.minimum.at(new, u, m)
        np.minimum.at(new, v, m)
        if (new == low).all():
            return low
        low = new


def _join(threshold: float, eps: float):
    """One pair of blocks of one cell: (key, id, links, root) of its linked rows."""
    def run(t: pa.Table) -> pa.Table:
        dim, core = t.column("dim")[0].as_py(), t.column("core")[0].as_py()
        t = t.sort_by([("side", "ascending"), ("dist", "ascending"), ("key", "ascending")])
        side, dist, ids = np.asarray(t.column("side")), np.asarray(t.column("dist")), np.asarray(t.column("id"))
        weight, units = np.asarray(t.column("weight")), _units(t.column("raw").combine_chunks(), dim)
        cut = np.searchsorted(side, [0, 1, 2, 3])        # members, members of the other block, visitors
        first = slice(cut[0], cut[1])
        same = t.column("a")[0].as_py() == t.column("b")[0].as_py() and not core
        meets = [(slice(cut[1], cut[2]), False), (slice(cut[2], cut[3]), False)] + ([(first, True)] if same else [])
        links, us, vs = np.zeros(len(ids), np.int64), [], []
        for other, alike in meets:
            for i, j in _pairs(units[first], dist[first], units[other], dist[other], alike, threshold, eps):
                u, v = i + first.start, j + other.start
                links += np.bincount(u, weight[v], len(ids)).astype(np.int64) + np.bincount(v, weight[u], len(ids)).astype(np.int64)
                us.append(u)
                vs.append(v)
        at = np.flatnonzero(links)
        low = _reach(ids, np.concatenate(us), np.concatenate(vs)) if len(at) else ids
        return pa.table({"key": t.column("key").take(pa.array(at)), "id": pa.array(ids[at]), "links": pa.array(links[at]), "root": pa.array(low[at])})
    return run


def _thinned(rows: list, eps: float) -> dict[tuple[str, int], np.ndarray]:
    """Pivots by (label, dim), none within eps/2 of an earlier one."""
    spaces: dict[tuple[str, int], list] = {}
    for r in rows:
        spaces.setdefault((r.label, r.dim), []).append(bytes(r.raw))
    out = {}
    for (label, dim), raws in spaces.items():
        u = _units(pa.array(raws, pa.binary()), dim)
        kept = [0]
        for i in range(1, len(u)):
            if _distances(u[i:i + 1], u[kept]).min() > eps / 2:
                kept.append(i)
        out[label, dim] = u[kept]
    return out


def _choose(vectors: DataFrame, eps: float) -> Cells:
    """Pivots: the first vectors by hash, one per ``CELL`` and no more than
    ``PIVOT_VALUES`` components of them; bounded on the driver and as a broadcast."""
    n, widest = vectors.agg(F.count(F.lit(1)), F.max("dim")).first()
    most = min(n // CELL, PIVOT_VALUES // widest) if n else 0
    rows = vectors.orderBy(F.xxhash64("key"), "key").select("label", "dim", "raw").limit(most).collect() if most else []
    return Cells(_thinned(rows, eps), eps)


def _tasks(dealt: DataFrame) -> DataFrame:
    """Every member and visitor once per pair of blocks that needs it: task
    (a, b) and side (0 member of block a, 1 member of block b, 2 visitor).
    The first chunk of visitors rides with the tasks (a, a)."""
    cell = ["label", "dim", "cell", "core"]
    sizes = dealt.groupBy(*cell).agg(F.count(F.when(~F.col("visits"), 1)).alias("h"), F.count(F.when(F.col("visits"), 1)).alias("v"))
    sizes = sizes.where(f"h > {BLOCK} OR v > {BLOCK}").select(
        *cell, F.ceil(F.greatest("h", F.lit(1)) / BLOCK).cast("int").alias("nh"), F.ceil(F.greatest("v", F.lit(1)) / BLOCK).cast("int").alias("nv"))
    rows = dealt.join(sizes, cell, "left").withColumn("nh", F.coalesce("nh", F.lit(1))).withColumn("nv", F.coalesce("nv", F.lit(1)))
    block = F.pmod(F.xxhash64("key"), F.when(F.col("visits"), F.col("nv")).otherwise(F.col("nh")).cast("long")).cast("int")
    rows = rows.withColumn("block", block)
    to = lambda a, b, side: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"), F.lit(side).alias("side"))
    me, nh, nv = F.col("block"), F.col("nh"), F.col("nv")
    empty = F.array().cast("array<struct<a:int,b:int,side:int>>")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    chunks = F.transform(upto(nv - 1), lambda v: to(me, nh + v, 0))
    later = F.when(F.col("core"), empty).otherwise(F.transform(F.filter(upto(nh), lambda j: j > me), lambda j: to(me, j, 0)))
    earlier = F.when(F.col("core"), empty).otherwise(F.transform(F.filter(upto(nh), lambda j: j < me), lambda j: to(j, me, 1)))
    member = F.concat(F.array(to(me, me, 0)), later, earlier, chunks)
    visitor = F.transform(upto(nh), lambda a: to(a, F.when(me == 0, a).otherwise(nh + me - 1), 2))
    tasks = F.explode(F.when(F.col("visits"), visitor).otherwise(member))
    return rows.select(*cell, "id", "key", "weight", "dist", "raw", tasks.alias("task")).select("*", "task.*").drop("task")


def links(vectors: DataFrame, scratch: Scratch, threshold: float) -> DataFrame:
    """key, id, links, root: partial counts and the smallest id met, for the
    distinct ``vectors`` (label, dim, raw, key, id, weight)."""
    spark, eps = vectors.sparkSession, math.sqrt(2 - 2 * threshold)
    cells = _choose(vectors, eps)
    if cells.pivots:
        shared = spark.sparkContext.broadcast(cells)
        measured = vectors.mapInArrow(_measure(shared), "label string, dim int, cell int, core boolean, dist double, weight long, id long")
        # at most two rows for each pivot
        for r in measured.groupBy("label", "dim", "cell", "core").agg(F.max("dist").alias("d"), F.sum("weight").alias("w"), F.min("id").alias("i")).collect():
            cells.figures[r.label, r.dim, r.cell, r.core] = (r.d, r.w, r.i)
        shared.destroy()
    shared = spark.sparkContext.broadcast(cells)
    dealt = scratch.write(vectors.mapInArrow(_deal(shared), _DEALT), "dealt")
    shared.destroy()
    joined = _tasks(dealt).groupBy("label", "dim", "cell", "core", "a", "b").applyInArrow(_join(threshold, eps), "key binary, id long, links long, root long")
    cores = dealt.where("core AND NOT visits").select("key", "id", F.col("bonus").alias("links"), "root")
    return scratch.write(joined.unionAll(cores), "links")


def link_vectors(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors``
    (vec_id, label, embedding)."""
    scratch = Scratch(vectors.sparkSession, "metric")
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    rows = source.mapInArrow(_prepare, _PREPARED).withColumn("key", F.unhex(F.md5(F.concat(F.col("raw"), F.encode("label", "UTF-8")))))
    distinct = rows.where("raw IS NOT NULL").groupBy("label", "dim", "raw", "key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
    distinct = scratch.write(distinct, "vectors")
    rows = scratch.write(rows.select("vec_id", "key"), "rows")
    found = links(distinct, scratch, threshold)
    counts = distinct.select("key", "id", "weight").join(found.groupBy("key").agg(F.sum("links").alias("links")), "key", "left")
    counts = counts.select("key", "id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    able = rows.where("key IS NOT NULL").join(counts, "key").select("vec_id", "id", "n_links")
    alone = rows.where("key IS NULL").select("vec_id", F.col("vec_id").alias("id"), F.lit(0).cast("long").alias("n_links"))
    each = scratch.write(able.unionAll(alone), "each")
    edges = found.select(F.col("id").alias("u"), F.col("root").alias("v")).unionAll(each.select(F.col("vec_id").alias("u"), F.col("id").alias("v")))
    roots = components(edges, scratch)
    out = each.join(roots, F.col("vec_id") == F.col("node"), "left").select("vec_id", "n_links", F.coalesce("root", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
