"""Centroid clustering: exact k-means on whole numbers, every vector assigned
by the threshold algorithm.

A component x becomes floor(1024 * x). For every dimension the centroids are
a sorted list; from a vector's value the list is walked outward, one step in
all dimensions at a time. A centroid met for the first time in any list gets
its exact distance. No centroid still unmet can be nearer than the sum of the
squared distances at the frontier, so the walk ends once that sum strictly
exceeds the best exact distance (strictly, because an equal centroid with a
smaller number would win) or all are met.

A round is one Spark job: a task adds up its vectors per cluster and returns
one row a cluster, Spark sums them, and k rows reach the driver. Sums are
exact, so partitioning and lost tasks change nothing.

Defined cases: vectors that are null, of another length or with null or
non-finite components are not kept and have no row; rows without vec_id are
clustered but start a centroid last; repeated ids start centroids in the order
of their vectors; fewer vectors than k give fewer centroids; an empty table
gives no rows. Whole numbers of 2^27 and more in size, whose squared distances
pass the range of a long, raise OverflowError. Other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .metric_join import floats, rows_of_length

#: whole numbers per unit of a component
SCALE = 1024
#: vectors assigned in one numpy pass
ROWS = 2048
_FAR = np.iinfo(np.int64).max


def _points(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, starts, size = floats(b.column(1))
            rows = np.flatnonzero(size == dims)
            x = rows_of_length(values, starts, rows, dims).astype(np.float64)
            good = np.isfinite(x).all(axis=1)
            rows, x = rows[good], np.floor(x[good] * SCALE)
            if (np.abs(x) >= 1 << 27).any():
                raise OverflowError("a component is too large for squared distances in a long")
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array([p.tobytes() for p in x.astype(np.int64)], pa.binary())], names=["vec_id", "point"])
    return run


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, squared distance, exact distances computed) of every point."""
    n, dims = points.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    every = np.arange(dims)
    best, who, seen = np.full(n, _FAR), np.full(n, k), np.zeros((n, k), bool)
    right = np.zeros((n, dims), np.int64)
    for j in range(k):
        right += points >= lists[j]
    left, open_ = right - 1, np.arange(n)
    while len(open_):
        x = points[open_]
        lo = np.where(left >= 0, x - lists[np.maximum(left, 0), every], _FAR)
        hi = np.where(right < k, lists[np.minimum(right, k - 1), every] - x, _FAR)
        down = lo <= hi
        frontier = np.minimum(lo, hi)
        met = np.where(down, order[np.maximum(left, 0), every], order[np.minimum(right, k - 1), every])
        left, right = left - down, right + ~down
        mark = np.zeros((len(open_), k), bool)
        mark[np.arange(len(open_))[:, None], met] = True
        i, c = np.nonzero(mark & ~seen[open_])
        seen[open_[i], c] = True
        exact = np.full((len(open_), k), _FAR)
        gap = x[i] - centroids[c]
        exact[i, c] = (gap * gap).sum(axis=1)
        new = exact.argmin(axis=1)                       # the smaller number of equals
        d = exact[np.arange(len(open_)), new]
        better = (d < best[open_]) | ((d == best[open_]) & (new < who[open_]))
        best[open_], who[open_] = np.where(better, d, best[open_]), np.where(better, new, who[open_])
        go = ~(((frontier * frontier).sum(axis=1) > best[open_]) | seen[open_].all(axis=1))
        left, right, open_ = left[go], right[go], open_[go]
    return who, best, seen.sum(axis=1)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            part = b.slice(lo, ROWS)
            x = np.frombuffer(b"".join(part.column(1).to_pylist()), np.int64).reshape(part.num_rows, centroids.shape[1])
            yield part, x, *nearest(x, centroids)[:2]


def _sums(centroids: np.ndarray):
    """Task: vectors and component sums of every cluster."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for _, x, who, _ in _assigned(batches, centroids):
            np.add.at(total, who, x)
            n += np.bincount(who, minlength=len(centroids))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at]), pa.array(list(total[at]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])
    return run


def _rows(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, who, d in _assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(who.astype(np.int32)), pa.array(d)], names=["vec_id", "cluster", "distance"])
    return run


def first_centroids(points: DataFrame, k: int, dims: int, seed: str) -> np.ndarray:
    """The points of the k smallest sha256 of ``seed:vec_id``."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = points.orderBy(name.asc_nulls_last(), "point").limit(k).collect()
    return np.frombuffer(b"".join(bytes(r.point) for r in rows), np.int64).reshape(len(rows), dims)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, seed: str = "3") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector of ``vectors``
    (vec_id, embedding) as a written table, and the final centroids."""
    scratch = Scratch(vectors.sparkSession, "centroids")
    points = scratch.write(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_points(dims), "vec_id long, point binary"), "points")
    centroids = first_centroids(points, k, dims, seed)
    if not len(centroids):
        return points.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        part = points.mapInArrow(_sums(centroids), "cluster int, n long, total array<long>")
        whole = [F.sum(F.col("total")[d].cast("decimal(38,0)")).alias(f"t{d}") for d in range(dims)]
        centroids = centroids.copy()
        for r in part.groupBy("cluster").agg(F.sum("n").alias("n"), *whole).collect():      # at most k rows
            centroids[r.cluster] = [int(r[f"t{d}"]) // r.n for d in range(dims)]
    return scratch.write(points.mapInArrow(_rows(centroids), "vec_id long, cluster int, distance long"), "assigned"), centroids


def report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds the inertia of its cluster and of all, and its centroid's digest, to every vector."""
    sums = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}      # one row a cluster
    digest = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    facts = [(i, sums.get(i, 0), sum(sums.values()), digest(c)) for i, c in enumerate(centroids)]
    facts = assigned.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
