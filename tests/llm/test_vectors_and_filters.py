"""Operators 11 to 13 against brute force, with their odd cases."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from conftest import documents
from rollsnap.llm import centroids, filter_audit, metric_join

VECTORS = "vec_id long, embedding array<float>, label int, key string, raw string, cell int, weight long"


def vectors(spark, rows):
    """(vec_id, embedding, label) with columns whose names the operators use."""
    return spark.createDataFrame([(i, None if e is None else [None if x is None else float(x) for x in e], g, "k", "r", 1, 2) for i, e, g in rows], VECTORS)


def _linked(rows, threshold):
    """(links, component) of every row by comparing all pairs."""
    def unit(r):
        i, e, g = r
        if i is None or g is None or not e or any(x is None or not math.isfinite(x) for x in e) or not any(e):
            return None
        x = np.array([np.float32(v) for v in e], np.float64)
        return x / np.linalg.norm(x)
    us = [unit(r) for r in rows]
    pairs = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2)
             if us[a] is not None and us[b] is not None and rows[a][2] == rows[b][2] and len(us[a]) == len(us[b]) and us[a] @ us[b] >= threshold]
    root = {r[0]: r[0] for r in rows if r[0] is not None}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(root[rows[a][0]], root[rows[b][0]])
            for k in (rows[a][0], rows[b][0]):
                changed |= root[k] != m
                root[k] = m
    n = [0] * len(rows)
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    return sorted((-1 if r[0] is None else r[0], n[k], -1 if r[0] is None else root[r[0]], r[0] is not None and root[r[0]] == r[0]) for k, r in enumerate(rows))


def _got(df):
    return sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id, r.kept) for r in df.collect())


def _clouds(seed, dim, hot=60, free=120):
    """Chains, a dense group of near copies, exact copies and lone vectors in three labels."""
    g = np.random.default_rng(seed)
    rows, i = [], 0
    for label in (1, 2, 3):
        centre = g.normal(size=dim)
        for _ in range(hot if label == 1 else 10):
            rows.append((i, (centre + 0.02 * g.normal(size=dim)).tolist(), label))
            i += 1
        for _ in range(free):
            rows.append((i, g.normal(size=dim).tolist(), label))
            i += 1
        step = g.normal(size=dim)
        for k in range(25):                               # a chain: only neighbours are linked
            rows.append((i, (centre + 0.25 * k * step).tolist(), label))
            i += 1
        rows += [(i + k, rows[-1][1], label) for k in range(7)]
        i += 7
    rows += [(3, rows[0][1], 1), (3, rows[100][1], 1), (5, None, 1), (9000, None, 1), (9001, [], 1), (9002, [0.0] * dim, 1), (9003, [None] + [1.0] * (dim - 1), 1),
             (9004, [float("nan")] * dim, 1), (9005, rows[0][1], None), (None, rows[0][1], 1), (9006, [float("inf")] + [1.0] * (dim - 1), 1), (9007, rows[0][1][:-1], 1), (9008, rows[0][1], 7)]
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("cell, block, dim", [(4096, 2048, 6), (20, 16, 6), (8, 5, 3), (40, 512, 16)])
def test_links_are_those_of_all_pairs(spark, monkeypatch, cell, block, dim):
    monkeypatch.setattr(metric_join, "CELL", cell)
    monkeypatch.setattr(metric_join, "BLOCK", block)
    rows = _clouds(cell, dim)
    df = vectors(spark, rows).repartition(5)
    assert _got(metric_join.link_vectors(df, 0.93)) == _linked(rows, 0.93)


def test_pivots_leave_a_large_group_uncompared(spark, monkeypatch):
    """Members of the group are core members: no task gets pairs of them."""
    monkeypatch.setattr(metric_join, "CELL", 50)
    g = np.random.default_rng(5)
    rows = [(i, ([1.0] + [0.0] * 7) + 0.01 * g.normal(size=8), 1) for i in range(400)]
    met = []
    plain = metric_join._tasks
    monkeypatch.setattr(metric_join, "_tasks", lambda dealt: met.append(dealt) or plain(dealt))
    got = _got(metric_join.link_vectors(vectors(spark, rows), 0.93))
    assert got == [(i, 399, 0, i == 0) for i in range(400)]
    assert met[0].where("NOT core").count() == 0 and met[0].where("visits").count() == 0


def test_links_of_nothing(spark):
    assert metric_join.link_vectors(vectors(spark, [])).count() == 0
    assert _got(metric_join.link_vectors(vectors(spark, [(4, None, 1), (None, None, None)]))) == [(-1, 0, -1, False), (4, 0, 4, True)]


def _kmeans(rows, k, rounds, dims, seed):
    points = [(i, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, e, _ in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    first = sorted(points, key=lambda p: (p[0] is None, hashlib.sha256(f"{seed}:{p[0]}".encode()).hexdigest(), p[1]))[:k]
    cents = [list(p) for _, p in first]
    near = lambda p: min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, p in points:
            groups.setdefault(near(p)[1], []).append(p)
        for j, ps in groups.items():
            cents[j] = [sum(col) // len(ps) for col in zip(*ps)]
    return sorted((-1 if i is None else i, near(p)[1], near(p)[0]) for i, p in points), cents


@pytest.mark.parametrize("seed, spread", [(1, 1.0), (2, 0.002), (3, 30.0)])
def test_clusters_are_those_of_plain_kmeans(spark, seed, spread):
    g = np.random.default_rng(seed)
    rows = [(i, (spread * g.normal(size=4)).round(3).tolist(), None) for i in range(150)]
    rows += [(7, rows[9][1], 1), (7, [spread] * 4, 1), (None, [0.0] * 4, 1), (300, None, 1), (301, [1.0] * 3, 1), (302, [None] * 4, 1), (303, [float("nan")] * 4, 1), (304, [float("-inf")] * 4, 1)]
    rows += [(400 + i, rows[3][1], 2) for i in range(20)]
    assigned, final = centroids.cluster(vectors(spark, rows).repartition(4), 6, 4, 4, "3")
    expect, cents = _kmeans(rows, 6, 4, 4, "3")
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance) for r in assigned.collect()) == expect
    assert final.tolist() == cents
    out = centroids.report(assigned, final).collect()
    sums = {c: sum(d for _, k, d in expect if k == c) for c in range(6)}
    assert all(r.cluster_inertia == sums[r.cluster] and r.inertia == sum(sums.values()) for r in out) and len(out) == len(expect)
    assert {r.cluster: r.centroid_sha256 for r in out} == {c: hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest() for c in {k for _, k, _ in expect}}


def test_walk_stops_early_and_ties_go_to_the_smaller_number():
    cents = np.array([[0, 0], [10, 0], [100, 100], [110, 100], [-500, 900], [0, 0]])
    who, d, met = centroids.nearest(np.array([[1, 1], [5, 0], [104, 101]]), cents)
    assert who.tolist() == [0, 0, 2] and d.tolist() == [2, 25, 17]
    assert (met < len(cents)).all()


def test_few_vectors_and_none(spark):
    few, final = centroids.cluster(vectors(spark, [(1, [1.0, 2.0], 1), (2, [5.0, 5.0], 1)]), 8, 3, 2, "3")
    assert len(final) == 2 and sorted(r.distance for r in few.collect()) == [0, 0]
    none, final = centroids.cluster(vectors(spark, []), 8, 3, 2, "3")
    assert centroids.report(none, final).count() == 0
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(vectors(spark, [(1, [1e30, 2.0], 1)]), 8, 3, 2, "3")


def _audit(docs, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    texts, parts = {}, {}
    for i, t, _ in docs:
        if i is not None:
            texts[t or ""] = min(i, texts.get(t or "", i))
    for i, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, bad in zip("ABCDE", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                                               bool(re.search(r"[#$%&*|]", t)), i is not None and texts[t] < i)) if bad}
        parts.setdefault(s or "", []).append((fails, i in good, i in toxic))
    rows = []
    for part, ds in parts.items():
        steps, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            for k, f in enumerate(order):
                earlier = set(order[:k])
                gone = [d for d in ds if f in d[0] and not d[0] & earlier]
                shapley[f] += len(gone)
                steps.append((part, order, k + 1, sum(not d[0] & (earlier | {f}) for d in ds), len(gone), sum(f in d[0] and bool(d[0] & earlier) for d in ds),
                              sum(d[0] == {f} for d in ds), sum(d[1] for d in gone), sum(d[2] for d in gone)))
        rows += [(*s, shapley[s[1][s[2] - 1]]) for s in steps]
    return sorted(rows)


def test_audit_counts_every_order(spark):
    prose = " ".join(f"wörd{i}" for i in range(60))
    docs = [(1, prose, "a"), (2, prose, "a"), (2, prose, "b"), (1, prose, None), (None, prose, "a"), (3, "Ab " * 70, "a"), (4, "x y $ " * 40, "b"), (5, None, ""), (6, "", "b"), (7, " \n ", None),
            (8, prose + " #", "b"), (9, prose.upper(), "a"), (9, prose.upper(), "a"), (10, "字 " * 80, "é"), (11, "W" * 40_000, "c"), (12, " ".join(f"t{i}" for i in range(30_000)), "c"), (13, "a\x0bb\x0cc" * 30, "c")]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (9, None, 1), (None, 1, 1), (4, 1, None), (99, 1, 1)]
    got = filter_audit.audit(documents(spark, docs).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(tuple(r) for r in got.collect()) == _audit(docs, labels)


def test_audit_of_odd_tables(odd, nothing, labels):
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    assert sorted(tuple(r) for r in filter_audit.audit(odd, labels).collect()) == _audit(rows, [tuple(r) for r in labels.collect()])
    assert filter_audit.audit(nothing, labels).count() == 0
    assert filter_audit.audit(odd, labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_words_of_one_hash_stay_apart():
    """All words share one hash value: only the byte comparison tells them apart."""
    texts = ["a b c a b", "", "aa a aa aaa", "x" * 50 + " " + "x" * 49 + "y"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0] + [len(t) for t in texts])
    from rollsnap.llm.common import PLAIN_WORD, runs
    starts, ends, index = runs(data, off, PLAIN_WORD)
    for h in (None, np.zeros(len(starts), np.uint64)):
        assert filter_audit.distinct_words(data, starts, ends, index, h).tolist() == [3, 0, 3, 2]


def test_transducer_outputs():
    every = filter_audit.OUTPUTS
    assert [chr(i) for i in range(128) if every[i] & 8] == list("#$%&*|")
    assert [i for i in range(256) if not every[i] & 1] == [9, 10, 11, 12, 13, 32]
    assert sum(1 for b in "aé字😀".encode() if every[b] & 4) == 4 and pa.scalar("aé字😀").as_py()
