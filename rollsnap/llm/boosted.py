"""Small gradient-boosted tree learner (logistic loss, histogram splits,
monotone constraints) and its flattened numpy scorer.

Fitting sees a bounded sample (the caller's documented parameter); scoring
runs inside Spark tasks on whole batches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """All trees in flat node arrays. ``root[t]`` is tree t's first node; a
    leaf points at itself, so ``depth`` steps always end in a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    root: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for r in self.root:
            at = np.full(len(x), r, np.int32)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out += self.value[at]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
    q = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(x[:, j], q)) if len(x) else np.zeros(0) for j in range(x.shape[1])]


def fit(x: np.ndarray, y: np.ndarray, monotone: dict[int, int], rounds: int = 60, depth: int = 3, rate: float = 0.2,
        bins: int = 32, l2: float = 2.0, min_rows: int = 8) -> Trees:
    """Boost ``rounds`` trees. ``monotone[j]`` = +1 / -1 keeps the score
    non-decreasing / non-increasing in feature j: a split against the sign is
    refused, and both children inherit the midpoint as a bound, so deeper
    leaves cannot cross it. No rows: the model is the constant log-odds 0."""
    n, width = x.shape
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share))) if n else 0.0
    cuts = _cuts(x, bins)
    codes = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(width)], 1) if n else np.zeros((0, width), int)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        i = len(feature)
        feature.append(0), threshold.append(np.inf), left.append(i), right.append(i), value.append(0.0)
        return i

    margin = np.full(n, base)
    for _ in range(rounds if n else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        top = node()
        roots.append(top)
        open_nodes = [(top, np.arange(n), -np.inf, np.inf)]
        for level in range(depth + 1):
            nxt = []
            for at, rows, lo, hi in open_nodes:
                gs, hs = g[rows].sum(), h[rows].sum()
                weight = float(np.clip(-gs / (hs + l2), lo, hi))
                value[at] = rate * weight
                if level == depth or len(rows) < 2 * min_rows:
                    continue
                best = (1e-6, -1, -1)
                for j in range(width):
                    if not len(cuts[j]):
                        continue
                    c, size = codes[rows, j], len(cuts[j]) + 1
                    gl = np.cumsum(np.bincount(c, g[rows], size))[:-1]
                    hl = np.cumsum(np.bincount(c, h[rows], size))[:-1]
                    nl = np.cumsum(np.bincount(c, minlength=size))[:-1]
                    wl = np.clip(-gl / (hl + l2), lo, hi)
                    wr = np.clip(-(gs - gl) / (hs - hl + l2), lo, hi)
                    # gain of the (possibly clipped) leaf weights
                    gain = -(gl * wl + 0.5 * (hl + l2) * wl**2) - ((gs - gl) * wr + 0.5 * (hs - hl + l2) * wr**2) + (gs * weight + 0.5 * (hs + l2) * weight**2)
                    ok = (nl >= min_rows) & (len(rows) - nl >= min_rows)
                    if sign := monotone.get(j, 0):
                        ok &= sign * (wr - wl) >= 0
                    gain = np.where(ok, gain, -1)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), j, k)
                        mid = (wl[k] + wr[k]) / 2
                _, j, k = best
                if j < 0:
                    continue
                a, b = node(), node()
                feature[at], threshold[at], left[at], right[at] = j, float(cuts[j][k]), a, b
                down = codes[rows, j] <= k
                sign = monotone.get(j, 0)
                lo_a, hi_a, lo_b, hi_b = lo, hi, lo, hi
                if sign > 0:
                    hi_a, lo_b = min(hi, mid), max(lo, mid)
                elif sign < 0:
                    lo_a, hi_b = max(lo, mid), min(hi, mid)
                nxt += [(a, rows[down], lo_a, hi_a), (b, rows[~down], lo_b, hi_b)]
            open_nodes = nxt
        tree = Trees(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array([top]), depth, 0.0)
        margin += tree.margin(x)
    return Trees(np.array(feature, np.int32), np.array(threshold, float), np.array(left, np.int32), np.array(right, np.int32),
                 np.array(value, float), np.array(roots, np.int32), depth, base)
