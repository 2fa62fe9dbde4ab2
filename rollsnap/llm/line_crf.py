"""Quality classifier: a linear-chain conditional random field labels every
line of a text good or bad.

A line's features are its own statistics and those of the lines before and
after it. Forward-backward gives each line's marginal probability of being
good; the marginals, weighted by the lines' lengths, are the document's score.
Labels exist for documents only, so each line of a fitted document carries
its document's label. The field is fitted on a bounded sample of labelled
documents; scoring reads every line of every text inside Spark tasks.

Defined cases: lines without words are left out; a text without any line
(null or empty) scores 0; a null id is kept and never learned from; repeated
rows score alike; without both kinds of labels every line scores 0.5; extra
columns are ignored, and label, language, source and id are no features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLAIN_WORD, byte_set, chunks, fold, ids, label_sample, mix, per_row, rows_of, runs, span_hashes, window_hashes
from .quality_rules import CONTINUATION, DIGITS, NOT_NEWLINE, SHOUT, STOPS, SYMBOLS, UPPER, distinct_keys

#: labelled documents the field is fitted on at most, and lines of each
SAMPLE_ROWS = 3_000
SAMPLE_LINES = 64
#: steps of the fit
STEPS = 150
#: weight of the squared parameters
RIDGE = 1e-3
#: a document is predicted good from this score on
GOOD = 0.3

OWN = ["log_words", "mean_word", "longest_word", "symbols", "digits", "upper", "stops", "shouts", "foreign", "distinct", "repeated", "again", "ends_well", "bare_words"]


@dataclass
class Lines:
    """Lines with words of a run of texts: own features, length in
    characters, and where each text's lines begin."""

    own: np.ndarray
    length: np.ndarray
    index: np.ndarray


def read_lines(data: np.ndarray, off: np.ndarray) -> Lines:
    n = len(off) - 1
    starts, ends, windex = runs(data, off, PLAIN_WORD)
    ls, le, lindex = runs(data, off, NOT_NEWLINE)
    row = rows_of(lindex)
    a, b = np.searchsorted(starts, ls), np.searchsorted(starts, le)
    worded = b > a
    ls, le, row, a, b = ls[worded], le[worded], row[worded], a[worded], b[worded]
    m = len(ls)
    if not m:
        return Lines(np.zeros((0, len(OWN))), np.zeros(0, np.int64), np.zeros(n + 1, np.int64))

    def inside(mask: np.ndarray) -> np.ndarray:
        pre = np.append(0, np.cumsum(mask, dtype=np.int64))
        return pre[le] - pre[ls]

    lead = ~CONTINUATION[data]
    length = inside(lead)
    chars = np.maximum(inside(lead & PLAIN_WORD[data]), 1)
    words = b - a
    h = span_hashes(data, starts, ends)
    wrow = rows_of(windex)
    line = np.repeat(np.arange(m), words)       # every word stands in a line with words
    salt = mix(np.arange(max(n, m), dtype=np.uint64) + np.uint64(1))
    distinct, _ = distinct_keys(h ^ salt[line], line, m)
    tri = window_hashes(h, 3)
    covered = np.zeros(len(h), bool)
    if len(tri):
        at = np.flatnonzero(wrow[2:] == wrow[:-2])
        _, again = distinct_keys(tri[at] ^ salt[wrow[at]], wrow[at], n)
        for k in range(3):
            covered[at[again] + k] = True
    _, same = distinct_keys(span_hashes(data, ls, le) ^ salt[row], row, n)
    wlen = ends - starts
    windows = np.append(a, len(h))
    own = np.stack([
        np.log1p(words) / 4, inside(lead & PLAIN_WORD[data]) / words / 10, np.log1p(np.maximum.reduceat(wlen, a)) / 4,
        inside(SYMBOLS[data]) / chars * 4, inside(DIGITS[data]) / chars * 4, inside(UPPER[data]) / chars, inside(STOPS[data]) / chars * 10,
        inside(SHOUT[data]) / chars * 4, inside(data >= 0xC0) / chars * 2, distinct / words, per_row(covered, windows) / words, same.astype(float),
        byte_set(b".!?:;\"")[data[ends[b - 1] - 1]].astype(float), per_row((wlen == 1) & SYMBOLS[data[starts]], windows) / words * 4], 1)
    return Lines(own, length, np.searchsorted(row, np.arange(n + 1)))


def with_neighbours(own: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (zeros beyond the
    text), the two edges, and a constant."""
    n = len(own)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    full = np.flatnonzero(np.diff(index))
    first[index[full]] = True
    last[index[full + 1] - 1] = True
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    before[first] = 0
    after[:-1] = own[1:]
    after[last] = 0
    return np.hstack([own, before, after, first[:, None], last[:, None], np.ones((n, 1))])


@dataclass
class Field:
    """``weight``: log-odds of good from a line's features; ``step[i, j]``:
    log-potential of label j after label i (0 bad, 1 good)."""

    weight: np.ndarray
    step: np.ndarray


def _by_time(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts longest first: first line of each, and texts alive per time."""
    size = np.diff(index)
    order = np.argsort(-size, kind="stable")
    alive = np.searchsorted(-size[order], -np.arange(1, (size.max() if len(size) else 0) + 1), side="right")
    return index[:-1][order], alive


def marginals(field: Field, odds: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(probability of good per line, expected number of steps between each
    pair of labels, log of the partition function summed over texts)."""
    begin, alive = _by_time(index)
    n = len(odds)
    node = np.exp(np.stack([-odds / 2, odds / 2], 1).clip(-30, 30))
    step = np.exp(field.step)
    alpha, scale = np.empty((n, 2)), np.empty(n)
    a = np.ones((len(begin), 2))
    for t, k in enumerate(alive):
        at = begin[:k] + t
        a = (a[:k] @ step if t else a[:k]) * node[at]
        s = a.sum(1)
        a = a / s[:, None]
        alpha[at], scale[at] = a, s
    good, steps = np.empty(n), np.zeros((2, 2))
    beta = np.ones((len(begin), 2))
    for t in range(len(alive) - 1, -1, -1):
        at = begin[:alive[t]] + t
        both = alpha[at] * beta[:alive[t]]
        good[at] = both[:, 1]
        if t:
            back = node[at] * beta[:alive[t]] / scale[at, None]
            steps += alpha[at - 1].T @ back
            beta[:alive[t]] = back @ step.T
    return good, steps * step, float(np.log(scale).sum())


def fit_field(x: np.ndarray, y: np.ndarray, index: np.ndarray, steps: int = STEPS, ridge: float = RIDGE) -> Field:
    """Maximum conditional likelihood by Adam steps; every text weighs the
    same whatever its number of lines. ``y`` is a line's label."""
    size = np.diff(index)
    share = np.repeat(1 / np.maximum(size, 1), size)
    width = x.shape[1]
    theta, m, v = np.zeros(width + 4), np.zeros(width + 4), np.zeros(width + 4)
    pairs = np.flatnonzero(np.isin(np.arange(len(y)), index, invert=True))
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[pairs - 1], y[pairs]), 1)
    texts = max(1, int((size > 0).sum()))
    for k in range(1, steps + 1):
        field = Field(theta[:width], theta[width:].reshape(2, 2))
        good, expected, _ = marginals(field, x @ field.weight, index)
        g = np.concatenate([x.T @ ((y - good) * share) / texts, ((seen - expected) / max(1, len(pairs))).ravel()]) - ridge * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    return Field(theta[:width], theta[width:].reshape(2, 2))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, max_rows: int = SAMPLE_ROWS, max_lines: int = SAMPLE_LINES) -> Field:
    """The field of a bounded sample of the labelled documents whose fold is
    not 0. Only the features of at most ``max_lines`` lines of each reach the
    driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in chunks(batches):
            lines = read_lines(data, off)
            part = [lines.own[lo:min(hi, lo + max_lines)].astype(np.float32).tobytes() for lo, hi in zip(lines.index[:-1], lines.index[1:])]
            yield pa.RecordBatch.from_arrays([ids(rows), ids(rows, "y"), pa.array(part, pa.binary())], ["doc_id", "y", "own"])

    learn = F.col("doc_id").isNotNull() & (fold("doc_id", folds) != 0)
    sample = label_sample(docs, labels, "quality", max_rows, learn).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "y")
    got = sample.mapInArrow(run, "doc_id long, y int, own binary").toPandas().sort_values(["doc_id", "own"])
    own = [np.frombuffer(b, np.float32).reshape(-1, len(OWN)) for b in got.own]
    index = np.append(0, np.cumsum([len(o) for o in own])).astype(np.int64)
    width = 3 * len(OWN) + 3
    if got.y.nunique() < 2:
        return Field(np.zeros(width), np.zeros((2, 2)))
    x = with_neighbours(np.concatenate(own).astype(float), index)
    return fit_field(x, np.repeat(got.y.to_numpy(np.int64), np.diff(index)), index)


def label_lines(field: Field, lines: Lines) -> np.ndarray:
    """Probability of good of every line."""
    if not len(lines.own):
        return np.zeros(0)
    return marginals(field, with_neighbours(lines.own, lines.index) @ field.weight, lines.index)[0]


def score(docs: DataFrame, field: Field, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted, n_lines and n_bad_lines (marginal
    below a half) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in chunks(batches):
            lines = read_lines(data, off)
            good = label_lines(field, lines)
            row = rows_of(lines.index)
            n = rows.num_rows
            weight = np.bincount(row, lines.length, n)
            value = np.bincount(row, lines.length * good, n) / np.maximum(weight, 1)
            yield pa.RecordBatch.from_arrays([
                ids(rows), ids(rows, "held_out"), pa.array(value.clip(0, 1)), pa.array((value >= GOOD).astype(np.int32)),
                pa.array(np.diff(lines.index)), pa.array(np.bincount(row, good < 0.5, n).astype(np.int64))],
                ["doc_id", "held_out", "score", "predicted", "n_lines", "n_bad_lines"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", folds) == 0).alias("held_out"), "text")
    return keyed.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_lines long, n_bad_lines long")
