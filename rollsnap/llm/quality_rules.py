"""Quality rules: hard rules on document statistics plus gradient-boosted
trees over the same statistics.

Statistics are computed over whole texts in vectorised passes inside Spark
tasks; the trees are fitted on a bounded sample of labelled rows and scored
as flat node arrays.

Defined cases: a null or empty text has no words, so the hard rules reject
it; a null doc_id is kept as null and never learned from; repeated rows are
judged one by one; without usable labels the trees accept everything and only
the hard rules decide; other input columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosted
from .common import PLAIN_WORD, byte_set, chunks, ids, label_sample, mix, per_row, rows_of, runs, span_hashes, window_hashes

#: labelled rows the trees are fitted on at most
SAMPLE_ROWS = 12_000
#: rejected below this probability of being good
THRESHOLD = 0.5

SYMBOLS = byte_set(b"#*$%&|<>")
DIGITS = byte_set(b"0123456789")
UPPER = byte_set(bytes(range(65, 91)))
STOPS = byte_set(b".,;:?")
SHOUT = byte_set(b"!")
CONTINUATION = byte_set(bytes(range(0x80, 0xC0)))
NOT_NEWLINE = ~byte_set(b"\n")

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "symbol_share", "dup_line_share", "repeat_share", "digit_share", "upper_share", "stop_share",
            "shout_share", "mean_word", "mean_line", "distinct_share", "bare_words", "longest_word"]
#: the score may only fall when one of these rises
MONOTONE = {FEATURES.index(k): -1 for k in ("symbol_share", "dup_line_share", "repeat_share", "shout_share", "bare_words")}


def distinct_keys(keys: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys already mixed with their row: distinct keys per row, and for each
    item whether its key occurs twice or more."""
    if not len(keys):
        return np.zeros(n, np.int64), np.zeros(0, bool)
    order = np.argsort(keys)
    s = keys[order]
    first = np.empty(len(s), bool)
    first[0] = True
    first[1:] = s[1:] != s[:-1]
    many = ~first
    many[:-1] |= ~first[1:]
    again = np.empty(len(s), bool)
    again[order] = many
    return np.bincount(row[order][first], minlength=n), again


def statistics(data: np.ndarray, off: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Counts of the contract and the feature matrix of a run of texts."""
    n = len(off) - 1
    starts, ends, index = runs(data, off, PLAIN_WORD)
    row = rows_of(index)
    n_words = np.diff(index)
    salt = mix(np.arange(n, dtype=np.uint64) + np.uint64(1))

    in_word = PLAIN_WORD[data]
    lead = ~CONTINUATION[data]
    word_chars = per_row(in_word & lead, off)
    n_symbols = per_row(SYMBOLS[data], off)

    h = span_hashes(data, starts, ends)
    distinct, _ = distinct_keys(h ^ salt[row], row, n)
    tri = window_hashes(h, 3)
    covered = np.zeros(len(h), bool)
    if len(tri):
        whole = row[2:] == row[:-2]
        at = np.flatnonzero(whole)
        _, again = distinct_keys(tri[at] ^ salt[row[at]], row[at], n)
        hit = at[again]
        for k in range(3):
            covered[hit + k] = True
    n_repeat = per_row(covered, index)

    ls, le, lindex = runs(data, off, NOT_NEWLINE)
    words_to = np.searchsorted(starts, ls)
    with_word = np.searchsorted(starts, le) > words_to
    lrow, ls, le = rows_of(lindex)[with_word], ls[with_word], le[with_word]
    n_lines = np.bincount(lrow, minlength=n)
    seen, _ = distinct_keys(span_hashes(data, ls, le) ^ salt[lrow], lrow, n)
    n_dup = n_lines - seen

    chars = np.maximum(per_row(lead & in_word, off), 1)
    words, lines = np.maximum(n_words, 1), np.maximum(n_lines, 1)
    wlen = ends - starts
    longest = np.zeros(n, np.int64)
    if len(wlen):
        has = n_words > 0
        longest[has] = np.maximum.reduceat(wlen, index[:-1][has])
    bare = np.zeros(len(h), bool)
    if len(h):
        one = wlen == 1
        bare = one & SYMBOLS[data[starts]]
    x = np.stack([
        np.log1p(n_words), n_symbols / chars, n_dup / lines, n_repeat / words, per_row(DIGITS[data], off) / chars,
        per_row(UPPER[data], off) / chars, per_row(STOPS[data], off) / chars, per_row(SHOUT[data], off) / chars,
        word_chars / words, n_words / lines, distinct / words, per_row(bare, index) / words, np.log1p(longest)], 1)
    return dict(zip(COUNTS, (n_words, word_chars, n_symbols, n_dup, n_repeat))), x


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, off in chunks(batches):
        _, x = statistics(data, off)
        yield pa.RecordBatch.from_arrays([ids(rows, "y"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], ["y", "x"])


def fit_rules(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> boosted.Trees:
    """Trees fitted on at most ``max_rows`` labelled documents. Only their
    feature vectors reach the driver."""
    got = label_sample(docs, labels, "quality", max_rows).mapInArrow(_features, "y int, x array<double>").toPandas()
    got["k"] = [tuple(v) for v in got.x]
    got = got.sort_values(["k", "y"])       # the fit does not depend on the order rows arrive in
    x = np.array([list(v) for v in got.x], float).reshape(-1, len(FEATURES))
    y = got.y.to_numpy(float)
    if len(np.unique(y)) < 2:
        x, y = x[:0], y[:0]
    return boosted.fit(x, y, MONOTONE)


_JUDGED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"


def judge(docs: DataFrame, model: boosted.Trees, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the counts, base_failed, kept and score of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in chunks(batches):
            counts, failed, score = _verdict(data, off, model)
            cols = [ids(rows), *(pa.array(counts[k].astype(np.int64)) for k in COUNTS), pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", *COUNTS, "base_failed", "kept", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _JUDGED)


def _verdict(data: np.ndarray, off: np.ndarray, model: boosted.Trees) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    counts, x = statistics(data, off)
    failed = (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])
    return counts, failed, model.probability(x)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the rules keep, with the columns they came with."""
    model = fit_rules(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in chunks(batches):
            _, failed, score = _verdict(data, off, model)
            yield rows.filter(pa.array(~failed & (score >= threshold)))

    return docs.mapInArrow(run, docs.schema)
