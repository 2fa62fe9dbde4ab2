"""Hidden Markov language model of a corpus.

Tokens are lower-cased words and one end token per text. The most frequent
words (a fixed number, so their list may be broadcast) are symbols of their
own; all others share the tail symbol and are told apart by their smoothed
share of the tail. Baum-Welch runs over all training texts: each task sums the
expected counts of its sequences, Spark adds those of all tasks, the driver
only holds the model (states x symbols). A text's probability is the exact
scaled forward recursion over its whole sequence, times the tail shares.

An unknown word is treated as one more type of the tail, as in the unigram
base score.

Defined cases: null and empty texts are the end token alone; a null id is
never held out unless its empty name says so; repeated rows are scored one by
one; without training texts every word is unknown; an empty table gives no
rows; extra columns are ignored."""

from __future__ import annotations

import secrets
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, chunks, fold, ids

#: latent states
STATES = 8
#: words with a symbol of their own, the end token (number 0) included
SYMBOLS = 65_535
#: passes of Baum-Welch over the training texts
PASSES = 6
#: training sequences are at most this long; longer texts are several
SEQUENCE = 512
#: tokens of one batch of the recursions
BATCH_TOKENS = 1 << 20
SCORE_TOKENS = 4 << 20
#: distinct words a task counts before it hands them on
HELD_WORDS = 400_000
#: expected counts travel in this many blocks
BLOCKS = 32
#: added to every count
SMOOTH = 0.1
#: unigram pseudo-counts of every state, per word of the vocabulary
PRIOR = 0.5

END = ""
TAIL = SYMBOLS


def tokens(raw: bytes, lo: int, hi: int) -> list[bytes]:
    """Words of a text; bytes split and fold ASCII only."""
    return raw[lo:hi].lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts of ``docs``; the end token is ''."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = Counter(), 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for rows, data, off in chunks(batches):
            raw = data.tobytes()
            texts += rows.num_rows
            for lo, hi in zip(off[:-1].tolist(), off[1:].tolist()):
                held.update(tokens(raw, lo, hi))
                if len(held) > HELD_WORDS:
                    yield out()
                    held = Counter()
        if texts:
            held[b""] += texts
            yield out()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Words with symbols of their own and the sizes of the rest."""

    words: list
    counts: np.ndarray      # per symbol; the last is the tail
    total: int
    distinct: int

    @property
    def tail_total(self) -> int:
        return int(self.counts[-1])

    @property
    def tail_types(self) -> int:
        return self.distinct - int((self.counts[:len(self.words)] > 0).sum())

    def base(self, n):
        """log10 of the smoothed unigram probability of a count."""
        return np.log10((n + SMOOTH) / (self.total + SMOOTH * (self.distinct + 1)))


def vocabulary(counts: DataFrame, size: int = SYMBOLS) -> Vocabulary:
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    end = counts.where(F.col("word") == END).first()
    rest = counts.where(F.col("word") != END)
    # the count that the last of the most frequent words has: without it every task would send that many words to the driver
    before = F.coalesce(F.sum("words").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    least = rest.groupBy("n").agg(F.count(F.lit(1)).alias("words")).withColumn("before", before).where(F.col("before") < size - 1).agg(F.min("n")).first()[0]
    top = rest.where(F.col("n") >= F.lit(least or 0)).orderBy(F.desc("n"), "word").limit(size - 1).toPandas()
    words = [b"", *(w.encode() for w in top.word)]
    n = np.zeros(size + 1, np.int64)
    n[0] = end.n if end else 0
    n[1:len(words)] = top.n.to_numpy(np.int64)
    n[-1] = (total or 0) - n.sum()
    return Vocabulary(words, n, total or 0, distinct)


_CODED = "doc_id long, held_out boolean, rid long, codes binary, tail array<string>"


def code(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Every text as symbols (two bytes each, the end token last) and its
    words of the tail. ``rid`` is drawn at random: write before use."""
    sent = docs.sparkSession.sparkContext.broadcast(vocab.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(sent.value)}
        get = number.get
        for rows, data, off in chunks(batches):
            raw, codes, tail = data.tobytes(), [], []
            for lo, hi in zip(off[:-1].tolist(), off[1:].tolist()):
                words = tokens(raw, lo, hi)
                c = np.fromiter((get(w, TAIL) for w in words), np.uint16, len(words))
                tail.append([words[i] for i in np.flatnonzero(c == TAIL)])
                codes.append(c.tobytes() + b"\0\0")
            n = rows.num_rows
            yield pa.RecordBatch.from_arrays([
                ids(rows), ids(rows, "held_out"), pa.array([secrets.randbits(63) for _ in range(n)], pa.int64()), pa.array(codes, pa.binary()),
                pa.array(tail, pa.list_(pa.binary())).cast(pa.list_(pa.string()))], ["doc_id", "held_out", "rid", "codes", "tail"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, _CODED)


# --------------------------------------------------------------------------
# Model and recursions
# --------------------------------------------------------------------------

@dataclass
class Model:
    start: np.ndarray       # (states,)
    step: np.ndarray        # (states, states)
    emit: np.ndarray        # (symbols + 1, states): probability of the symbol in the state


def first_guess(vocab: Vocabulary, states: int = STATES, seed: int = 8) -> Model:
    """Unigram emissions bent at random, states that last."""
    rng = np.random.Generator(np.random.PCG64(seed))
    emit = (vocab.counts + SMOOTH)[:, None] * np.exp(rng.normal(0, 1, (len(vocab.counts), states)))
    emit[len(vocab.words):-1] = 0
    step = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(step, 0.95 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), step, emit / emit.sum(0))


def _matrix(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences longest first as (time, sequence) symbols; (codes, alive
    sequences per time, order)."""
    length = np.array([len(s) for s in seqs])
    order = np.argsort(-length, kind="stable")
    codes = np.zeros((int(length.max()), len(seqs)), np.uint16)
    for j, i in enumerate(order):
        codes[:length[i], j] = seqs[i]
    alive = np.searchsorted(-length[order], -np.arange(1, len(codes) + 1), side="right")
    return codes, alive, order


def forward(model: Model, seqs: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each whole sequence."""
    step, emit = model.step.astype(np.float64), model.emit.astype(np.float64)
    length = np.array([len(s) for s in seqs])
    order = np.argsort(-length, kind="stable")
    flat = np.concatenate([seqs[i] for i in order]) if seqs else np.zeros(0, np.uint16)
    begin = np.append(0, np.cumsum(length[order]))[:-1]
    alive = np.searchsorted(-length[order], -np.arange(1, (length.max() if len(length) else 0) + 1), side="right")
    out, a = np.zeros(len(seqs)), np.broadcast_to(model.start, (len(seqs), len(model.start)))
    scale = np.ones(len(seqs))
    for t, n in enumerate(alive):
        a = (a[:n] @ step if t else a[:n]) * emit[flat[begin[:n] + t]]
        s = a.sum(1)
        a /= s[:, None]
        scale[:n] *= s
        if t % 16 == 15:        # products of 16 stay far above the least double
            out += np.log10(scale)
            scale[:] = 1
    out += np.log10(scale)
    back = np.empty(len(seqs))
    back[order] = out
    return back


def expected_counts(model: Model, seqs: list[np.ndarray], symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch sums of some sequences: starts, steps, emissions."""
    codes, alive, _ = _matrix(seqs)
    steps, states = len(codes), len(model.start)
    step, emit = model.step.astype(np.float32), model.emit.astype(np.float32)
    first = np.append(0, np.cumsum(alive))
    alpha = np.empty((first[-1], states), np.float32)
    scale = np.empty(first[-1], np.float32)
    seen = np.empty((first[-1], states), np.float32)
    a = np.broadcast_to(model.start.astype(np.float32), (alive[0], states))
    for t in range(steps):
        lo, hi, n = first[t], first[t + 1], alive[t]
        b = seen[lo:hi] = emit[codes[t, :n]]
        a = (a[:n] @ step if t else a[:n]) * b
        s = np.maximum(a.sum(1), 1e-30)
        a = a / s[:, None]
        alpha[lo:hi], scale[lo:hi] = a, s
    moves = np.zeros((states, states))
    beta = np.ones((alive[0], states), np.float32)
    for t in range(steps - 1, 0, -1):
        lo, hi, n = first[t], first[t + 1], alive[t]
        # alpha becomes the state probabilities once beta is known
        back = seen[lo:hi] * beta[:n] / scale[lo:hi, None]
        alpha[lo:hi] *= beta[:n]
        moves += alpha[first[t - 1]:first[t - 1] + n].T @ back
        beta[:n] = back @ step.T
    alpha[:alive[0]] *= beta
    flat = np.concatenate([codes[t, :alive[t]] for t in range(steps)])
    emits = np.stack([np.bincount(flat, alpha[:, s], symbols) for s in range(states)], 1)
    return alpha[:alive[0]].sum(0, dtype=np.float64), moves * model.step, emits


_COUNTS = "block int, sums binary"


def _sequences(batches: Iterator[pa.RecordBatch], most: int | None, size: int) -> Iterator[tuple[list, list]]:
    """Batches of (rows, sequences) of about ``size`` symbols."""
    rows, seqs, held = [], [], 0
    for batch in batches:
        for r, raw in enumerate(ids(batch, "codes")):
            c = np.frombuffer(raw.as_py(), np.uint16)
            for lo in range(0, len(c), most or len(c)):
                seqs.append(c[lo:lo + most] if most else c)
            held += len(c)
            rows.append((batch, r))
            if held >= size:
                yield rows, seqs
                rows, seqs, held = [], [], 0
    if seqs:
        yield rows, seqs


def improve(coded: DataFrame, model: Model, vocab: Vocabulary) -> Model:
    """One pass of Baum-Welch over all texts that are not held out."""
    spark = coded.sparkSession
    sent = spark.sparkContext.broadcast(model)
    states, symbols = len(model.start), len(vocab.counts)
    size = states + states * states + states * symbols

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for _, seqs in _sequences(batches, SEQUENCE, BATCH_TOKENS):
            total += np.concatenate([x.ravel() for x in expected_counts(sent.value, seqs, symbols)])
        if total.any():
            parts = np.array_split(total.astype(np.float32), BLOCKS)
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())], ["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, raw in zip(ids(batch, "block").to_pylist(), ids(batch, "sums")):
                total[b] = total.get(b, 0) + np.frombuffer(zlib.decompress(raw.as_py()), np.float32).astype(np.float64)
        for b, x in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["block", "sums"])

    sums = coded.where("NOT held_out").select("codes").mapInArrow(count, _COUNTS).repartition("block").mapInArrow(add, _COUNTS)
    got = {r.block: np.frombuffer(r.sums) for r in sums.toLocalIterator()}
    sent.destroy()
    if not got:
        return model
    total = np.concatenate([got[b] for b in range(BLOCKS)])
    start, step, emit = total[:states], total[states:states + states**2].reshape(states, states), total[states + states**2:].reshape(symbols, states)
    live = len(vocab.words) + 1
    share = ((vocab.counts + SMOOTH) / (vocab.total + SMOOTH * live))[:, None]
    emit = emit + PRIOR * share * len(vocab.words)          # pulled to the unigram shares, the more the fewer texts there are
    emit[len(vocab.words):-1] = 0
    return Model((start + 1) / (start.sum() + states), (step + 1) / (step.sum(1, keepdims=True) + states), emit / emit.sum(0))


def train(coded: DataFrame, vocab: Vocabulary, states: int = STATES, passes: int = PASSES) -> Model:
    model = first_guess(vocab, states)
    for _ in range(passes):
        model = improve(coded, model, vocab)
    return model


def score(docs: DataFrame, folds: int = 10, states: int = STATES, passes: int = PASSES) -> DataFrame:
    """Per text: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score. Learns from rows whose fold is not 0."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "hmm")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", folds) == 0).alias("held_out"), "text")
    counts = scratch.write(word_counts(docs.where("NOT held_out")), "counts")
    vocab = vocabulary(counts)
    coded = scratch.write(code(docs, vocab), "coded")
    model = train(coded, vocab, states, passes)

    # words of the tail meet their counts by a join: there is no bound on them
    base = F.log10((F.col("c") + SMOOTH) / F.lit(float(vocab.total + SMOOTH * (vocab.distinct + 1))))
    share = F.log10((F.col("c") + SMOOTH) / F.lit(float(vocab.tail_total + SMOOTH * (vocab.tail_types + 1))))
    tail = coded.select("rid", F.explode("tail").alias("word")).join(counts, "word", "left").select("rid", F.coalesce("n", F.lit(0)).alias("c"))
    tail = tail.groupBy("rid").agg(F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("tail_known"), F.sum(base).alias("tail_base"), F.sum(share).alias("tail_share"))

    sent = spark.sparkContext.broadcast((model, vocab.base(vocab.counts.astype(float)), vocab.counts > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, unit, known = sent.value
        unit, known = unit.copy(), known.copy()
        unit[TAIL], known[TAIL] = 0, False          # added by the join
        for rows, seqs in _sequences(batches, None, SCORE_TOKENS):
            yield pa.RecordBatch.from_arrays([
                pa.array([ids(b)[r].as_py() for b, r in rows], pa.int64()), pa.array([ids(b, "held_out")[r].as_py() for b, r in rows], pa.bool_()),
                pa.array([ids(b, "rid")[r].as_py() for b, r in rows], pa.int64()), pa.array([len(s) for s in seqs], pa.int64()),
                pa.array([int(known[s].sum()) for s in seqs], pa.int64()), pa.array([float(unit[s].sum()) for s in seqs]), pa.array(forward(model, seqs))],
                ["doc_id", "held_out", "rid", "n_tokens", "known", "base", "hidden"])

    whole = coded.select("doc_id", "held_out", "rid", "codes").mapInArrow(run, "doc_id long, held_out boolean, rid long, n_tokens long, known long, base double, hidden double")
    zero = F.lit(0.0)
    return whole.join(tail, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", zero)).alias("base_score"), (F.col("hidden") + F.coalesce("tail_share", zero)).alias("score"))
