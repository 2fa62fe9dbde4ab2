"""Registered queries: against their SQL where there is some, else against a
brute-force reading of the contract."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from oracle import compare
from rollsnap.llm import boosted, hmm, jaccard, line_crf, sharding
from rollsnap.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


def docs():
    return pd.read_parquet(f"{SF}/documents.parquet")


def held(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    ok, msg = compare(spark, QUERIES[name], ORACLES[name], SF)
    assert ok, msg


def test_op10_counts_and_verdicts(spark):
    got = QUERIES["op10_quality_rules"](spark, SF).toPandas().merge(docs(), on="doc_id")
    assert len(got) == len(docs())
    for r in got.itertuples():
        w = WORD.findall(r.text)
        seen = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i, t in enumerate(zip(w, w[1:], w[2:])) if seen[t] > 1 for k in range(3)}
        lines, dup = set(), 0
        for line in r.text.split("\n"):
            if WORD.search(line):
                dup += line in lines
                lines.add(line)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r.text)), dup, len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.kept and r.base_failed)
    marked = got.merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    assert marked[(marked.quality == 1) & ~marked.base_failed].kept.all()
    assert not marked[marked.quality == 0].kept.any()


def test_op1_held_out_accuracy(spark):
    got = QUERIES["op1_quality_classifier"](spark, "/root/testdata/sf0.01").toPandas()
    marked = got.merge(pd.read_parquet("/root/testdata/sf0.01/labels.parquet"), on="doc_id")
    assert (got.held_out == [held(i, 5) for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    out = marked[marked.held_out]
    assert (out.predicted == out.quality).mean() > 0.95


def test_op3_article_text_only(spark):
    pages = pd.read_parquet(f"{SF}/pages.parquet")
    got = QUERIES["op3_html_extraction"](spark, SF).toPandas().merge(pages, on="page_id")
    assert len(got) == len(pages)
    for r in got.itertuples():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(re.sub(r"<[^>]+>", "", b).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        want = "\n".join(b for b in blocks if b).replace("&amp;", "&").replace("&quot;", '"').replace("&#x27;", "'").replace("&lt;", "<").replace("&gt;", ">")
        assert r.text == want and r.n_chars == len(want)


def test_op8_base_and_held_out_gain(spark):
    got = QUERIES["op8_lm_scoring"](spark, SF).toPandas().merge(docs(), on="doc_id")
    counts = Counter()
    for r in got.itertuples():
        if not held(r.doc_id, 10):
            counts.update([*WORD.findall(lower(r.text)), ""])
    total, distinct = sum(counts.values()), len(counts)
    for r in got.itertuples():
        t = [*WORD.findall(lower(r.text)), ""]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id, 10), len(t), sum(counts[x] > 0 for x in t), total)
        assert r.base_score == pytest.approx(sum(np.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in t))
    assert got[got.held_out].score.sum() > got[got.held_out].base_score.sum()


def test_hmm_forward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    model = hmm.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3).T)
    seqs = [rng.integers(0, 5, n).astype(np.uint16) for n in (1, 4, 6)]
    for seq, got in zip(seqs, hmm.forward(model, seqs)):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(seq)):
            p = model.start[path[0]] * model.emit[seq[0], path[0]]
            for a, b, s in zip(path, path[1:], seq[1:]):
                p *= model.step[a, b] * model.emit[s, b]
            total += p
        assert got == pytest.approx(np.log10(total))
    start, step, emit = hmm.expected_counts(model, seqs, 5)
    assert start.sum() == pytest.approx(3, rel=1e-4) and step.sum() == pytest.approx(8, rel=1e-4) and emit.sum() == pytest.approx(11, rel=1e-4)
    assert emit.sum(1) == pytest.approx(np.bincount(np.concatenate(seqs), minlength=5), rel=1e-4)


def test_crf_marginals_are_the_sums_over_all_labellings():
    rng = np.random.default_rng(2)
    field = line_crf.Field(np.zeros(1), rng.normal(size=(2, 2)))
    index, odds = np.array([0, 1, 1, 5]), rng.normal(size=5)
    good, _, _ = line_crf.marginals(field, odds, index)
    for lo, hi in ((0, 1), (1, 5)):
        weight, total = np.zeros(hi - lo), 0.0
        for y in itertools.product((0, 1), repeat=hi - lo):
            e = np.exp(sum(odds[lo + i] / 2 * (2 * v - 1) for i, v in enumerate(y)) + sum(field.step[a, b] for a, b in zip(y, y[1:])))
            total += e
            weight += e * np.array(y)
        assert good[lo:hi] == pytest.approx(weight / total)


def test_trees_keep_their_monotone_features():
    rng = np.random.default_rng(3)
    x = rng.random((800, 3))
    y = ((x[:, 0] + 0.3 * rng.normal(size=800) < 0.5) ^ (x[:, 2] > 0.7)).astype(float)
    trees = boosted.fit(x, y, {0: -1}, rounds=20)
    probe = np.repeat(rng.random((50, 1, 3)), 40, 1)
    probe[:, :, 0] = np.linspace(-0.2, 1.2, 40)
    assert (np.diff(trees.margin(probe.reshape(-1, 3)).reshape(50, 40), axis=1) <= 1e-12).all()
    assert ((trees.probability(x) > 0.5) == y).mean() > max(y.mean(), 1 - y.mean()) + 0.1


def test_jump_hash_moves_rows_into_the_new_shard_only():
    keys = np.arange(-2_000, 50_000)
    for n in (1, 5, 16):
        before, after = sharding.jump(keys, n), sharding.jump(keys, n + 1)
        moved = before != after
        assert (after[moved] == n).all() and moved.mean() == pytest.approx(1 / (n + 1), abs=0.02)
        assert np.bincount(before, minlength=n).min() > 0.9 * len(keys) / n


def _brute_components(texts):
    sets = []
    for t in texts:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    comp = list(range(len(sets)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            a, b = sorted((root(i), root(j)))
            comp[b] = a
    return [root(i) for i in range(len(sets))], [len(s) for s in sets]


@pytest.mark.parametrize("edits", [1, 3, 6])
def test_jaccard_groups_equal_brute_force(spark, edits):
    """Groups of copies around originals that are missing, chains of edits,
    shared passages and borderline pairs."""
    rng = np.random.default_rng(edits)
    texts = []
    passage = [f"p{i}" for i in range(40)]
    for g in range(6):
        origin = [f"g{g}w{i}" for i in range(60 + 10 * g)]
        chain = list(origin)
        for _ in range(9):
            copy = list(origin)
            for _ in range(rng.integers(0, edits + 1)):
                copy[rng.integers(len(copy))] = f"e{rng.integers(10**6)}"
            chain[rng.integers(len(chain))] = f"c{rng.integers(10**6)}"
            texts += [" ".join(copy), " ".join(chain)]
        texts.append(" ".join([f"u{g}x{i}" for i in range(8)] + passage))
    texts += ["", "one two", "one two", "One TWO", "one"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in jaccard.link_groups(frame, per_bucket=50).collect()}
    comp, size = _brute_components(texts)
    assert got == {i: (comp[i], size[i]) for i in range(len(texts))}


def test_pipeline_against_its_stages_by_brute_force(spark):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF).toPandas()
    source = docs().set_index("doc_id")
    verdict = QUERIES["op10_quality_rules"](spark, SF).toPandas().set_index("doc_id").kept
    good = [i for i in source.index if verdict[i]]
    comp, _ = _brute_components([source.text[i] for i in good])
    unique = [i for k, i in enumerate(good) if comp[k] == k]
    alnum = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for t in pd.read_parquet(f"{SF}/benchmark.parquet").text:
        w = alnum.findall(lower(t))
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()

    def hit(t):
        w = alnum.findall(lower(t))
        return any(tuple(w[i:i + 10]) in windows for i in range(len(w) - 9))

    clean = [i for i in unique if not hit(source.text[i])]
    assert set(got.doc_id) <= set(clean)
    sizes = {i: len(WORD.findall(source.text[i])) for i in clean}
    total = Counter()
    for i in clean:
        total[source.source[i]] += sizes[i]
    names = sorted(total)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_names, rest = {}, set(names), float(sum(total.values()))
    while True:
        level = rest / sum(weight[s] for s in open_names)
        full = [s for s in open_names if level * weight[s] > 3 * total[s]]
        if not full:
            target.update({s: level * weight[s] for s in open_names})
            break
        for s in full:
            target[s] = 3.0 * total[s]
            rest -= target[s]
            open_names.discard(s)
    copies = Counter(got.doc_id)
    for i in clean:
        rate = target[source.source[i]] / total[source.source[i]]
        assert int(np.floor(rate - 1e-6)) <= copies[i] <= int(np.ceil(rate + 1e-6))
    assert (got.shard == sharding.jump(got.doc_id.to_numpy(), 16)).all()
    for c in ("text", "lang", "source", "n_chars"):
        assert (got[c] == source.loc[got.doc_id, c].to_numpy()).all()


def test_sketches_bound_the_overlap(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 58, 600, dtype=np.uint64)
    sets = [np.unique(np.append(rng.choice(base, k, replace=False), rng.integers(0, 1 << 58, m, dtype=np.uint64))) for k in (0, 1, 60, 300, 600) for m in (0, 5, 40, 700)]
    index = np.append(0, np.cumsum([len(s) for s in sets]))
    raw = jaccard.sketches(np.concatenate(sets), index).to_pylist()
    width = np.array([len(r) for r in raw])
    a, b = (x.ravel() for x in np.indices((len(sets), len(sets))))
    most = jaccard.most_shared(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(width) - width, width, a, b)
    assert len(set(width)) > 3 and all(m >= len(np.intersect1d(sets[i], sets[j])) for m, i, j in zip(most, a, b))
    assert all(most[a == b] == np.diff(index))
    full = jaccard.sketches(np.arange(300, dtype=np.uint64) << np.uint64(10), np.array([0, 300]))     # one counter gets all
    assert full.to_pylist() == [b""]

    # texts that share half their words with each neighbour all stand in lists; only the two alike ones send their shingles
    counts, plausible, members = {}, jaccard.plausible, jaccard.Scratch.bucketed
    monkeypatch.setattr(jaccard, "plausible", lambda entries, *a: counts.update(listed=entries.select("sig").distinct().count()) or plausible(entries, *a))

    def bucketed(self, df, part, *a, **k):
        out = members(self, df, part, *a, **k)
        counts[part] = out.count()
        return out

    monkeypatch.setattr(jaccard.Scratch, "bucketed", bucketed)
    half = [" ".join(f"w{d}x{i}" for i in range(60)) for d in range(12)]
    texts = [f"{half[d]} {half[(d + 1) % 12]}" for d in range(12)]
    frame = spark.createDataFrame(list(enumerate(texts + [texts[0] + " tail"])), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.link_groups(frame, per_bucket=50).collect()}
    assert got == {d: d for d in range(12)} | {12: 0}
    assert counts["members"] == 2 < counts["listed"]
