"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing column names for every operator and every pipeline stage."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import documents
from rollsnap.llm import hmm, jaccard, line_crf, line_dedup, mixing, positional, quality_rules, repeats, sharding, wrappers
from rollsnap.llm.common import Scratch


def by_row(df, *keys):
    return sorted((tuple(r) for r in df.select(*keys).collect()), key=str)


def test_quality_rules(spark, odd, nothing, labels):
    model = quality_rules.fit_rules(odd, labels)
    got = quality_rules.judge(odd, model)
    assert got.count() == odd.count()
    rows = by_row(got.where("doc_id IN (4, 5, 6, 7)"), "doc_id", "n_words", "word_chars", "n_dup_lines", "kept")
    assert rows == [(4, 0, 0, 0, False), (5, 0, 0, 0, False), (6, 0, 0, 0, False), (7, 1, 3, 0, False), (7, 2, 8, 0, False)]
    nine = got.where("doc_id = 9").first()
    assert (nine.n_words, nine.n_dup_lines, nine.n_repeat_words, nine.base_failed) == (6_000, 2_999, 6_000, True)
    kept = quality_rules.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.where("n_chars < 50").count() == 0
    assert quality_rules.judge(nothing, model).count() == 0
    empty = quality_rules.fit_rules(nothing, labels)
    assert quality_rules.judge(odd, empty).where("doc_id = 1").first().kept


def test_line_crf(odd, nothing, labels):
    field = line_crf.fit(odd, labels)
    got = line_crf.score(odd, field)
    assert got.count() == odd.count()
    assert got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert {r.score for r in got.where("doc_id IN (4, 5, 6)").collect()} == {0.0}
    assert got.where("doc_id = 2").select("score").distinct().count() == 1
    assert line_crf.score(nothing, field).count() == 0
    assert line_crf.fit(nothing, labels).weight.any() == False  # noqa: E712
    assert {r.score for r in line_crf.score(odd, line_crf.fit(nothing, labels)).where("doc_id = 1").collect()} == {0.5}


def test_sharding(odd, nothing):
    got = sharding.shard_table(odd, 16)
    assert got.count() == odd.count()
    for r in got.groupBy("shard").agg(F.array_sort(F.collect_list("slot")).alias("s")).collect():
        assert r.s == list(range(len(r.s)))
    assert by_row(got.where("doc_id IN (4, 5)"), "doc_id", "size", "text_crc32") == [(4, 1, 0), (5, 1, 0)]
    assert sharding.shard_table(nothing, 16).count() == 0
    out = sharding.to_shards(odd, 16)
    assert out.columns == odd.columns and out.where("doc_id = 2").select("shard").distinct().count() == 1
    assert sharding.to_shards(odd, 16, "source").where("shard IS NULL").count() == 0


def test_mixing(odd, nothing):
    got = mixing.copies(odd.select("doc_id", "source", mixing.words().alias("size")))
    assert got.count() == odd.count() and got.where("copies < 0 OR copies > 3").count() == 0
    assert got.agg(F.sum("size")).first()[0] == pytest.approx(sum(r.target for r in got.select("source", "target").distinct().collect()))
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.mix(odd).count() == got.agg(F.sum("copies")).first()[0]
    assert mixing.mix(nothing).count() == 0
    # rows of one id and size with unlike texts: reruns agree on which is taken how often
    twins = documents(odd.sparkSession, [(i % 7, f"w{i} x y z", "ab"[i % 2]) for i in range(60)] + [(100 + i, "one " * 9, "c") for i in range(40)])
    one, two = (sorted((r.doc_id, r.text) for r in mixing.mix(d).collect()) for d in (twins.repartition(3), twins.repartition(9)))
    assert one == two and len(one) == mixing.copies(twins.select("doc_id", "source", mixing.words().alias("size"))).agg(F.sum("copies")).first()[0]
    wordless = odd.where("doc_id IN (4, 5, 6)")
    assert mixing.mix(wordless).count() == 0


def test_line_dedup(odd, nothing):
    got = line_dedup.removed_lines(odd)
    assert got.count() == odd.count()
    assert by_row(got.where("doc_id IN (1, 3, 9)"), "doc_id", "n_lines", "n_removed") == [(1, 1, 0), (3, 1, 1), (9, 3_000, 2_999)]
    assert by_row(got.where("doc_id = 2"), "n_lines", "n_removed") == [(1, 1), (1, 1)]
    assert by_row(got.where("doc_id IN (4, 5, 6)"), "doc_id", "n_lines", "n_removed") == [(4, 0, 0), (5, 0, 0), (6, 0, 0)]
    assert line_dedup.removed_lines(nothing).count() == 0
    one = line_dedup.drop_repeated(odd.where("doc_id IN (1, 3, 4, 9)"))
    assert one.columns == odd.columns
    assert {r.doc_id: r.text for r in one.where("doc_id <> 1").collect()} == {3: "", 4: None, 9: "a line\n"}


def test_substring_dedup(odd, nothing):
    got = {}
    for r in repeats.remove_repeats(odd, run_bytes=1_000).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.text))
    assert sum(map(len, got.values())) == odd.count()
    assert got[4] == got[5] == got[6] == [(0, 0, "")]
    # a null id is the smallest: its copy keeps the words
    assert sorted(x[1] for x in got[None]) == [0, 0]
    assert [x[:2] for x in got[1] + got[2]] == [(180, 180)] * 3
    assert got[3][0][1] > 100
    assert got[9] == [(6_000, 5_998, "a line")]       # every window from the second line on also starts earlier
    assert repeats.remove_repeats(nothing).count() == 0


def test_decontamination(spark, odd, nothing, items):
    index = Scratch(spark, "t").write(positional.build_index(odd), "index")
    got = positional.contaminated_words(index, items)
    assert got.count() == odd.count()
    rows = {r.doc_id: (r.n_words, r.n_hit, sorted(r["items"])) for r in got.where("doc_id IN (1, 4, 10)").collect()}
    assert rows == {1: (180, 6, ["1"]), 4: (0, 0, []), 10: (30_000, 11, ["5"])}
    assert by_row(got.where("doc_id = 7"), "n_words", "n_hit") == [(1, 1), (2, 0)]
    none = Scratch(spark, "t").write(positional.build_index(nothing), "index")
    assert positional.contaminated_words(none, items).count() == 0
    assert positional.contaminated_words(index, items.limit(0)).where("n_hit > 0").count() == 0
    out = positional.drop_contaminated(odd, items)
    assert out.columns == odd.columns and out.where("doc_id IN (1, 2, 3, 10)").count() == 0
    assert out.where("doc_id IN (4, 5, 6, 7, 8, 9, 11)").count() == 7


def test_lm(odd, nothing):
    got = hmm.score(odd, states=3, passes=2)
    assert got.count() == odd.count() and got.where("score IS NULL OR isnan(score) OR score > 0").count() == 0
    assert by_row(got.where("doc_id IN (4, 5, 6)"), "doc_id", "n_tokens") == [(4, 1), (5, 1), (6, 1)]
    assert got.where("doc_id = 2").select("score").distinct().count() == 1
    assert hmm.score(nothing, states=2, passes=1).count() == 0
    held = odd.where("doc_id = 2").withColumn("doc_id", F.lit(29).cast("long"))      # crc32('29') mod 10 is 0
    alone = hmm.score(held, states=2, passes=1)
    assert {(r.held_out, r.n_known, r.train_tokens) for r in alone.collect()} == {(True, 0, 0)}


def test_jaccard(odd, nothing):
    got = jaccard.link_groups(odd)
    assert got.count() == odd.count()
    assert {(r.doc_id, r.component_id) for r in got.where("doc_id IN (1, 2, 3)").collect()} == {(1, 1), (2, 1), (3, 1)}
    assert by_row(got.where("doc_id IN (4, 5, 6)"), "doc_id", "n_shingles", "component_id") == [(4, 0, 4), (5, 0, 5), (6, 0, 6)]
    assert by_row(got.where("doc_id = 7"), "n_shingles", "component_id") == [(1, 7), (1, 7)]
    assert jaccard.link_groups(nothing).count() == 0
    one = jaccard.keep_one(odd)
    assert one.columns == odd.columns
    assert one.where("doc_id IN (1, 2, 3) OR (doc_id IS NULL AND text IS NOT NULL)").count() == 1
    assert one.where("doc_id IN (4, 5, 6) OR (doc_id IS NULL AND text IS NULL)").count() == 4
    assert jaccard.keep_one(nothing).count() == 0


def test_wrappers(spark):
    rows = [(1, "http://a.example/x", "<p>one</p>"), (1, "http://a.example/x", "<p>one</p>"), (2, None, "<p>two"), (3, "no host", None), (None, "http://b.example", ""),
            (4, "http://c.example", "<div>" * 3_000 + "deep" + "</div>" * 3_000), (5, "http://c.example", "x " * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("wrapper", F.lit(1))
    got = wrappers.extract(pages)
    assert got.columns == ["page_id", "url", "text"]
    text = {r.page_id: r.text for r in got.collect()}
    assert got.count() == 7 and text[1] == "one" and text[2] == "two" and text[3] == "" and text[None] == "" and text[4] == "deep" and len(text[5]) == 199_999
    assert wrappers.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("k", range(5))
def test_stage(spark, odd, nothing, tmp_path, labels, items, k):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    _, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, odd, str(tmp_path))
    out.write.parquet(f"{tmp_path}/out")
    assert set(odd.columns) <= set(out.columns)
    assert stage(spark, nothing, str(tmp_path)).count() == 0




def test_words_of_items_without_id_are_hits(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "delta"), (3, "beta one"), (4, "clean")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "beta gamma"), (None, "delta"), (7, "one"), (None, "one")], "item_id long, text string")
    index = Scratch(spark, "t").write(positional.build_index(docs), "index")
    got = positional.contaminated_words(index, items)
    assert by_row(got, "doc_id", "n_hit", "items") == [(1, 2, []), (2, 1, []), (3, 1, ["7"]), (4, 0, [])]
    assert [r.doc_id for r in positional.drop_contaminated(docs, items).collect()] == [4]
    assert by_row(positional.contaminated_words(index, items.where("item_id IS NULL")), "doc_id", "n_hit") == [(1, 2), (2, 1), (3, 1), (4, 0)]


LONG = "Many plain words of running text stand in this part, more than anywhere else. " * 4


@pytest.mark.parametrize("page", [
    "<html><body class='has-sidebar'><h1>T</h1><p>{}</p></body></html>", "<body><div class='no-sidebar'><h1>T</h1><p>{}</p></div></body>",
    "<body><div class='menu-open'><main><h1>T</h1><p>{}</p></main></div><div class='comments'><article>Me too.</article></div></body>",
    "<body><article class='post has-comments'><h1>T</h1><p>{}</p></article></body>", "<body><form action='/'><div><h1>T</h1><p>{}</p></div></form></body>"])
def test_a_class_word_or_form_never_removes_the_whole_page(page):
    tree = wrappers.parse(page.format(LONG))
    assert wrappers.read_page(tree, *wrappers.article_paths(wrappers.page_wrapper(tree))) == ["T", LONG.strip()]


def test_comments_longer_than_the_article_stay_out():
    tree = wrappers.parse(f"<body><main><h1>T</h1><p>short text</p></main><div class='comments'><p>{LONG}</p></div></body>")
    assert wrappers.read_page(tree, *wrappers.article_paths(wrappers.page_wrapper(tree))) == ["T", "short text"]


def test_raw_elements_end_where_they_end():
    tree = wrappers.parse("<p>" + "\u0130" * 9 + "</p><SCRIPT>if (a<b) x()</Script><p>whole text</p>")
    assert wrappers.read_page(tree, (), set()) == ["\u0130" * 9, "whole text"]


def read_host(pages):
    trees = [wrappers.parse(p) for p in pages]
    known = wrappers.page_wrapper(trees[0])
    for t in trees[1:]:
        known = wrappers.align(known, wrappers.Wrapper.unpack(wrappers.page_wrapper(t).pack()))
    return [wrappers.read_page(t, *wrappers.article_paths(known)) for t in trees]


@pytest.mark.parametrize("around", ["<body>{}</body>", "<body><article>{}</article></body>", "<body><div class='content'>{}</div><div>{}</div></body>"])
def test_constant_texts_of_an_article_stay(around):
    copy = around.format("<h1>Title</h1><blockquote>said</blockquote><p>only one</p>", "x")
    assert read_host([copy] * 4) == read_host([copy]) * 4
    pages = [around.format(f"<h1>Dish {i}</h1><p>{LONG}{i}</p><h2>Ingredients</h2><ul><li>salt {i}</li></ul>", f"x{i}") for i in range(12)]
    assert all("Ingredients" in blocks for blocks in read_host(pages))
    some = [p.replace("<h2>", "<blockquote>as always</blockquote><h2>") if i < 3 else p for i, p in enumerate(pages)]
    assert ["as always" in blocks for blocks in read_host(some)] == [i < 3 for i in range(12)]


def test_constant_text_beside_the_article_goes():
    pages = [f"<body><h1>Title {i}</h1><p>{LONG}{i}</p><div>All rights are ours.</div></body>" for i in range(12)]
    assert read_host(pages) == [[f"Title {i}", f"{LONG}{i}"] for i in range(12)]
    assert read_host([*pages[:1] * 50, *[p.replace("All", "Not all") for p in pages[1:3]]])[0][-1] == "All rights are ours."


def test_unlike_short_lines_share_no_key(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=rng.randint(1, 80))) for _ in range(400)]
    lines = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "h long, line string")
    keys = line_dedup.with_bands(lines).select("h", F.explode("bands").alias("band"))
    assert keys.groupBy("band").count().where("count > 1").count() == 0
    assert line_dedup.rare_keys(line_dedup.with_bands(lines).where("short IS NOT NULL")).groupBy("band").count().where("count > 3").count() == 0


def test_near_short_lines_always_meet(spark):
    """Lines of 1 to 80 shingles and edits of them, against brute force."""
    rng = random.Random(5)
    texts = []
    for n in range(1, 88):
        line = "".join(rng.choices("abcdefghij", k=n))
        texts += [line, line + "z", line[:-1] + "y", "x" + line, line + "zwvut"[:n // 20]]
    sets = {t: {t[i:i + 8] for i in range(max(1, len(t) - 7))} for t in dict.fromkeys(texts)}
    root = {t: t for t in sets}

    def top(t):
        while root[t] != t:
            t = root[t]
        return t

    for a, b in itertools.combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[top(b)] = top(a)
    docs = spark.createDataFrame([(1, "\n".join(texts))], "doc_id long, text string")
    assert line_dedup.removed_lines(docs).first().n_removed == len(texts) - len({top(t) for t in sets})


def test_unlike_lines_of_a_group_are_not_compared_by_text(spark, monkeypatch):
    """Copies of one line, most of them below the threshold against each
    other: the bound in the buckets leaves few pairs, and loses no link."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(60)]
    texts = []
    for i in range(60):
        mine = list(words)
        for at in rng.sample(range(60), 1 if i % 10 == 0 else 5):
            mine[at] = f"other{i}x{at}"
        texts.append(" ".join(mine))
    sets = [{t[i:i + 8] for i in range(len(t) - 7)} for t in texts]
    root = list(range(60))

    def top(i):
        return i if root[i] == i else top(root[i])

    links = [(a, b) for a, b in itertools.combinations(range(60), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for a, b in links:
        root[top(b)] = top(a)
    compared, alike = [], line_dedup._alike
    monkeypatch.setattr(line_dedup, "_alike", lambda pairs, lines: compared.append(pairs.count()) or alike(pairs, lines))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    gone = line_dedup.removed_lines(docs).agg(F.sum("n_removed")).first()[0]
    assert gone == 60 - len({top(i) for i in range(60)}) > 0
    assert sum(compared) < 600 < 60 * 59 // 2 - len(links)


def test_runs_keep_their_names_when_a_task_runs_again(spark, odd):
    blocks = repeats.window_blocks(odd, 4, run_bytes=1_000).select("run", "bucket")
    assert by_row(blocks, "run", "bucket") == by_row(blocks, "run", "bucket")
    heads = blocks.where("bucket < 0")
    assert heads.count() == heads.distinct().count() > 1


@pytest.mark.parametrize("with_note", [range(34), [i for i in range(40) if i % 10]])
def test_constant_texts_are_counted_on_all_pages(spark, with_note):
    """A note on 34 or 36 of a host's 40 pages, 90 % being the bound."""
    note = "<div>All rights are ours.</div>"
    rows = [(i, "http://n.example/x", f"<body><h1>Title {i}</h1><p>{LONG}{i}</p>{note if i in with_note else ''}</body>") for i in range(40)]
    rows += rows[:5] * 30                   # copies count once
    got = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)).collect()
    assert len(got) == 190
    stays = len(with_note) < 36
    assert all(("All rights" in r.text) == (stays and r.page_id in with_note) for r in got)


def test_equal_lines_are_hashed_once(spark, monkeypatch):
    """Before, every occurrence of a line was hashed, and a line stayed a
    candidate though no line of its buckets was near it in size."""
    hashed, with_bands = [], line_dedup.with_bands
    monkeypatch.setattr(line_dedup, "with_bands", lambda lines, *a: hashed.append(lines.count()) or with_bands(lines, *a))
    rng = random.Random(3)
    lines = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(20)) for _ in range(5)]
    docs = documents(spark, [(d, "\n".join(lines), "a") for d in range(6)] + [(9, lines[0] + " end", "a")])
    got = {r.doc_id: r.n_removed for r in line_dedup.removed_lines(docs).collect()}
    assert got == {0: 0, 9: 1} | {d: 5 for d in range(1, 6)}
    assert hashed == [6]

    entries = spark.createDataFrame([(1, 1, 100), (1, 2, 126), (1, 3, 200), (1, 4, 240), (2, 1, 100), (2, 5, 80), (3, 6, 50)], "band long, h long, n int")
    assert by_row(line_dedup.shared_keys(entries), "band", "h") == [(1, 3), (1, 4), (2, 1), (2, 5)]


def test_a_pair_of_several_buckets_is_looked_at_once(spark):
    """Before, an open pair of lines left every bucket that held both."""
    shared = list(range(100))
    sets = spark.createDataFrame([(h, shared[:100 - h]) for h in range(1, 5)] + [(9, list(range(200, 300)))], "h long, few array<short>")
    held = [(band, h, 100 - h, h) for band in (7, -5, 3) for h in range(1, 4)] + [(3, 4, 96, 1), (7, 4, 96, 1), (7, 9, 100, 9)]
    pairs = line_dedup._open_pairs(spark.createDataFrame(held, "band long, h long, n int, c long"), sets)
    assert by_row(pairs, "x", "y") == [(1, 2), (1, 3), (2, 3), (2, 4), (3, 4)]
