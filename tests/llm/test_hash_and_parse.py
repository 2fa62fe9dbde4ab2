"""Words that defeat polynomial hashes, characters of several units, markup
inside a line, repeated labelled rows."""

from pyspark.sql import functions as F

from conftest import documents
from rollsnap.llm import common, line_dedup, repeats, wrappers


def _thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_thue_morse_words_are_different_words(spark):
    word = _thue_morse(2048)
    other = word.translate(str.maketrans("ab", "ba"))
    tail = " ".join(f"w{i}" for i in range(19))
    docs = documents(spark, [(1, f"{word} {tail}", "a"), (2, f"{other} {tail}", "a"), (3, f"{word} {tail}", "a"), (4, f"{word.upper()} {tail}", "a")])
    assert {r.doc_id: r.n_removed for r in repeats.remove_repeats(docs).collect()} == {1: 0, 2: 0, 3: 20, 4: 0}


def test_long_words_fold_case():
    import numpy as np

    a, b = "X" * 400 + "é", "x" * 400 + "é"
    data = np.frombuffer((a + b).encode(), np.uint8)
    cut = len(a.encode())
    starts, ends = np.array([0, cut]), np.array([cut, len(data)])
    one, two = common.span_hashes(data, starts, ends, fold_case=True)
    assert one == two and len(set(common.span_hashes(data, starts, ends).tolist())) == 2


def test_line_shingles_are_of_code_points(spark):
    face = [chr(0x1F600 + i) for i in range(60)]
    line = "".join(face[:50])
    near = "".join([*face[:25], face[55], *face[26:50]])      # 35 of 51 shingles are shared
    like = "".join([*face[:49], face[56]])                     # 42 of 44
    got = {r.doc_id: r.n_removed for r in line_dedup.removed_lines(documents(spark, [(1, line, "a"), (2, near, "a"), (3, like, "a")])).collect()}
    assert got == {1: 0, 2: 0, 3: 1}
    n = spark.createDataFrame([(line,)], "line string").select(F.size(line_dedup.shingles("line")).alias("n")).first().n
    assert n == 43


def _article(spark, body):
    words = " ".join(f"word{i}" for i in range(60))
    page = f"<html><body><nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{words}</p>{body}</article><footer>foot</footer></body></html>"
    pages = spark.createDataFrame([(1, "http://h.example/a", page)], "page_id long, url string, html string")
    return wrappers.extract(pages).first().text.split("\n")[2:]


def test_markup_inside_a_line_does_not_end_it(spark):
    body = ("<p>Hello <img src=x> world</p><p>a <input value=q>b<script>var x = 1;</script> c <svg><text>no</text></svg>d</p>"
            "<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><p>one<br>two</p>")
    assert _article(spark, body) == ["Hello world", "a b c d", "so x=2 holds", "one", "two"]


def test_class_words_do_not_take_lines_out_of_an_article(spark):
    body = "<p class='alert'>Do not mix acids.</p><p class='social'>A social history.</p><div class='share'><a href=x>Share this</a></div><ul><li class='related'>kept too</li></ul>"
    assert _article(spark, body) == ["Do not mix acids.", "A social history.", "kept too"]


def test_label_sample_bounds_rows(spark):
    docs = documents(spark, [(1, "same text", "a")] * 500 + [(2, f"text {i}", "a") for i in range(500)] + [(i, "t", "a") for i in range(3, 40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int")
    got = common.label_sample(docs, labels, "quality", 10)
    assert got.count() <= 10
    assert got.groupBy("doc_id", "text").count().where("count > 1").count() == 0
    every = common.label_sample(docs, labels, "quality", 5_000)
    assert every.count() == 1 + 500 + 37
