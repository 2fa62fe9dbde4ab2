"""Scalar functions on the small cases of FIXTURES.md section 3, plus
property tests against plain-Python definitions."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollsnap.functions import dates as D
from rollsnap.functions import keys as K
from rollsnap.functions import predicates as P
from rollsnap.functions import text as X


def _col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_c1_strip(spark):
    assert _col(spark, ["\t a   ", None, " b　", "x y"], X.strip_ws) == ["a", None, "b", "x y"]


def test_f1_sentinel_keeps_nulls(spark):
    df = spark.createDataFrame([("ACP",), (None,), ("1",)], "id string")
    assert [r.id for r in df.where(P.not_sentinel("id")).collect()] == [None, "1"]


def test_c5_reorder(spark):
    assert _col(spark, ["01-02-2020", "2020", "a-b-c-d", None], D.reorder_mdy) == ["2020-01-02", None, None, None]


def test_c6_parse(spark):
    got = _col(spark, ["01-02-2020", "1-2-2021", "bad", "13-45-2020", None], D.parse_mdy)
    assert got == [dt.date(2020, 1, 2), dt.date(2021, 1, 2), None, None, None]


def test_c9_birth_year_and_age(spark):
    df = spark.createDataFrame([("1990", ""), ("19XX", ""), ("1700", ""), (None, ""), ("1990", "confidential")],
                               "b string, conf string")
    out = df.select(D.birth_year("b", "conf").alias("y")).withColumn("age", D.age("y", 2024)).collect()
    assert [(r.y, r.age) for r in out] == [(1990, 34), (1850, 174), (1850, 174), (1850, 174), (1850, 174)]


def test_c10_year_only(spark):
    assert _col(spark, ["1990", "1990-05-01"], D.year_only_to_date_text) == ["1990-01-01", "1990-05-01"]


def test_c15_docstring_example(spark):
    got = _col(spark, ["1234 Long Street Name, Big City"], lambda c: X.truncate_words(c, 5))
    assert got == ["1234 Long Stree Name, Big City"]


def test_c2_null_propagates(spark):
    df = spark.createDataFrame([("A", "1", None), ("A", "1", "2")], "a string, b string, c string")
    assert [r[0] for r in df.select(K.link_key("a", "b", "c")).collect()] == [None, "A-1-2"]


def test_c4_marks(spark):
    assert _col(spark, ["yes", None, "-", "no"], K.normalise_mark) == ["YES", "ITV", "ITV", "NO"]


def test_f5_patterns(spark):
    df = spark.createDataFrame([("PILOT BUTTE", ""), ("near x", ""), ("NEAR X", ""), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(P.pattern_flag(["a", "b"])).collect()]
    assert got == [True, False, True, False]


def test_c20_tokens(spark):
    got = _col(spark, ["1234 N Main-St, Apt #5", "", None], X.analyze)
    assert got[0] == ["1234", "n", "main", "st", "apt", "5"]
    assert got[1] == [] and got[2] is None


def test_c11_number_or_zero(spark):
    assert _col(spark, ["1.5", "x", None, "NaN"], K.number_or_zero) == [1.5, 0.0, 0.0, 0.0]


# ------------------------------------------------------------------ properties
_text = st.text(alphabet=st.sampled_from(list("ab -\t XY1")), max_size=12)


@settings(max_examples=40, deadline=None)
@given(st.lists(_text, min_size=1, max_size=20))
def test_c1_matches_python_strip(spark, values):
    assert _col(spark, values, X.strip_ws) == [v.strip() for v in values]


@settings(max_examples=40, deadline=None)
@given(st.lists(_text, min_size=1, max_size=20), st.integers(min_value=1, max_value=4))
def test_c15_matches_python(spark, values, n):
    want = [" ".join(w[:n] for w in v.split()) for v in values]
    assert _col(spark, values, lambda c: X.truncate_words(c, n)) == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), _text), min_size=1, max_size=20))
def test_c4_matches_python(spark, values):
    want = ["ITV" if v is None or "-" in v else v.upper() for v in values]
    assert _col(spark, values, K.normalise_mark) == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), _text), min_size=1, max_size=20))
def test_c5_matches_python(spark, values):
    def ref(v):
        if v is None:
            return None
        p = v.split("-")
        return f"{p[2]}-{p[0]}-{p[1]}" if len(p) == 3 else None

    assert _col(spark, values, D.reorder_mdy) == [ref(v) for v in values]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from(["1990", "19XX", "1700", "abc", "2001", " 1960"])),
                min_size=1, max_size=10))
def test_c9_matches_python(spark, values):
    def ref(v):
        if v is None or "X" in v:
            return 1850
        try:
            return max(int(v), 1850)
        except ValueError:
            return 1850

    assert _col(spark, values, lambda c: D.birth_year(c)) == [ref(v) for v in values]
