"""Operators on the small expected cases of FIXTURES.md section 3 and the
invariants of the test strategy."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollsnap.operators import dedup, diff, dims, project, reshape, resolve


def test_p1_file_order_wins(spark):
    df = spark.createDataFrame([(" v1 ", "v2")], "VTR_ID string, VOTER_ID string")
    out = project.contract_project(df, {"state_voter_id": ["VOTER_ID", "VTR_ID"]})
    assert out.columns == ["state_voter_id"] and out.first()[0] == "v1"


def test_p1_broken_contract(spark):
    import pytest

    df = spark.createDataFrame([("x",)], "OTHER string")
    with pytest.raises(project.BrokenContract):
        project.contract_project(df, {"state_voter_id": ["VOTER_ID"]})


def test_a2_bad_date_wins(spark):
    df = spark.createDataFrame([("1", "01-02-2020"), ("1", "bad"), ("2", "1-2-2021")], "id string, d string")
    from rollsnap.functions.dates import parse_mdy

    df = df.withColumn("reg", parse_mdy("d"))
    got = sorted((r.id, r.d, r.reg) for r in dedup.latest_per_key(df, "id", "reg", ["d"]).collect())
    assert got == [("1", "bad", None), ("2", "1-2-2021", dt.date(2021, 1, 2))]


def test_c4_p5_f4_history(spark):
    from rollsnap.plans.feeds import history_long

    raw = spark.createDataFrame([("1", "yes", None, "x"), ("2", "-", "no", "y")],
                                "VOTER_ID string, `05/17/2022` string, `11/8/2022` string, NOTES string")
    got = sorted(tuple(r) for r in history_long(raw).collect())
    assert got == [("OR", "1", dt.date(2022, 5, 17), "YES"), ("OR", "2", dt.date(2022, 11, 8), "NO")]


def test_j1_keeps_duplicates_and_matches_nulls(spark):
    new = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), ("b", 3), ("c", 4)], "k string, v int")
    old = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    got = sorted(tuple(r) for r in diff.new_rows(new, old).collect())
    assert got == [("b", 3), ("b", 3), ("c", 4)]


def test_j2_ledger_keeps_first_date(spark):
    new = spark.createDataFrame([("k", dt.date(2024, 2, 1))], "id string, file_date date")
    old = spark.createDataFrame([("k", dt.date(2024, 1, 1))], "id string, file_date date")
    assert diff.new_keys(new, old, ["id"]).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2)), max_size=12),
       st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2)), max_size=12))
def test_j1_matches_python(spark, new_rows_, old_rows):
    new = spark.createDataFrame(new_rows_, "k string, v int")
    old = spark.createDataFrame(old_rows, "k string, v int")
    want = sorted((r for r in new_rows_ if r not in set(old_rows)), key=repr)
    got = sorted((tuple(r) for r in diff.new_rows(new, old).collect()), key=repr)
    assert got == want
    # idempotence: a second load of the same rows appends nothing
    loaded = old.unionByName(diff.new_rows(new, old))
    assert diff.new_rows(new, loaded).count() == 0


def _places(spark, rows):
    return spark.createDataFrame(rows, "place_id string, group_id string, PropertyAddressFull string")


def test_j4_collapse_and_j5_no_collapse(spark):
    places = _places(spark, [("d1", "P1", "1 MAIN ST 97000"), ("d2", "P1", "1 MAIN ST 97000 UNIT 2"),
                             ("d3", "P2", "9 ELM AVE 97001"), ("d4", "P3", "9 ELM AVE 97001 REAR")])
    texts = spark.createDataFrame([("1 main st",), ("9 elm ave",), ("",), ("1 main oak",)], "text string")
    j4 = {r.text: r.place_id for r in resolve.token_lookup(texts, resolve.index_places(places), True).collect()}
    assert j4 == {"1 main st": "d1"}          # two docs of one property: accepted
    j5 = resolve.token_lookup(texts, resolve.index_places(places, group_col=None), False).collect()
    assert j5 == []                            # two docs: not found without collapse


def test_j6_homeless_overrides_confidential_and_r3(spark):
    rows = spark.createDataFrame(
        [("1", "NEAR the park", "", "Confidential", "c-1-1"), ("2", "1 A ST", "X OR 97000", "", "c-1-2")],
        "id string, physical_address_1 string, physical_address_2 string, confidential string, precinct_link string",
    )
    df = resolve.mark_pass01(rows)
    assert {r.id: r.results for r in df.collect()} == {"1": "Homeless", "2": "Not Found"}
    df = df.withColumns({"physical_unit_type": F.lit(""), "physical_city": F.lit("X"),
                         "physical_state": F.lit("OR"), "physical_zip_code": F.lit("97000")})
    out = {r.id: r for r in resolve.post_rules(df).collect()}
    assert out["2"].physical_id == "Not-Found-1 A ST X OR 97000"
    assert out["1"].physical_id == "Homeless" and out["1"].address_type == "Homeless"


def test_j6_cascade_is_idempotent(spark):
    places = _places(spark, [("d1", "P1", "1 MAIN ST 97000"), ("d2", "P2", "5 OAK RD 97000")])
    rows = spark.createDataFrame([("1", "1 main st", "Not Found"), ("2", "7 pine", "Not Found")],
                                 "id string, t string, results string")
    for c in ["physical_id", "PropertyAddressFull"] + resolve.PLACE_ATTRS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("double" if c.startswith("PropertyL") else "string"))
    passes = [resolve.Pass(2.0, "group", "t")]
    once = resolve.cascade(rows, "id", passes, places)
    twice = resolve.cascade(once, "id", passes, places)
    a = sorted((r.id, r.results, r.physical_id) for r in once.collect())
    assert a == [("1", "Success", "d1"), ("2", "Not Found", "")]
    assert sorted((r.id, r.results, r.physical_id) for r in twice.collect()) == a


def test_j7_fallback_to_middle(spark):
    names = spark.createDataFrame([("Pat", "andy"), ("Ann", "mostly_female")], "name string, label string")
    people = spark.createDataFrame([("pat", "ANN"), ("zed", None)], "name_first string, name_middle string")
    got = sorted(r.gender for r in dims.guess_gender(people, names).collect())
    assert got == ["female", "unknown"]


def test_p8_sample_exact_and_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = [r.k for r in project.fixed_sample(df, 17, 3, ["k"]).collect()]
    b = [r.k for r in project.fixed_sample(df, 17, 3, ["k"]).collect()]
    assert len(a) == 17 and a == b


def test_u1_union_by_name(spark):
    a = spark.createDataFrame([("1", "x")], "id string, county string")
    b = spark.createDataFrame([("y", "2")], "county string, id string")
    c = spark.createDataFrame([("3",)], "id string")
    got = sorted(tuple(r) for r in reshape.union_by_name([a, b, c]).select("id", "county").collect())
    assert got == [("1", "x"), ("2", "y"), ("3", None)]


def test_j6_strategies_agree(spark):
    places = _places(spark, [("d1", "P1", "1 MAIN ST 97000"), ("d2", "P2", "5 OAK RD 97000"),
                             ("d3", "P3", "5 OAK RD 97000 REAR"), ("d4", "P4", "7 PINE 97001")])
    rows = spark.createDataFrame(
        [(str(i), t, u, "Not Found") for i, (t, u) in enumerate(
            [("1 main st", "x"), ("5 oak rd", "5 oak rd rear"), ("7 pine", "y"), ("zzz", "zzz"), ("", "1 main")])],
        "id string, t string, u string, results string")
    for c in ["physical_id", "PropertyAddressFull"] + resolve.PLACE_ATTRS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("double" if c.startswith("PropertyL") else "string"))
    passes = [resolve.Pass(2.0, "group", "t"), resolve.Pass(3.0, "doc", "u"), resolve.Pass(4.0, "group", "u")]
    got = {}
    for strategy in ("all", "chain"):
        out = resolve.cascade(rows, "id", passes, places, strategy=strategy)
        got[strategy] = sorted((r.id, r.results, r.physical_id) for r in out.collect())
    assert got["all"] == got["chain"]
    assert ("1", "Success", "d3") in got["all"] and ("0", "Success", "d1") in got["all"]


def test_header_map_of_many_files(spark, tmp_path):
    from rollsnap.sources import delimited

    files = []
    for i in range(70):
        f = tmp_path / f"f{i}.csv"
        f.write_text(("A,B\n" if i % 2 else "B,A\n") + "1,2\n")
        files.append(str(f))
    par = delimited.header_lines(spark, files)
    assert par == {f: delimited.header_line(spark, f) for f in files}
    df = delimited.read_delimited(spark, files)
    assert sorted(df.columns) == ["A", "B"] and df.count() == 70


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS d")
    plan = dedup.latest_per_key(df, "k", "d", [])._jdf.queryExecution().executedPlan().toString()
    # a partial WindowGroupLimit runs map-side, before the Exchange
    assert plan.count("WindowGroupLimit") >= 2
    assert plan.rfind("WindowGroupLimit") > plan.find("Exchange")


def test_keep_last_and_upsert_limit_before_the_shuffle(spark):
    from rollsnap.sources import sinks

    df = spark.range(1000).selectExpr("CAST(id % 3 AS STRING) AS id", "id AS line_no")
    for out in (dedup.keep_last(df, ["id"], ["line_no"]), sinks.keyed_upsert(df.select("id"), df, ["id"], ["line_no"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") >= 2, plan


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                          st.one_of(st.none(), st.dates(dt.date(2000, 1, 1), dt.date(2000, 1, 5))),
                          st.integers(0, 50)), min_size=1, max_size=15, unique_by=lambda r: r[2]))
def test_a2_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "k string, d date, tie int")
    got = sorted(tuple(r) for r in dedup.latest_per_key(df, "k", "d", ["tie"]).collect())
    best = {}
    for k, d, tie in rows:
        # unparseable (null) dates rank first, then newest date, then smallest tie-breaker
        rank = (d is not None, -(d.toordinal() if d else 0), tie)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, d, tie))
    assert got == sorted(v for _, v in best.values())


_WORDS = ["1", "2", "main", "oak", "st", "rd", "apt", "97000"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(_WORDS), min_size=1, max_size=4), st.sampled_from(["g1", "g2", "g3"])),
                min_size=1, max_size=8),
       st.lists(st.lists(st.sampled_from(_WORDS), max_size=3), min_size=1, max_size=6),
       st.booleans())
def test_token_lookup_matches_brute_force(spark, places, queries, collapse):
    rows = [(f"p{i}", g, " ".join(ws)) for i, (ws, g) in enumerate(places)]
    pl = _places(spark, rows)
    texts = sorted({" ".join(q) for q in queries})
    tdf = spark.createDataFrame([(t,) for t in texts], "text string")
    index = resolve.index_places(pl, group_col="group_id" if collapse else None)
    got = {r.text: r.place_id for r in resolve.token_lookup(tdf, index, collapse).collect()}
    want = {}
    for t in texts:
        qt = set(t.split())
        if not qt:
            continue
        hits = [(pid, g) for pid, g, full in rows if qt <= set(full.split())]
        ok = len({g for _, g in hits}) == 1 if collapse else len(hits) == 1
        if hits and ok:
            want[t] = min(pid for pid, _ in hits)
    assert got == want


def test_j6_without_passes_blanks_misses(spark):
    places = _places(spark, [("d1", "P1", "1 MAIN ST")])
    rows = resolve.mark_pass01(spark.createDataFrame(
        [("1", "1 main st", "", "", "c")],
        "id string, physical_address_1 string, physical_address_2 string, confidential string, precinct_link string"))
    out = resolve.cascade(rows, "id", [], places).first()
    assert out.results == "Not Found" and out.physical_id == "" and out.PropertyLatitude == 0.0


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_anti_join_shuffles_each_side_once(spark):
    from rollsnap.operators import diff

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.range(1000).selectExpr("id AS k", "CAST(id AS STRING) AS v")
        assert _exchanges(diff.new_rows(a, a.where("k < 10"), ["k"])) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_history_long_shuffles_once(spark):
    from rollsnap.plans import feeds

    raw = spark.createDataFrame([("1", "yes", "x"), ("1", "yes", "x"), ("ACP", "no", "y")], "VOTER_ID string, `5/17/2022` string, NOTES string")
    out = feeds.history_long(raw)
    assert _exchanges(out) == 1 and out.count() == 1




def test_candidates_per_query_do_not_grow_with_places(spark):
    """Addresses of a large vocabulary: ten times the places hold every single
    token ten times as often, but a pair of them hardly more often."""
    from pyspark.sql import functions as F

    from rollsnap.operators.place_index import PassingIndex

    def met(n):
        places = spark.range(n).selectExpr(
            "CAST(id AS STRING) AS place_id", "CAST(id AS STRING) AS group_id",
            "concat_ws(' ', id % 997, concat('st', id DIV 7 % 5003), concat('zip', id % 89), 'or') AS PropertyAddressFull")
        index = PassingIndex(resolve.index_places(places).cache())
        texts = places.where("id % 50 = 0").select(F.col("PropertyAddressFull").alias("text"))
        keys = texts.select(resolve.token_key("text").alias("key")).distinct()
        probes = index.probes(keys)
        pairs = probes.join(index.pairs(probes).select("pair"), "pair").count()
        return pairs / probes.count(), index.candidates(keys).count() / keys.count(), resolve.token_lookup(texts, index, True).count()

    (small, _, _), (large, candidates, accepted) = met(2_000), met(20_000)
    assert large <= 2 * small and large < 4 and candidates <= large
    assert accepted > 0


def test_repeated_place_ids_do_not_multiply_rows(spark):
    from pyspark.sql import functions as F

    places = spark.createDataFrame([("p1", "g1", "1 main st"), ("p1", "g1", "1 main st")], "place_id string, group_id string, PropertyAddressFull string")
    for c in resolve.PLACE_ATTRS:
        if c not in places.columns:
            places = places.withColumn(c, F.lit("1"))
    rows = spark.createDataFrame([("a", "1 main", "Not Found")], "id string, t string, results string")
    for c in ["physical_id"] + resolve.PLACE_ATTRS:
        rows = rows.withColumn(c, F.lit(None).cast("double" if c.startswith("PropertyL") else "string"))
    out = resolve.cascade(rows, "id", [resolve.Pass(2.0, "group", "t")], places, pass_col="pass_no")
    assert [(r.id, r.results, r.pass_no) for r in out.collect()] == [("a", "Success", 2.0)]


@pytest.mark.parametrize("kind", ["group", "doc"])
def test_texts_are_analysed_once_each(spark, kind):
    """No analysis in the plan that meets the rows: Spark would push it to every row."""
    places = _places(spark, [("d1", "P1", "1 MAIN ST 97000"), ("d2", "P2", "5 OAK RD 97000")])
    texts = spark.createDataFrame([("1 main st",), ("1 main st",), ("",), (None,), ("--",)], "text string")
    for index in (resolve.index_places(places).cache(), resolve.stored_index(places)):
        got = resolve.token_lookup(texts, index, kind == "group")
        assert "lower(" not in got._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
        assert [tuple(r) for r in got.collect()] == [("1 main st", "d1")]


def test_chain_gives_a_repeated_key_its_first_pass(spark):
    """Rows that share a key or have none, with different texts and passes;
    the chain keeps no join of the pending rows on their key."""
    places = _places(spark, [("d1", "P1", "1 MAIN ST 97000"), ("d2", "P2", "5 OAK RD 97000"), ("d3", "P3", "7 PINE 97001")])
    rows = spark.createDataFrame(
        [("1", "zzz", "5 oak rd"), ("1", "7 pine", None), ("1", "zzz", "zzz"), (None, "zzz", "1 main"), (None, "zzz", "5 oak"), ("2", None, None), ("3", "1 main st", "7 pine")],
        "id string, t string, u string").withColumn("results", F.lit("Not Found"))
    for c in ["physical_id", "PropertyAddressFull"] + resolve.PLACE_ATTRS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("double" if c.startswith("PropertyL") else "string"))
    passes = [resolve.Pass(2.0, "group", "t"), resolve.Pass(3.0, "doc", "u")]
    got = [sorted((str(r.id), str(r.t), str(r.u), r.results, r.physical_id, r.n) for r in resolve.cascade(rows, "id", passes, places, strategy=s, pass_col="n").collect())
           for s in ("all", "chain")]
    assert got[0] == got[1]
    assert {(r[0], r[4], r[5]) for r in got[1]} == {("1", "d3", 2.0), ("None", "d1", 3.0), ("2", "", None), ("3", "d1", 2.0)}
