"""What lives from run to run: manifests, the stored place index, keyed
stores, dated tables, delivery manifests, keyed streams."""

import datetime as dt
import glob
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollsnap.operators import resolve
from rollsnap.operators.place_index import PlaceIndex
from rollsnap.session import scratch_path
from rollsnap.sources import sinks
from rollsnap.sources.dated import DatedTable
from rollsnap.sources.deliveries import Deliveries
from rollsnap.sources.keyed_store import KeyedStore
from rollsnap.sources.manifest import Manifest

DAY = dt.date


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _bytes(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True))


# ---------------------------------------------------------------- manifests and K7
def test_manifest_records(spark):
    m = Manifest(spark, scratch_path(spark, "manifest"))
    assert m.newest() is None and m.records() == []
    assert [m.commit({"k": i}) for i in range(3)] == [1, 2, 3]
    assert m.newest() == {"k": 2} and [r["k"] for r in m.records()] == [0, 1, 2]
    with open(f"{m.folder}/000000004.json", "w") as f:       # what a copying rename leaves behind
        f.write('{"k": ')
    assert m.newest() == {"k": 2}
    assert m.commit({"k": 9}) == 5 and m.newest() == {"k": 9}


def test_a_crash_between_the_steps_leaves_the_old_pointer(spark, monkeypatch):
    df = spark.createDataFrame([(1, DAY(2024, 1, 1)), (2, DAY(2024, 2, 1))], "id int, file_date date")
    path = scratch_path(spark, "dated")
    sinks.replace_snapshot(df, path)
    sinks.point_current(spark, path, "2024-01-01")

    class Dies:
        def __init__(self, fs):
            self._fs = fs

        def __getattr__(self, name):
            return getattr(self._fs, name)

        def rename(self, *_):
            raise KeyboardInterrupt

    plain = Manifest.__init__

    def broken(self, *a):
        plain(self, *a)
        self._fs = Dies(self._fs)

    monkeypatch.setattr(Manifest, "__init__", broken)
    with pytest.raises(KeyboardInterrupt):
        sinks.point_current(spark, path, "2024-02-01")
    assert [r.id for r in sinks.current_view(spark, path).collect()] == [1]
    monkeypatch.undo()
    assert [r.id for r in sinks.current_view(spark, path, date="2024-02-01").collect()] == [2]


# ---------------------------------------------------------------- the stored place index
def _places(spark, rows):
    return spark.createDataFrame(rows, "place_id string, group_id string, PropertyAddressFull string")


def _found(index, texts, collapse=True):
    q = index.spark.createDataFrame([(t,) for t in texts], "text string")
    return {r.text: r.place_id for r in resolve.token_lookup(q, index, collapse).collect()}


def test_index_is_kept_updated_and_compacted(spark):
    root = scratch_path(spark, "index")
    index = resolve.stored_index(_places(spark, [("a", "A", "1 main st"), ("b", "B", "2 oak rd"), ("c", "C", "2 oak rd rear"), (None, None, "9 lost ln")]), root, buckets=3)
    assert _found(index, ["1 main", "2 oak", "rear", "9 lost"]) == {"1 main": "a", "rear": "c", "9 lost": None}
    old = PlaceIndex.open(spark, root)
    index.update(resolve.index_places(_places(spark, [("c", "C", "5 elm"), ("d", "D", "1 main st rear")])), removed=spark.createDataFrame([("a",)], "place_id string"))
    for now in (index, PlaceIndex.open(spark, root)):
        assert _found(now, ["1 main", "2 oak", "rear", "elm", "st"]) == {"1 main": "d", "2 oak": "b", "rear": "d", "elm": "c", "st": "d"}
    assert _found(old, ["1 main", "rear"]) == {"1 main": "a", "rear": "c"}       # a reader of before is not disturbed
    index.compact(buckets=2)
    now = PlaceIndex.open(spark, root)
    assert now.state["buckets"] == 2 and now.state["replaced"] is False
    assert _found(now, ["1 main", "2 oak", "rear", "elm", "st"]) == {"1 main": "d", "2 oak": "b", "rear": "d", "elm": "c", "st": "d"}
    assert {r.n for r in now.frequencies().collect()} == {1}                       # a's and the old c's tokens are gone
    with pytest.raises(ValueError):
        PlaceIndex.create(spark, root)


def test_a_broken_update_is_not_seen(spark, monkeypatch):
    root = scratch_path(spark, "index")
    index = resolve.stored_index(_places(spark, [("a", "A", "1 main st")]), root, buckets=2)

    def dies(self, state):
        raise RuntimeError("lost")

    new = resolve.index_places(_places(spark, [("a", "A", "7 pine"), ("b", "B", "1 main st")]))
    with monkeypatch.context() as m:
        m.setattr(PlaceIndex, "_commit", dies)
        with pytest.raises(RuntimeError):
            index.update(new)
    again = PlaceIndex.open(spark, root)
    assert _found(again, ["1 main", "pine"]) == {"1 main": "a"}
    again.update(new)                                        # run again under a number of its own
    assert _found(again, ["1 main", "pine"]) == {"1 main": "b", "pine": "a"}
    assert {r.n for r in again.frequencies().collect()} == {1}


def test_postings_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = resolve.stored_index(_places(spark, [(str(i), str(i), f"{i % 7} st{i}") for i in range(200)]), scratch_path(spark, "index"))
        asked = spark.createDataFrame([(1,)], "th long").distinct()
        # one exchange deals the asked tokens; the postings stay in their buckets
        assert _exchanges(index.read("postings").join(asked, "th")) == 1
        assert _exchanges(index.frequencies()) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


_WORDS = ["1", "2", "main", "oak", "st", "rd", "apt", "97000"]
_TEXT = st.lists(st.sampled_from(_WORDS), min_size=1, max_size=4).map(" ".join)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(list("abcdef")), st.tuples(_TEXT, st.sampled_from(["g", "h"])), max_size=4), min_size=1, max_size=3),
       st.lists(st.sampled_from(list("abcdef")), max_size=2), st.lists(_TEXT, min_size=1, max_size=6))
def test_index_after_deltas_matches_brute_force(spark, deliveries, removed, queries):
    index, live = PlaceIndex.create(spark, scratch_path(spark, "index"), 2), {}
    for k, d in enumerate(deliveries):
        gone = removed if k == len(deliveries) - 1 else []
        rows = [(p, g, t) for p, (t, g) in d.items()]
        live = {p: v for p, v in live.items() if p not in gone} | d
        index.update(resolve.index_places(_places(spark, rows)), spark.createDataFrame([(p,) for p in gone], "place_id string"))
    want = {}
    for q in set(queries):
        hits = [(p, g) for p, (t, g) in live.items() if set(q.split()) <= set(t.split())]
        if hits and len({g for _, g in hits}) == 1:
            want[q] = min(p for p, _ in hits)
    assert _found(index, sorted(set(queries))) == want


# ---------------------------------------------------------------- K8: keyed store
def test_store_writes_what_changed(spark):
    root = scratch_path(spark, "store")
    rows = spark.range(20_000).selectExpr("CAST(id AS STRING) AS k", "CAST(hash(id) AS STRING) AS v", "repeat(CAST(hash(id, 7) AS STRING), 8) AS w")
    store = KeyedStore.of(rows, root, ["k"])
    assert store.upsert(rows) == 20_000
    store.compact()
    before = _bytes(root)
    assert store.upsert(rows.where("CAST(k AS INT) % 100 = 0").withColumn("v", F.lit("new"))) == 200
    assert _bytes(root) - before < 0.05 * before
    got = KeyedStore.open(spark, root).read()
    assert got.count() == 20_000 and got.where("v = 'new'").count() == 200
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _exchanges(KeyedStore.open(spark, root).read()) == 0        # base and deltas meet bucket by bucket
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_store_last_wins_and_rows_without_key_stay(spark):
    root, schema = scratch_path(spark, "store"), "k string, v string, n int"
    one = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), (None, "x", 1), (None, "y", 2)], schema)
    two = spark.createDataFrame([("a", "3", 1), ("b", "4", 1), (None, "x", 1)], schema)
    store = KeyedStore.of(one.drop("n"), root, ["k"])
    store.upsert(one, ["n"])
    reader = KeyedStore.open(spark, root).read()
    store.compact()
    store.upsert(two, ["n"])
    want = [("a", "3"), ("b", "4"), (None, "x"), (None, "x"), (None, "y")]
    assert sorted(map(tuple, store.read().collect()), key=str) == want
    assert sorted(map(tuple, reader.collect()), key=str) == [("a", "2"), (None, "x"), (None, "y")]
    store.compact()
    store.vacuum()
    assert sorted(map(tuple, KeyedStore.open(spark, root).read().collect()), key=str) == want
    assert store.upsert(one.limit(0), ["n"]) == 0 and store.read().count() == 5


def test_a_broken_delivery_is_not_seen(spark, monkeypatch):
    root = scratch_path(spark, "store")
    df = spark.createDataFrame([("a", "1")], "k string, v string")
    store = KeyedStore.of(df, root, ["k"])
    store.upsert(df)

    def dies(self, state):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedStore, "_commit", dies)
        with pytest.raises(RuntimeError):
            store.upsert(df.withColumn("v", F.lit("2")))
    assert [r.v for r in KeyedStore.open(spark, root).read().collect()] == ["1"]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(1, 9) | st.none()), max_size=6), min_size=1, max_size=4), st.integers(0, 3))
def test_ledger_holds_the_least_date_in_any_order(spark, deliveries, compact_after):
    root, schema = scratch_path(spark, "ledger"), "k string, file_date date"
    day = lambda n: None if n is None else DAY(2024, 1, n)
    frames = [spark.createDataFrame([(k, day(n)) for k, n in d], schema) for d in deliveries]
    store = KeyedStore.create(spark, root, frames[0].schema, ["k"], least="file_date", buckets=2)
    for i, f in enumerate(frames):
        store.upsert(f)
        assert store.upsert(f) == 0                          # a second delivery of the same rows writes nothing
        if i == compact_after:
            store.compact()
    want = {}
    for k, n in (r for d in deliveries for r in d):
        want[k] = min((x for x in (want.get(k), day(n)) if x is not None), default=None)
    assert {r.k: r.file_date for r in KeyedStore.open(spark, root).read().collect()} == want


# ---------------------------------------------------------------- K2-K4: dated tables
def test_dated_table(spark):
    t = DatedTable(spark, scratch_path(spark, "dated"), "election_date")
    assert t.read() is None
    schema = "id int, election_date date"
    rows = [(i, DAY(2024, 1 + i % 2, 1)) for i in range(10)]
    for i in range(5):
        t.append(spark.createDataFrame(rows[2 * i:2 * i + 2], schema))
    assert t.append_unseen(spark.createDataFrame(rows + [(99, DAY(2024, 1, 1)), (98, None)], schema)) == 2
    assert t.append_unseen(spark.createDataFrame([(98, None)], schema)) == 0
    reader = t.read()
    files = len(reader.inputFiles())
    assert t.compact() == ["2024-01-01", "2024-02-01"]
    assert len(t.read().inputFiles()) < files
    want = sorted([*rows, (99, DAY(2024, 1, 1)), (98, None)], key=str)
    assert sorted(map(tuple, t.read().collect()), key=str) == want == sorted(map(tuple, reader.collect()), key=str)
    t.replace(spark.createDataFrame([(7, DAY(2024, 1, 1))], schema))
    assert sorted(map(tuple, t.read(["2024-01-01"]).collect())) == [(7, DAY(2024, 1, 1))]
    t.vacuum()
    assert t.read().count() == 1 + 5 + 1 and t.read(["1999-01-01"]).count() == 0


# ---------------------------------------------------------------- S9: deliveries
def test_deliveries_are_read_once(spark):
    root, kept = scratch_path(spark, "raw"), Deliveries(spark, scratch_path(spark, "kept"))
    assert kept.load(root, list) is None                     # no folder yet

    def drop(folder, name, text="ID\n1\n"):
        os.makedirs(f"{root}/{folder}", exist_ok=True)
        with open(f"{root}/{folder}/{name}", "w") as f:
            f.write(text)

    drop("2024_01_01", "a.csv")
    drop("2024_01_01", "_tmp")
    drop("other", "b.csv")                                   # in no dated folder
    names = lambda paths: sorted(os.path.basename(p) for p in paths)
    with pytest.raises(ZeroDivisionError):
        kept.load(root, lambda paths: 1 / 0)
    assert names(kept.load(root, list)) == ["a.csv"]
    assert kept.load(root, list) is None
    drop("2024_01_02", "c.csv")
    drop("2024_01_01", "a.csv", "ID\n1\n2\n")               # written anew
    assert names(Deliveries(spark, kept.folder).load(root, list)) == ["a.csv", "c.csv"]
    assert [str(r.file_date) for r in kept.pending(root).collect()] == []


def test_jobs_end_quietly_where_nothing_arrived(spark, tmp_path):
    from rollsnap.plans import jobs

    assert jobs.run_motor_voter(spark, str(tmp_path) + "/*", str(tmp_path / "ledger"), "OR") == 0
    assert jobs.run_motor_voter(spark, str(tmp_path / "none"), str(tmp_path / "ledger"), "OR", deliveries=str(tmp_path / "kept")) == 0
    assert jobs.run_daily_voted(spark, str(tmp_path), str(tmp_path / "out"), "OR") == {"current": 0, "history": 0, "store": 0}


def test_motor_job_layers_and_back_fill(spark, tmp_path):
    from rollsnap.plans import jobs

    raw, ledger, kept = tmp_path / "raw", str(tmp_path / "ledger"), str(tmp_path / "kept")

    def deliver(folder, ids):
        (raw / folder).mkdir(parents=True)
        (raw / folder / "f.csv").write_text("VTR_ID,COUNTY\n" + "".join(f"{i},Lane\n" for i in ids))

    deliver("2024_02_01", [1, 2])
    assert jobs.run_motor_voter(spark, str(raw), ledger, "OR", deliveries=kept, back_fill=True) == 2
    deliver("2024_01_01", [2, 3])
    assert jobs.run_motor_voter(spark, str(raw), ledger, "OR", deliveries=kept, back_fill=True) == 2
    assert jobs.run_motor_voter(spark, str(raw), ledger, "OR", deliveries=kept, back_fill=True) == 0
    got = {r.state_voter_id: str(r.file_date) for r in KeyedStore.open(spark, ledger).read().collect()}
    assert got == {"1": "2024-02-01", "2": "2024-01-01", "3": "2024-01-01"}
    assert glob.glob(f"{ledger}__processed/*/*.parquet")


# ---------------------------------------------------------------- T2: keyed state
def test_first_seen_stream_keeps_its_state(spark):
    from rollsnap.streaming import first_seen_stream

    schema = "k string, file_date date"
    src, out = scratch_path(spark, "src"), scratch_path(spark, "out")
    ledger = spark.createDataFrame([("a", DAY(2024, 1, 1))], schema)
    run = lambda: first_seen_stream(spark, f"{src}/*", schema, out, f"{out}-ckpt", ["k"], ledger=ledger)
    spark.createDataFrame([("a", DAY(2024, 1, 5)), ("b", DAY(2024, 1, 7)), ("b", DAY(2024, 1, 6)), (None, None)], schema).coalesce(1).write.parquet(f"{src}/1")
    run()
    read = lambda: sorted(map(tuple, spark.read.schema(schema).option("recursiveFileLookup", True).parquet(out).collect()), key=str)
    assert read() == [("b", DAY(2024, 1, 6)), (None, None)]
    spark.createDataFrame([("b", DAY(2023, 1, 1)), ("c", DAY(2024, 2, 1)), ("a", DAY(2023, 1, 1))], schema).coalesce(1).write.parquet(f"{src}/2")
    run()
    assert read() == [("b", DAY(2024, 1, 6)), ("c", DAY(2024, 2, 1)), (None, None)]


def test_first_seen_stream_by_files(spark, monkeypatch):
    """A file a micro-batch, keys of the ledger in any of them; the state is
    an aggregate's, so no key passes through Python."""
    from rollsnap.streaming import first_seen_stream, streams

    plans, drain = [], streams._drain
    monkeypatch.setattr(streams, "_drain", lambda stream, *a, **k: (plans.append(stream._jdf.queryExecution().analyzed().toString()), drain(stream, *a, **k)))
    schema = "k string, n long, file_date date"
    src, out = scratch_path(spark, "src"), scratch_path(spark, "out")
    ledger = spark.createDataFrame([("a", 1, DAY(2024, 1, 1)), ("a", 1, None), (None, 2, DAY(2024, 1, 1))], schema)
    files = [[("b", 1, DAY(2024, 3, 2)), ("b", 1, DAY(2024, 3, 1)), ("a", 2, None)], [("b", 1, DAY(2024, 1, 1)), ("a", 1, DAY(2023, 1, 1)), ("a", 2, DAY(2024, 1, 1))],
             [(None, 2, DAY(2023, 1, 1)), (None, None, DAY(2024, 5, 1)), ("c", 1, DAY(2024, 5, 2))], [(None, None, DAY(2024, 1, 1)), ("c", 1, DAY(2024, 1, 1))]]

    def run(part, known):
        for rows in part:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        first_seen_stream(spark, src, schema, out, f"{out}-ckpt", ["k", "n"], ledger=known)

    run(files[:3], ledger)
    run(files[3:], ledger.limit(1).withColumn("k", F.lit("z")))     # a checkpoint keeps the ledger it began with
    run([[("z", 1, DAY(2024, 6, 1))]], None)
    got = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(out).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("b", 1, DAY(2024, 3, 1)), ("a", 2, None), (None, None, DAY(2024, 5, 1)), ("c", 1, DAY(2024, 5, 2)), ("z", 1, DAY(2024, 6, 1))], key=str)
    assert len(plans) == 3 and not any("TransformWithState" in p for p in plans)


# ---------------------------------------------------------------- S2: entries of a bundle
def _zip(path, members, method=8):
    import zipfile

    with zipfile.ZipFile(path, "w", method) as z:
        for name, text in members:
            z.writestr(name, text)


def _records(spark, *paths):
    from rollsnap.sources import zipped

    df = zipped.read_zip_tsv(spark, [str(p) for p in paths])
    return sorted((r.county, r.A, r.B) for r in df.select("county", "A", "B").collect())


def test_members_are_dealt_to_tasks(spark, tmp_path):
    import random

    from rollsnap.sources import zipped

    rnd = random.Random(1)
    want, members = [], [("docs/", ""), ("docs/readme.txt", "no data")]
    for m in range(12):
        rows = [(str(m), f"{m}-{i}", f"{rnd.random()}") for i in range(2_000)]
        want += rows
        members.append((f"x_{m}.txt", "A\tB\n" + "".join(f"{a}\t{b}\n" for _, a, b in rows)))
    _zip(tmp_path / "b.zip", members)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        records = zipped.zip_records(spark, [str(tmp_path / "b.zip")])
        assert len({r.f for r in records.select(F.input_file_name().alias("f")).distinct().collect()}) > 4
        assert _records(spark, tmp_path / "b.zip") == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_odd_bundles(spark, tmp_path):
    import io
    import zipfile

    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("n_1.txt", "A\tB\n")
    _zip(tmp_path / "empty.zip", [])
    _zip(tmp_path / "stored.zip", [("s_1.txt", "A\tB\nx\ty\n"), ("s_2.txt", "")], 0)
    _zip(tmp_path / "bz.zip", [("z_1.txt", "A\tB\nbz\ty\n")], 12)            # not a stream we inflate: through the directory
    # the mark occurs inside a member: the bundle is read again
    _zip(tmp_path / "mark.zip", [("m_1.txt", "A\tB\nin PK\x03\x04 side\ty\n"), ("m_2.txt", "A\tB\np\tq\n")], 0)
    with open(tmp_path / "prefix.zip", "wb") as f:           # something in front of the first entry
        f.write(b"#!/bin/sh\n" + (tmp_path / "stored.zip").read_bytes())
    paths = [tmp_path / f"{n}.zip" for n in ("empty", "stored", "bz", "mark")]
    assert _records(spark, *paths) == [("1", "bz", "y"), ("1", "in PK\x03\x04 side", "y"), ("1", "x", "y"), ("2", "p", "q")]
    assert _records(spark, tmp_path / "prefix.zip") == [("1", "x", "y")]
    (tmp_path / "broken.zip").write_bytes((tmp_path / "bz.zip").read_bytes()[:40])
    with pytest.raises(Exception, match="zip"):
        _records(spark, tmp_path / "broken.zip")
    _zip(tmp_path / "cut.zip", [("c_1.txt", "A\tB\n" + "u\tv\n" * 5_000)])
    data = bytearray((tmp_path / "cut.zip").read_bytes())
    data[60] ^= 0xFF                                         # a damaged stream is an error, not fewer rows
    (tmp_path / "cut.zip").write_bytes(data)
    with pytest.raises(Exception):
        _records(spark, tmp_path / "cut.zip")


def test_open_quotes():
    import io

    from rollsnap.sources.zipped import read_records

    read = lambda text: [(f, o) for _, _, f, o in read_records(io.BytesIO(text.encode()))]
    assert read('A\tB\n1\ta\n2\t"open\n3\tc\n4\td\n5\te\n') == [
        (["1", "a"], False), (["2", '"open'], True), (["3", "c"], False), (["4", "d"], False), (["5", "e"], False)]
    assert read('A\tB\n1\t"two\nlines"\n2\t"a""b"c\n') == [(["1", "two\nlines"], False), (["2", 'a"bc'], False)]
    assert read('A\tB\tC\n"x"\t"y\tz\n') == [(["x", '"y', "z"], True)]
    far = "x" * 2_000
    assert len(read('A\tB\n1\t"open\n' + f"2\t{far}\n" * 2_000 + '3\t"q"\n')) == 2_002
