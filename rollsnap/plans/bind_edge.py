"""Bindings for what clean, unique, quote-free data never reaches: quoted and
repeated content, empty deliveries, back-fills, broken versions. Inputs are
derived from the driver tables, so each grows with them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import contracts as C
from ..operators import diff
from ..session import scratch_path, stage
from ..sources import delimited, sinks, tables, zipped
from ..sources.keyed_store import KeyedStore
from ..streaming import first_seen_stream, tail_with_quarantine
from . import feeds
from .bind_clean import wide_history
from .bind_feeds import FILE_DATE, _PRECINCT_FROM, RAW_PRECINCTS, raw_precincts, resolved_roll, _publish_sql
from .bind_io import _HISTORY_SQL, _daily_bundles
from .fixtures import write_csv_snapshots, write_zip_bundles
from .registry import binding, table


# ---------------------------------------------------------------- S1 / K5: quotes
@binding("s1_quoted_csv",
         """SELECT CAST(c_custkey AS VARCHAR) AS "ID", 'say "' || c_name || '", ' || c_mktsegment AS "NOTE",
            CASE WHEN c_custkey % 3 = 0 THEN 'two' || chr(10) || 'lines' ELSE 'end\\' END AS "TAIL" FROM customer""")
def q_s1(spark, d):
    c = table(spark, d, "customer")
    note = F.concat(F.lit('say "'), "c_name", F.lit('", '), "c_mktsegment")
    tail = F.when(F.col("c_custkey") % 3 == 0, F.lit("two\nlines")).otherwise(F.lit("end\\"))
    root = scratch_path(spark, "quoted")
    # one file per task, each with its header line; every field quoted, quotes doubled
    rows = c.select(F.col("c_custkey").cast("string").alias("ID"), note.alias("NOTE"), tail.alias("TAIL"))
    rows.repartition(4).write.option("header", True).option("quoteAll", True).option("escape", '"').csv(root)
    return delimited.read_delimited(spark, root, multi_line=True).select("ID", "NOTE", "TAIL")


@binding("k5_csv_quotes", """SELECT c_custkey, 'a "' || c_name || '" b, c' AS note FROM customer""")
def q_k5(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit('a "'), "c_name", F.lit('" b, c')).alias("note"))
    out = sinks.csv_drop(c, scratch_path(spark, "csv-quotes"))
    # the file must be RFC 4180: read with doubled quotes as the escape
    return spark.read.option("escape", '"').schema("c_custkey LONG, note STRING").csv(out)


# ---------------------------------------------------------------- S2 / S4 / U1: members of any shape
def _members(spark, d, header: str, line, name: str):
    """Customers as members of bundles, dealt to the bundles by the hash of
    their key; the bundles' paths."""
    c = table(spark, d, "customer")
    root = scratch_path(spark, "bundles")
    folder = F.concat(F.lit("2024_05_01/"), F.pmod(F.xxhash64("c_custkey"), F.lit(8)).cast("string"))
    lines = c.select(folder.alias("folder"), F.concat(F.lit(name), F.col("c_nationkey").cast("string"), F.lit(".txt")).alias("member"),
                     F.col("c_custkey").alias("seq"), line.alias("line"))
    return [r.path for r in write_zip_bundles(lines, root, header, "b.zip").collect()]


@binding("s2_member_headers", """
    SELECT CAST(c_nationkey AS VARCHAR) AS county, CAST(c_custkey AS VARCHAR) AS "VOTER_ID", c_mktsegment AS "COUNTY.1", NULL::VARCHAR AS "EXTRA" FROM customer
    UNION ALL SELECT CAST(c_nationkey AS VARCHAR), CAST(c_custkey AS VARCHAR), NULL, c_name || chr(12) || 'x' FROM customer""")
def q_s2(spark, d):
    vid = F.col("c_custkey").cast("string")
    one = _members(spark, d, "﻿VOTER_ID\tCOUNTY", F.concat_ws("\t", vid, "c_mktsegment"), "r_")
    two = _members(spark, d, "EXTRA\tVOTER_ID", F.concat_ws("\t", F.concat("c_name", F.lit("\x0cx")), vid), "r_")
    both = zipped.read_zip_tsv(spark, one + two)
    return both.select("county", "VOTER_ID", "`COUNTY.1`", "EXTRA")


@binding("s4_bad_lines", """
    SELECT CAST(c_custkey AS VARCHAR) AS "A", CASE WHEN c_custkey % 4 = 1 THEN 'in ' || chr(9) || 'tab' WHEN c_custkey % 4 = 2 THEN 'mid"quote' ELSE c_name END AS "B",
           CASE WHEN c_custkey % 4 <> 3 THEN 'z' END AS "C" FROM customer WHERE c_custkey % 4 <> 0""")
def q_s4(spark, d):
    k, tab = F.col("c_custkey") % 4, F.lit("\t")
    vid = F.col("c_custkey").cast("string")
    line = (F.when(k == 0, F.concat(vid, F.lit('\ta"b\tc"d\te\tf')))             # five fields of three: skipped
            .when(k == 1, F.concat(vid, F.lit('\t"in \ttab"\tz')))
            .when(k == 2, F.concat(vid, F.lit('\tmid"quote\tz')))
            .otherwise(F.concat(vid, tab, F.col("c_name"))))                      # short: padded
    return zipped.read_zip_tsv(spark, _members(spark, d, "A\tB\tC", line, "m_")).select("A", "B", "C")


@binding("s4_unclosed_quote", """
    SELECT CAST(c_nationkey AS VARCHAR) AS county, CAST(c_custkey AS VARCHAR) AS "A", CASE WHEN c_custkey = last THEN '"open ' || c_name ELSE c_name END AS "B", c_custkey = last AS open_quote
    FROM (SELECT *, max(c_custkey) OVER (PARTITION BY c_nationkey) AS last FROM customer)""")
def q_s4_unclosed(spark, d):
    """The last record of every member opens a quote that nothing closes; in
    front of it stand records with quoted line ends, behind it a blank line."""
    last = F.max("c_custkey").over(Window.partitionBy("c_nationkey"))
    c = table(spark, d, "customer").withColumn("last", last)
    vid = F.col("c_custkey").cast("string")
    line = F.when(F.col("c_custkey") == F.col("last"), F.concat(vid, F.lit('\t"open '), "c_name", F.lit("\n"))).otherwise(F.concat_ws("\t", vid, "c_name"))
    root = scratch_path(spark, "bundles")
    lines = c.select(F.concat(F.lit("2024_05_01/"), F.pmod("c_nationkey", F.lit(8)).cast("string")).alias("folder"),
                     F.concat(F.lit("m_"), F.col("c_nationkey").cast("string"), F.lit(".txt")).alias("member"), F.col("c_custkey").alias("seq"), line.alias("line"))
    paths = [r.path for r in write_zip_bundles(lines, root, "A\tB", "b.zip").collect()]
    return zipped.read_zip_tsv(spark, paths).select("county", "A", "B", "open_quote")


@binding("s2_many_members", """
    SELECT CAST(o_orderkey % 97 AS VARCHAR) AS county, CAST(o_orderkey AS VARCHAR) AS "ID", o_orderpriority AS "PRIORITY", 'OK ' || o_orderstatus AS "STATUS" FROM orders""")
def q_s2_many(spark, d):
    """Bundles of up to 97 members each, read in ranges of 64 KB: a bundle's
    members go to several tasks."""
    o = table(spark, d, "orders")
    root = scratch_path(spark, "bundles")
    lines = o.select(F.concat(F.lit("2024_05_01/"), F.pmod(F.xxhash64("o_orderkey"), F.lit(4)).cast("string")).alias("folder"),
                     F.concat(F.lit("m_"), F.pmod("o_orderkey", F.lit(97)).cast("string"), F.lit(".txt")).alias("member"), F.col("o_orderkey").alias("seq"),
                     F.concat_ws("\t", F.col("o_orderkey").cast("string"), "o_orderpriority", F.concat(F.lit("OK "), "o_orderstatus")).alias("line"))
    paths = [r.path for r in write_zip_bundles(lines, root, "ID\tPRIORITY\tSTATUS", "b.zip").collect()]
    ranges = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(ranges)
    spark.conf.set(ranges, "64k")
    try:
        rows = zipped.read_zip_tsv(spark, paths)
    finally:
        spark.conf.set(ranges, before)
    return rows.select("county", "ID", "PRIORITY", "STATUS")


# ---------------------------------------------------------------- S8 / S9
@binding("s8_filtered_scan", "SELECT o_orderkey, o_orderstatus, make_date(year(o_orderdate), 1, 1) AS file_date FROM orders WHERE year(o_orderdate) = 1995")
def q_s8(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("file_date"))
    path = scratch_path(spark, "dated")
    sinks.replace_snapshot(o, path)
    return tables.read_where(spark, path, "file_date", "1995-01-01").select("o_orderkey", "o_orderstatus", "file_date")


def _motor_files(spark, d, root, rows):
    write_csv_snapshots(rows.select(F.col("user_id").alias("VTR_ID"), F.col("event_type").alias("COUNTY"), F.date_format("ts", "yyyy_MM_dd").alias("snap")), root, "snap")


@binding("s9_undated_folder", "SELECT event_type AS county, CAST(user_id AS VARCHAR) AS state_voter_id, CAST(ts AS DATE) AS file_date FROM events")
def q_s9(spark, d):
    e = table(spark, d, "events")
    root = scratch_path(spark, "raw") + "/2001_01_01_old"        # no snapshot folder of its own
    _motor_files(spark, d, root, e)
    e.select(F.col("user_id").cast("string").alias("VTR_ID"), F.col("event_type").alias("COUNTY")).write.option("header", True).csv(root + "/tmp_old")
    return feeds.read_motor_snapshots(spark, root + "/*").select("county", "state_voter_id", "file_date")


# ---------------------------------------------------------------- E7 / F9: the ledger only grows
_LEDGER_SQL = """
    SELECT 'or' AS state, event_type AS county, CAST(user_id AS VARCHAR) AS state_voter_id, min(CAST(ts AS DATE)) AS file_date
    FROM events GROUP BY event_type, user_id"""


@binding("e7_incremental_ledger", _LEDGER_SQL)
def q_e7_incremental(spark, d):
    """Three deliveries in order of their dates, each through the job's load."""
    e = table(spark, d, "events")
    ledger = scratch_path(spark, "ledger")
    days = F.dayofyear("ts")
    for lo, hi in ((0, 5), (5, 20), (20, 400)):
        root = scratch_path(spark, "raw-omv")
        _motor_files(spark, d, root, e.where((days > lo) & (days <= hi)))
        if delimited.list_files(spark, root + "/*"):
            feeds.motor_voter_load(feeds.read_motor_snapshots(spark, root + "/*"), ledger)
    return spark.read.parquet(ledger).select(*C.MOTOR_FINAL_COLUMNS)


@binding("f9_empty_delivery", _LEDGER_SQL)
def q_f9(spark, d):
    snaps = table(spark, d, "events").select(F.col("user_id").cast("string").alias("state_voter_id"), F.col("event_type").alias("county"), F.to_date("ts").alias("file_date"))
    ledger = scratch_path(spark, "ledger")
    feeds.motor_voter_load(snaps, ledger)
    feeds.motor_voter_load(snaps.where("file_date IS NULL"), ledger)     # nothing arrived
    return spark.read.parquet(ledger).select(*C.MOTOR_FINAL_COLUMNS)


# ---------------------------------------------------------------- K8 / E6 store
@binding("k8_upsert_duplicates", """
    SELECT CAST(o_custkey AS VARCHAR) AS id, arg_max(o_orderpriority, o_orderkey) AS priority FROM orders GROUP BY o_custkey""")
def q_k8(spark, d):
    """Two deliveries with many rows per key: the later row wins."""
    o = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("id"), F.col("o_orderpriority").alias("priority"), F.col("o_orderkey").alias("n"))
    root = scratch_path(spark, "store")
    middle = o.agg(F.max("n") / 2).first()[0]
    sinks.upsert_store(o.where(F.col("n") <= middle), root, ["id"], ["n"])
    return sinks.upsert_store(o.where(F.col("n") > middle), root, ["id"], ["n"])


@binding("e6_store", """
    WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS state_voter_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS election_date,
                 CAST(o_orderdate AS DATE) AS voted_on_date, o_orderkey FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'))
    SELECT 'OR-' || strftime(election_date, '%Y-%m-%d') || '-' || state_voter_id AS id, 'OR' AS state, state_voter_id, election_date,
           arg_max(voted_on_date, o_orderkey) AS voted_on_date FROM o GROUP BY state_voter_id, election_date""")
def q_e6_store(spark, d):
    """The keyed store after two deliveries, by the order of the files: the
    later line of a voter's county file is the ballot that stays (a bundle's
    lines stand in the order of their order key)."""
    root = _daily_bundles(spark, d, buckets=1)
    out = scratch_path(spark, "daily-tables")
    ballots = stage(feeds.daily_voted(spark, root, "OR", positions=True), "ballots")
    feeds.daily_voted_load(ballots.where(F.dayofmonth("voted_on_date") < 20), out)
    feeds.daily_voted_load(ballots, out)
    return KeyedStore.open(spark, out + "/store").read().select("id", "state", "state_voter_id", "election_date", "voted_on_date")


# ---------------------------------------------------------------- E5 / T2
@binding("e5_empty_then_load", _HISTORY_SQL)
def q_e5_empty(spark, d):
    long = feeds.history_long(wide_history(spark, d))
    path = scratch_path(spark, "vote_history")
    feeds.history_publish(long.where("voted = 'none of them'"), path)    # an empty first load
    feeds.history_publish(long, path)
    return spark.read.parquet(path).select(*C.HISTORY_FINAL_COLUMNS)


@binding("t2_key_ledger", "SELECT user_id, event_type, min(CAST(ts AS DATE)) AS file_date FROM events GROUP BY user_id, event_type")
def q_t2_keys(spark, d):
    """Key stream: the first third of the dates is a ledger that seeds the
    state, the next arrives before the last; the stream stops in between and
    goes on under its checkpoint."""
    e = table(spark, d, "events").select("user_id", "event_type", F.to_date("ts").alias("file_date"))
    src, target, key = scratch_path(spark, "ledger-src"), scratch_path(spark, "ledger"), ["user_id", "event_type"]
    lo, hi = e.agg(F.min("file_date"), F.max("file_date")).first()
    cuts = [lo + (hi - lo) * k / 3 for k in (1, 2)]
    first = F.col("file_date") <= F.lit(cuts[0])
    ledger = stage(diff.first_seen(e.where(first), key), "ledger")
    for k, part in enumerate((e.where(~first & (F.col("file_date") <= F.lit(cuts[1]))), e.where(F.col("file_date") > F.lit(cuts[1])))):
        part.write.parquet(f"{src}/{k}")
        first_seen_stream(spark, f"{src}/*", "user_id LONG, event_type STRING, file_date DATE", target, f"{target}-ckpt", key, ledger=ledger, max_files=None)
    added = spark.read.schema("user_id LONG, event_type STRING, file_date DATE").option("recursiveFileLookup", True).parquet(target)
    return ledger.unionByName(added).select("user_id", "event_type", "file_date")


@binding("t1_bad_lines", """
    SELECT CASE WHEN event_id % 10 <> 3 THEN event_id END AS event_id, CASE WHEN event_id % 10 <> 3 THEN event_type END AS event_type,
           CASE WHEN event_id % 20 = 3 THEN '{"event_id": ' || event_id WHEN event_id % 20 = 13 THEN '[' || event_id || ']' END AS line FROM events""")
def q_t1_bad(spark, d):
    """Every tenth line is cut off or JSON of another shape: it is in the
    quarantine, and no row of nulls is among the parsed ones."""
    e = table(spark, d, "events").select("event_id", "event_type")
    k, text = F.col("event_id") % 20, F.col("event_id").cast("string")
    line = F.when(k == 3, F.concat(F.lit('{"event_id": '), text)).when(k == 13, F.concat(F.lit("["), text, F.lit("]"))).otherwise(F.to_json(F.struct("event_id", "event_type")))
    src, good, bad = (scratch_path(spark, n) for n in ("json-src", "json-good", "json-bad"))
    e.select(line.alias("value")).repartition(4).write.text(src)
    tail_with_quarantine(spark, src, "event_id LONG, event_type STRING", good, bad, scratch_path(spark, "json-ckpt"), max_files=2)
    rows = spark.read.schema("event_id LONG, event_type STRING").option("recursiveFileLookup", True).parquet(good).withColumn("line", F.lit(None).cast("string"))
    lines = spark.read.option("recursiveFileLookup", True).text(bad)
    return rows.unionByName(lines.select(F.lit(None).cast("long").alias("event_id"), F.lit(None).cast("string").alias("event_type"), F.col("value").alias("line")))


# ---------------------------------------------------------------- E3 / E8 / K7 outputs
@binding("e3_publish_table", _publish_sql())
def q_e3_table(spark, d):
    path = scratch_path(spark, "voters")
    feeds.voters_publish(resolved_roll(spark, d), path, FILE_DATE)
    return sinks.current_view(spark, path).select(*C.VOTERS_FINAL_COLUMNS)


@binding("e3_publish_json", _publish_sql())
def q_e3_json(spark, d):
    path = scratch_path(spark, "voters-json")
    good, _ = feeds.voters_publish(resolved_roll(spark, d), None, FILE_DATE, json_path=path)
    return spark.read.schema(good.schema).json(path).select(*C.VOTERS_FINAL_COLUMNS)


@binding("k7_backfill_view", "SELECT o_orderkey, make_date(year(o_orderdate), 1, 1) AS file_date FROM orders WHERE year(o_orderdate) = (SELECT min(year(o_orderdate)) FROM orders)")
def q_k7_backfill(spark, d):
    """A back-fill of an older date becomes current though newer ones exist."""
    snaps = table(spark, d, "orders").select("o_orderkey", F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("file_date"))
    path = scratch_path(spark, "dated")
    sinks.replace_snapshot(snaps, path)
    sinks.point_current(spark, path, snaps.agg(F.min("file_date")).first()[0])
    return sinks.current_view(spark, path).select("o_orderkey", "file_date")


@binding("e8_load", f"""
    WITH raw AS (SELECT DISTINCT {', '.join(f'{e} AS {h}' for h, e in RAW_PRECINCTS)} FROM {_PRECINCT_FROM})
    SELECT DATE '{FILE_DATE}' AS file_date, 'or' AS state, COUNTY AS district_county, PRECINCT AS precinct_number FROM raw""")
def q_e8_load(spark, d):
    path = scratch_path(spark, "precincts")
    newer = feeds.precincts(raw_precincts(spark, d), "2025-01-01", "OR")
    feeds.precincts_load(newer, path, file_date="2025-01-01", layer=scratch_path(spark, "final"))
    run = feeds.precincts(raw_precincts(spark, d), FILE_DATE, "OR")
    feeds.precincts_load(run, path, csv_folder=scratch_path(spark, "drop"), file_date=FILE_DATE, layer=scratch_path(spark, "final"))
    return sinks.current_view(spark, path).select("file_date", "state", "district_county", "precinct_number")


# ---------------------------------------------------------------- A8 / U1
@binding("a8_stage_counts", """
    SELECT 'raw' AS stage, count(*) AS n FROM customer UNION ALL
    SELECT 'precincts', count(*) FROM (SELECT DISTINCT {} FROM {})""".format(", ".join(f"{e} AS {h}" for h, e in RAW_PRECINCTS), _PRECINCT_FROM))
def q_a8(spark, d):
    report: dict = {}
    sinks.write_layer(feeds.precincts(raw_precincts(spark, d), FILE_DATE, "OR", report=report), scratch_path(spark, "counted"))
    return spark.createDataFrame([(k, v.get["rows"]) for k, v in report.items()], "stage string, n long")


@binding("a9_incremental_diff", "SELECT DISTINCT user_id FROM events")
def q_a9(spark, d):
    ids = table(spark, d, "events").select("user_id").distinct()
    half = ids.where("user_id % 2 = 0")
    return half.unionAll(diff.new_rows(ids, half))


