"""Bindings of the file sources, sinks and file-based feeds (S1-S10, K1-K9,
E4-E7). Each binding writes real files derived from the driver tables into a
fresh folder under the shared ``spark.checkpoint.dir`` and reads them back;
the oracle is the source query."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contracts as C
from ..functions import dates as D
from ..functions import keys as K
from ..operators import project
from ..session import scratch_path
from ..sources import delimited, sinks, tables
from . import feeds
from .bind_clean import wide_history
from .fixtures import write_csv_snapshots, write_zip_bundles
from .registry import binding, table

_HISTORY_SQL = """
    WITH m AS (
      SELECT o_custkey, year(o_orderdate) AS y,
             max(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '-' ELSE lower(o_orderstatus) END) AS mark
      FROM orders GROUP BY o_custkey, year(o_orderdate))
    SELECT DISTINCT 'OR' AS state, CAST(o_custkey AS VARCHAR) AS state_voter_id,
           make_date(y, 1, 1) AS election_date, upper(mark) AS voted
    FROM m WHERE o_custkey <> 0 AND NOT contains(mark, '-')
"""


# ---------------------------------------------------------------- K1 / S6
@binding("k1_s6_parquet_layer",
         "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS file_date FROM orders")
def q_k1(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                         F.to_date("o_orderdate").alias("file_date"))
    path = scratch_path(spark, "layer")
    sinks.write_layer(o, path)
    return tables.read_layer(spark, path)


# ---------------------------------------------------------------- K2 / S8 / K7
def _snapshots(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus",
                    F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("file_date"))


@binding(
    "k2_s8_partition_replace",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, make_date(year(o_orderdate), 1, 1) AS file_date FROM orders
    WHERE NOT (year(o_orderdate) = 1996 AND o_orderstatus = 'P')
    """,
)
def q_k2(spark, d):
    path = scratch_path(spark, "dated")
    snaps = _snapshots(spark, d)
    sinks.replace_snapshot(snaps, path)
    # re-deliver the 1996 snapshot without pending orders: only that date
    # changes (the source is re-derived; a job never overwrites what it reads)
    redo = snaps.where((F.col("file_date") == F.lit("1996-01-01").cast("date")) & (F.col("o_orderstatus") != "P"))
    sinks.replace_snapshot(redo, path)
    before = tables.read_where(spark, path, "file_date", "1995-01-01").count()
    if before == 0:
        raise RuntimeError("untouched snapshot lost")
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_orderstatus", "file_date")


@binding(
    "k7_current_view",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, make_date(year(o_orderdate), 1, 1) AS file_date FROM orders
    WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)
    """,
)
def q_k7(spark, d):
    path = scratch_path(spark, "dated")
    sinks.replace_snapshot(_snapshots(spark, d), path)
    sinks.current_view(spark, path, "orders_current")
    return spark.table("orders_current").select("o_orderkey", "o_custkey", "o_orderstatus", "file_date")


# ---------------------------------------------------------------- K3 / K4 / J1 / A6 (E5)
@binding("e5_history_publish", _HISTORY_SQL)
def q_e5(spark, d):
    long = feeds.history_long(wide_history(spark, d))
    path = scratch_path(spark, "vote_history")
    # first delivery: the finished ballots; second: everything (re-sends overlap)
    feeds.history_publish(long.where(F.col("voted") == "F"), path)
    feeds.history_publish(long, path)
    return spark.read.parquet(path).select(*C.HISTORY_FINAL_COLUMNS)


# ---------------------------------------------------------------- S1 / S9 / E4
@binding("e4_history_extract", _HISTORY_SQL)
def q_e4(spark, d):
    root = scratch_path(spark, "raw-history")
    wide = wide_history(spark, d).withColumn("snap", F.lit("2024_06_30"))
    write_csv_snapshots(wide, root, "snap")
    raw = delimited.read_delimited(spark, root + "/*")
    return feeds.history_long(raw)


# ---------------------------------------------------------------- S1 / S9 / P1 / J2 / A9
@binding(
    "e7_motor_voter_ledger",
    """
    SELECT 'or' AS state, event_type AS county, CAST(user_id AS VARCHAR) AS state_voter_id,
           min(CAST(ts AS DATE)) AS file_date
    FROM events GROUP BY event_type, user_id
    """,
)
def q_e7(spark, d):
    root = scratch_path(spark, "raw-omv")
    e = table(spark, d, "events").select(
        "user_id", "event_type", F.date_format("ts", "yyyy_MM_dd").alias("snap"), F.dayofmonth("ts").alias("dom")
    )
    # early snapshots: VTR_ID,COUNTY; later ones list a decoy VOTER_ID after
    # STATE_VOTER_ID, so the alias that comes first in the file must win
    early = e.where(F.col("dom") < 15).select(
        F.col("user_id").alias("VTR_ID"), F.col("event_type").alias("COUNTY"), "snap")
    late = e.where(F.col("dom") >= 15).select(
        F.col("event_type").alias("COUNTY"), F.col("user_id").alias("STATE_VOTER_ID"),
        F.concat(F.lit("decoy-"), F.col("user_id").cast("string")).alias("VOTER_ID"), "snap")
    write_csv_snapshots(early, root, "snap")
    write_csv_snapshots(late, root, "snap")
    return feeds.motor_voter(feeds.read_motor_snapshots(spark, root + "/*"), "OR")


# ---------------------------------------------------------------- S2-S5 / S3 / A3 / C5
_BALLOT_HEADER = "VOTER_ID\tRECEIVE_DATE\tBALLOT_STYLE"


BUCKETS = 4   # folders per election month


def _ballot_lines(spark, d, stale: bool, buckets: int):
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    month = F.date_format("o_orderdate", "yyyy-MM-01")
    bucket = F.pmod(F.xxhash64("o_orderkey"), F.lit(buckets)).cast("string")
    style = (
        F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit('"3-MEDIUM\tquoted"'))
        .otherwise(F.col("o_orderpriority"))
    )
    line = F.concat_ws("\t", F.col("o_custkey").cast("string"), F.date_format("o_orderdate", "MM-dd-yyyy"), style)
    # malformed: too many fields -> skipped by the reader
    bad = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    line = F.when(bad, F.concat(line, F.lit("\textra\tfields"))).otherwise(line)
    if stale:
        # an older bundle in the same folder with wrong dates: must be ignored
        line = F.concat_ws("\t", F.col("o_custkey").cast("string"), F.lit("01-01-1900"), F.lit("stale"))
    return j.select(
        F.concat_ws("/", month, bucket).alias("folder"),
        F.concat(F.lit("received-"), month, F.lit("_"), F.col("n_name"), F.lit(".txt")).alias("member"),
        F.col("o_orderkey").alias("seq"),
        line.alias("line"),
    )


_DAILY_SQL = """
    SELECT DISTINCT 'OR' AS state, string_split(n.n_name, '_')[-1] AS county,
           CAST(o.o_custkey AS VARCHAR) AS state_voter_id,
           CAST(date_trunc('month', o.o_orderdate) AS DATE) AS election_date,
           CAST(o.o_orderdate AS DATE) AS voted_on_date
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE NOT (o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'P')
"""


def _daily_bundles(spark, d, buckets: int = BUCKETS) -> str:
    root = scratch_path(spark, "raw-daily")
    # one folder per (election month, bucket) at any size
    write_zip_bundles(_ballot_lines(spark, d, True, buckets), root, _BALLOT_HEADER, "older.zip").count()
    write_zip_bundles(_ballot_lines(spark, d, False, buckets), root, _BALLOT_HEADER, "ballots.zip").count()
    return root


@binding("e6_daily_voted_load", _DAILY_SQL)
def q_e6_load(spark, d):
    ballots = feeds.daily_voted(spark, _daily_bundles(spark, d), "OR", positions=True)
    out = scratch_path(spark, "daily-tables")
    feeds.daily_voted_load(ballots, out)
    if feeds.daily_voted_load(ballots, out)["history"]:   # a re-delivery adds nothing
        raise RuntimeError("re-delivered ballots were appended again")
    return spark.read.parquet(out + "/history").select(*C.DAILY_FINAL_COLUMNS)


@binding("e6_daily_voted", _DAILY_SQL)
def q_e6(spark, d):
    return feeds.daily_voted(spark, _daily_bundles(spark, d), "OR")


# ---------------------------------------------------------------- K5
@binding("k5_headerless_csv", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def q_k5(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    out = sinks.csv_drop(c, scratch_path(spark, "csv-drop"))
    return spark.read.schema("c_custkey LONG, c_name STRING, c_mktsegment STRING, c_acctbal DOUBLE").csv(out)


# ---------------------------------------------------------------- K6
@binding(
    "k6_json_lines",
    "SELECT c_custkey, c_name, NULLIF(c_mktsegment, 'HOUSEHOLD') AS segment FROM customer",
)
def q_k6(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", "c_name", F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("segment"))
    path = scratch_path(spark, "json")
    sinks.json_lines(c, path)
    # null fields are present as JSON nulls (not dropped)
    text = spark.read.text(path)
    return text.select(F.from_json("value", "c_custkey LONG, c_name STRING, segment STRING").alias("j")).select("j.*")


# ---------------------------------------------------------------- K8 / C3
@binding(
    "k8_keyed_upsert",
    """
    SELECT 'OR' || '-' || strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || '-' || CAST(o_orderkey AS VARCHAR) AS id,
           CASE WHEN o_orderstatus = 'O' THEN 'X' ELSE o_orderstatus END AS status
    FROM orders
    """,
)
def q_k8(spark, d):
    o = table(spark, d, "orders")
    docs = o.select(
        K.link_key(F.lit("OR"), D.format_date(F.to_date("o_orderdate")), F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderstatus").alias("status"),
    )
    store = scratch_path(spark, "store")
    sinks.write_layer(docs, store + "/v1")
    newer = docs.where(F.col("status") == "O").withColumn("status", F.lit("X"))
    merged = sinks.keyed_upsert(spark.read.parquet(store + "/v1"), newer, ["id"], [])
    return sinks.write_layer(merged, store + "/v2")


# ---------------------------------------------------------------- K9 / P7
@binding(
    "k9_reject_log",
    """
    WITH raw AS (
      SELECT CAST(o_custkey AS VARCHAR) AS state_voter_id, 'or' AS state,
             CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS file_date,
             CASE WHEN o_orderpriority = '5-LOW' THEN 'Douglas County Extended Name' ELSE o_orderpriority END AS county
      FROM orders),
    r AS (SELECT *, concat_ws('; ',
            CASE WHEN file_date = 'pending' THEN 'file_date: not a date' END,
            CASE WHEN length(county) > 20 THEN 'county: longer than 20' END) AS reject_reason FROM raw)
    SELECT * FROM r WHERE reject_reason <> ''
    """,
)
def q_k9(spark, d):
    o = table(spark, d, "orders")
    raw = o.select(
        F.col("o_custkey").cast("string").alias("state_voter_id"),
        F.lit("or").alias("state"),
        F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("file_date"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("Douglas County Extended Name"))
        .otherwise(F.col("o_orderpriority")).alias("county"),
    )
    _good, rejects = project.typed_projection(raw, C.MOTOR_TYPES | {"county": ("string", 20)},
                                              ["state_voter_id", "state", "file_date", "county"])
    path = scratch_path(spark, "quarantine")
    sinks.json_lines(rejects, path)
    return spark.read.schema(rejects.schema).json(path)


# ---------------------------------------------------------------- S7 / S10
@binding(
    "s7_s10_table_scan",
    """
    SELECT 'OR' AS state, CAST(o_custkey AS VARCHAR) AS state_voter_id,
           CAST(o_orderdate AS DATE) AS election_date, CAST(o_orderdate AS DATE) AS voted_on_date
    FROM orders
    """,
)
def q_s7(spark, d):
    o = table(spark, d, "orders")
    path = scratch_path(spark, "daily_voted_history")
    if tables.table_exists(spark, path):
        raise RuntimeError("fresh path already exists")
    # dates stored as text, as a loader without types would leave them
    o.select(F.lit("OR").alias("state"), F.col("o_custkey").cast("string").alias("state_voter_id"),
             F.date_format("o_orderdate", "yyyy-MM-dd").alias("election_date"),
             F.date_format("o_orderdate", "yyyy-MM-dd").alias("voted_on_date"),
             F.lit("x").alias("unused")).write.parquet(path)
    if not tables.table_exists(spark, path):
        raise RuntimeError("table missing after write")
    return tables.read_table(spark, path, ["state", "state_voter_id", "election_date", "voted_on_date"])
