"""Bindings of what lives from run to run: keyed stores of base and deltas,
first-seen ledgers under back-fills, delivery manifests, dated tables and
their compaction; and of feeds read from files. Inputs are derived from the
driver tables, so each grows with them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contracts as C
from ..operators import project, reshape
from ..session import scratch_path, stage
from ..sources import delimited, sinks
from ..sources.dated import DatedTable
from ..sources.deliveries import Deliveries
from ..sources.keyed_store import KeyedStore
from . import feeds, jobs
from .bind_clean import wide_history
from .bind_edge import _LEDGER_SQL, _motor_files
from .bind_feeds import AS_OF_YEAR, FILE_DATE, _clean_sql, _raw_roll_sql, raw_roll, resolved_roll
from .bind_io import _HISTORY_SQL
from .fixtures import write_csv_snapshots
from .registry import binding, table


# ---------------------------------------------------------------- K8: base and deltas
@binding("k8_delta_store", """
    SELECT CAST(o_custkey AS VARCHAR) AS id, arg_max(o_orderpriority, o_orderkey) AS priority, arg_max(CAST(o_orderdate AS DATE), o_orderkey) AS day FROM orders GROUP BY o_custkey""")
def q_k8_delta(spark, d):
    """Five deliveries of orders in the order of their keys, many rows per
    customer; compacted after the second, so the rest are deltas on a base."""
    o = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("id"), F.col("o_orderpriority").alias("priority"),
                                         F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("n"))
    root, top = scratch_path(spark, "store"), o.agg(F.max("n")).first()[0]
    for k in range(5):
        part = o.where((F.col("n") > top * k / 5) & (F.col("n") <= top * (k + 1) / 5))
        KeyedStore.of(part.drop("n"), root, ["id"]).upsert(part, ["n"])
        if k == 1:
            KeyedStore.open(spark, root).compact()
    return KeyedStore.open(spark, root).read()


# ---------------------------------------------------------------- A9 / E7: back-fills
@binding("e7_backfill", _LEDGER_SQL)
def q_e7_backfill(spark, d):
    """Snapshots out of order: late ones first, then the earliest, then those
    between; the ledger holds the least date of every key."""
    e, ledger, days = table(spark, d, "events"), scratch_path(spark, "ledger"), F.dayofyear("ts")
    for k, (lo, hi) in enumerate(((20, 400), (0, 5), (5, 20))):
        root = scratch_path(spark, "raw-omv")
        _motor_files(spark, d, root, e.where((days > lo) & (days <= hi)))
        jobs.run_motor_voter(spark, root + "/*", ledger, "OR", back_fill=True)
        if k == 1:
            KeyedStore.open(spark, ledger).compact()
    return KeyedStore.open(spark, ledger).read().select(*C.MOTOR_FINAL_COLUMNS)


# ---------------------------------------------------------------- S9: a second run reads new folders only
@binding("s9_second_run", """
    WITH e AS (SELECT CAST(ts AS DATE) AS file_date, dayofyear(ts) <= 10 AS early FROM events)
    SELECT CASE WHEN early THEN 1 ELSE 2 END AS run, file_date, count(*) AS n FROM e GROUP BY ALL""")
def q_s9_second(spark, d):
    """Rows that each run reads, by date: the second run, over a folder that
    still holds the first one's files, reads none of them. A run that fails
    in between records nothing."""
    e, days = table(spark, d, "events"), F.dayofyear("ts")
    root, kept, read = scratch_path(spark, "raw-omv"), Deliveries(spark, scratch_path(spark, "loaded")), scratch_path(spark, "read")

    def load(run):
        def action(files):
            rows = delimited.read_snapshots(spark, files, contract=C.MOTOR_CONTRACT)
            rows.groupBy("file_date").agg(F.count(F.lit(1)).alias("n")).withColumn("run", F.lit(run)).write.mode("append").parquet(read)
        return action

    def fails(files):
        raise RuntimeError("the load broke off")

    _motor_files(spark, d, root, e.where(days <= 10))
    kept.load(root, load(1))
    _motor_files(spark, d, root, e.where(days > 10))
    try:
        kept.load(root, fails)
    except RuntimeError:
        pass
    kept.load(root, load(2))
    if kept.load(root, load(3)) is not None:
        raise RuntimeError("a third run found files that the second had loaded")
    return spark.read.schema("file_date date, n long, run int").parquet(read).select("run", "file_date", "n")


# ---------------------------------------------------------------- K4: compaction
@binding("k4_compact", _HISTORY_SQL)
def q_k4_compact(spark, d):
    """Vote history appended in eight deliveries (overlapping ones add
    nothing), then rewritten: a date that was many runs is one."""
    long = stage(feeds.history_long(wide_history(spark, d)), "history")
    history = DatedTable(spark, scratch_path(spark, "dated"), "election_date")
    part = F.pmod(F.xxhash64("state_voter_id"), F.lit(8))
    for k in range(8):
        history.append_unseen(long.where((part == k) | (part == (k + 1) % 8)))
    before = len(history.read().inputFiles())
    history.compact()
    if len(history.read().inputFiles()) >= before:
        raise RuntimeError("compaction left as many files")
    return history.read().select(*C.HISTORY_FINAL_COLUMNS)


# ---------------------------------------------------------------- E1 from files, E1 before the cut-over
@binding("e1_from_files", _clean_sql())
def q_e1_files(spark, d):
    """E1 over CSV files of two header orders in a dated folder."""
    raw, root = raw_roll(spark, d), scratch_path(spark, "raw-roll")
    cols = raw.columns
    write_csv_snapshots(raw.where("STATUS = 'A'").withColumn("snap", F.lit("2024_06_30")), root, "snap")
    write_csv_snapshots(raw.where("STATUS <> 'A'").select(*reversed(cols)).withColumn("snap", F.lit("2024_06_30")), root, "snap")
    return feeds.voters_clean(delimited.read_delimited(spark, root + "/*"), FILE_DATE, AS_OF_YEAR, tie_breakers=["physical_address_1"])


_BORN = "make_date(1900 + k % 90, k % 12 + 1, k % 28 + 1)"


@binding("e1_before_cutover", f"""
    WITH raw AS ({_raw_roll_sql()}),
    v AS (SELECT DISTINCT VOTER_ID AS state_voter_id, CAST(VOTER_ID AS BIGINT) AS k FROM raw WHERE VOTER_ID <> 'ACP' AND STATUS = 'A' AND PRECINCT IS NOT NULL),
    b AS (SELECT state_voter_id, CASE WHEN k % 6 < 3 THEN {_BORN} WHEN k % 6 = 3 THEN make_date(1900 + k % 90, 1, 1) ELSE DATE '1850-01-01' END AS birthdate FROM v)
    SELECT state_voter_id, birthdate, CAST(2016 - year(birthdate) AS INTEGER) AS age FROM b""")
def q_e1_before(spark, d):
    """A file of before the cut-over: birth dates as text in every layout
    (ISO, month/day/year, month-day-year, a year alone), unreadable and
    missing ones."""
    k = F.col("VOTER_ID").try_cast("long")
    born = F.expr(_BORN.replace("k %", "CAST(VOTER_ID AS BIGINT) %"))
    text = (F.when(k % 6 == 0, F.date_format(born, "yyyy-MM-dd")).when(k % 6 == 1, F.date_format(born, "M/d/yyyy"))
            .when(k % 6 == 2, F.date_format(born, "M-d-yyyy")).when(k % 6 == 3, F.date_format(born, "yyyy")).when(k % 6 == 4, F.lit("unknown")))
    raw = raw_roll(spark, d).withColumn("BIRTH_DATE", F.when(k.isNotNull(), text))
    return feeds.voters_clean(raw, "2016-06-30", 2016, tie_breakers=["physical_address_1"]).select("state_voter_id", "birthdate", "age")


# ---------------------------------------------------------------- U1 / P8 / K9
@binding("u1_unlike_columns", """
    SELECT c_custkey AS id, c_name AS name, NULL::VARCHAR AS segment, NULL::DOUBLE AS balance FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT c_custkey, NULL, c_mktsegment, NULL FROM customer WHERE c_custkey % 3 = 1
    UNION ALL SELECT c_custkey, c_name, NULL, c_acctbal FROM customer WHERE c_custkey % 3 = 2""")
def q_u1(spark, d):
    c = table(spark, d, "customer").withColumnsRenamed({"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment", "c_acctbal": "balance"})
    part = [c.where(F.col("id") % 3 == k) for k in range(3)]
    return reshape.union_by_name([part[0].select("id", "name"), part[1].select("segment", "id"), part[2].select("balance", "name", "id")])


@binding("p8_hash_sample", """
    SELECT least(count(*), 137) AS n, least(count(*), 137) AS same, least(count(*), 137) AS inside FROM (SELECT DISTINCT o_orderkey FROM orders)""")
def q_p8_hash(spark, d):
    """The default rank of a sample: exactly n keys, the same again however
    the table is partitioned, all of them from the table."""
    o = table(spark, d, "orders").select("o_orderkey").distinct()
    one = project.fixed_sample(o, 137, 7, ["o_orderkey"])
    two = project.fixed_sample(o.repartition(13), 137, 7, ["o_orderkey"])
    marked = o.join(one.withColumn("first", F.lit(1)), "o_orderkey", "full").join(two.withColumn("second", F.lit(1)), "o_orderkey", "left")
    return marked.agg(F.count("first").alias("n"), F.count(F.when(F.col("first") == F.col("second"), 1)).alias("same"),
                      F.count(F.when(F.col("o_orderkey").isNotNull() & F.col("first").isNotNull(), 1)).alias("inside"))


_TOO_LONG = "CAST(state_voter_id AS BIGINT) % 7 = 0"


@binding("k9_load_counts", f"""
    WITH c AS ({_clean_sql()})
    SELECT 'loaded' AS outcome, count(*) FILTER (NOT {_TOO_LONG}) AS n FROM c UNION ALL SELECT 'rejected', count(*) FILTER ({_TOO_LONG}) FROM c""")
def q_k9_counts(spark, d):
    """What a load reports: rows in the table and rows in the quarantine,
    counted by the writes themselves."""
    limit = C.VOTERS_TYPES["name_last"][1]
    resolved = resolved_roll(spark, d).withColumn("name_last", F.when(F.expr(_TOO_LONG), F.repeat(F.lit("x"), limit + 1)).otherwise(F.col("name_last")))
    report: dict = {}
    _, rejects = feeds.voters_publish(resolved, scratch_path(spark, "voters"), FILE_DATE, report=report)
    sinks.json_lines(rejects, scratch_path(spark, "quarantine"))
    return spark.createDataFrame(list(feeds.load_counts(report).items()), "outcome string, n long")
