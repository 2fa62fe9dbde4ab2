"""End-to-end jobs: raw dated folders -> published tables, one call per feed.

These are what a scheduler runs for each delivery; paths and run parameters
are plain arguments (no command-line parsing, no config files). Each job
reads whole snapshot folders with the sources, runs the feed composition and
writes through the sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..operators import project
from ..operators.place_index import PlaceIndex
from ..session import scratch_scope, stage
from ..sources import delimited, sinks, zipped
from ..sources.deliveries import Deliveries
from . import feeds


def run_voters(
    spark: SparkSession,
    raw_files: str,
    places: DataFrame,
    units: DataFrame,
    names: DataFrame,
    table_path: str,
    file_date,
    state: str,
    as_of_year: int,
    sep: str = ",",
    view: str | None = None,
    tie_breakers: list[str] | None = None,
    json_path: str | None = None,
    sample: int | None = None,
    report: dict | None = None,
    place_index: PlaceIndex | None = None,
    unit_index: PlaceIndex | None = None,
) -> DataFrame:
    """E1 -> E2 -> E3 for one delivery: clean the raw roll (all files of the
    snapshot folder) into the processed layer, resolve addresses into the
    resolved layer, replace the dated partition of the voters table and make
    it current (optionally also JSON documents). Returns the published rows;
    rejected rows (type or length) are written next to the table. ``report``
    gets the rows loaded and rejected. Stored indexes of the places are
    reused from run to run. Staged tables are deleted at the end."""
    raw = delimited.read_delimited(spark, raw_files, sep)
    observed: dict = {}
    with scratch_scope(spark):
        clean = feeds.voters_clean(raw, file_date, as_of_year, tie_breakers, sample)
        clean = sinks.write_layer(clean, f"{table_path}__processed/file_date={file_date}")
        resolved = feeds.voters_resolve(clean, places, units, names, file_date, state, place_index=place_index, unit_index=unit_index)
        resolved = sinks.write_layer(resolved, f"{table_path}__resolved/file_date={file_date}")
        _, rejects = feeds.voters_publish(resolved, table_path, file_date, view, json_path, report=observed, staged=True)
        sinks.json_lines(rejects, f"{table_path}__rejects/file_date={file_date}")
    if report is not None:
        report.update(feeds.load_counts(observed))
    return spark.read.parquet(table_path).where(F.col("file_date") == F.lit(str(file_date)).cast("date"))


def run_history(spark: SparkSession, raw_files: str, table_path: str, state: str, sep: str = ",", sample: int | None = None) -> int:
    """E4 -> E5: wide history extract to long form, one processed layer per
    election date, appended per election date without duplicates. Returns
    rows appended."""
    with scratch_scope(spark):
        long = stage(feeds.history_long(delimited.read_delimited(spark, raw_files, sep), state, sample=sample), "history")
        sinks.replace_snapshot(long, f"{table_path}__processed", "election_date", "gzip")
        return feeds.history_publish(long, table_path)


def run_daily_voted(spark: SparkSession, bundle_root: str, tables_root: str, state: str, sample: int | None = None) -> dict[str, int]:
    """Newest bundle per dated folder -> ballots -> processed layer per
    election date, keyed store, insert-only current/history tables. A folder
    without bundles changes nothing."""
    if zipped.newest_per_folder(spark, bundle_root).isEmpty():
        return {"current": 0, "history": 0, "store": 0}
    with scratch_scope(spark):
        ballots = feeds.daily_voted(spark, bundle_root, state, positions=True, sample=sample)
        return feeds.daily_voted_load(ballots, tables_root)


def run_motor_voter(spark: SparkSession, snapshot_glob: str, ledger_path: str, state: str,
                    sep: str = ",", sample: int | None = None, deliveries: str | None = None, back_fill: bool = False) -> int:
    """Rows of the given dated folders that the ledger has not seen yet,
    each with its first date among them, in the ledger. What earlier runs
    wrote stays; where no files arrived the run ends quietly. Returns rows
    written.

    ``deliveries`` names the folder that keeps which files were loaded: a run
    then reads only new ones below ``snapshot_glob`` (a folder there).
    ``back_fill`` keeps the ledger as a keyed store that holds the least date
    whatever the order of snapshots; else it is an insert-only table."""
    load = feeds.motor_voter_merge if back_fill else feeds.motor_voter_load

    def run(files: list[str]) -> int:
        snapshots = delimited.read_snapshots(spark, files, sep, contract=C.MOTOR_CONTRACT)
        if sample:
            snapshots = project.fixed_sample(snapshots.distinct(), sample, keys=["state_voter_id", "county", "file_date"])
        with scratch_scope(spark):
            snapshots = sinks.write_layer(snapshots, f"{ledger_path}__processed/loaded_at={sinks.timestamp()}")
            return load(snapshots, ledger_path, state)

    if deliveries:
        return Deliveries(spark, deliveries).load(snapshot_glob, run) or 0
    files = delimited.list_files(spark, snapshot_glob)
    return run(files) if files else 0


def run_precincts(spark: SparkSession, raw_files: str, table_path: str, file_date, state: str,
                  sep: str = ",", csv_folder: str | None = None, view: str | None = None, sample: int | None = None) -> DataFrame:
    """precinct/district link table for one delivery, dated partition
    replaced and made current; processed and final layer, optional
    header-less CSV drop."""
    raw = delimited.read_delimited(spark, raw_files, sep)
    df = sinks.write_layer(feeds.precincts(raw, file_date, state, sample=sample), f"{table_path}__processed/file_date={file_date}")
    return feeds.precincts_load(df, table_path, csv_folder, view, file_date, f"{table_path}__final/file_date={file_date}")


__all__ = ["run_voters", "run_history", "run_daily_voted", "run_motor_voter", "run_precincts"]
