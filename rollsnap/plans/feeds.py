"""Feed compositions (E1-E8): each is one declarative plan over the operators;
shuffles happen only at de-dups, lookups and writes."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions import dates as D
from ..functions import keys as K
from ..functions.text import strip_ws
from ..operators import dedup, diff, dims, filters, project, reshape, resolve
from ..operators.place_index import PlaceIndex
from ..operators.metrics import observe_rows, observed_rows
from ..session import stage
from ..sources import delimited, sinks, zipped
from ..sources.keyed_store import KeyedStore


PASS_COL = "pass_no"


def _counted(df: DataFrame, stage: str, report: dict | None) -> DataFrame:
    """With ``report`` (a dict) attach the stage's row counter to it; it
    fills when the result runs, without an extra job."""
    if report is None:
        return df
    df, report[stage] = observe_rows(df, stage)
    return df


def _as_date(v) -> _dt.date:
    return v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v))


# --------------------------------------------------------------------------- E1
def voters_clean(
    raw: DataFrame,
    file_date,
    as_of_year: int,
    tie_breakers: list[str] | None = None,
    sample: int | None = None,
    seed: int = 42,
    report: dict | None = None,
) -> DataFrame:
    """Contract -> sentinel/status/precinct filters -> registration date
    -> latest record per voter -> (sample) -> birth rule and age -> precinct
    link -> blanks. (Keep-first after latest-per-key is a no-op and is not
    re-run.) With ``report`` (a dict), A8 stage counters ``validated``,
    ``cleaned`` and ``latest`` are attached; they fill when the result runs,
    without extra jobs."""
    df = project.contract_project(raw, C.VOTERS_CONTRACT)
    df = filters.clean_roll(_counted(df, "validated", report))
    df = _counted(df, "cleaned", report)
    df = df.withColumn("registration_date", D.parse_mdy("registration_date"))
    df = dedup.latest_per_key(df, "state_voter_id", "registration_date", tie_breakers)
    df = _counted(df, "latest", report)
    if sample:
        df = project.fixed_sample(df, sample, seed, ["state_voter_id"])
    if _as_date(file_date) < D.BIRTH_RULE_CUTOVER:
        df = df.withColumn("birthdate", D.birth_by_date("birthdate"))
        df = df.withColumn("age", D.age(D.year_of("birthdate"), as_of_year))
    else:
        df = df.withColumn("birthdate", D.birth_year("birthdate", "confidential"))
        df = df.withColumn("age", D.age("birthdate", as_of_year))
    df = df.withColumn("precinct_link", K.link_key("county", "precinct", "split"))
    return project.fill_blank(df)


# --------------------------------------------------------------------------- E2
def voters_resolve(
    clean: DataFrame,
    places: DataFrame,
    units: DataFrame,
    names: DataFrame,
    file_date,
    state: str,
    passes: list[resolve.Pass] | None = None,
    sample: int | None = None,
    seed: int = 42,
    report: dict | None = None,
    strategy: str = "all",
    place_index: PlaceIndex | None = None,
    unit_index: PlaceIndex | None = None,
) -> DataFrame:
    """Blanks -> query texts -> pass 01 -> passes 02-07 (one cascade job)
    -> file date / state -> R1-R4 -> year-only birth dates -> gender -> mail id.
    Column ``pass_no`` holds the pass that resolved a row (A5 per pass);
    stored indexes of places and units are used where given."""
    if sample:
        clean = project.fixed_sample(clean, sample, seed, ["state_voter_id"])
    df = project.fill_blank(_counted(clean, "clean", report))
    df = resolve.reference_texts(df)
    df = resolve.mark_pass01(df)
    df = resolve.cascade(df, "state_voter_id", passes or resolve.reference_passes(), places, units, strategy=strategy,
                         pass_col=PASS_COL, place_index=place_index, unit_index=unit_index)
    df = project.with_constants(df, {"file_date": F.lit(str(_as_date(file_date))).cast("date"),
                                     "state": state.lower()})
    df = resolve.post_rules(df)
    df = df.withColumn("birthdate", D.year_only_to_date_text(F.col("birthdate").cast("string")))
    df = dims.guess_gender(df, names)
    df = df.withColumn("mail_id", K.mail_key("mail_address_1", "mail_zip_code"))
    return df.drop("find_address_02", "find_address_04", "find_address_06", "find_address_07")


# --------------------------------------------------------------------------- E3
def voters_publish(resolved: DataFrame, table_path: str | None, file_date, view: str | None = None,
                   json_path: str | None = None, sample: int | None = None, seed: int = 42,
                   report: dict | None = None, staged: bool = False):
    """(sample) -> missing registration date -> file date, blanks, final
    typed projection; replace the dated partition and make its date current
    (K2, K7), and/or write JSON documents (K6). Returns ``(good, rejects)``.

    With an output the checked rows are staged first: clean and cascade run
    once, however many tables are written from them (``staged`` says that
    ``resolved`` is a written layer already). With ``report`` (a dict) and a
    table, the rows loaded and rejected are counted in it (K9)
    once they are written; ``load_counts`` reads it."""
    fd = _as_date(file_date)
    if sample:
        resolved = project.fixed_sample(resolved, sample, seed, ["state_voter_id"])
    df = resolved.withColumn("registration_date", D.fill_date("registration_date", str(fd)))
    df = project.fill_blank(df)
    if (table_path or json_path) and not (staged and not sample):
        df = stage(df.select(*C.VOTERS_FINAL_COLUMNS), "voters-final")
    good, rejects = project.typed_projection(df, C.VOTERS_TYPES, C.VOTERS_FINAL_COLUMNS)
    good, rejects = _counted(good, "loaded", report), _counted(rejects, "rejected", report)
    if table_path:
        sinks.replace_snapshot(good, table_path, "file_date")
        sinks.current_view(good.sparkSession, table_path, view, fd)
    if json_path:
        sinks.json_lines(good, json_path)
    return good, rejects


def load_counts(report: dict) -> dict[str, int]:
    """K9: the numbers in a report whose stages have run."""
    return {name: observed_rows(seen) for name, seen in report.items()}


# --------------------------------------------------------------------------- E4 / E5
def history_long(raw: DataFrame, state: str = "or", id_header: str = "VOTER_ID", sample: int | None = None,
                 seed: int = 42, report: dict | None = None) -> DataFrame:
    """Wide history extract -> long ``(state, id, election_date, voted)``.
    The final distinct also drops what repeated wide rows give, so the wide
    rows are not de-duplicated (and shuffled) first. ``sample`` keeps that
    many voters' extract rows."""
    df = project.rename(_counted(raw, "raw", report), {id_header: "state_voter_id"})
    if sample:
        df = project.fixed_sample(df.dropDuplicates(), sample, seed, ["state_voter_id"])
    df = filters.drop_sentinel(df, "state_voter_id")
    df = reshape.election_headers(df, "state_voter_id")
    df = reshape.unpivot_marks(df, "state_voter_id")
    df = filters.drop_ineligible(df, "voted")
    df = project.with_constants(df, {"state": state.upper()})
    return _counted(dedup.distinct_rows(project.final_projection(df, C.HISTORY_FINAL_COLUMNS)), "long", report)


def history_publish(long: DataFrame, table_path: str, sample: int | None = None, seed: int = 42) -> int:
    """E5: (sample) -> append unseen rows, one partition per election date;
    only the touched election partitions of the table are read. Returns rows
    added."""
    df = project.final_projection(long, C.HISTORY_FINAL_COLUMNS)
    if sample:
        df = project.fixed_sample(df, sample, seed)
    return sinks.append_unseen(df, table_path, partition_by=["election_date"])


# --------------------------------------------------------------------------- E6
#: columns that tell the order in which ballots were written
BALLOT_ORDER = ["zip_path", "member_no", "line_no"]


def daily_voted(spark: SparkSession, root: str, state: str = "or", positions: bool = False, sample: int | None = None,
                seed: int = 42, report: dict | None = None) -> DataFrame:
    """Newest bundle per dated folder -> member lines -> contract ->
    keep last per (county, voter, date) in file order -> sentinel -> state
    and election date (the folder date) -> ISO receive date -> typed. With
    ``positions`` the file order (``BALLOT_ORDER``) is carried along, which
    the keyed store needs."""
    newest = zipped.newest_per_folder(spark, root)
    raw = zipped.read_zip_tsv(spark, newest)
    mapping = project.resolve_contract(raw.columns, C.DAILY_CONTRACT)
    df = raw.select(
        "zip_path", "member_no", "line_no",
        *[strip_ws(F.col(f"`{src}`")).alias(t) for t, src in mapping.items()],
    )
    df = _counted(df, "records", report).withColumn("election_date", delimited.snapshot_date("zip_path"))
    df = dedup.keep_last(df, ["election_date", "county", "state_voter_id", "voted_on_date"],
                         ["zip_path", "member_no", "line_no"])
    df = filters.drop_sentinel(df, "state_voter_id")
    df = df.withColumns({
        "state": F.lit(state.upper()),
        "voted_on_date": D.reorder_mdy("voted_on_date").try_cast("date"),
    })
    if sample:
        df = project.fixed_sample(df, sample, seed, ["election_date", "county", "state_voter_id", "voted_on_date"])
    return _counted(project.final_projection(df, C.DAILY_FINAL_COLUMNS + (BALLOT_ORDER if positions else [])), "ballots", report)


def ballot_ids(df: DataFrame) -> DataFrame:
    """Document id ``STATE-election_date-voter`` for the keyed store."""
    return df.withColumn("id", K.link_key("state", D.format_date("election_date"), "state_voter_id"))


# --------------------------------------------------------------------------- E7
def read_motor_snapshots(spark: SparkSession, root_glob: str, sep: str = ",") -> DataFrame:
    """S9 + P1 for the motor-voter feed: every dated snapshot, contract
    applied per header group, ``file_date`` from the folder name."""
    return delimited.read_snapshots(spark, root_glob, sep, contract=C.MOTOR_CONTRACT)


def motor_voter(snapshots: DataFrame, state: str = "or", sample: int | None = None, seed: int = 42) -> DataFrame:
    """E7 (batch): distinct -> state -> first-seen ledger keyed by (state,
    county, voter) - what appending J2 diffs over ascending snapshots
    produces. ``snapshots`` = ``read_motor_snapshots`` output."""
    if not filters.has_rows(snapshots):   # F9: nothing arrived
        return snapshots.sparkSession.createDataFrame([], C.struct_type(C.MOTOR_TYPES, C.MOTOR_FINAL_COLUMNS))
    df = project.with_constants(snapshots.select("state_voter_id", "county", "file_date"), {"state": state.lower()})
    ledger = diff.first_seen(df, ["state", "county", "state_voter_id"], "file_date")
    if sample:
        ledger = project.fixed_sample(ledger, sample, seed, ["state", "county", "state_voter_id"])
    return project.final_projection(ledger, C.MOTOR_FINAL_COLUMNS)


# --------------------------------------------------------------------------- E8
def precincts(raw: DataFrame, file_date, state: str = "or", sample: int | None = None, seed: int = 42,
              report: dict | None = None) -> DataFrame:
    """Contract -> distinct -> precinct and district links -> state and
    file date -> final projection."""
    df = project.contract_project(_counted(raw, "raw", report), C.PRECINCT_CONTRACT)
    df = dedup.distinct_rows(df)
    if sample:
        df = project.fixed_sample(df, sample, seed)
    df = df.withColumns({
        "precinct_link": K.link_key("district_county", "precinct_number", "precinct_split"),
        "district_link": K.link_key("district_county", "district_type", "district_name"),
        "file_date": F.lit(str(_as_date(file_date))).cast("date"),
        "state": F.lit(state.lower()),
    })
    return _counted(project.final_projection(df, C.PRECINCT_FINAL_COLUMNS), "precincts", report)


# --------------------------------------------------------------------------- loads
def daily_voted_load(ballots: DataFrame, root: str) -> dict[str, int]:
    """E6 loads: processed layer by election date (K1); keyed document store
    by ``STATE-election_date-voter`` (C3 + K8, the later line of the files
    wins; ``KeyedStore`` in ``<root>/store``); insert-only current and history
    tables partitioned by election date (J1 + K3, only touched partitions
    read). Returns rows appended per table.

    ``ballots`` should carry ``BALLOT_ORDER`` (``daily_voted(...,
    positions=True)``); without it the later receive date counts as later."""
    order = [c for c in BALLOT_ORDER if c in ballots.columns] or ["voted_on_date", "county"]
    # one file set per election date: a newer delivery leaves other dates' layers
    staged = stage(ballots, "ballots")
    sinks.replace_snapshot(staged, f"{root}/processed", "election_date", "gzip")
    documents = ballot_ids(staged)
    if order[0] not in BALLOT_ORDER:
        documents = documents.withColumns({f"__{c}": F.col(c) for c in order})
        order = [f"__{c}" for c in order]
    documents = documents.select("id", *C.DAILY_FINAL_COLUMNS, *order)
    store = KeyedStore.of(documents.drop(*order), f"{root}/store", ["id"])
    store.upsert(documents, order)
    rows = staged.select(*C.DAILY_FINAL_COLUMNS)
    return {
        "current": sinks.append_unseen(rows, f"{root}/current", partition_by=["election_date"]),
        "history": sinks.append_unseen(rows, f"{root}/history", partition_by=["election_date"]),
        "store": store.read().count(),
    }


def motor_voter_load(snapshot: DataFrame, ledger_path: str, state: str = "or") -> int:
    """E7 (incremental): the first-seen rows of one or more new snapshots
    appended to the ledger - J2 on (state, county, voter) against the ledger,
    then K3. The ledger is only ever appended to: a delivery without rows
    leaves it as it is (F9). Applied to snapshots in ascending date order it
    builds the same ledger as ``motor_voter``. Returns rows appended."""
    if not filters.has_rows(snapshot):
        return 0
    keys = ["state", "county", "state_voter_id"]
    df = project.with_constants(snapshot.select("state_voter_id", "county", "file_date"), {"state": state.lower()})
    first = project.final_projection(diff.first_seen(df, keys, "file_date"), C.MOTOR_FINAL_COLUMNS)
    old = sinks.read_existing(first, ledger_path)
    if old is not None:
        first = diff.new_keys(first, old, keys)
    first, obs = observe_rows(first, "ledger")
    sinks.append_rows(first, ledger_path)
    return observed_rows(obs)


def motor_voter_merge(snapshot: DataFrame, ledger_root: str, state: str = "or") -> int:
    """E7 (back-fill correct): new snapshots merged into a keyed store that
    holds the first date of every (state, county, voter), in whatever order
    the snapshots arrive. Only keys that are new or get an earlier date are
    written. An empty delivery changes nothing (F9). Returns rows written."""
    if not filters.has_rows(snapshot):
        return 0
    keys = ["state", "county", "state_voter_id"]
    df = project.with_constants(snapshot.select("state_voter_id", "county", "file_date"), {"state": state.lower()})
    first = project.final_projection(diff.first_seen(df, keys, "file_date"), C.MOTOR_FINAL_COLUMNS)
    return KeyedStore.of(first, ledger_root, keys, least="file_date").upsert(first)


def precincts_load(df: DataFrame, table_path: str, csv_folder: str | None = None,
                   view: str | None = None, file_date=None, layer: str | None = None) -> DataFrame:
    """E8 loads: final layer (K1, at ``layer``), the dated table replaced
    (K2), the run's date made current (K7; a back-fill names its own date) and
    header-less CSV drop (K5)."""
    if layer:
        df = sinks.write_layer(df, layer)
    sinks.replace_snapshot(df, table_path, "file_date")
    if view or file_date is not None:
        sinks.current_view(df.sparkSession, table_path, view, file_date)
    if csv_folder:
        sinks.csv_drop(df, csv_folder)
    return df.sparkSession.read.parquet(table_path)
