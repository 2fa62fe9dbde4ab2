"""Address resolution against a places table.

The source resolved one row at a time with a remote search per pass. Here
each lookup is a set-based join over the **distinct** query texts:

* J4 / J5 (token containment, "all query tokens occur in the place"): the
  stored inverted index of ``place_index``, or one derived from the rows at
  hand. Texts are analysed once per distinct text and looked up once per
  distinct token set; a query is accepted when exactly one place (J5) or one
  place group (J4) remains. No cross join, no per-row Python, no cap on
  candidates.
* J3 (exact three-key lookup): equi-join to the places that are unique on
  the key (A7: count = 1).
* J6 (ordered fall-back over passes): every distinct text of every pass is
  looked up at once and a row takes the first pass that hit, or the passes run
  as a chain; the caller chooses. Both give the same rows because a pass
  depends only on the row being unresolved, never on an earlier pass's output.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import PLACE_RESULT_COLUMNS, PLACE_TEXT_FIELDS
from ..functions.keys import number_or_zero
from ..functions.predicates import contains_literal, equals_flag, pattern_flag
from ..functions.text import analyze, search_text
from ..session import scratch_path, stage, together
from .place_index import PassingIndex, PlaceIndex

NOT_FOUND = "Not Found"
SUCCESS = "Success"
HOMELESS = "Homeless"
CONFIDENTIAL = "Confidential"

PLACE_ATTRS = PLACE_RESULT_COLUMNS[2:]   # the 12 attributes copied on a hit


# --------------------------------------------------------------------------- places
def index_places(
    places: DataFrame,
    id_col: str = "place_id",
    group_col: str | None = "group_id",
    fields: list[str] = PLACE_TEXT_FIELDS,
) -> DataFrame:
    """Analysed places ``(place_id, group_id, pt)``, one row per place row.

    ``pt`` is the distinct token set of all searched fields of the place (a
    query token may match in any field)."""
    present = [f for f in fields if f in places.columns]
    pt = analyze(F.concat_ws(" ", *[F.col(f).cast("string") for f in present]))
    grp = F.col(group_col).cast("string") if group_col else F.col(id_col).cast("string")
    return places.select(F.col(id_col).cast("string").alias("place_id"), grp.alias("group_id"), pt.alias("pt"))


def token_key(text) -> "F.Column":
    """Canonical form of a query: its sorted distinct tokens joined by blanks
    (tokens never hold blanks, so equal keys mean equal token sets). Texts
    that differ only in spacing, case, punctuation or empty parts share one
    key and are looked up once."""
    c = F.col(text) if isinstance(text, str) else text
    return F.array_join(F.array_sort(analyze(c)), " ")


def stored_index(places: DataFrame, root: str | None = None, id_col: str = "place_id", group_col: str | None = "group_id",
                 buckets: int | None = None) -> PlaceIndex:
    """A stored index of ``places`` in ``root`` (default: the job's scratch
    folder), with one delivery in it."""
    spark = places.sparkSession
    index = PlaceIndex.create(spark, root or scratch_path(spark, "place-index"), buckets)
    index.update(index_places(places, id_col, group_col))
    return index


def stored_indexes(places: DataFrame, units: DataFrame, id_col: str = "place_id", group_col: str | None = "group_id") -> dict[str, PlaceIndex]:
    """Stored indexes of the two place tables, as ``cascade`` takes them."""
    both = together(lambda: stored_index(places, None, id_col, group_col), lambda: stored_index(units, None, id_col, None))
    return dict(zip(("place_index", "unit_index"), both))


def token_lookup(texts: DataFrame, index: PlaceIndex | DataFrame, collapse: bool, text_col: str = "text") -> DataFrame:
    """J4 (``collapse=True``) / J5 (``collapse=False``) against a stored index
    or the rows of ``index_places``.

    Returns ``(text, place_id)`` for every accepted text: all query tokens
    occur in the place, and exactly one group (J4) / one place (J5) matches.
    Empty queries are never accepted. The representative of a collapsed group
    is its smallest place id.
    """
    index = PassingIndex(index) if isinstance(index, DataFrame) else index
    tk = _analysed(texts.select(F.col(text_col).alias("text")).distinct())
    return tk.join(index.lookup_keys(tk.select("key").distinct(), collapse), "key").select("text", "place_id")


def _analysed(texts: DataFrame) -> DataFrame:
    """Distinct ``texts`` with the canonical form ``key`` of each, without
    empty ones. They are written once: in one plan with the rows that ask,
    Spark pushes the test for empty keys below the aggregate and across the
    joins on the text, and so analyses every row instead of every text."""
    keyed = stage(texts.withColumn("key", token_key("text")), "analysed-texts")
    return keyed.where("text IS NOT NULL AND key <> ''")


def unique_keys(places: DataFrame, keys: list[str], id_col: str = "place_id") -> DataFrame:
    """Places that are the only hit for their key -> ``(keys..., place_id)``."""
    return (
        places.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.col(id_col).cast("string")).alias("place_id"))
        .where(F.col("n") == 1)
        .drop("n")
    )


def exact_lookup(rows: DataFrame, places: DataFrame, row_keys: list[str], place_keys: list[str],
                 id_col: str = "place_id") -> DataFrame:
    """Rows joined to the places unique on the key; adds ``place_id``
    (null when zero or several places share the key)."""
    u = unique_keys(places, place_keys, id_col)
    cond = reduce(lambda a, b: a & b, [rows[r] == u[p] for r, p in zip(row_keys, place_keys)])
    return rows.join(u, cond, "left").drop(*[u[p] for p in place_keys])


# --------------------------------------------------------------------------- pass 01
def mark_pass01(
    df: DataFrame,
    line1: str = "physical_address_1",
    line2: str = "physical_address_2",
    confidential: str = "confidential",
    link: str = "precinct_link",
) -> DataFrame:
    """Pass 01: clear the result columns, 'Not Found' by default,
    'Confidential' rows link to their precinct, homeless tests (F5 on both
    lines, F6 on line 2) set 'Homeless' and override 'Confidential'."""
    conf = equals_flag(confidential)
    homeless = pattern_flag([line1, line2]) | contains_literal(line2)
    cols = {c: F.lit(None).cast("string") for c in PLACE_RESULT_COLUMNS}
    cols["PropertyLatitude"] = F.lit(None).cast("double")
    cols["PropertyLongitude"] = F.lit(None).cast("double")
    cols["results"] = (
        F.when(homeless, F.lit(HOMELESS)).when(conf, F.lit(CONFIDENTIAL)).otherwise(F.lit(NOT_FOUND))
    )
    cols["physical_id"] = F.when(conf, F.col(link))
    return df.withColumns(cols)


# --------------------------------------------------------------------------- cascade
@dataclass(frozen=True)
class Pass:
    """One fall-back lookup. ``kind``: 'group' (J4 on places), 'doc' (J5 on
    the unit table) or 'exact' (J3 on places). ``text`` is the query text
    column (token kinds); ``keys`` are ``(row_col, place_col)`` pairs (exact)."""

    number: float
    kind: str
    text: str | None = None
    keys: tuple[tuple[str, str], ...] = ()


def reference_passes() -> list[Pass]:
    """Passes 02-07 in order (06 and 07 try J4 then J5)."""
    ex = (("physical_house_number", "PropertyAddressHouseNumber"),
          ("physical_street_name", "PropertyAddressStreetName"),
          ("physical_zip_code", "PropertyAddressZIP"))
    return [
        Pass(2.0, "group", "find_address_02"),
        Pass(3.0, "doc", "find_address_02"),
        Pass(4.0, "doc", "find_address_04"),
        Pass(5.0, "exact", keys=ex),
        Pass(6.0, "group", "find_address_06"),
        Pass(6.1, "doc", "find_address_06"),
        Pass(7.0, "group", "find_address_07"),
        Pass(7.1, "doc", "find_address_07"),
    ]


def reference_texts(df: DataFrame) -> DataFrame:
    """C16 query texts of passes 02/03, 04, 06 and 07 (after C12)."""
    t02 = search_text("physical_house_number", "physical_street_pre_direction", "physical_street_name",
                      "physical_zip_code", "physical_unit_number")
    t04 = F.concat_ws(" ", t02, F.coalesce(F.col("physical_unit_type"), F.lit("")))
    t06 = F.concat_ws(" ", t04, F.coalesce(F.col("physical_street_suffix"), F.lit("")))
    t07 = search_text("physical_address_2", "physical_zip_code")
    return df.withColumns({"find_address_02": t02, "find_address_04": t04,
                           "find_address_06": t06, "find_address_07": t07})


def _attr_table(places: DataFrame, source: str, id_col: str) -> DataFrame:
    cols = [F.lit(source).alias("src"), F.col(id_col).cast("string").alias("place_id")]
    for a in PLACE_ATTRS:
        if a in ("PropertyLatitude", "PropertyLongitude"):
            v = F.col(a).cast("string").try_cast("double") if a in places.columns else F.lit(None).cast("double")
        else:
            v = F.col(a).cast("string") if a in places.columns else F.lit(None).cast("string")
        cols.append(v.alias(a))
    return places.select(*cols)


def cascade(
    df: DataFrame,
    row_key: str | list[str],
    passes: list[Pass],
    places: DataFrame,
    units: DataFrame | None = None,
    place_id: str = "place_id",
    group_id: str | None = "group_id",
    results_col: str = "results",
    materialize: bool = True,
    strategy: str = "all",
    pass_col: str | None = None,
    place_index: PlaceIndex | None = None,
    unit_index: PlaceIndex | None = None,
) -> DataFrame:
    """Resolve rows still 'Not Found' through ``passes`` in order.

    ``row_key`` names the column(s) that identify a row (rows that share them
    get the same answer). With
    ``materialize`` the narrow lookup inputs of the unresolved rows (key and
    query texts) are written once to the shared folder, since every pass
    reads them; the full rows are read once more for the final merge.

    ``place_index`` and ``unit_index`` are stored indexes of the two tables,
    reused by all passes and runs; without them the places are analysed for
    this call.

    ``strategy``: ``"all"`` looks up every distinct text of every pass at once
    and gives each unresolved row its first pass that hit (fewer jobs, more
    lookups); ``"chain"`` runs the passes in order, each on the rows the earlier passes
    left unresolved (work shrinks as rows resolve; one staged table per pass).
    Both give the same answer, whatever the size. ``pass_col`` names a column
    to add with the number of the pass that hit (null for the rest).

    A hit copies the place id and its 12 attributes and sets 'Success';
    misses keep 'Not Found' with blank attributes and 0/0 coordinates;
    rows that were not 'Not Found' on entry are left as they are.
    """
    units = units if units is not None else places
    key_cols = [row_key] if isinstance(row_key, str) else list(row_key)
    # the (unique) row key travels as one struct column
    df = df.withColumn("__row", F.struct(*[F.col(f"`{k}`") for k in key_cols]))
    row_key = "__row"
    needed = sorted({p.text for p in passes if p.text} | {r for p in passes for r, _ in p.keys})
    pending = df.where(F.col(results_col) == F.lit(NOT_FOUND)).select(row_key, *needed)
    if materialize:
        # the narrow lookup inputs feed every pass: write them once
        pending = stage(pending, "cascade-pending")
    if strategy not in ("all", "chain"):
        raise ValueError(f"unknown cascade strategy {strategy!r}")
    if place_index is None:
        place_index = PassingIndex(stage(index_places(places, place_id, group_id if group_id else None), "analysed"), kept=strategy == "chain")
    if unit_index is None:
        unit_index = place_index if units is places else PassingIndex(stage(index_places(units, place_id, None), "analysed"), kept=strategy == "chain")
    lookups = {"group": (place_index, True, "places"), "doc": (unit_index, False, "places" if units is places else "units")}
    run = _all_at_once if strategy == "all" else _chain
    best = run(pending, row_key, passes, lookups, places, place_id) if passes else None

    if best is None:
        # nothing was looked up: unresolved rows still get the miss blanks
        miss = F.col(results_col) == F.lit(NOT_FOUND)
        blanks = {c: F.when(miss, F.lit(0.0) if c in ("PropertyLatitude", "PropertyLongitude") else F.lit(""))
                  .otherwise(F.col(c)) for c in PLACE_RESULT_COLUMNS if c != results_col}
        if pass_col:
            blanks[pass_col] = F.lit(None).cast("double")
        return df.drop("__row").withColumns(blanks)
    # a key that the rows repeat gets one answer, so no row is multiplied
    best = best.groupBy("row_key").agg(F.min(F.struct("pass_no", "src", "place_id")).alias("w")).select("row_key", "w.*")
    attrs = _attr_table(places, "places", place_id)
    if units is not places:
        attrs = attrs.unionByName(_attr_table(units, "units", place_id))
    # one row of attributes per place id (the smallest), so a repeated id never multiplies rows
    attrs = attrs.groupBy("src", "place_id").agg(F.min(F.struct(*PLACE_ATTRS)).alias("a")).select("src", "place_id", "a.*")
    resolved = best.join(attrs, ["src", "place_id"]).drop("src")

    r = resolved.alias("r")
    out = df.alias("d").join(r, F.col(f"d.{row_key}") == F.col("r.row_key"), "left")
    hit = F.col("r.row_key").isNotNull()
    miss = F.col(f"d.{results_col}") == F.lit(NOT_FOUND)
    sets: dict[str, Column] = {}
    for c in PLACE_RESULT_COLUMNS:
        if c == results_col:
            v = F.when(hit, F.lit(SUCCESS)).otherwise(F.col(f"d.{c}"))
        elif c == "physical_id":
            v = F.when(hit, F.col("r.place_id")).when(miss, F.lit("")).otherwise(F.col(f"d.{c}"))
        elif c in ("PropertyLatitude", "PropertyLongitude"):
            v = F.when(hit, F.col(f"r.{c}")).when(miss, F.lit(0.0)).otherwise(F.col(f"d.{c}"))
        else:
            v = F.when(hit, F.col(f"r.{c}")).when(miss, F.lit("")).otherwise(F.col(f"d.{c}"))
        sets[c] = v
    keep = [F.col(f"d.`{c}`") if c not in sets else sets[c].alias(c) for c in df.columns if c != "__row"]
    if pass_col:
        keep.append(F.col("r.pass_no").alias(pass_col))
    return out.select(*keep)


# --------------------------------------------------------------------------- post-pass rules
def _answers(pending: DataFrame, passes: list[Pass], lookups: dict) -> DataFrame:
    """(text, group, doc): what each distinct text of the token passes leads
    to by either kind of lookup, written once."""
    wanted = {(p.text, p.kind) for p in passes if p.kind != "exact"}
    texts = reduce(lambda a, b: a.unionByName(b), [
        pending.select(F.col(c).alias("text"), *[F.lit((c, kind) in wanted).alias(f"ask_{kind}") for kind in lookups]).distinct()
        for c in sorted({c for c, _ in wanted})])
    asked = _analysed(texts.groupBy("text").agg(*[F.max(f"ask_{kind}").alias(f"ask_{kind}") for kind in lookups]))
    kinds = [kind for kind in lookups if any(k == kind for _, k in wanted)]

    def hits(kind: str) -> DataFrame:
        index, collapse, _ = lookups[kind]
        return index.lookup_keys(asked.where(f"ask_{kind}").select("key").distinct(), collapse).select("key", F.col("place_id").alias(kind))

    out = asked
    for kind, hit in zip(kinds, together(*[lambda kind=kind: hits(kind) for kind in kinds])):
        # a key shared with a text of other passes answers only who asked
        out = out.join(hit, "key", "left").withColumn(kind, F.when(F.col(f"ask_{kind}"), F.col(kind)))
    out = out.withColumns({kind: F.lit(None).cast("string") for kind in lookups if kind not in kinds})
    return stage(out.select("text", *lookups).where(" OR ".join(f"{kind} IS NOT NULL" for kind in lookups)), "cascade-answers")


def _all_at_once(pending, row_key, passes, lookups, places, place_id) -> DataFrame:
    """(row_key, src, place_id, pass_no): the first pass that hit, by one
    join of the pending rows per text column."""
    rows, value = pending.withColumnRenamed(row_key, "row_key"), {}
    if any(p.kind != "exact" for p in passes):
        answers = _answers(pending, passes, lookups)
        for i, c in enumerate(sorted({p.text for p in passes if p.kind != "exact"})):
            a = answers.select(F.col("text").alias(f"__t{i}"), *[F.col(kind).alias(f"__{kind}{i}") for kind in lookups])
            rows = rows.join(a, F.col(c) == F.col(f"__t{i}"), "left")
            value.update({(c, kind): F.col(f"__{kind}{i}") for kind in lookups})
    for n, p in enumerate(p for p in passes if p.kind == "exact"):
        u = unique_keys(places, [pc for _, pc in p.keys], place_id)
        u = u.select(*[F.col(pc).alias(f"__e{n}_{k}") for k, (_, pc) in enumerate(p.keys)], F.col("place_id").alias(f"__exact{n}"))
        rows = rows.join(u, reduce(lambda a, b: a & b, [F.col(rc) == F.col(f"__e{n}_{k}") for k, (rc, _) in enumerate(p.keys)]), "left")
        value[p] = F.col(f"__exact{n}")
    first = F.coalesce(*[F.when(v.isNotNull(), F.struct(F.lit(src).alias("src"), v.alias("place_id"), F.lit(float(p.number)).alias("pass_no")))
                         for p, v, src in ((p, value[p] if p.kind == "exact" else value[p.text, p.kind], "places" if p.kind == "exact" else lookups[p.kind][2])
                                           for p in sorted(passes, key=lambda x: x.number))])
    return rows.select("row_key", first.alias("w")).where("w IS NOT NULL").select("row_key", "w.src", "w.place_id", "w.pass_no")


def _chain(pending, row_key, passes, lookups, places, place_id) -> DataFrame:
    found: list[DataFrame] = []
    for p in sorted(passes, key=lambda x: x.number):
        if p.kind == "exact":
            u = unique_keys(places, [pc for _, pc in p.keys], place_id)
            answers = u.select(*[F.col(pc).alias(f"__k{i}") for i, (_, pc) in enumerate(p.keys)], F.col("place_id").alias("__hit"))
            src, asked = "places", [rc for rc, _ in p.keys]
        else:
            index, collapse, src = lookups[p.kind]
            answers = stage(token_lookup(pending.select(F.col(p.text).alias("text")), index, collapse), "cascade-answers")
            answers, asked = answers.select(F.col("text").alias("__k0"), F.col("place_id").alias("__hit")), [p.text]
        on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__k{i}") for i, c in enumerate(asked)])
        met = pending.join(answers, on, "left").select(*pending.columns, "__hit")
        met = stage(met, "cascade-met")
        found.append(met.where("__hit IS NOT NULL").select(F.col(row_key).alias("row_key"), F.lit(src).alias("src"), F.col("__hit").alias("place_id"), F.lit(float(p.number)).alias("pass_no")))
        # only rows this pass left unresolved go on to the next pass (rows that share a key and differ in text may
        # both go on and be found; the key's answer is that of its first pass)
        pending = met.where("__hit IS NULL").drop("__hit")
        if pending.isEmpty():
            break
    return reduce(lambda a, b: a.unionByName(b), found)


def post_rules(df: DataFrame) -> DataFrame:
    """R1-R4 in order: address type, numeric coordinates, Not-Found ids from
    the raw address, Homeless literals."""
    nf = F.col("results") == F.lit(NOT_FOUND)
    hl = F.col("results") == F.lit(HOMELESS)
    raw_full = F.concat(F.col("physical_address_1"), F.lit(" "), F.col("physical_address_2"))
    hl_lit = F.lit(HOMELESS)
    address_type = F.when(F.col("physical_unit_type") != F.lit(""), F.lit("apartment")).otherwise(F.lit("residential"))
    return df.withColumns({
        "address_type": F.when(hl, hl_lit).otherwise(address_type),
        "PropertyLatitude": number_or_zero("PropertyLatitude"),
        "PropertyLongitude": number_or_zero("PropertyLongitude"),
        "physical_id": F.when(hl, hl_lit).when(nf, F.concat(F.lit("Not-Found-"), raw_full)).otherwise(F.col("physical_id")),
        "PropertyAddressFull": F.when(hl, hl_lit).when(nf, raw_full).otherwise(F.col("PropertyAddressFull")),
        "PropertyAddressCity": F.when(hl, hl_lit).when(nf, F.col("physical_city")).otherwise(F.col("PropertyAddressCity")),
        "PropertyAddressState": F.when(hl, hl_lit).when(nf, F.col("physical_state")).otherwise(F.col("PropertyAddressState")),
        "PropertyAddressZIP": F.when(hl, hl_lit).when(nf, F.col("physical_zip_code")).otherwise(F.col("PropertyAddressZIP")),
    })
