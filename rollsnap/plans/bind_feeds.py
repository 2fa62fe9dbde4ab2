"""Bindings of the voter and precinct feeds.

The raw roll is derived from the driver tables: one row per order, the voter
is the order's customer, the home 'address' comes from the part sharing the
customer's key. Raw columns are written once as SQL expressions that both
Spark and DuckDB evaluate, so fixture and oracle cannot drift apart.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contracts as C
from ..operators import resolve
from ..session import scratch_path
from ..sources import sinks
from . import feeds
from ..functions import predicates as P
from .bind_clean import _homeless_sql
from .bind_resolve import _PLACES_SQL, _accept_sql, _tok, places_from_part
from .registry import binding, table

FILE_DATE = "2024-06-30"
AS_OF_YEAR = 2024

# raw header -> expression over o (orders), c (customer), n (nation), p (part)
RAW_ROLL = [
    ("VOTER_ID", "CASE WHEN c.c_mktsegment = 'AUTOMOBILE' AND o.o_orderpriority = '1-URGENT' THEN 'ACP' "
                 "ELSE CAST(o.o_custkey AS STRING) END"),
    ("FIRST_NAME", "split_part(p.p_name, ' ', 1)"),
    ("LAST_NAME", "c.c_name"),
    ("MIDDLE_NAME", "split_part(p.p_name, ' ', 2)"),
    ("BIRTH_DATE", "CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN '19XX' ELSE CAST(1840 + c.c_custkey % 170 AS STRING) END"),
    ("PARTY_CODE", "substring(o.o_orderpriority, 1, 1)"),
    ("EFF_REGN_DATE", None),
    ("STATUS", "CASE WHEN o.o_orderstatus = 'P' THEN 'I' ELSE 'A' END"),
    ("CONFIDENTIAL", "CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'confidential' ELSE '' END"),
    ("RES_ADDRESS_1", "CAST(o.o_orderkey AS STRING) || ' ' || p.p_name"),
    ("RES_ADDRESS_2", "p.p_brand"),
    ("CITY", "n.n_name"),
    ("STATE", "'OR'"),
    ("ZIP_CODE", "p.p_brand"),
    ("HOUSE_NUM", "CAST(p.p_size AS STRING)"),
    ("HOUSE_SUFFIX", "''"),
    ("PRE_DIRECTION", "''"),
    ("STREET_NAME", "p.p_name"),
    ("STREET_TYPE", "p.p_type"),
    ("POST_DIRECTION", "''"),
    ("UNIT_TYPE", "CASE WHEN c.c_mktsegment = 'FURNITURE' THEN 'APT' ELSE '' END"),
    ("UNIT_NUM", "''"),
    ("COUNTY", "n.n_name"),
    ("PRECINCT", "NULLIF(o.o_orderpriority, '5-LOW')"),
    ("SPLIT", "o.o_orderstatus"),
    ("EFF_ADDRESS_1", "CAST(c.c_custkey AS STRING) || ' PO BOX'"),
    ("EFF_ADDRESS_2", "''"),
    ("EFF_ADDRESS_3", "CAST(NULL AS STRING)"),
    ("EFF_ADDRESS_4", "CAST(NULL AS STRING)"),
    ("EFF_CITY", "n.n_name"),
    ("EFF_STATE", "'OR'"),
    ("EFF_ZIP_CODE", "CAST(c.c_nationkey AS STRING)"),
]
_REG_SPARK = ("CASE WHEN o.o_orderpriority = '1-URGENT' THEN date_format(o.o_orderdate, 'MM/dd/yyyy') "
              "WHEN o.o_orderpriority = '2-HIGH' THEN date_format(o.o_orderdate, 'M-d-yyyy') "
              "ELSE date_format(o.o_orderdate, 'MM-dd-yyyy') END")
_REG_DUCK = ("CASE WHEN o.o_orderpriority = '1-URGENT' THEN strftime(o.o_orderdate, '%m/%d/%Y') "
             "WHEN o.o_orderpriority = '2-HIGH' THEN strftime(o.o_orderdate, '%-m-%-d-%Y') "
             "ELSE strftime(o.o_orderdate, '%m-%d-%Y') END")
_ROLL_FROM = ("orders o JOIN customer c ON o.o_custkey = c.c_custkey "
              "JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN part p ON p.p_partkey = c.c_custkey")


def raw_roll(spark, d):
    """The raw voter roll (all text, source headers)."""
    o = table(spark, d, "orders").alias("o")
    c = table(spark, d, "customer").alias("c")
    n = table(spark, d, "nation").alias("n")
    p = table(spark, d, "part").alias("p")
    j = (
        o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey"))
        .join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey"))
        .join(p, F.col("p.p_partkey") == F.col("c.c_custkey"), "left")
    )
    return j.select(*[F.expr(e or _REG_SPARK).alias(h) for h, e in RAW_ROLL])


def _raw_roll_sql() -> str:
    cols = ",\n      ".join(f"{e or _REG_DUCK} AS {h}" for h, e in RAW_ROLL)
    return f"SELECT {cols}\n    FROM {_ROLL_FROM}"


def _clean_sql() -> str:
    src = {t: a[0] for t, a in C.VOTERS_CONTRACT.items()}
    out = []
    for t, h in src.items():
        if t == "registration_date":
            out.append("reg AS registration_date")
        elif t == "birthdate":
            out.append("byr AS birthdate")
        else:
            out.append(f"coalesce({h}, '') AS {t}")
    out.append("CAST(2024 - byr AS INTEGER) AS age")
    out.append("coalesce(COUNTY || '-' || PRECINCT || '-' || SPLIT, '') AS precinct_link")
    cols = ",\n           ".join(out)
    return f"""
    WITH raw AS ({_raw_roll_sql()}),
    f AS (SELECT * FROM raw WHERE VOTER_ID IS DISTINCT FROM 'ACP' AND STATUS IN ('A') AND PRECINCT IS NOT NULL),
    p AS (SELECT *, CAST(try_strptime(EFF_REGN_DATE, '%m-%d-%Y') AS DATE) AS reg FROM f),
    l AS (SELECT * FROM p QUALIFY row_number() OVER (
            PARTITION BY VOTER_ID ORDER BY reg DESC NULLS FIRST, RES_ADDRESS_1 ASC NULLS FIRST) = 1),
    b AS (SELECT *, CAST(CASE WHEN CONFIDENTIAL = 'confidential' OR contains(BIRTH_DATE, 'X') THEN 1850
                              ELSE greatest(coalesce(try_cast(BIRTH_DATE AS INTEGER), 1850), 1850) END AS INTEGER) AS byr
          FROM l)
    SELECT {cols}
    FROM b
    """


def clean_roll(spark, d):
    return feeds.voters_clean(raw_roll(spark, d), FILE_DATE, AS_OF_YEAR, tie_breakers=["physical_address_1"])


@binding("e1_voters_clean", _clean_sql())
def q_e1(spark, d):
    return clean_roll(spark, d)


# ---------------------------------------------------------------- E2 / E3 / J7 names
def name_labels(spark, d):
    """Caller-supplied names dimension, derived from the words of part names."""
    first = F.substring("name", 1, 1)
    label = (
        F.when(first.between("a", "e"), F.lit("male"))
        .when(first.between("f", "j"), F.lit("female"))
        .when(first.between("k", "o"), F.lit("mostly_male"))
        .when(first.between("p", "s"), F.lit("mostly_female"))
        .when(first.between("t", "v"), F.lit("andy"))
    )
    words = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("name")).distinct()
    return words.withColumn("label", label).where(F.col("label").isNotNull())


def resolved_roll(spark, d):
    # E1 hands over through its processed layer (K1 -> S6), as the feeds do;
    # the cascade then reads files instead of recomputing the clean step
    clean = sinks.write_layer(clean_roll(spark, d), scratch_path(spark, "processed-voters"))
    places, units = places_from_part(spark, d), places_from_part(spark, d, units=True)
    return feeds.voters_resolve(
        clean, places, units, name_labels(spark, d), FILE_DATE, "OR", resolve.reference_passes(),
        **resolve.stored_indexes(places, units),
    )


def _label_sql(w: str) -> str:
    return (f"CASE WHEN substr({w}, 1, 1) BETWEEN 'a' AND 'e' THEN 'male' "
            f"WHEN substr({w}, 1, 1) BETWEEN 'f' AND 'j' THEN 'female' "
            f"WHEN substr({w}, 1, 1) BETWEEN 'k' AND 'o' THEN 'mostly_male' "
            f"WHEN substr({w}, 1, 1) BETWEEN 'p' AND 's' THEN 'mostly_female' "
            f"WHEN substr({w}, 1, 1) BETWEEN 't' AND 'v' THEN 'andy' END")


def _resolve_sql() -> str:
    """Brute-force E2: every pass's lookup answered by ``list_has_all`` over
    all (distinct query, place) pairs, first hit in pass order."""
    homeless = (f"({_homeless_sql('physical_address_1')} OR {_homeless_sql('physical_address_2')} "
                f"OR coalesce(contains(physical_address_2, '{P.SECOND_LINE_LITERAL}'), false))")
    texts = {
        "t02": "physical_house_number || ' ' || physical_street_pre_direction || ' ' || physical_street_name"
               " || ' ' || physical_zip_code || ' ' || physical_unit_number",
    }
    texts["t04"] = f"({texts['t02']}) || ' ' || physical_unit_type"
    texts["t06"] = f"({texts['t04']}) || ' ' || physical_street_suffix"
    texts["t07"] = "physical_address_2 || ' ' || physical_zip_code"
    qs = ",\n    ".join(
        f"q{n} AS (SELECT DISTINCT {n} AS text, {_tok(n)} AS qt FROM v WHERE r01 = 'Not Found')" for n in texts)
    group = ["t02", "t06", "t07"]
    doc = ["t02", "t04", "t06", "t07"]
    acc = ",\n    ".join(
        [f"g{n} AS ({_accept_sql('q' + n, 'pl', True)})" for n in group]
        + [f"d{n} AS ({_accept_sql('q' + n, 'un', False)})" for n in doc])
    order = ["gt02.pid", "dt02.pid", "dt04.pid", "ex.pid", "gt06.pid", "dt06.pid", "gt07.pid", "dt07.pid"]
    joins = " ".join(
        [f"LEFT JOIN g{n} ON g{n}.text = v.{n}" for n in group]
        + [f"LEFT JOIN d{n} ON d{n}.text = v.{n}" for n in doc])
    cols = {c: c for c in C.VOTERS_FINAL_COLUMNS}
    nf, hl, ok = "results = 'Not Found'", "results = 'Homeless'", "results = 'Success'"
    raw_full = "physical_address_1 || ' ' || physical_address_2"
    cols.update({
        "file_date": f"DATE '{FILE_DATE}' AS file_date",
        "state": "'or' AS state",
        "birthdate": "CASE WHEN length(CAST(birthdate AS VARCHAR)) = 4 THEN CAST(birthdate AS VARCHAR) || '-01-01' "
                     "ELSE CAST(birthdate AS VARCHAR) END AS birthdate",
        "gender": "gender",
        "physical_id": f"CASE WHEN {hl} THEN 'Homeless' WHEN {nf} THEN 'Not-Found-' || {raw_full} "
                       f"WHEN {ok} THEN CAST(hit AS VARCHAR) WHEN results = 'Confidential' THEN precinct_link END AS physical_id",
        "PropertyAddressFull": f"CASE WHEN {hl} THEN 'Homeless' WHEN {nf} THEN {raw_full} "
                               f"WHEN {ok} THEN h_name || ' ' || h_brand END AS PropertyAddressFull",
        "PropertyAddressHouseNumber": f"CASE WHEN {nf} THEN '' WHEN {ok} THEN CAST(h_size AS VARCHAR) END AS PropertyAddressHouseNumber",
        "PropertyAddressStreetDirection": f"CASE WHEN {nf} OR {ok} THEN '' END AS PropertyAddressStreetDirection",
        "PropertyAddressStreetName": f"CASE WHEN {nf} THEN '' WHEN {ok} THEN h_name END AS PropertyAddressStreetName",
        "PropertyAddressStreetSuffix": f"CASE WHEN {nf} THEN '' WHEN {ok} THEN h_type END AS PropertyAddressStreetSuffix",
        "PropertyAddressCity": f"CASE WHEN {hl} THEN 'Homeless' WHEN {nf} THEN physical_city WHEN {ok} THEN '' END AS PropertyAddressCity",
        "PropertyAddressState": f"CASE WHEN {hl} THEN 'Homeless' WHEN {nf} THEN physical_state WHEN {ok} THEN '' END AS PropertyAddressState",
        "PropertyAddressZIP": f"CASE WHEN {hl} THEN 'Homeless' WHEN {nf} THEN physical_zip_code WHEN {ok} THEN h_brand END AS PropertyAddressZIP",
        "PropertyAddressZIP4": f"CASE WHEN {nf} OR {ok} THEN '' END AS PropertyAddressZIP4",
        "PropertyAddressCRRT": f"CASE WHEN {nf} OR {ok} THEN '' END AS PropertyAddressCRRT",
        "PropertyLatitude": f"CASE WHEN {ok} THEN h_lat ELSE 0.0 END AS PropertyLatitude",
        "PropertyLongitude": f"CASE WHEN {ok} THEN CAST(-h_size AS DOUBLE) ELSE 0.0 END AS PropertyLongitude",
        "address_type": f"CASE WHEN {hl} THEN 'Homeless' WHEN physical_unit_type <> '' THEN 'apartment' "
                        f"ELSE 'residential' END AS address_type",
        "results": "results",
        "mail_id": "mail_address_1 || ' ' || mail_zip_code AS mail_id",
    })
    select = ",\n      ".join(cols[c] for c in C.VOTERS_FINAL_COLUMNS)
    return f"""
    WITH clean AS ({_clean_sql()}),
    pl AS ({_PLACES_SQL}),
    un AS (SELECT * FROM pl WHERE p_size <= 25),
    v AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in texts.items())},
                 CASE WHEN {homeless} THEN 'Homeless' WHEN confidential = 'Confidential' THEN 'Confidential'
                      ELSE 'Not Found' END AS r01
          FROM clean),
    {qs},
    {acc},
    ex AS (SELECT CAST(p_size AS VARCHAR) AS hn, p_name AS sn, p_brand AS zip, min(pid) AS pid FROM pl
           GROUP BY p_size, p_name, p_brand HAVING count(*) = 1),
    h AS (SELECT v.*, CASE WHEN v.r01 = 'Not Found' THEN coalesce({', '.join(order)}) END AS hit
          FROM v {joins}
          LEFT JOIN ex ON ex.hn = v.physical_house_number AND ex.sn = v.physical_street_name
                      AND ex.zip = v.physical_zip_code),
    nm AS (SELECT lower(w) AS n, min({_label_sql('w')}) AS label
           FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS w FROM part)
           WHERE {_label_sql('w')} IS NOT NULL GROUP BY lower(w)),
    r AS (SELECT h.*, CASE WHEN hit IS NOT NULL THEN 'Success' ELSE r01 END AS results,
                 hp.p_name AS h_name, hp.p_brand AS h_brand, hp.p_type AS h_type, hp.p_size AS h_size,
                 hp.p_retailprice AS h_lat,
                 coalesce(a.label, 'unknown') AS g1, coalesce(b.label, 'unknown') AS g2
          FROM h LEFT JOIN part hp ON hp.p_partkey = h.hit
                 LEFT JOIN nm a ON lower(h.name_first) = a.n LEFT JOIN nm b ON lower(h.name_middle) = b.n),
    g AS (SELECT r.*, CASE WHEN g1 IN ('unknown', 'andy') THEN g2 ELSE g1 END AS gx FROM r),
    out AS (SELECT g.*, CASE WHEN gx IN ('unknown', 'andy') THEN 'unknown' WHEN gx = 'mostly_male' THEN 'male'
                             WHEN gx = 'mostly_female' THEN 'female' ELSE gx END AS gender FROM g)
    SELECT {select}
    FROM out
    """


_RESOLVE_SQL = _resolve_sql()


@binding("e2_voters_resolve", _RESOLVE_SQL)
def q_e2(spark, d):
    return resolved_roll(spark, d).select(*C.VOTERS_FINAL_COLUMNS)


def _publish_sql() -> str:
    cols = []
    for c in C.VOTERS_FINAL_COLUMNS:
        kind, _ = C.VOTERS_TYPES[c]
        if c == "registration_date":
            cols.append(f"coalesce(registration_date, DATE '{FILE_DATE}') AS registration_date")
        elif c == "birthdate":
            cols.append("CAST(birthdate AS DATE) AS birthdate")
        elif kind == "string":
            cols.append(f"coalesce({c}, '') AS {c}")
        else:
            cols.append(c)
    return f"SELECT {', '.join(cols)} FROM ({_RESOLVE_SQL})"


@binding("e3_voters_publish", _publish_sql())
def q_e3(spark, d):
    good, _rejects = feeds.voters_publish(resolved_roll(spark, d), None, FILE_DATE)
    return good


# ---------------------------------------------------------------- E8
RAW_PRECINCTS = [
    ("COUNTY", "n.n_name"),
    ("DISTRICT_TYPE", "r.r_name"),
    ("DISTRICT_NAME", "c.c_mktsegment"),
    ("PRECINCT", "CAST(c.c_nationkey AS STRING)"),
    ("PRECINCT_CODE", "'decoy'"),
    ("PRECINCT_NAME", "n.n_name || ' P'"),
    ("SPLIT", "CASE WHEN c.c_mktsegment = 'MACHINERY' THEN NULL ELSE substring(c.c_mktsegment, 1, 2) END"),
]
_PRECINCT_FROM = ("customer c JOIN nation n ON c.c_nationkey = n.n_nationkey "
                  "JOIN region r ON n.n_regionkey = r.r_regionkey")


def raw_precincts(spark, d):
    c = table(spark, d, "customer").alias("c")
    n = table(spark, d, "nation").alias("n")
    r = table(spark, d, "region").alias("r")
    j = c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey")).join(r, F.col("n.n_regionkey") == F.col("r.r_regionkey"))
    return j.select(*[F.expr(e).alias(h) for h, e in RAW_PRECINCTS])


@binding(
    "e8_precincts",
    f"""
    WITH raw AS (SELECT DISTINCT {', '.join(f'{e} AS {h}' for h, e in RAW_PRECINCTS)} FROM {_PRECINCT_FROM})
    SELECT DATE '{FILE_DATE}' AS file_date, 'or' AS state,
           COUNTY AS district_county, DISTRICT_TYPE AS district_type, DISTRICT_NAME AS district_name,
           COUNTY || '-' || DISTRICT_TYPE || '-' || DISTRICT_NAME AS district_link,
           PRECINCT_NAME AS precinct_name, PRECINCT AS precinct_number, SPLIT AS precinct_split,
           COUNTY || '-' || PRECINCT || '-' || SPLIT AS precinct_link
    FROM raw
    """,
)
def q_e8(spark, d):
    return feeds.precincts(raw_precincts(spark, d), FILE_DATE, "OR")
