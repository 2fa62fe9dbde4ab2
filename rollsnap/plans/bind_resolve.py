"""Bindings of the address-resolution and dimension operators
to the driver tables.

``part`` plays the places table (place = part, group = part key div 2;
searched fields = name, brand, size, type); the unit table is the parts of
size <= 25. Rows to resolve are parts (J4/J5) or line items (J3/J6).
The DuckDB oracles answer the lookups by brute force (``list_has_all`` over
all query x place pairs); the Spark side never forms those pairs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..operators import dims, metrics, resolve
from ..operators.place_index import PlaceIndex
from ..session import scratch_path
from .bind_clean import _homeless_sql
from .registry import binding, table


def places_from_part(spark, d, units: bool = False):
    p = table(spark, d, "part")
    if units:
        p = p.where(F.col("p_size") <= 25)
    return p.select(
        F.col("p_partkey").cast("string").alias("place_id"),
        (F.col("p_partkey") / 2).cast("long").cast("string").alias("group_id"),
        F.concat_ws(" ", "p_name", "p_brand").alias("PropertyAddressFull"),
        F.col("p_size").cast("string").alias("PropertyAddressHouseNumber"),
        F.lit("").alias("PropertyAddressStreetDirection"),
        F.col("p_name").alias("PropertyAddressStreetName"),
        F.col("p_type").alias("PropertyAddressStreetSuffix"),
        F.lit("").alias("PropertyAddressCity"),
        F.lit("").alias("PropertyAddressState"),
        F.col("p_brand").alias("PropertyAddressZIP"),
        F.lit("").alias("PropertyAddressZIP4"),
        F.lit("").alias("PropertyAddressCRRT"),
        F.col("p_retailprice").cast("string").alias("PropertyLatitude"),
        (-F.col("p_size")).cast("string").alias("PropertyLongitude"),
    )


def _tok(expr: str) -> str:
    return (
        f"list_distinct(list_filter(regexp_split_to_array(lower({expr}), '[^\\p{{L}}\\p{{N}}_]+'), "
        f"lambda x: x <> ''))"
    )


_PLACE_TOK = _tok("p_name || ' ' || p_brand || ' ' || CAST(p_size AS VARCHAR) || ' ' || p_type")
_PLACES_SQL = f"SELECT p_partkey AS pid, p_partkey // 2 AS grp, p_size, p_name, p_brand, p_retailprice, {_PLACE_TOK} AS pt FROM part"


def _accept_sql(qname: str, tname: str, collapse: bool) -> str:
    gate = "count(DISTINCT t.grp) = 1" if collapse else "count(*) = 1"
    return (
        f"SELECT q.text, min(t.pid) AS pid FROM {qname} q JOIN {tname} t ON list_has_all(t.pt, q.qt) "
        f"WHERE len(q.qt) > 0 GROUP BY q.text HAVING {gate}"
    )


# ---------------------------------------------------------------- J3 / A7
@binding(
    "j3_exact_unique_lookup",
    """
    WITH u AS (SELECT p_brand, p_type, p_size, min(p_partkey) AS pid FROM part
               GROUP BY p_brand, p_type, p_size HAVING count(*) = 1)
    SELECT l.l_orderkey, l.l_linenumber,
           CASE WHEN u.pid IS NULL THEN 'Not Found' ELSE 'Success' END AS results,
           coalesce(CAST(u.pid AS VARCHAR), '') AS physical_id
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    LEFT JOIN u ON u.p_brand = p.p_brand AND u.p_type = p.p_type AND u.p_size = CAST(l.l_quantity AS INTEGER)
    """,
)
def q_j3(spark, d):
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    rows = li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber",
        F.col("p_brand").alias("k_zip"), F.col("p_type").alias("k_street"),
        F.col("l_quantity").cast("int").cast("string").alias("k_house"),
    )
    places = places_from_part(spark, d)
    hit = resolve.exact_lookup(
        rows, places, ["k_house", "k_street", "k_zip"],
        ["PropertyAddressHouseNumber", "PropertyAddressStreetSuffix", "PropertyAddressZIP"],
    )
    return hit.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("place_id").isNull(), F.lit("Not Found")).otherwise(F.lit("Success")).alias("results"),
        F.coalesce(F.col("place_id"), F.lit("")).alias("physical_id"),
    )


# ---------------------------------------------------------------- J4 / J5 / C20
def _token_binding(spark, d, collapse: bool):
    index = resolve.stored_index(places_from_part(spark, d, units=not collapse), group_col="group_id" if collapse else None)
    return _looked_up(spark, d, index, collapse)


def _looked_up(spark, d, index, collapse: bool):
    rows = table(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("text"))
    acc = resolve.token_lookup(rows.select("text"), index, collapse)
    out = rows.join(acc, "text", "left")
    return out.select(
        "p_partkey",
        F.when(F.col("place_id").isNull(), F.lit("Not Found")).otherwise(F.lit("Success")).alias("results"),
        F.coalesce(F.col("place_id"), F.lit("")).alias("physical_id"),
    )


def _token_sql(collapse: bool) -> str:
    where = "" if collapse else "WHERE p_size <= 25"
    return f"""
    WITH pl AS ({_PLACES_SQL} {where}),
    q AS (SELECT DISTINCT p_name || ' ' || p_brand AS text FROM part),
    qt AS (SELECT text, {_tok('text')} AS qt FROM q),
    acc AS ({_accept_sql('qt', 'pl', collapse)})
    SELECT p.p_partkey,
           CASE WHEN acc.pid IS NULL THEN 'Not Found' ELSE 'Success' END AS results,
           coalesce(CAST(acc.pid AS VARCHAR), '') AS physical_id
    FROM part p LEFT JOIN acc ON acc.text = p.p_name || ' ' || p.p_brand
    """


@binding("j4_token_group_lookup", _token_sql(True))
def q_j4(spark, d):
    return _token_binding(spark, d, collapse=True)


@binding("j5_token_unit_lookup", _token_sql(False))
def q_j5(spark, d):
    return _token_binding(spark, d, collapse=False)


@binding("j4_index_update", _token_sql(True))
def q_j4_update(spark, d):
    """The index after three deliveries: first other addresses for a third of
    the places and places that are no longer there, then the right ones for
    half of that third, then the rest and the removals; compacted in between
    and opened anew. It answers as an index of the final places does."""
    places = places_from_part(spark, d)
    key = F.col("place_id").cast("long")
    wrong = places.where(key % 3 == 0).withColumn("PropertyAddressFull", F.reverse("PropertyAddressFull")).withColumn("group_id", F.lit("moved"))
    gone = places.where(key % 5 == 0).withColumn("place_id", F.concat(F.lit("gone-"), "place_id"))
    root = scratch_path(spark, "place-index")
    index = resolve.stored_index(places.where(key % 3 != 0).unionByName(wrong).unionByName(gone), root)
    index.update(resolve.index_places(places.where(key % 6 == 0)))
    index.compact()
    PlaceIndex.open(spark, root).update(resolve.index_places(places.where(key % 3 == 0)), removed=gone.select("place_id"))
    return _looked_up(spark, d, PlaceIndex.open(spark, root), True)


# ---------------------------------------------------------------- J6 + R1-R4
def lineitem_voters(spark, d):
    """Line items as voters living at their part's 'address'."""
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    j = li.join(p, li.l_partkey == p.p_partkey)
    qs = F.col("l_quantity").cast("int").cast("string")
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_linenumber") == 7, F.concat(F.lit("NEAR "), F.col("p_name"))).otherwise(F.col("p_name")).alias("physical_address_1"),
        F.col("p_brand").alias("physical_address_2"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit("Confidential")).otherwise(F.lit("")).alias("confidential"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("precinct_link"),
        F.when(F.col("l_linenumber") == 2, F.lit("APT")).otherwise(F.lit("")).alias("physical_unit_type"),
        F.lit("").alias("physical_city"),
        F.lit("OR").alias("physical_state"),
        F.col("p_brand").alias("physical_zip_code"),
        F.concat_ws(" ", "p_name", "p_brand").alias("text_a"),
        F.concat_ws(" ", F.col("p_name"), qs).alias("text_b"),
        qs.alias("k_house"), F.col("p_name").alias("k_street"), F.col("p_brand").alias("k_zip"),
    )


CASCADE_PASSES = [
    resolve.Pass(2.0, "group", "text_a"),
    resolve.Pass(3.0, "doc", "text_a"),
    resolve.Pass(5.0, "exact", keys=(("k_house", "PropertyAddressHouseNumber"),
                                    ("k_street", "PropertyAddressStreetName"),
                                    ("k_zip", "PropertyAddressZIP"))),
    resolve.Pass(7.0, "group", "text_b"),
    resolve.Pass(7.1, "doc", "text_b"),
]


def _flags_sql(a1: str, a2: str) -> str:
    return f"({_homeless_sql(a1)} OR {_homeless_sql(a2)} OR coalesce(contains({a2}, '{P.SECOND_LINE_LITERAL}'), false))"


_J6_SQL = f"""
WITH pl AS ({_PLACES_SQL}),
un AS (SELECT * FROM pl WHERE p_size <= 25),
v AS (SELECT l.l_orderkey, l.l_linenumber, p.p_name, p.p_brand,
             CASE WHEN l.l_linenumber = 7 THEN 'NEAR ' || p.p_name ELSE p.p_name END AS a1,
             p.p_brand AS a2,
             CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'Confidential' ELSE '' END AS conf,
             l.l_returnflag || '-' || l.l_linestatus AS link,
             CASE WHEN l.l_linenumber = 2 THEN 'APT' ELSE '' END AS unit_type,
             p.p_name || ' ' || p.p_brand AS ta,
             p.p_name || ' ' || CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS tb,
             CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS qs
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
f AS (SELECT *, CASE WHEN {_flags_sql('a1', 'a2')} THEN 'Homeless'
                     WHEN conf = 'Confidential' THEN 'Confidential' ELSE 'Not Found' END AS r01 FROM v),
qa AS (SELECT DISTINCT ta AS text, {_tok('ta')} AS qt FROM f WHERE r01 = 'Not Found'),
qb AS (SELECT DISTINCT tb AS text, {_tok('tb')} AS qt FROM f WHERE r01 = 'Not Found'),
ga AS ({_accept_sql('qa', 'pl', True)}),
da AS ({_accept_sql('qa', 'un', False)}),
gb AS ({_accept_sql('qb', 'pl', True)}),
db AS ({_accept_sql('qb', 'un', False)}),
ex AS (SELECT CAST(p_size AS VARCHAR) AS hn, p_name AS sn, p_brand AS zip, min(pid) AS pid FROM pl
       GROUP BY p_size, p_name, p_brand HAVING count(*) = 1),
h AS (SELECT f.*, CASE WHEN f.r01 = 'Not Found' THEN coalesce(ga.pid, da.pid, ex.pid, gb.pid, db.pid) END AS hit
      FROM f LEFT JOIN ga ON ga.text = f.ta LEFT JOIN da ON da.text = f.ta
             LEFT JOIN ex ON ex.hn = f.qs AND ex.sn = f.p_name AND ex.zip = f.p_brand
             LEFT JOIN gb ON gb.text = f.tb LEFT JOIN db ON db.text = f.tb),
r AS (SELECT h.*, CASE WHEN hit IS NOT NULL THEN 'Success' ELSE r01 END AS results, hp.p_name AS h_name,
             hp.p_brand AS h_brand, hp.p_retailprice AS h_lat
      FROM h LEFT JOIN part hp ON hp.p_partkey = h.hit)
SELECT l_orderkey, l_linenumber, results,
       CASE results WHEN 'Homeless' THEN 'Homeless' WHEN 'Not Found' THEN 'Not-Found-' || a1 || ' ' || a2
                    WHEN 'Success' THEN CAST(hit AS VARCHAR) ELSE link END AS physical_id,
       CASE results WHEN 'Homeless' THEN 'Homeless' WHEN 'Not Found' THEN a1 || ' ' || a2
                    WHEN 'Success' THEN h_name || ' ' || h_brand END AS PropertyAddressFull,
       CASE results WHEN 'Homeless' THEN 'Homeless' WHEN 'Not Found' THEN p_brand
                    WHEN 'Success' THEN h_brand END AS PropertyAddressZIP,
       CASE WHEN results = 'Homeless' THEN 'Homeless' WHEN unit_type <> '' THEN 'apartment' ELSE 'residential' END AS address_type,
       CASE WHEN results = 'Success' THEN h_lat ELSE 0.0 END AS PropertyLatitude
FROM r
"""


@binding("j6_address_cascade", _J6_SQL)
def q_j6(spark, d):
    v = resolve.mark_pass01(lineitem_voters(spark, d))
    places, units = places_from_part(spark, d), places_from_part(spark, d, units=True)
    out = resolve.cascade(v, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], CASCADE_PASSES, places, units,
                          **resolve.stored_indexes(places, units))
    out = resolve.post_rules(out)
    return out.select("l_orderkey", "l_linenumber", "results", "physical_id", "PropertyAddressFull",
                      "PropertyAddressZIP", "address_type", "PropertyLatitude")


@binding("j6_cascade_chain", _J6_SQL)
def q_j6_chain(spark, d):
    v = resolve.mark_pass01(lineitem_voters(spark, d))
    out = resolve.cascade(
        v, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], CASCADE_PASSES, places_from_part(spark, d),
        places_from_part(spark, d, units=True), strategy="chain"
    )
    return resolve.post_rules(out).select("l_orderkey", "l_linenumber", "results", "physical_id", "PropertyAddressFull",
                                          "PropertyAddressZIP", "address_type", "PropertyLatitude")


_PASS_CASE = "CASE WHEN f.r01 = 'Not Found' THEN CASE WHEN ga.pid IS NOT NULL THEN 2.0 WHEN da.pid IS NOT NULL THEN 3.0 " \
    "WHEN ex.pid IS NOT NULL THEN 5.0 WHEN gb.pid IS NOT NULL THEN 7.0 WHEN db.pid IS NOT NULL THEN 7.1 END END"


@binding(
    "a5_per_pass",
    _J6_SQL[:_J6_SQL.index("r AS (SELECT h.*")].replace("h AS (SELECT f.*,", f"h AS (SELECT f.*, {_PASS_CASE} AS pass_no,") + """
    steps AS (SELECT unnest([2.0, 3.0, 5.0, 7.0, 7.1]) AS after)
    SELECT CAST(after AS DOUBLE) AS pass_no, CASE WHEN h.pass_no <= after THEN 'Success' ELSE r01 END AS results, count(*) AS n
    FROM h, steps GROUP BY ALL
    """,
)
def q_a5_per_pass(spark, d):
    v = resolve.mark_pass01(lineitem_voters(spark, d))
    out = resolve.cascade(
        v, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], CASCADE_PASSES, places_from_part(spark, d),
        places_from_part(spark, d, units=True), pass_col="pass_no"
    )
    return metrics.per_pass_frequency(out, [p.number for p in CASCADE_PASSES])


# ---------------------------------------------------------------- J7
def _label_rule(c):
    first = F.substring(c, 1, 1)
    return (
        F.when(first.between("a", "e"), F.lit("male"))
        .when(first.between("f", "j"), F.lit("female"))
        .when(first.between("k", "o"), F.lit("mostly_male"))
        .when(first.between("p", "s"), F.lit("mostly_female"))
        .when(first.between("t", "v"), F.lit("andy"))
    )


@binding(
    "j7_name_label_lookup",
    """
    WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS name FROM part),
    names AS (SELECT name, CASE WHEN substr(name, 1, 1) BETWEEN 'a' AND 'e' THEN 'male'
                                WHEN substr(name, 1, 1) BETWEEN 'f' AND 'j' THEN 'female'
                                WHEN substr(name, 1, 1) BETWEEN 'k' AND 'o' THEN 'mostly_male'
                                WHEN substr(name, 1, 1) BETWEEN 'p' AND 's' THEN 'mostly_female'
                                WHEN substr(name, 1, 1) BETWEEN 't' AND 'v' THEN 'andy' END AS label FROM w),
    nm AS (SELECT lower(name) AS n, min(label) AS label FROM names WHERE label IS NOT NULL GROUP BY lower(name)),
    ppl AS (SELECT p_partkey,
                   CASE WHEN p_partkey % 2 = 0 THEN upper(split_part(p_name, ' ', 1)) ELSE split_part(p_name, ' ', 1) END AS fst,
                   split_part(p_name, ' ', 2) AS mid FROM part),
    g AS (SELECT p_partkey, coalesce(a.label, 'unknown') AS g1, coalesce(b.label, 'unknown') AS g2
          FROM ppl LEFT JOIN nm a ON lower(fst) = a.n LEFT JOIN nm b ON lower(mid) = b.n),
    g2 AS (SELECT p_partkey, CASE WHEN g1 IN ('unknown', 'andy') THEN g2 ELSE g1 END AS x FROM g)
    SELECT p_partkey,
           CASE WHEN x IN ('unknown', 'andy') THEN 'unknown' WHEN x = 'mostly_male' THEN 'male'
                WHEN x = 'mostly_female' THEN 'female' ELSE x END AS gender
    FROM g2
    """,
)
def q_j7(spark, d):
    p = table(spark, d, "part")
    names = (
        p.select(F.explode(F.split("p_name", " ")).alias("name")).distinct()
        .withColumn("label", _label_rule(F.col("name")))
        .where(F.col("label").isNotNull())
    )
    w = F.split("p_name", " ")
    people = p.select(
        "p_partkey",
        F.when(F.col("p_partkey") % 2 == 0, F.upper(w.getItem(0))).otherwise(w.getItem(0)).alias("name_first"),
        w.getItem(1).alias("name_middle"),
    )
    return dims.guess_gender(people, names).select("p_partkey", "gender")


# ---------------------------------------------------------------- J8
@binding(
    "j8_history_hit_count",
    """
    SELECT c.c_custkey, coalesce(o.n, 0) AS hits
    FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) o
      ON c.c_custkey = o.o_custkey
    """,
)
def q_j8(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    return dims.hit_count(c, table(spark, d, "orders"), "c_custkey", "o_custkey")
