"""Bindings of the training-data operators to the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import centroids, filter_audit, hmm, jaccard, line_crf, line_dedup, metric_join, mixing, positional, quality_rules, repeats, sharding, wrappers
from .common import Scratch, table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from its lines' marginals."""
    docs = table(spark, sf_dir, "documents")
    return line_crf.score(docs, line_crf.fit(docs, table(spark, sf_dir, "labels")))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards by jump consistent hashing."""
    out = sharding.shard_table(table(spark, sf_dir, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article text of every page, read through its host's wrapper."""
    out = wrappers.extract(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-equal lines that go, by document."""
    out = line_dedup.removed_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    sized = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.words().alias("size"))
    out = mixing.copies(sized)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that occur earlier."""
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of ten benchmark words found in every document."""
    index = Scratch(spark, "op7").write(positional.build_index(table(spark, sf_dir, "documents")), "index")
    found = positional.contaminated_words(index, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hidden Markov and unigram log10 probability of every document."""
    return hmm.score(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and group of every document."""
    return jaccard.link_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, hard rules and the trees' verdict for every document."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit_rules(docs, table(spark, sf_dir, "labels")))


def op11_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and group of every vector within its label."""
    return metric_join.link_vectors(table(spark, sf_dir, "embeddings"), 0.93)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten rounds from eight centroids."""
    assigned, final = centroids.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, seed="3")
    return centroids.report(assigned, final)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each filter removes at every step of all 120 orders, by source."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_BUILDERS: list[Callable[[SparkSession, str], DataFrame]] = [op1_quality_classifier, op2_sharding, op3_html_extraction, op4_line_dedup, op5_mixing, op6_substring_dedup, op7_benchmark_decontamination, op8_lm_scoring, op9_ngram_jaccard, op10_quality_rules, op11_metric_range_join, op12_centroid_clustering, op13_filter_audit]


def _shipped(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    return run


QUERIES = {fn.__name__: _shipped(fn) for fn in _BUILDERS}

# words of a text are compared as strings here, never as hashes
_OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i+9], ' ') AS g
  FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, i, k, array_to_string(w[i:i+k-1], ' ') AS g
  FROM d, lens, LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i) WHERE len(w) >= k),
m AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM m, LATERAL (SELECT unnest(range(i, i + k)) AS p) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

_OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i+19], ' ') AS g
  FROM d, LATERAL (SELECT unnest(range(1, len(w) - 18)) AS i) WHERE len(w) >= 20),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
cut AS (SELECT DISTINCT doc_id, p FROM rep, LATERAL (SELECT unnest(range(i, i + 20)) AS p)),
words AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY p) AS s, count(*) AS n FROM words ANTI JOIN cut USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g
  FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) WHERE len(w) > 0),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM o JOIN c x ON x.doc_id = u JOIN c y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN c USING (doc_id) JOIN (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id) USING (doc_id)
"""

# CRC-32 byte by byte over a table made from its polynomial
_OP2_SQL = r"""
WITH RECURSIVE t AS (
  SELECT i, 0 AS k, i::UBIGINT AS c FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM t WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM t WHERE k = 8),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, CAST(coalesce(octet_length(encode(text)), 0) + 1 AS BIGINT) AS size FROM documents),
e AS (
  SELECT d.*, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
             regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::UBIGINT)),
           lambda a, b: xor(a >> 8, tab[CAST(xor(a, b) % 256 AS INTEGER) + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM d, crc),
j AS (
  SELECT rid, coalesce(doc_id, 0)::UHUGEINT AS key, -1::BIGINT AS b, 0::BIGINT AS j, 0 AS step FROM d
  UNION ALL
  SELECT rid, nk, j, CAST(floor((j + 1) * (2147483648::DOUBLE / ((nk >> 33) + 1)::DOUBLE)) AS BIGINT), step + 1
  FROM (SELECT *, (key * 2862933555777941757::UHUGEINT + 1) % 18446744073709551616::UHUGEINT AS nk FROM j WHERE j < 17)),
s AS (SELECT rid, max(b) FILTER (b < 16) AS shard, max(b) AS grown_shard FROM j GROUP BY rid)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS LAST, text_crc32, size) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard
FROM e JOIN s USING (rid)
"""

_OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
one AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][CAST((place - 1) % 3 + 1 AS INTEGER)] AS weight FROM one),
f AS (
  SELECT *, CAST(coalesce(sum(source_size) OVER b, 0) * 3 AS BIGINT) AS full_size,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS BIGINT) AS open_weight, CAST(sum(source_size) OVER () AS BIGINT) AS whole, row_number() OVER (ORDER BY source_size / weight, place) AS turn
  FROM w WINDOW b AS (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((whole - full_size) / open_weight, turn) AS level FROM f WHERE (whole - full_size) * weight <= source_size * 3 * open_weight),
t AS (
  SELECT source, source_size, least(CAST(source_size * 3 AS DOUBLE), level * weight) AS target FROM f, l),
u AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 16777216 + 0.5) AS BIGINT) ELSE 0 END AS unit,
         CAST('0x' || substr(md5('mix-1' || CASE WHEN source IS NULL THEN '-' ELSE '+' || source END), 1, 6) AS BIGINT) AS shift
  FROM t),
p AS (
  SELECT doc_id, d.source, size, source_size, target, unit,
         CAST(sum(unit) OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS LAST ROWS UNBOUNDED PRECEDING) AS BIGINT) + shift AS upto
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source),
k AS (
  SELECT source, o, abs(sum(((upto + o) // 16777216 - (upto + o - unit) // 16777216) * size) - any_value(target)) AS miss
  FROM p, (SELECT i * 1048576 AS o FROM range(16) r(i)) GROUP BY source, o),
g AS (SELECT source, arg_min(o, (miss, o)) AS o FROM k GROUP BY source)
SELECT doc_id, size, source_size, target, ((upto + o) // 16777216 - (upto + o - unit) // 16777216) * size AS taken
FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source
"""

_OP4_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL),
o AS (
  SELECT * FROM (SELECT doc_id, unnest(a) AS line, unnest(range(len(a))) AS pos FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
n AS (SELECT line, row_number() OVER (ORDER BY line) AS id FROM (SELECT DISTINCT line FROM o)),
s AS (SELECT DISTINCT id, substr(line, i, 8) AS g FROM n, LATERAL (SELECT unnest(range(1, greatest(length(line) - 7, 1) + 1)) AS i)),
c AS (SELECT id, count(*) AS k FROM s GROUP BY id),
r AS (SELECT id, g, row_number() OVER (PARTITION BY id ORDER BY f, g) AS p FROM s JOIN (SELECT g, count(*) AS f FROM s GROUP BY g) USING (g)),
q AS (SELECT id, g FROM r JOIN c USING (id) WHERE p <= k - ceil(0.8 * k) + 1),
x AS (SELECT DISTINCT a.id AS u, b.id AS v FROM q a JOIN q b ON a.g = b.g AND a.id < b.id),
y AS (SELECT u, v, count(*) AS m FROM x JOIN s a ON a.id = u JOIN s b ON b.id = v AND b.g = a.g GROUP BY u, v),
e AS (SELECT u, v FROM y JOIN c a ON a.id = u JOIN c b ON b.id = v WHERE 100 * m >= 80 * (a.k + b.k - m)),
t AS (SELECT id, id AS root FROM n UNION SELECT CASE WHEN e.u = t.id THEN e.v ELSE e.u END, t.root FROM t JOIN e ON e.u = t.id OR e.v = t.id),
w AS (SELECT id, min(root) AS root FROM t GROUP BY id),
z AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY root ORDER BY doc_id NULLS LAST, pos) > 1 AS gone
  FROM o JOIN n USING (line) JOIN w USING (id)),
g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, string_agg(pos, ',' ORDER BY pos) FILTER (gone) AS removed FROM z GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(removed, '') AS removed
FROM documents LEFT JOIN g USING (doc_id)
"""

_OP11_SQL = r"""
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding) AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
p AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.x) = len(b.x) THEN list_cosine_similarity(a.x, b.x) >= 0.93 ELSE false END),
r AS (SELECT vec_id, vec_id AS root FROM embeddings UNION SELECT p.v, r.root FROM r JOIN p ON p.u = r.vec_id),
c AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT u AS vec_id, count(*) AS n_links FROM p GROUP BY u)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""


def _op12_sql(k: int = 8, rounds: int = 10, dims: int = 64, seed: str = "3") -> str:
    """k-means over (vector, component) rows, one stage a round."""
    near = """
n{0} AS (
  SELECT vid, c, d FROM (
    SELECT p.vid, m.c, sum((p.x - m.x) * (p.x - m.x)) AS d, row_number() OVER (PARTITION BY p.vid ORDER BY sum((p.x - m.x) * (p.x - m.x)), m.c) AS r
    FROM p JOIN m{0} m USING (i) GROUP BY p.vid, m.c) WHERE r = 1),"""
    move = """
s{0} AS (SELECT n{0}.c, p.i, sum(p.x) AS t, count(*) AS n FROM n{0} JOIN p USING (vid) GROUP BY n{0}.c, p.i),
m{1} AS MATERIALIZED (
  SELECT m.c, m.i, CASE WHEN s.n IS NULL THEN m.x ELSE CAST((s.t - ((s.t % s.n) + s.n) % s.n) // s.n AS BIGINT) END AS x
  FROM m{0} m LEFT JOIN s{0} s ON s.c = m.c AND s.i = m.i),"""
    stages = "".join(near.format(j).replace("AS (", "AS MATERIALIZED (", 1) + move.format(j, j + 1) for j in range(rounds)) + near.format(rounds)
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS vid, vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS p
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims}),
p AS MATERIALIZED (SELECT vid, unnest(p) AS x, unnest(range({dims})) AS i FROM v),
m0 AS MATERIALIZED (
  SELECT c, unnest(p) AS x, unnest(range({dims})) AS i
  FROM (SELECT p, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, p) - 1 AS c FROM v) WHERE c < {k}),{stages}
f AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM m{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM n{rounds} JOIN v USING (vid) JOIN f USING (c)
"""


_OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CAST(len(w) < 50 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INTEGER)
         + 4 * CAST(100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS INTEGER)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
         + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS INTEGER) AS bits
  FROM d LEFT JOIN g USING (doc_id)),
t AS (SELECT part, bits, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, bits),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS b
  FROM l a, l b, l c, l d, l e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s AS (SELECT filter_order, i AS step, b[i] AS bit, coalesce(list_sum(b[1:i-1]), 0)::INTEGER AS before FROM o, (SELECT unnest(range(1, 6)) AS i)),
x AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN bits & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN bits & bit > 0 AND bits & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN bits & bit > 0 AND bits & before > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN bits = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN bits & bit > 0 AND bits & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN bits & bit > 0 AND bits & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM t, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM x
"""

ORACLES: dict[str, str] = {
    "op2_sharding": _OP2_SQL, "op4_line_dedup": _OP4_SQL, "op5_mixing": _OP5_SQL, "op6_substring_dedup": _OP6_SQL, "op7_benchmark_decontamination": _OP7_SQL,
    "op9_ngram_jaccard": _OP9_SQL, "op11_metric_range_join": _OP11_SQL, "op12_centroid_clustering": _op12_sql(), "op13_filter_audit": _OP13_SQL}
