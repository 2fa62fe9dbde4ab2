"""Line dedup: near-equal lines by MinHash over character shingles, with
DataFrame functions only.

A line's shingle hashes are sorted once; the hash range is cut into as many
regions as there are bands, and the few smallest hashes of each region are the
band's signature (one permutation, several minima); a region without hashes
has none. Lines of few shingles, whose regions would be near empty, meet
exactly instead: by the rarest of their shingles, as many as two lines at 0.8
cannot all differ in. Lines that share a band or one of those shingles
are compared exactly: Jaccard similarity of their sets of shingles of 0.8 or
more links them, and union-find over the links keeps one line a component.

Each line of a shared bucket is first compared with one leader of its
buckets, in a few rounds with other leaders; lines that are connected by then
need no comparison any more, and every remaining pair of a bucket whose sets
are near enough in size is compared at the end. So a large group costs about
one comparison a line and round, and no candidate pair between different
groups is left out. At the end the lines of a bucket carry 16 bits of every
shingle: the common ones bound the overlap from above, so a pair that cannot
be similar never leaves the bucket, and only the few others are compared by
their texts. A pair that meets in several buckets is looked at in the first
of them only.

A line is named by the 64-bit hash of its text; equal lines are one line from
the start. Shingles are of code points.

Defined cases: lines without words are never removed and not counted; a null
or empty text has no lines; a line shorter than a shingle is one shingle; the
first of equal or near lines by (doc_id, null last, then line number) stays;
rows that repeat a doc_id are ordered among themselves arbitrarily; an empty
table gives no rows; extra columns are ignored (or carried by
``drop_repeated``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, boxed
from .graph import components

#: code points of a shingle
SHINGLE = 8
#: bands, and minima of each; a pair at similarity 0.8 shares a band with
#: probability 1 - (1 - 0.8^4)^12 = 0.998, one at 0.85 with 0.9999
BANDS, MINIMA = 12, 4
#: lines of fewer shingles have no bands but their rarest shingles; those of
#: up to BOTH have both, as a line below FEW can be like one of 5/4 its size
FEW = BANDS * MINIMA
BOTH = FEW * 5 // 4
#: turns in which the keys are dealt
TURNS = 3
#: rounds of comparison with leaders before all remaining pairs
ROUNDS = 3


def shingles(line: str | Column, size: int = SHINGLE) -> Column:
    """Hashes of the distinct shingles of a line."""
    # the outer transform binds the encoded line: a lambda would encode it anew for every shingle
    return F.array_distinct(F.transform(F.array(F.encode(line, "UTF-32")), lambda raw: F.transform(
        F.sequence(F.lit(1), F.greatest(F.octet_length(raw) - 4 * size + 1, F.lit(1)), F.lit(4)),
        lambda i: F.xxhash64(F.substring(raw, i, F.lit(4 * size)))))[0])


def with_bands(lines: DataFrame, bands: int = BANDS, minima: int = MINIMA) -> DataFrame:
    """``line`` gives way to ``n`` (distinct shingles), ``bands``: one key per
    band from the smallest hashes of its region, where it has any and the line
    is not of few shingles, and ``short``: the line if it has at most BOTH.
    The regions' lower ends are sorted in among the hashes to find where each
    begins. (Each step is a projection of its own, outside of lambdas, so that
    it is compiled; the places are columns, as items of an array made on the
    spot would be looked for anew wherever they are used.)"""
    ends = [F.lit(-(1 << 63) + i * ((1 << 64) // bands)).cast("long") for i in range(bands)]
    hashed = lines.withColumn("hashes", shingles("line")).withColumn("n", F.size("hashes"))
    hashed = hashed.withColumn("short", F.when(F.col("n") <= BOTH, F.col("line"))).drop("line")
    ordered = hashed.withColumn("hashes", F.when(F.col("n") >= FEW, F.sort_array(F.concat("hashes", F.array(*ends)))))
    places = {f"at{i}": F.array_position("hashes", e).cast("int") for i, e in enumerate(ends)} | {f"at{bands}": F.size("hashes") + 1}
    placed = ordered.withColumns(places)
    keys = []
    for i in range(bands):
        held = F.col(f"at{i + 1}") - F.col(f"at{i}") - 1
        keys.append(F.when(held > 0, F.xxhash64(F.lit(i), F.slice("hashes", F.col(f"at{i}") + 1, F.least(held, F.lit(minima))))))
    return placed.withColumn("bands", F.when(F.col("n") >= FEW, F.array_compact(F.array(*keys)))).drop("hashes", *places)


def rare_keys(lines: DataFrame) -> DataFrame:
    """h, n, band of lines of few shingles (h distinct, n, short): one key for
    each of their first shingles in a rare-first order. Two sets of similarity
    0.8 or more always share one of these."""
    each = lines.select("h", "n", F.explode(shingles("short")).alias("s"))
    # a shingle of one line is the rarest and joins nothing: it need not meet its count
    often = each.groupBy("s").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    first = F.col("n") - F.floor((4 * F.col("n") + 4) / 5).cast("int") + 1
    met = each.join(often, "s").groupBy("h", "n").agg(F.array_sort(F.collect_list(F.struct("f", "s"))).alias("met"))
    # the n - size(met) shingles of this line alone come before
    kept = met.withColumn("left", first - (F.col("n") - F.size("met"))).where("left > 0")
    return kept.select("h", "n", F.explode(F.slice("met", F.lit(1), F.col("left"))).alias("m")).select("h", "n", F.xxhash64(F.lit(-1), "m.s").alias("band"))


def shared_keys(entries: DataFrame) -> DataFrame:
    """(band, h, n) of the lines that share a band or shingle with a line near
    enough in size; by size, the nearest such line is a neighbour."""
    place = Window.partitionBy("band").orderBy("n", "h")
    near = entries.withColumn("below", F.lag("n").over(place)).withColumn("above", F.lead("n").over(place))
    return near.where("5 * below >= 4 * n OR 5 * n >= 4 * above").select("band", "h", "n")


def _lines(docs: DataFrame) -> DataFrame:
    """rid, doc_id, pos, line, h of every line with a word."""
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("rid", F.monotonically_increasing_id())
    lines = numbered.select("rid", "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return lines.withColumn("h", F.xxhash64("line"))


def _alike(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of (u, v) pairs those with a similarity of 0.8 or more, exactly."""
    left = texts.select(F.col("h").alias("u"), F.col("line").alias("lu"))
    right = texts.select(F.col("h").alias("v"), F.col("line").alias("lv"))
    both = pairs.join(left, "u").join(right, "v").select("u", "v", shingles("lu").alias("a"), shingles("lv").alias("b"))
    both = both.select("u", "v", F.size(F.array_intersect("a", "b")).alias("shared"), (F.size("a") + F.size("b")).alias("sizes"))
    return both.where("100 * shared >= 80 * (sizes - shared)").select("u", "v")


def short_set(line: str | Column) -> Column:
    """The distinct upper 16 bits of a line's shingle hashes."""
    return F.array_distinct(F.transform(shingles(line), lambda s: F.shiftright(s, 48).cast("short")))


def _open_pairs(held: DataFrame, sets: DataFrame) -> DataFrame:
    """(x, y) of a bucket in different components (held: band, h, n, c), each
    in the first bucket that holds both, that can have a similarity of 0.8 by their short sets (h, few). Two sets share
    at most as many shingles as short ones, and those that fell together in
    the set where fewer did; the bound is part of the join, so the pairs that
    it rules out are never rows."""
    met = held.groupBy("h").agg(F.collect_list("band").alias("met"))
    each = held.join(met, "h").join(sets, "h")
    cols = ("band", "h", "n", "c", "few", "met")        # all renamed on both sides, so that both read one exchange
    left, right = (each.select(*[F.col(c).alias(f"{c}_{side}") for c in cols]) for side in ("x", "y"))
    near = F.expr("h_x < h_y AND c_x <> c_y AND 5 * least(n_x, n_y) >= 4 * greatest(n_x, n_y)")
    once = F.expr("band_x = array_min(array_intersect(met_x, met_y))")
    most = F.expr("size(array_intersect(few_x, few_y)) + least(n_x - size(few_x), n_y - size(few_y))")
    pairs = left.join(right, (F.col("band_x") == F.col("band_y")) & near & once & (9 * most >= F.expr("4 * (n_x + n_y)")))
    return pairs.select(F.col("h_x").alias("x"), F.col("h_y").alias("y"))


def line_components(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(occurrences, components): rid, doc_id, pos, h of every line with a
    word; and (node, root) of every distinct line with a link."""
    lines = scratch.write(_lines(docs).drop("line"), "lines")
    # equal lines are one line before they are hashed; the texts are dealt once, into buckets of the line
    every = scratch.bucketed(_lines(docs).select("h", "line").dropDuplicates(["h"]), "every", "h", dealt=True)
    scratch.clear(*scratch.paths)
    signed = scratch.write(with_bands(every), "signed")
    rare = scratch.write(rare_keys(signed.where("short IS NOT NULL").select("h", "n", "short")), "rare")
    scratch.clear(*scratch.paths)
    entries = signed.where("bands IS NOT NULL").select("h", "n", F.explode("bands").alias("band")).unionAll(rare)
    buckets, kept = None, ["lines", "every", "signed", "rare"]
    for k in range(TURNS):      # one turn's keys are dealt after the other's have gone
        part = scratch.write(shared_keys(entries.where(F.expr(f"pmod(band, {TURNS})") == k)), f"buckets{k}")
        buckets = part if buckets is None else buckets.unionAll(part)
        kept.append(f"buckets{k}")
        scratch.clear(*kept)
    buckets = scratch.write(buckets, "buckets")
    scratch.clear("lines", "every", "buckets")

    texts = scratch.bucketed(every.join(buckets.select("h").distinct(), "h", "left_semi"), "texts", "h", dealt=True)
    scratch.clear("lines", "texts", "buckets")

    comp, seen, held = None, None, buckets.withColumn("c", F.col("h"))
    for k in range(ROUNDS + 1):
        if k < ROUNDS:
            turn = Window.partitionBy("band").orderBy(F.xxhash64(F.lit(k), "h"))
            asked = held.withColumn("lead", F.first(F.struct("h", "c", "n")).over(turn)).where("lead.c <> c").withColumn("m", F.col("lead.n")).where("5 * least(n, m) >= 4 * greatest(n, m)")
            pairs = asked.groupBy(F.col("h").alias("y")).agg(F.min_by("lead.h", F.xxhash64(F.lit(k), "lead.h")).alias("x"))
        else:
            scratch.clear(*scratch.paths)       # the rounds' shuffles are not read again
            pairs = _open_pairs(held, scratch.write(texts.join(held.select("h").distinct(), "h", "left_semi").select("h", short_set("line").alias("few")), "sets"))
        pairs = pairs.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()
        if seen is not None:        # never compare twice
            pairs = pairs.join(seen, ["u", "v"], "left_anti")
        pairs = scratch.write(pairs, f"pairs{k}")
        seen = pairs if seen is None else seen.unionAll(pairs)
        links = _alike(pairs, texts)
        if comp is not None:
            links = links.unionAll(comp.select(F.col("node").alias("u"), F.col("root").alias("v")))
        comp = components(links, scratch, f"round{k}")
        if k < ROUNDS:      # buckets of more than one component go on
            named = buckets.join(comp.withColumnRenamed("node", "h"), "h", "left").select("band", "h", "n", F.coalesce("root", "h").alias("c"))
            mixed = named.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("band")
            held = scratch.write(named.join(mixed, "band", "left_semi"), f"open{k}")
            buckets = held.select("band", "h", "n")
            if held.isEmpty():
                break
    scratch.clear(*scratch.paths)
    return lines.select("rid", "doc_id", "pos", "h"), comp


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (with words), n_removed and removed (their line
    numbers from 0, ascending) of every document."""
    scratch = Scratch(docs.sparkSession, "linededup")
    lines, comp = line_components(docs, scratch)
    lines = lines.join(comp.withColumnRenamed("node", "h"), "h", "left").withColumn("c", F.coalesce("root", "h"))
    first = lines.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid", "pos")).alias("first"))
    kept = first.select(F.col("first.rid").alias("rid"), F.col("first.pos").alias("pos"), F.lit(True).alias("kept"))
    marked = lines.select("rid", "doc_id", "pos").join(kept, ["rid", "pos"], "left")
    per = marked.groupBy("rid", "doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.array_sort(F.collect_list(F.when(F.col("kept").isNull(), F.col("pos")))).alias("removed"))
    with_lines = per.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")
    none = docs.where(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).select(F.col("doc_id").cast("long").alias("doc_id"))
    none = none.select("doc_id", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"), F.array().cast("array<int>").alias("removed"))
    return with_lines.unionAll(none)


def drop_repeated(docs: DataFrame) -> DataFrame:
    """The documents without their removed lines, with the columns they came
    with. Their doc_id must be unique."""
    gone = removed_lines(docs).where("n_removed > 0").select(F.col("doc_id").alias("id"), "removed")
    whole = boxed(docs, F.col("doc_id").cast("long").alias("id"), "text")
    text = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("removed", i)), "\n")
    out = whole.join(gone, "id", "left").withColumn("row", F.when(F.col("removed").isNull(), F.col("row")).otherwise(F.col("row").withField("text", text)))
    return out.select("row.*")
