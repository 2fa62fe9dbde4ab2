"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / size of the source`` times.
The documents of a source stand in the order of their size; their expected
copies are summed up along it, one offset per source is added, and a document
is taken once per whole number that its part of the sum crosses. The offset
is a random start plus the one of ``PHASES`` equal steps whose sample comes
nearest to the target. Sums are fixed-point whole numbers, so reruns and any
partitioning agree.

Defined cases: a null source is a source of its own, the last; a null text has
size 0; sources without words have target 0 and none of their documents is
taken; repeated rows are sampled one by one; an empty table gives no rows;
extra columns are ignored (or carried along by ``mix``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, boxed, in_order, running_total, unboxed

#: weights dealt to the sources in order, repeating
WEIGHTS = (5, 2, 1)
#: a source's target is at most this many times its size
MOST = 3
#: fixed-point units of one copy
UNIT = 1 << 24
#: steps of the offset that are tried
PHASES = 16
#: so many sources at most make a broadcast table
SOURCES = 100_000
#: names the offsets
SEED = "mix-1"


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target and unit (expected copies of each of its
    documents, fixed-point).

    The targets share the whole size by weight; none exceeds ``most`` times
    its source, the excess going to the others by weight. That level is found
    in closed form: with the sources sorted by size per weight, those before
    the first that stays below its limit are full. The windows run over one
    row per source."""
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    one = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    one = one.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("weight", w)
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    one = one.withColumn("turn", F.row_number().over(order))
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    one = one.withColumn("full", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most)
    one = one.withColumn("open_weight", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    one = one.withColumn("whole", F.sum("source_size").over(all_rows))
    fits = (F.col("whole") - F.col("full")) * F.col("weight") <= F.col("source_size") * most * F.col("open_weight")
    level = F.min_by((F.col("whole") - F.col("full")) / F.col("open_weight"), F.when(fits, F.col("turn"))).over(all_rows)
    one = one.withColumn("target", F.least((F.col("source_size") * most).cast("double"), level * F.col("weight")))
    unit = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT + 0.5)).otherwise(F.lit(0))
    return one.select("source", "source_size", "target", unit.cast("long").alias("unit"))


def start(source: str = "source", seed: str = SEED) -> Column:
    """One fixed-point start in [0, 1) per source, from its name."""
    name = F.concat(F.lit(seed), F.when(F.col(source).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source))))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 6), 16, 10).cast("long")


def _crossed(offset: Column) -> Column:
    """Whole numbers crossed by a row's part of the shifted sum."""
    upto = F.col("upto") + offset
    return (F.floor(upto / UNIT) - F.floor((upto - F.col("unit")) / UNIT)).cast("long")


def _few(per_source: DataFrame) -> DataFrame:
    """A written table of one row per source, broadcast where their counted
    number bounds its size; so the rows of a large source stay where they are.
    With more sources than that it is joined by a shuffle."""
    return F.broadcast(per_source) if per_source.count() <= SOURCES else per_source


def copies(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, copies of every row."""
    scratch = Scratch(sized.sparkSession, "mix")
    rows = in_order(sized, scratch, "rows", ["source"], ["size", "doc_id"])
    share = _few(scratch.write(targets(rows, weights, most).withColumnRenamed("source", "__source"), "share"))
    rows = rows.join(share, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rows = scratch.write(running_total(rows, "source", "unit", "upto").withColumn("start", start()).drop("part", "row"), "sums")
    scratch.drop("rows")
    step = UNIT // PHASES
    sums = rows.groupBy("source").agg(F.first("target").alias("target"), *[F.sum(_crossed(F.col("start") + k * step) * F.col("size")).alias(f"s{k}") for k in range(PHASES)])
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"s{k}") - F.col("target")).alias("miss"), F.lit(k * step).alias("add")) for k in range(PHASES)]))
    best = _few(scratch.write(sums.select(F.col("source").alias("__source"), best["add"].alias("add")), "offsets"))
    rows = rows.join(best, F.col("source").eqNullSafe(F.col("__source")))
    return rows.select("doc_id", "source", "size", "source_size", "target", _crossed(F.col("start") + F.col("add")).alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the
    columns they came with."""
    whole = boxed(docs, "doc_id", "source", words().alias("size"))
    taken = copies(whole.select("doc_id", "source", "size"), weights, most)
    # rows of one doc_id, source and size are interchangeable: their numbers of
    # copies are told as how many rows are taken how often, and dealt out again
    # where the row meets them; so the texts are shuffled once
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.col("doc_id").isNull().alias("dn"),
           F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("sn"), "size"]
    names = ["d", "dn", "s", "sn", "size"]
    told = taken.select("copies", *key).groupBy(*names, "copies").agg(F.count(F.lit(1)).alias("n"))
    # a source's rows are taken one of two numbers of times: two entries at most
    told = told.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("copies", "n"))).alias("t")).where("t[size(t) - 1].copies > 0")
    met = whole.select("row", *key).join(told, names).withColumn("nth", _nth(names))
    often = F.when((F.size("t") == 1) | (F.col("nth") <= F.col("t")[0]["n"]), F.col("t")[0]["copies"]).otherwise(F.element_at("t", -1)["copies"])
    return unboxed(met.withColumn("often", often).where("often > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "often"))))


def _nth(names: list[str]) -> Column:
    """Number of a row among those of its names, in the order of the rows
    themselves where these differ in their hash: reruns agree."""
    return F.row_number().over(Window.partitionBy(*names).orderBy(F.xxhash64("row")))
