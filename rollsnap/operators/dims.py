"""Dimension lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Name labels and how they fold into the published gender.
# ---------------------------------------------------------------------------
NAME_LABELS = ["male", "female", "mostly_male", "mostly_female", "andy"]
UNDECIDED = ["unknown", "andy"]
FOLD = {"mostly_male": "male", "mostly_female": "female"}
UNKNOWN = "unknown"
# ---------------------------------------------------------------------------


def guess_gender(
    people: DataFrame,
    names: DataFrame,
    first: str = "name_first",
    middle: str = "name_middle",
    out: str = "gender",
    name_col: str = "name",
    label_col: str = "label",
) -> DataFrame:
    """Label from the first name (case-insensitive); when that is
    'unknown' or 'andy', try the middle name; still undecided -> 'unknown';
    'mostly_male'/'mostly_female' fold to 'male'/'female'.

    ``names`` is a caller-supplied ``(name, label)`` table; duplicates are
    resolved to one label per lower-cased name (smallest label) so the join
    never multiplies rows. Spark broadcasts it where its size allows.
    """
    dim = names.groupBy(F.lower(F.col(name_col)).alias("__n")).agg(F.min(label_col).alias("__label"))
    d1 = dim.select(F.col("__n").alias("__n1"), F.col("__label").alias("__l1"))
    d2 = dim.select(F.col("__n").alias("__n2"), F.col("__label").alias("__l2"))
    j = (
        people.join(d1, F.lower(F.col(first)) == F.col("__n1"), "left")
        .join(d2, F.lower(F.col(middle)) == F.col("__n2"), "left")
    )
    undecided = F.array(*[F.lit(u) for u in UNDECIDED])
    g1 = F.coalesce(F.col("__l1"), F.lit(UNKNOWN))
    g2 = F.coalesce(F.col("__l2"), F.lit(UNKNOWN))
    g = F.when(F.array_contains(undecided, g1), g2).otherwise(g1)
    g = F.when(F.array_contains(undecided, g), F.lit(UNKNOWN)).otherwise(g)
    for k, v in FOLD.items():
        g = F.when(g == F.lit(k), F.lit(v)).otherwise(g)
    return j.withColumn(out, g).drop("__n1", "__l1", "__n2", "__l2")


def hit_count(rows: DataFrame, events: DataFrame, row_key: str, event_key: str, out: str = "hits") -> DataFrame:
    """Number of documents per key (0 when none); the events side is
    pre-aggregated map-side before the join."""
    counts = events.groupBy(F.col(event_key).alias("__k")).agg(F.count(F.lit(1)).alias(out))
    return (
        rows.join(counts, rows[row_key] == counts["__k"], "left")
        .withColumn(out, F.coalesce(F.col(out), F.lit(0).cast("long")))
        .drop("__k")
    )
