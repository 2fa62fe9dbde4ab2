"""Stage metrics (A5, A8) without extra scans where possible."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def value_frequency(df: DataFrame, col: str = "results", name: str = "n") -> DataFrame:
    """A5: value frequency of one column (partial aggregation map-side)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def observe_rows(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter to a stage; it is filled by whatever action
    runs the plan, so reporting counts costs no extra job.
    Read it with ``obs.get['rows']`` after the action."""
    obs = Observation(stage)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def observed_rows(obs: Observation) -> int:
    """The counted rows, after the action. A plan that adaptive execution
    finds empty is dropped together with its counter: then there is no row of
    metrics, which Spark asserts there is, and the count is 0. Any other error
    is raised."""
    try:
        return int(obs.get.get("rows", 0))
    except Py4JJavaError as e:
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return 0


def per_pass_frequency(df: DataFrame, passes: list[float], results_col: str = "results", pass_col: str = "pass_no",
                       found: str = "Success", missing: str = "Not Found") -> DataFrame:
    """A5 after every pass: ``(pass_no, results, n)`` as the value counts
    stood once that pass had run. A row found by a later pass still counts as
    missing; one aggregation over the finished rows gives all passes."""
    by = df.groupBy(results_col, pass_col).agg(F.count(F.lit(1)).alias("n"))
    later = F.col(pass_col) > F.col("after")
    state = F.when((F.col(results_col) == found) & later, F.lit(missing)).otherwise(F.col(results_col))
    # one row per result and pass meets the fixed list of passes
    seen = by.select(results_col, pass_col, "n", F.explode(F.array(*[F.lit(float(p)) for p in passes])).alias("after"))
    return seen.groupBy(F.col("after").alias("pass_no"), state.alias("results")).agg(F.sum("n").alias("n"))
