"""Structured Streaming forms of the feeds.

* T1 tails a folder of JSON-lines files, parses each line into fields and
  drops the raw text. Lines that are no such JSON go to a quarantine.
* T2 is the repeated insert-only load as a file-source stream: every
  micro-batch is de-duplicated and anti-joined (null-safe) against the target
  before it is appended. ``foreachBatch`` is at-least-once, and the anti-join
  makes a replayed batch append nothing, so the sink is effectively
  exactly-once. Checkpoints live in the shared folder.
* ``first_seen_stream`` keeps the keys it has seen in a state store instead:
  a micro-batch meets the state of its own keys, never the ledger, which is
  read once to seed the state.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.diff import new_rows
from ..operators.metrics import observe_rows, observed_rows
from ..operators.dedup import first_by_order
from ..sources.sinks import append_rows, read_existing, touched_partitions
from ..sources.tables import table_exists


def json_tail(spark: SparkSession, folder: str, schema: T.StructType | str, max_files: int | None = None,
              corrupt: str | None = None) -> DataFrame:
    """Streaming frame of the parsed lines of every file in ``folder``.
    A line that is no JSON of the schema is a row of nulls; ``corrupt`` names
    a further column that holds such a line's text (null for good lines)."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(folder)
    if not corrupt:
        return lines.select(F.from_json("value", fields).alias("j")).select("j.*")
    whole = T.StructType([*fields.fields, T.StructField(corrupt, T.StringType())])
    parsed = lines.select("value", F.from_json("value", whole, {"columnNameOfCorruptRecord": corrupt}).alias("j"))
    # JSON of another shape (a number, a list) parses to no struct at all
    bad = F.when(F.col("j").isNull(), F.col("value")).otherwise(F.col(f"j.`{corrupt}`"))
    return parsed.select(*[F.col(f"j.`{f.name}`").alias(f.name) for f in fields.fields], bad.alias(corrupt))


def _drain(stream: DataFrame, checkpoint: str, load, mode: str = "append") -> None:
    q = stream.writeStream.foreachBatch(load).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def _epoch(folder: str, checkpoint: str, epoch_id: int) -> str:
    """Where one micro-batch of one checkpoint writes: a replay overwrites
    its own rows and nothing else."""
    return f"{folder}/stream={hashlib.md5(checkpoint.encode()).hexdigest()[:12]}/epoch={epoch_id}"


def tail_with_quarantine(spark: SparkSession, folder: str, schema: T.StructType | str, target: str, quarantine: str,
                         checkpoint: str, max_files: int | None = None) -> None:
    """T1 with dead letters: drain ``folder``; parsed lines go to ``target``
    (parquet), the text of the others to ``quarantine`` (one text line each).
    Every line lands in exactly one of them, also when a batch is replayed."""
    lines = json_tail(spark, folder, schema, max_files, corrupt="__line")

    def load(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            batch.where("__line IS NULL").drop("__line").write.mode("overwrite").parquet(_epoch(target, checkpoint, epoch_id))
            batch.where("__line IS NOT NULL").select("__line").write.mode("overwrite").text(_epoch(quarantine, checkpoint, epoch_id))
        finally:
            batch.unpersist()

    _drain(lines, checkpoint, load)


def run_to_parquet(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Drain a stream into parquet (``availableNow``: all data present now,
    in as many micro-batches as the source limits ask, then stop)."""
    q = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def append_unseen_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    on: list[str] | None = None,
    partition_by: list[str] | None = None,
    max_files: int | None = 1,
    source_format: str = "parquet",
) -> list[int]:
    """Drain ``source`` into ``target`` appending only unseen rows; with
    ``on`` only rows of unseen keys, one per key.

    Returns the number of rows each micro-batch appended.
    """
    appended: list[int] = []

    def load(batch: DataFrame, epoch_id: int) -> None:
        fresh = batch.distinct()
        if on:
            # the first row of a key by its other columns (e.g. its date)
            rest = [F.col(f"`{c}`").asc_nulls_last() for c in fresh.columns if c not in on]
            fresh = first_by_order(fresh, on, rest or [F.lit(0)])
        old = read_existing(fresh, target)
        if old is not None:
            if partition_by and not on:
                # whole rows can only repeat in the partitions this batch touches
                old = touched_partitions(old, fresh, partition_by)
            fresh = new_rows(fresh, old.select(*fresh.columns), on)
        fresh, obs = observe_rows(fresh, f"batch-{epoch_id}")
        append_rows(fresh, target, partition_by)
        appended.append(observed_rows(obs))

    reader = spark.readStream.format(source_format).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    q = (
        reader.load(source).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return appended


def first_seen_stream(spark: SparkSession, source: str, schema: T.StructType | str, target: str, checkpoint: str,
                      key: list[str], date_col: str = "file_date", ledger: DataFrame | None = None,
                      max_files: int | None = 1, source_format: str = "parquet") -> None:
    """T2 on keys: drain ``source`` (rows of the key and a date) and append
    to ``target`` one row per key not seen before, with the least date of the
    micro-batch that brought it.

    The keys seen live in a state store (RocksDB, under the checkpoint); a
    micro-batch touches the state of its own keys only. ``ledger`` (key and
    date) seeds the state of a new checkpoint: it is kept under the checkpoint
    and all of it arrives with the first micro-batch. A restarted stream goes
    on with its state; a replayed micro-batch overwrites its own output.

    The state is that of a running aggregate: the least date of a key, the
    first and the last micro-batch (by the time that the checkpoint records
    for it) that brought it, and whether the ledger holds it. A key is new
    when all its rows are of one micro-batch and none is the ledger's."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.readStream.format(source_format).schema(fields)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    names = [f.name for f in fields.fields if f.name in (*key, date_col)]
    rows = reader.load(source).select(*[f"`{c}`" for c in names], F.lit(False).alias("__seed"))
    seed, new = f"{checkpoint}/seed", not table_exists(spark, f"{checkpoint}/offsets")
    if new and ledger is not None:
        kinds = {f.name: f.dataType for f in fields.fields}
        ledger.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in names]).write.mode("overwrite").parquet(seed)
    if ledger is not None if new else table_exists(spark, seed):
        # the checkpoint has this second source from its first start on
        known = spark.readStream.schema(T.StructType([f for f in fields.fields if f.name in names])).parquet(seed)
        rows = rows.unionByName(known.withColumn("__seed", F.lit(True)))
    seen = rows.withColumn("__at", F.current_timestamp()).groupBy(*[F.col(f"`{k}`") for k in key]).agg(
        F.min(f"`{date_col}`").alias(date_col), F.min("__at").alias("__first"), F.max("__at").alias("__last"), F.max("__seed").alias("__seed"))
    first = seen.where("__first = __last AND NOT __seed").select(*[f"`{c}`" for c in names])
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        _drain(first, checkpoint, lambda batch, epoch_id: batch.write.mode("overwrite").parquet(_epoch(target, checkpoint, epoch_id)), mode="update")
    finally:
        if before is None:
            spark.conf.unset(provider)
        else:
            spark.conf.set(provider, before)
