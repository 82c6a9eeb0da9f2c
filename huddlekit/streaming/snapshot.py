"""Incremental snapshot ingest with Structured Streaming.

Landed snapshot files are read as a file stream with a declared schema,
conformed, and each micro-batch is upserted on the table's grain through
``foreachBatch``. Because the upsert replaces rows by key, replaying a file
or a whole batch (after a failure, or a duplicate delivery) is a no-op, and
the stream's checkpoint in the shared checkpoint folder makes a restarted
query resume after the last committed batch.

Exact duplicate deliveries inside a batch are collapsed before the upsert. Of
several versions of a key the latest one is kept (``latest_by``), inside a
batch and against the stored row alike, so an old version that lands late
never replaces a newer one;
optionally, duplicates that arrive in *different* batches within a time
window are dropped early with ``dropDuplicatesWithinWatermark`` (rows
older than the watermark are late and discarded by Spark, so only use it
when the upstream delivery window is known).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddlekit.sources.store import upsert


def snapshot_stream(spark: SparkSession, landing: str, schema, *, fmt: str = "parquet",
                    grain: list[str] | None = None, event_time: str | None = None,
                    dedupe_window: str | None = None,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(landing)
    if dedupe_window and grain and event_time:
        # a watermark needs a TIMESTAMP column; a wall-clock (NTZ) capture
        # time is read in the session time zone for it
        df = (df.withColumn("_event_time", F.col(event_time).cast("timestamp"))
              .withWatermark("_event_time", dedupe_window)
              .dropDuplicatesWithinWatermark(grain)
              .drop("_event_time"))
    return df


def upsert_stream(stream: DataFrame, table: str, keys: list[str], checkpoint: str, *,
                  partition_by: tuple[str, ...] = (),
                  transform: Callable[[DataFrame], DataFrame] | None = None,
                  latest_by: str | None = None,
                  available_now: bool = True):
    """Start a query that upserts every micro-batch into catalog table
    ``table``; with ``available_now`` it processes what has landed and stops.
    With ``latest_by`` there may be several versions of a key, in one batch or
    over many: the row with the largest value of that column wins (ties by the
    remaining columns, so the order of arrival does not matter and a replay
    changes nothing); without it two versions in a batch are an error and the
    later batch wins.
    The query runs in a cloned session: refresh the table in the calling
    session (``spark.catalog.refreshTable``) before reading it there."""
    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = transform(batch) if transform else batch
        if latest_by:
            # the stored columns in their order, as the merge compares them
            stored = rows.sparkSession.table(table).columns
            rest = [latest_by, *[c for c in stored if c != latest_by and c not in keys]]
            rows = (rows.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
                    .select(*keys, *[f"_row.{c}" for c in rest]))
        else:
            rows = rows.dropDuplicates()
        upsert(rows.sparkSession, table, rows, keys, partition_by=partition_by, latest_by=latest_by)

    writer = (stream.writeStream.foreachBatch(each_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def stage_stream(stream: DataFrame, staging: str, checkpoint: str):
    """Callback-free variant: land the stream in a Parquet staging folder
    (the file sink's commit log makes each batch exactly-once), then upsert
    from the staging folder as a batch with ``sources.store.upsert``. Read the
    folder back with ``spark.read.parquet(staging)``: the reader follows the
    sink's log and sees only committed files."""
    return (stream.writeStream.format("parquet").option("path", staging)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
