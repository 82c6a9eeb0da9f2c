"""Streaming bindings: events land as snapshot files, and a file stream upserts
them into a Parquet table keyed on the event id and capture day.

* ``stream_snapshot``: the click events first land with a provisional value.
  After that run a replay of the view events and the corrected click events
  land, and a second run resumes from the checkpoint. The replay must not add
  rows, the corrections must replace.
* ``stream_late_versions``: three deliveries, each its own run. Every event
  lands; then corrections of the clicks, captured a day later; then, late, an
  older version of every click, and a replay of all first rows. What is stored
  is the newest version of each event, whenever it arrived.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huddlekit.plans.loads import taken
from huddlekit.session import remove_path, scratch_path
from huddlekit.sources.store import create_table_if_missing
from huddlekit.streaming.snapshot import snapshot_stream, upsert_stream
from huddlekit.plans.tables import rounded, table

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("captured_at", T.TimestampNTZType()), T.StructField("capture_day", T.DateType()),
])


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", "event_type", "value",
                     F.col("ts").alias("captured_at"),
                     F.to_date("ts").alias("capture_day"))


def stream_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed(spark, sf_dir)
    provisional = F.when(F.col("event_type") == "click", -F.col("value")).otherwise(F.col("value"))
    return _delivered(spark, [landed.withColumn("value", provisional),
                              landed.where(F.col("event_type").isin("click", "view"))])


def _delivered(spark: SparkSession, deliveries: list[DataFrame]) -> DataFrame:
    """What is stored after the deliveries landed and streamed, one by one."""
    run = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    name = f"snap_{uuid.uuid4().hex[:12]}"
    # partitioned by capture day: a batch rewrites only the days it touches
    create_table_if_missing(spark, name, SNAPSHOT_SCHEMA, partition_by=("capture_day",), location=f"{run}/table")
    for delivery in deliveries:
        delivery.write.mode("append").parquet(f"{run}/landing")
        stream = snapshot_stream(spark, f"{run}/landing", SNAPSHOT_SCHEMA, max_files_per_trigger=16)
        upsert_stream(stream, name, ["event_id", "capture_day"], f"{run}/checkpoint", partition_by=("capture_day",),
                      latest_by="captured_at").awaitTermination()
    spark.catalog.refreshTable(name)
    rows = taken(spark, name, SNAPSHOT_SCHEMA.fieldNames())
    remove_path(spark, run)
    return rounded(rows)


def stream_late_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _landed(spark, sf_dir)
    clicks = first.where("event_type = 'click'")
    corrected = clicks.withColumns({"value": F.col("value") + 1000,
                                    "captured_at": F.expr("captured_at + interval 1 day")})
    older = clicks.withColumns({"value": F.col("value") - 1000,
                                "captured_at": F.expr("captured_at - interval 1 hour")})
    return _delivered(spark, [first, corrected, older.unionByName(first)])


STREAM_LATE_VERSIONS_SQL = """
SELECT event_id, user_id, event_type, round(CASE WHEN event_type = 'click' THEN value + 1000 ELSE value END, 6) AS value,
       CASE WHEN event_type = 'click' THEN ts + INTERVAL 1 DAY ELSE ts END AS captured_at,
       CAST(ts AS DATE) AS capture_day
FROM events
"""


STREAM_SNAPSHOT_SQL = """
SELECT event_id, user_id, event_type, round(value, 6) AS value, ts AS captured_at,
       CAST(ts AS DATE) AS capture_day
FROM events
"""
