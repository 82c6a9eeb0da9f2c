import uuid

from pyspark.sql import functions as F

from huddlekit.plans.streams import SNAPSHOT_SCHEMA
from huddlekit.sources.store import create_table_if_missing
from huddlekit.streaming.snapshot import snapshot_stream, upsert_stream


def test_replay_is_noop_and_dedupe_window(spark, tmp_path):
    landing, ckpt = str(tmp_path / "landing"), str(tmp_path / "ckpt")
    rows = [(i, i % 3, "click", float(i), f"2024-01-0{1 + i % 3} 10:00:00") for i in range(9)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, ts string") \
        .select("event_id", "user_id", "event_type", "value",
                F.to_timestamp_ntz("ts").alias("captured_at"), F.to_date("ts").alias("capture_day"))
    df.write.mode("append").parquet(landing)
    df.write.mode("append").parquet(landing)           # duplicate delivery
    name = f"st_{uuid.uuid4().hex[:10]}"
    create_table_if_missing(spark, name, SNAPSHOT_SCHEMA, location=str(tmp_path / "table"))
    upsert_stream(snapshot_stream(spark, landing, SNAPSHOT_SCHEMA, max_files_per_trigger=1),
                  name, ["event_id"], ckpt).awaitTermination()
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 9
    df.write.mode("append").parquet(landing)           # a later replay of the same rows
    upsert_stream(snapshot_stream(spark, landing, SNAPSHOT_SCHEMA), name, ["event_id"], ckpt).awaitTermination()
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 9
    # dedupe within a watermark window drops duplicates across micro-batches too
    name2 = f"st_{uuid.uuid4().hex[:10]}"
    create_table_if_missing(spark, name2, SNAPSHOT_SCHEMA, location=str(tmp_path / "table2"))
    s = snapshot_stream(spark, landing, SNAPSHOT_SCHEMA, grain=["event_id"], event_time="captured_at",
                        dedupe_window="30 days", max_files_per_trigger=1)
    upsert_stream(s, name2, ["event_id"], str(tmp_path / "ckpt2")).awaitTermination()
    spark.catalog.refreshTable(name2)
    assert spark.table(name2).count() == 9


def test_stage_then_batch_upsert(spark, tmp_path):
    from huddlekit.sources.store import upsert
    from huddlekit.streaming.snapshot import stage_stream
    landing = str(tmp_path / "landing")
    df = spark.createDataFrame([(i, 1, "view", 1.0, "2024-01-02 00:00:00") for i in range(5)],
                               "event_id long, user_id long, event_type string, value double, ts string") \
        .select("event_id", "user_id", "event_type", "value",
                F.to_timestamp_ntz("ts").alias("captured_at"), F.to_date("ts").alias("capture_day"))
    df.write.parquet(landing)
    staging, ckpt = str(tmp_path / "staging"), str(tmp_path / "ckpt")
    stage_stream(snapshot_stream(spark, landing, SNAPSHOT_SCHEMA), staging, ckpt).awaitTermination()
    stage_stream(snapshot_stream(spark, landing, SNAPSHOT_SCHEMA), staging, ckpt).awaitTermination()
    name = f"st_{uuid.uuid4().hex[:10]}"
    create_table_if_missing(spark, name, SNAPSHOT_SCHEMA, location=str(tmp_path / "t"))
    staged = spark.read.parquet(staging)
    assert staged.count() == 5                      # the rerun added no files
    upsert(spark, name, staged, ["event_id"])
    upsert(spark, name, staged, ["event_id"])
    assert spark.table(name).count() == 5


def test_latest_version_of_a_key_wins(spark, tmp_path):
    landing, name = str(tmp_path / "landing"), f"st_{uuid.uuid4().hex[:10]}"
    df = spark.createDataFrame([(1, 0, "click", 5.0, "2024-01-01 10:00:00"), (1, 0, "click", 2.0, "2024-01-01 11:00:00"),
                                (2, 0, "click", 7.0, "2024-01-01 10:00:00")],
                               "event_id long, user_id long, event_type string, value double, ts string") \
        .select("event_id", "user_id", "event_type", "value",
                F.to_timestamp_ntz("ts").alias("captured_at"), F.to_date("ts").alias("capture_day"))
    df.coalesce(1).write.parquet(landing)
    create_table_if_missing(spark, name, SNAPSHOT_SCHEMA, location=str(tmp_path / "table"))
    upsert_stream(snapshot_stream(spark, landing, SNAPSHOT_SCHEMA), name, ["event_id"], str(tmp_path / "ckpt"),
                  latest_by="captured_at").awaitTermination()
    spark.catalog.refreshTable(name)
    assert sorted((r.event_id, r.value) for r in spark.table(name).collect()) == [(1, 2.0), (2, 7.0)]
