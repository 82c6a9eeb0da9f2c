"""Atomic publishing: readers see whole versions, failures change nothing."""
import os
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huddlekit.session import scratch_path
from huddlekit.sources.store import (clustered, create_table_if_missing, drop_old_versions, drop_table, merge_latest,
                                     replace_season, upsert)

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType()),
                       T.StructField("season", T.LongType())])


@pytest.fixture
def name(spark, tmp_path):
    table = f"v_{uuid.uuid4().hex[:10]}"
    create_table_if_missing(spark, table, SCHEMA, partition_by=("season",), location=str(tmp_path / table))
    return table


def rows(spark, *values, ddl="k long, v double, season long"):
    return spark.createDataFrame(list(values), ddl)


def folders(tmp_path, name):
    root = tmp_path / name / "_versions"
    return sorted(p.name for v in root.iterdir() for p in v.iterdir() if "=" in p.name)


def staged(spark):
    path = scratch_path(spark, "staging")
    return os.listdir(path) if os.path.isdir(path) else []


def broken(df):
    """Fails while it is written, after some rows."""
    return df.withColumn("v", F.when(F.col("k") == 2, F.raise_error("broken row").cast("double")).otherwise(F.col("v")))


def test_failed_writes_leave_the_old_rows_and_no_folders(spark, tmp_path, name):
    replace_season(spark, name, rows(spark, (1, 1.0, 2020)), 2020)
    before = folders(tmp_path, name)
    for write in (lambda: replace_season(spark, name, broken(rows(spark, (1, 9.0, 2020), (2, 9.0, 2020))), 2020),
                  lambda: upsert(spark, name, broken(rows(spark, (1, 9.0, 2020), (2, 9.0, 2020))), ["k", "season"],
                                 partition_by=("season",)),
                  lambda: replace_season(spark, name, rows(spark, (None, 9.0, 2020)), 2020, required=("k",))):
        with pytest.raises((PySparkException, ValueError)):
            write()
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, 1.0, 2020)]
    assert folders(tmp_path, name) == before and staged(spark) == []


def test_a_write_that_dies_while_publishing_changes_nothing(spark, tmp_path, name, monkeypatch):
    from huddlekit.sources import store
    replace_season(spark, name, rows(spark, (1, 1.0, 2020)), 2020)
    monkeypatch.setattr(store, "_partition_folder", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        replace_season(spark, name, rows(spark, (2, 2.0, 2020)), 2020)
    assert [r.k for r in spark.table(name).collect()] == [1]
    assert folders(tmp_path, name) == ["season=2020"]


def test_running_readers_finish_from_the_version_they_planned(spark, tmp_path, name):
    replace_season(spark, name, rows(spark, (1, 1.0, 2020)), 2020)
    files = spark.table(name).where("season = 2020").inputFiles()
    replace_season(spark, name, rows(spark, (2, 2.0, 2020)), 2020)
    assert [r.k for r in spark.read.parquet(*files).collect()] == [1]     # still there
    assert [r.k for r in spark.table(name).collect()] == [2]
    replace_season(spark, name, rows(spark, (3, 3.0, 2020)), 2020)
    assert folders(tmp_path, name) == ["season=2020"] * 2                 # the one left and the new one
    drop_old_versions(spark, name)
    assert folders(tmp_path, name) == ["season=2020"]
    assert [r.k for r in spark.table(name).collect()] == [3]


def test_only_touched_partitions_move(spark, tmp_path, name):
    def place(season):
        return {r[0] for r in spark.table(name).where(F.col("season") == season)
                .select("_metadata.file_path").collect()}
    upsert(spark, name, rows(spark, (1, 1.0, 2020), (2, 2.0, 2021)), ["k", "season"], partition_by=("season",))
    old = place(2020), place(2021)
    upsert(spark, name, rows(spark, (2, 5.0, 2021), (3, 6.0, 2022)), ["k", "season"], partition_by=("season",))
    assert place(2020) == old[0] and place(2021) != old[1]
    assert sorted(tuple(r) for r in spark.table(name).select("k", "v", "season").collect()) == [
        (1, 1.0, 2020), (2, 5.0, 2021), (3, 6.0, 2022)]
    assert staged(spark) == []


def test_odd_partition_values_and_whole_tables(spark, tmp_path):
    odd = f"o_{uuid.uuid4().hex[:10]}"
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("day", T.DateType()),
                           T.StructField("label", T.StringType())])
    create_table_if_missing(spark, odd, schema, partition_by=("day", "label"), location=str(tmp_path / odd))
    batch = spark.createDataFrame([(1, "2024-01-02", "it's a/b=c"), (2, "2024-01-02", "x y%z")],
                                  "k long, day string, label string").withColumn("day", F.col("day").cast("date"))
    for _ in range(3):
        upsert(spark, odd, batch, ["k", "day", "label"], partition_by=("day", "label"))
    assert sorted((r.k, str(r.day), r.label) for r in spark.table(odd).collect()) == [
        (1, "2024-01-02", "it's a/b=c"), (2, "2024-01-02", "x y%z")]
    drop_old_versions(spark, odd)
    assert spark.table(odd).count() == 2
    plain = f"p_{uuid.uuid4().hex[:10]}"
    create_table_if_missing(spark, plain, SCHEMA, location=str(tmp_path / plain))
    for v in (1.0, 2.0, 3.0):
        upsert(spark, plain, rows(spark, (1, v, 2020)), ["k"])
    assert [r.v for r in spark.table(plain).collect()] == [3.0]
    assert len(os.listdir(tmp_path / plain / "_versions")) == 2
    drop_table(spark, plain)
    assert not (tmp_path / plain).exists() and not spark.catalog.tableExists(plain)


def test_merge_latest_in_any_order_of_arrival(spark, name):
    import itertools
    versions = [(1, 1.0, 2020), (1, 5.0, 2020), (1, None, 2020), (1, 3.0, 2020)]
    for order in itertools.permutations(versions):
        state = rows(spark, order[0])
        for later in order[1:]:
            state = merge_latest(state, rows(spark, later), ["k", "season"], "v")
        if order[0] == versions[0]:     # a replay of all
            for again in order:
                state = merge_latest(state, rows(spark, again), ["k", "season"], "v")
        assert [tuple(r) for r in state.select("k", "v", "season").collect()] == [(1, 5.0, 2020)]
        if order[0] == versions[1]:
            break


def test_clustered_files_are_skipped_by_a_filter_on_the_cluster_column(spark, tmp_path):
    import pyarrow.parquet as pq
    table = f"c_{uuid.uuid4().hex[:10]}"
    create_table_if_missing(spark, table, SCHEMA, partition_by=("season",), cluster_by=("k",),
                            location=str(tmp_path / table))
    data = spark.range(4000).select(F.xxhash64("id").alias("k"), F.rand(1).alias("v"), F.lit(2020).cast("long").alias("season"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        replace_season(spark, table, data, 2020, cluster_by=("k",))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f.removeprefix("file://") for f in spark.table(table).inputFiles()]
    wanted = spark.table(table).agg(F.min("k")).first()[0]
    spans = []
    for f in files:
        stats = pq.ParquetFile(f).metadata.row_group(0).column(0).statistics
        spans.append((stats.min, stats.max))
    assert len(files) > 1 and sum(lo <= wanted <= hi for lo, hi in spans) == 1
    assert clustered(spark.range(3).withColumnRenamed("id", "k"), ["k"]).count() == 3
