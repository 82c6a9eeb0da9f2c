import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huddlekit.sources.store import (append_run_log, completed, create_table_if_missing, merge_upsert,
                                     replace_season, run_log_rows, upsert)

SCHEMA = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("day", T.StringType()),
                       T.StructField("v", T.DoubleType())])


def _table(spark, tmp_path, partition_by=()):
    name = f"t_{uuid.uuid4().hex[:10]}"
    create_table_if_missing(spark, name, SCHEMA, partition_by=partition_by,
                            location=str(tmp_path / name))
    return name


@pytest.mark.parametrize("partition_by", [(), ("day",)])
def test_upsert_idempotent(spark, tmp_path, partition_by):
    name = _table(spark, tmp_path, partition_by)
    b1 = spark.createDataFrame([(1, "d1", 1.0), (2, "d1", 2.0), (3, "d2", 3.0)], "k long, day string, v double")
    assert upsert(spark, name, b1, ["k", "day"], partition_by=partition_by) == 3
    b2 = spark.createDataFrame([(2, "d1", 20.0), (4, "d1", 4.0)], "k long, day string, v double")
    upsert(spark, name, b2, ["k", "day"], partition_by=partition_by)
    first = sorted(tuple(r) for r in spark.table(name).select("k", "day", "v").collect())
    upsert(spark, name, b2, ["k", "day"], partition_by=partition_by)   # rerun: no-op
    again = sorted(tuple(r) for r in spark.table(name).select("k", "day", "v").collect())
    assert first == again == [(1, "d1", 1.0), (2, "d1", 20.0), (3, "d2", 3.0), (4, "d1", 4.0)]
    assert upsert(spark, name, b2.limit(0), ["k", "day"], partition_by=partition_by) == 0


def test_upsert_rejects_bad_keys(spark, tmp_path):
    name = _table(spark, tmp_path)
    with pytest.raises(ValueError):
        upsert(spark, name, spark.createDataFrame([(None, "d", 1.0)], "k long, day string, v double"), ["k"])
    with pytest.raises(ValueError):
        upsert(spark, name, spark.createDataFrame([(1, "d", 1.0), (1, "e", 2.0)],
                                                  "k long, day string, v double"), ["k"])
    with pytest.raises(ValueError):
        upsert(spark, name, spark.createDataFrame([(1, "d", 1.0)], "k long, day string, v double"), ["nope"])


def test_upsert_partition_columns_must_be_keys(spark, tmp_path):
    name = _table(spark, tmp_path, ("day",))
    row = spark.createDataFrame([(1, "d1", 1.0)], "k long, day string, v double")
    with pytest.raises(ValueError, match="partition columns"):   # a moved key would stay behind
        upsert(spark, name, row, ["k"], partition_by=("day",))
    with pytest.raises(ValueError, match="NULL key"):
        upsert(spark, name, row.withColumn("day", F.lit(None).cast("string")), ["k", "day"], partition_by=("day",))
    assert spark.table(name).count() == 0


def test_replace_season_types_missing_columns(spark, tmp_path):
    name = _season_table(spark, tmp_path)
    res = replace_season(spark, name, spark.createDataFrame([(2025,), (2026,), (2026,)], "season long"), 2025)
    assert spark.table(name).where("season = 2025").first().val is None
    assert (res.dropped, res.offending) == (2, [2026])


def test_merge_upsert_plan(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k long, s string")
    s = spark.createDataFrame([(2, "B"), (3, "C")], "k long, s string")
    assert sorted(tuple(r) for r in merge_upsert(t, s, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "C")]


def _season_table(spark, tmp_path):
    name = f"s_{uuid.uuid4().hex[:10]}"
    schema = T.StructType([T.StructField("val", T.DoubleType()), T.StructField("season", T.LongType())])
    create_table_if_missing(spark, name, schema, partition_by=("season",), location=str(tmp_path / name))
    spark.createDataFrame([(1.0, 2025), (2.0, 2024)], "val double, season long") \
        .write.insertInto(name)
    return name


@pytest.mark.parametrize("seasons,written,dropped", [([2025, 2025, 2026], 2, 1), ([2025, None], 1, 1),
                                                    ([2025, 2026, 2026, None], 1, 3), ([2026, 2026], 0, 2)])
def test_replace_season(spark, tmp_path, seasons, written, dropped):
    name = _season_table(spark, tmp_path)
    df = spark.createDataFrame([(10.0, s) for s in seasons], "val double, season long")
    res = replace_season(spark, name, df, 2025)
    assert (res.written, res.dropped) == (written, dropped)
    got = spark.table(name)
    assert got.where("season = 2025").count() == written         # old 2025 rows always gone
    assert got.where("season = 2024").count() == 1               # other seasons untouched
    assert got.where("season = 2026").count() == 0
    again = replace_season(spark, name, df, 2025)                 # rerun: same state
    assert (again.written, spark.table(name).where("season = 2025").count()) == (written, written)


def test_replace_season_empty_and_no_season_column(spark, tmp_path):
    name = _season_table(spark, tmp_path)
    res = replace_season(spark, name, spark.createDataFrame([], "val double, season long"), 2025)
    assert res.written == 0 and spark.table(name).where("season = 2025").count() == 0
    res = replace_season(spark, name, spark.createDataFrame([(5.0,)], "val double"), 2025)
    assert res.written == 1 and spark.table(name).where("season = 2025").count() == 1


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    chunks = spark.createDataFrame([("ffc", 2015), ("mfl", 2015), ("ffc", 2016)], "source string, season long")
    append_run_log(run_log_rows(chunks.where("source = 'ffc'"), "success", 10), path)
    append_run_log(run_log_rows(chunks.where("source = 'mfl'"), "failed", None, "x" * 5000), path)
    log = spark.read.parquet(path)
    assert log.where("status = 'failed'").first().error == "x" * 5000
    done = sorted(tuple(r) for r in completed(log, ["source", "season"]).collect())
    assert done == [("ffc", 2015), ("ffc", 2016)]


def test_required_columns_enforced(spark, tmp_path):
    name = _table(spark, tmp_path)
    bad = spark.createDataFrame([(1, "d", None)], "k long, day string, v double")
    with pytest.raises(ValueError, match="required"):
        upsert(spark, name, bad, ["k"], required=("v",))
    season = _season_table(spark, tmp_path)
    with pytest.raises(ValueError, match="required"):
        replace_season(spark, season, spark.createDataFrame([(None, 2025)], "val double, season long"),
                       2025, required=("val",))


def test_staged_copies_are_packed_tightly(spark):
    from huddlekit.sources.store import staged_copy
    with staged_copy(spark, spark.range(100), "packed") as staged:
        assert staged.count() == 100
        assert all(f.endswith(".zstd.parquet") for f in staged.inputFiles())
