import pytest

from huddlekit.sources.vintages import common_schema, drift_report, footers, read_vintages, wider


def test_least_common_types():
    assert wider("INT64", "FLOAT64") == "FLOAT64" and wider("NUMERIC", "INT64") == "NUMERIC"
    assert wider("DATE", "TIMESTAMP") == "TIMESTAMP" and wider("BOOL", "INT64") == "STRING"
    assert wider("DATE", "INT64") == "STRING" and wider("STRING", "BOOL") == "STRING" and wider("BOOL", "BOOL") == "BOOL"


@pytest.fixture
def landed(spark, tmp_path):
    def path(season):
        return str(tmp_path / f"season={season}")
    spark.createDataFrame([(1, "x", True)], "play_id int, t string, flag boolean").write.parquet(path(2019))
    spark.createDataFrame([(2.5, 7)], "play_id double, extra int").write.parquet(path(2020))
    spark.createDataFrame([("3.0", "y", 4)], "play_id string, t string, flag int").write.parquet(path(2022))
    return path


def test_footers_schema_and_report(spark, landed):
    seen = footers(spark, landed, [2018, 2019, 2020, 2021, 2022])
    assert list(seen) == [2019, 2020, 2022]
    assert {f.name: f.dataType.simpleString() for f in common_schema(seen).fields} == {
        "play_id": "string", "t": "string", "flag": "string", "extra": "bigint"}
    report = {(r.column, r.type): (r.seasons, r.common_type, r.drifts, r.absent)
              for r in drift_report(spark, seen).collect()}
    assert report["play_id", "FLOAT64"] == ([2020], "STRING", True, [])
    assert report["t", "STRING"] == ([2019, 2022], "STRING", False, [2020])
    assert report["flag", "BOOL"] == ([2019], "STRING", True, [2020])
    assert common_schema({2020: seen[2020], 2019: seen[2019]})["play_id"].dataType.simpleString() == "double"


def test_read_vintages(spark, landed):
    got = sorted((r.feed_season, r.play_id, r.t, r.flag, r.extra) for r in
                 read_vintages(spark, landed, range(2018, 2023)).collect())
    assert got == [(2019, "1", "x", "true", None), (2020, "2.5", None, None, 7), (2022, "3.0", "y", "4", None)]
    with pytest.raises(ValueError, match="vintage"):
        read_vintages(spark, landed, [1990])
