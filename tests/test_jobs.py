import json
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huddlekit.operators.jobs import (load_seasons, run_tallies, sync_adp, sync_bridge, sync_coordinators,
                                      sync_rankings)
from huddlekit.operators.specs import TableSpec, conform_participation
from huddlekit.operators.pages import page_title
from huddlekit.sources.feeds import read_bridge_csv, read_feed_a
from huddlekit.sources.store import clustered, create_table_if_missing


def _name(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _doc(players):
    return {"status": "Success", "meta": {"total_drafts": 10, "start_date": "2024-08-01",
                                          "end_date": "2024-08-03"}, "players": players}


def test_sync_adp_idempotent_with_log(spark, tmp_path):
    root = tmp_path / "ffc"
    for fmt, players in (("ppr", [{"player_id": 1, "name": "A.J. Brown", "position": "WR", "adp": 10.5},
                                  {"player_id": 2, "name": "Nobody Known", "position": "RB", "adp": 20.0}]),
                         ("standard", [])):
        d = root / "season=2024" / f"scoring_format={fmt}" / "teams=12"
        d.mkdir(parents=True)
        (d / "doc.json").write_text(json.dumps(_doc(players)))
    bridge = spark.createDataFrame([(100, "00-1", "aj brown", "WR")],
                                   "mfl_id long, gsis_id string, merge_name string, position string")
    table, log_path = _name("adp"), str(tmp_path / "runs")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    docs = read_feed_a(spark, str(root))
    log = {r.scoring_format: (r.status, r.rows) for r in
           sync_adp(spark, table, "2024-08-04", bridge, log_path, feed_a_docs=docs).collect()}
    assert log == {"ppr": ("success", 2), "standard": ("empty", 0)}
    got = sorted((r.source_player_id, r.gsis_id) for r in spark.table(table).collect())
    assert got == [("1", "00-1"), ("2", None)]
    sync_adp(spark, table, "2024-08-04", bridge, log_path, feed_a_docs=docs)   # same day again
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 2
    sync_adp(spark, table, "2024-08-05", bridge, log_path, feed_a_docs=docs)   # next day adds a snapshot
    spark.catalog.refreshTable(table)
    assert spark.table(table).groupBy("snapshot_date").count().count() == 2
    t = run_tallies(spark.read.parquet(log_path)).first()
    assert t.by_status == {"success": 3, "empty": 3} and t.run_failed is False and t.log_failures == 0


def test_sync_adp_isolates_a_chunk_with_required_nulls(spark, tmp_path):
    root = tmp_path / "ffc"
    for teams, players in ((10, [{"player_id": 1, "name": "X", "adp": None}]),
                           (12, [{"player_id": 2, "name": "Y", "adp": 3.0}])):
        d = root / "season=2024" / "scoring_format=ppr" / f"teams={teams}"
        d.mkdir(parents=True)
        (d / "doc.json").write_text(json.dumps(_doc(players)))
    bridge = spark.createDataFrame([], "mfl_id long, gsis_id string, merge_name string, position string")
    table = _name("adp")
    log = {r.teams: (r.status, r.rows) for r in sync_adp(
        spark, table, "2024-08-04", bridge, str(tmp_path / "runs"),
        feed_a_docs=read_feed_a(spark, str(root))).collect()}
    assert log == {10: ("failed", None), 12: ("success", 1)}
    spark.catalog.refreshTable(table)
    assert [r.source_player_id for r in spark.table(table).collect()] == ["2"]


def test_sync_adp_fails_damaged_and_duplicated_chunks_alone(spark, tmp_path):
    root = tmp_path / "feed"
    good = [{"player_id": "31", "name": "Text Values", "adp": "2.5", "high": 4.0, "low": "9"}]
    twice = [{"player_id": 8, "name": "Twice", "adp": 3.0}, {"player_id": 8, "name": "Twice", "adp": 4.0}]
    texts = {8: json.dumps(_doc(good)), 10: json.dumps(_doc(twice)), 12: json.dumps(_doc(good))[:60],
             14: json.dumps(_doc([]))}
    for teams, text in texts.items():
        d = root / "season=2024" / "scoring_format=ppr" / f"teams={teams}"
        d.mkdir(parents=True)
        (d / "doc.json").write_text(text)
    b_docs = spark.createDataFrame(
        [(2024, "ppr", 8, json.dumps({"adp": {"totalDrafts": "3", "player": {"id": "5", "averagePick": "1.5"}}})),
         (2024, "ppr", 10, '{"adp": {"totalDrafts": "3", "pla'), (2024, "ppr", 12, '{"adp": {}}')],
        "season long, scoring_format string, teams long, raw string")
    bridge = spark.createDataFrame([], "mfl_id long, gsis_id string, merge_name string, position string")
    table = _name("adp")
    log = {(r.source, r.teams): r for r in sync_adp(
        spark, table, "2024-08-04", bridge, str(tmp_path / "runs"),
        feed_a_docs=read_feed_a(spark, str(root)), feed_b_docs=b_docs).collect()}
    assert {k: (r.status, r.rows) for k, r in log.items()} == {
        ("ffc", 8): ("success", 1), ("ffc", 10): ("failed", None), ("ffc", 12): ("failed", None),
        ("ffc", 14): ("empty", 0), ("mfl", 8): ("success", 1), ("mfl", 10): ("failed", None),
        ("mfl", 12): ("empty", 0)}
    assert "duplicated" in log["ffc", 10].error and "damaged" in log["ffc", 12].error
    got = {r.source: r for r in spark.table(table).collect()}
    r = got["ffc"]
    assert (r.source_player_id, r.adp, r.adp_earliest_pick, r.adp_latest_pick) == ("31", 2.5, 4, 9)
    assert got["mfl"].source_player_id == "5"


def test_load_seasons_casts_each_vintage_and_isolates_required(spark, tmp_path):
    land = tmp_path / "land"
    for season, rows, ddl in ((2019, [("a", 7, 1.5)], "g string, play_id int, x double"),
                              (2020, [("b", "8.0", 2.5), ("c", "junk", 3.5)], "g string, play_id string, x double"),
                              (2021, [(None, "9", 1.0)], "g string, play_id string, x double")):
        spark.createDataFrame(rows, ddl).write.parquet(str(land / str(season)))
    schema = T.StructType([T.StructField("g", T.StringType(), False), T.StructField("play_id", T.LongType()),
                           T.StructField("absent", T.DateType()), T.StructField("season", T.LongType())])
    table = _name("vintages")
    spec = TableSpec("vintages", lambda s: str(land / str(s)), 2019, schema=schema, cluster_by=("play_id",))
    log = {r.season: r for r in load_seasons(spark, spec, table, [2019, 2020, 2021], str(tmp_path / "runs")).collect()}
    assert {s: (r.status, r.rows, r.dropped) for s, r in log.items()} == {
        2019: ("success", 1, 0), 2020: ("success", 2, 0), 2021: ("failed", None, None)}
    assert "'g': 1" in log[2021].error
    got = sorted((r.g, r.play_id, r.absent, r.season) for r in spark.table(table).collect())
    assert got == [("a", 7, None, 2019), ("b", 8, None, 2020), ("c", None, None, 2020)]


def test_load_seasons(spark, tmp_path):
    land = tmp_path / "land"
    spark.createDataFrame([("2016_01_A_B", 1.0, "x")], "nflverse_game_id string, play_id double, t string") \
        .write.parquet(str(land / "2016"))
    spark.createDataFrame([("2017_02_A_B", 5, "y"), ("2018_01_A_B", 6, "z")],
                          "nflverse_game_id string, play_id int, t string").write.parquet(str(land / "2017"))
    table = _name("part")
    schema = T.StructType([T.StructField("nflverse_game_id", T.StringType()),
                           T.StructField("play_id", T.LongType()), T.StructField("week", T.LongType()),
                           T.StructField("season", T.LongType())])
    create_table_if_missing(spark, table, schema, partition_by=("season",), location=str(tmp_path / table))

    def transform(df, season):
        df = conform_participation(df, season)
        # upstream stamps the season from the id for the odd foreign row
        return df.withColumn("season", F.when(F.col("nflverse_game_id").startswith("2018"), 2018)
                             .otherwise(F.col("season")))

    spec = TableSpec("participation", lambda s: str(land / str(s)), min_season=2016, transform=transform)
    log = {r.season: (r.status, r.rows) for r in
           load_seasons(spark, spec, table, [2015, 2016, 2017, 2019], str(tmp_path / "runs")).collect()}
    assert log[2015] == ("empty", 0) and log[2016] == ("success", 1) and log[2017] == ("success", 1)
    assert log[2019][0] == "failed"
    got = sorted((r.season, r.play_id, r.week) for r in spark.table(table).collect())
    assert got == [(2016, 1, 1), (2017, 5, 2)]
    # the 2016 feed becomes empty: the season is cleared on reload
    spark.createDataFrame([], "nflverse_game_id string, play_id double, t string") \
        .write.mode("overwrite").parquet(str(land / "2016"))
    load_seasons(spark, spec, table, [2016], str(tmp_path / "runs"))
    assert sorted(r.season for r in spark.table(table).collect()) == [2017]


def test_sync_bridge_and_rankings(spark, tmp_path):
    csv = tmp_path / "ids.csv"
    csv.write_text("mfl_id,gsis_id,merge_name,position,birthdate,age,twitter_username\n"
                   "17482,,mike washington,RB,2000-01-02,24.5,x\n"
                   "11192,00-0030496,leveon bell,RB,,,\n"
                   ",00-9,no key,WR,,,\n")
    table = _name("xref")
    assert sync_bridge(spark, table, read_bridge_csv(spark, str(csv))) == 2
    cols = spark.table(table).columns
    assert len(cols) == 29 and "twitter_username" not in cols
    dup = tmp_path / "dup.csv"
    dup.write_text("mfl_id,gsis_id\n1,a\n1,b\n")
    with pytest.raises(ValueError):
        sync_bridge(spark, table, read_bridge_csv(spark, str(dup)))
    rk = _name("rank")
    create_table_if_missing(spark, rk, T.StructType([
        T.StructField("id", T.StringType()), T.StructField("ecr_type", T.StringType()),
        T.StructField("ecr", T.DoubleType()), T.StructField("scrape_date", T.DateType())]),
        partition_by=("scrape_date",), location=str(tmp_path / rk))
    day = spark.createDataFrame([("1", "rp", 2.0, "2024-08-01")], "id string, ecr_type string, ecr double, d string") \
        .select("id", "ecr_type", "ecr", F.to_date("d").alias("scrape_date"))
    sync_rankings(spark, rk, day)
    sync_rankings(spark, rk, day)
    assert spark.table(rk).count() == 1


def test_sync_coordinators(spark):
    pages = spark.createDataFrame(
        [(2024, "GB", "{{Infobox\n| off_coach = [[Adam Stenavich]]\n| def_coach = [[Jeff Hafley]]\n}}")],
        "season long, team string, wikitext string").withColumn("retrieved_at", F.current_timestamp())
    table = _name("coord")
    assert sync_coordinators(spark, table, pages) == 2
    assert sync_coordinators(spark, table, pages) == 2
    spark.catalog.refreshTable(table)
    assert sorted((r.role, r.name) for r in spark.table(table).collect()) == [
        ("DC", "Jeff Hafley"), ("OC", "Adam Stenavich")]


def test_page_title_and_clustered(spark):
    df = spark.createDataFrame([(2024, "GB"), (2019, "XX")], "season int, team string")
    assert [r[0] for r in df.select(page_title("season", "team")).collect()] == [
        "2024_Green_Bay_Packers_season", None]
    c = clustered(spark.range(100).withColumn("k", F.col("id") % 7), ["k"])
    assert c.count() == 100


def test_coordinator_job_from_landed_pages(spark, tmp_path):
    d = tmp_path / "wiki"
    d.mkdir()
    (d / "a.json").write_text(json.dumps({"parse": {"title": "2024 Green Bay Packers season",
        "wikitext": "{{Infobox\n| off_coach = [[Adam Stenavich]]\n| def_coach = [[Jeff Hafley]]\n}}"}}))
    (d / "b.json").write_text(json.dumps({"error": {"code": "missingtitle"}}))
    (d / "c.json").write_text('{"parse": {"title": "2023 Gr')
    from huddlekit.operators.jobs import sync_coordinators_from_pages
    from huddlekit.sources.feeds import read_wiki_pages
    table = _name("coord")
    t = sync_coordinators_from_pages(spark, table, read_wiki_pages(spark, str(d)), [2023, 2024], ["GB"]).first()
    assert (t.requested, t.found, t.missing, t.rows_written) == (2, 1, 1, 2)
