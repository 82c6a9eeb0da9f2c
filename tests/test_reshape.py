import datetime as dt

import pytest
from pyspark.sql import functions as F

from huddlekit.functions.exprs import season_from_date, season_week_from_key, to_long
from huddlekit.operators.reshape import reconcile_eras, season_guard, unpivot_sides

SCHED = [("2031_04_KAO_LUM", 2031, 4, "2031-10-03", "LUM", "KAO", "Ada Rooke", "Piet Halloran"),
         ("2031_05_KAO_VES", 2031, 5, "2031-10-11", "VES", "KAO", "Sven Tarly", "Piet Halloran")]
SCHED_SCHEMA = ("game_id string, season long, week long, gameday string, home_team string, "
                "away_team string, home_coach string, away_coach string")


def test_unpivot_two_rows_per_game(spark):
    out = unpivot_sides(spark.createDataFrame(SCHED, SCHED_SCHEMA))
    got = sorted((r.game_id, r.team, r.opponent, r.is_home, r.head_coach) for r in out.collect())
    assert got == [("2031_04_KAO_LUM", "KAO", "LUM", False, "Piet Halloran"),
                   ("2031_04_KAO_LUM", "LUM", "KAO", True, "Ada Rooke"),
                   ("2031_05_KAO_VES", "KAO", "VES", False, "Piet Halloran"),
                   ("2031_05_KAO_VES", "VES", "KAO", True, "Sven Tarly")]
    assert out.first().game_date == dt.date(2031, 10, 3)


def test_unpivot_date_fallback_and_empty(spark):
    df = spark.createDataFrame(SCHED, SCHED_SCHEMA.replace("gameday", "game_date"))
    assert unpivot_sides(df).first().game_date is not None
    assert unpivot_sides(spark.createDataFrame([], SCHED_SCHEMA)).count() == 0
    assert {r.season for r in unpivot_sides(df, season=2020).collect()} == {2020}


@pytest.mark.parametrize("d,season", [("2028-08-19", 2028), ("2028-12-30", 2028), ("2029-01-02", 2028),
                                      ("2029-02-28", 2028), ("2029-03-01", 2029)])
def test_season_from_date(spark, d, season):
    df = spark.createDataFrame([(d,)], "d string").select(F.to_date("d").alias("d"))
    assert df.select(season_from_date("d")).first()[0] == season


@pytest.mark.parametrize("key,expected", [("2027_11_LUM_KAO", (2027, 11)), ("2027_xx_LUM_KAO", (None, None)),
                                          ("garbage", (None, None)), (None, (None, None))])
def test_season_week_from_key(spark, key, expected):
    s, w = season_week_from_key("k")
    assert tuple(spark.createDataFrame([(key,)], "k string").select(s, w).first()) == expected


@pytest.mark.parametrize("raw,expected", [("4107.0", 4107), ("1e3", 1000), (" 7 ", 7), ("junk", None),
                                          ("6.75", None), ("", None), (None, None),
                                          ("9007199254740993", 9007199254740993)])
def test_to_long(spark, raw, expected):
    assert spark.createDataFrame([(raw,)], "x string").select(to_long("x")).first()[0] == expected


def test_two_eras(spark):
    legacy = spark.createDataFrame(
        [(2025.0, 1.0, "KAO", "00-1", "Ilse", "Brandvold", "QB", "1", "QB", "Offense"),
         (2025.0, 1.0, "KAO", "00-2", None, None, "WR", "2", "WR", "Offense")],
        "season double, week double, club_code string, gsis_id string, first_name string, "
        "last_name string, position string, depth_team string, depth_position string, formation string")
    modern = spark.createDataFrame(
        [(dt.datetime(2026, 1, 15, 12), "VES", "00-3", "Remy Castellane", "QB", 1, "QB", "7")],
        "dt timestamp, team string, gsis_id string, player_name string, pos_abb string, pos_rank long, "
        "pos_name string, pos_slot string")
    both = legacy.unionByName(modern, allowMissingColumns=True)
    out = {r.gsis_id: r for r in reconcile_eras(both, season_arg=2030).collect()}
    assert out["00-1"].player_name == "Ilse Brandvold" and out["00-1"].source_era == "legacy"
    assert out["00-2"].player_name == ""       # two missing parts: '' not NULL
    assert out["00-3"].season == 2025          # derived from the date, beats the argument
    assert out["00-3"].team == "VES" and out["00-3"].depth_rank == 1 and out["00-3"].pos_slot == "7"
    assert out["00-1"].depth_rank == 1 and out["00-1"].week == 1 and out["00-1"].depth_position == "QB"
    assert "dt" not in reconcile_eras(both).columns


@pytest.mark.parametrize("seasons,written,dropped", [([2025, 2025, 2026], 2, 1), ([2025, None], 1, 1),
                                                    ([2025, 2026, 2026, None], 1, 3), ([2026, 2026], 0, 2)])
def test_season_guard_counts(spark, seasons, written, dropped):
    df = spark.createDataFrame([(s, 1.0) for s in seasons], "season long, val double")
    kept, w, d = season_guard(df, 2025)
    assert tuple(df.agg(w, d).first()) == (written, dropped)
    assert kept.count() == written
