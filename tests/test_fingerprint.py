import pytest
from pyspark.sql import functions as F

from huddlekit.operators.fingerprint import FINGERPRINT_COLUMNS, team_week_fingerprint

PLAYS = [  # season, week, team, game_id, play_id (double), play_type, shotgun, no_huddle, pass_oe, epa
    (2019, 1, "GB", "g", 1.0, "pass", 1, 1, 10.0, 0.5),
    (2019, 1, "GB", "g", 2.0, "run", 0, 0, -2.0, -0.2),
    (2019, 1, "GB", "g", 3.0, "pass", 1, 0, 6.0, 0.3),
    (2019, 1, "GB", "g", 4.0, "run", 0, 0, -4.0, 0.1),
    (2019, 1, "GB", "g", 5.0, "punt", 0, 0, None, 0.0),     # not an offensive snap
    (2019, 1, None, "g", 6.0, "pass", 1, 1, 1.0, 1.0),     # no team: dropped
]
PLAY_SCHEMA = ("season long, week long, team string, game_id string, play_id double, "
               "play_type string, shotgun long, no_huddle long, pass_oe double, epa double")


@pytest.fixture
def plays(spark):
    return spark.createDataFrame(PLAYS, PLAY_SCHEMA)


def test_base_metrics(spark, plays):
    r = team_week_fingerprint(plays).collect()
    assert len(r) == 1
    row = r[0]
    assert row["plays"] == 4
    assert row["shotgun_rate"] == pytest.approx(0.5)
    assert row["no_huddle_rate"] == pytest.approx(0.25)
    assert row["pass_rate"] == pytest.approx(0.5)
    assert row["proe"] == pytest.approx(2.5)
    assert row["epa_per_play"] == pytest.approx(0.175)
    assert tuple(team_week_fingerprint(plays).columns) == FINGERPRINT_COLUMNS


def test_coverage_denominator_is_charted_plays(spark, plays):
    part = spark.createDataFrame(
        [("g", 1, "MAN_COVERAGE", 6.0, True), ("g", 2, "ZONE_COVERAGE", 7.0, False),
         ("g", 3, "", None, None), ("g", 4, None, None, None)],
        "game_id string, play_id long, defense_man_zone_type string, defenders_in_box double, "
        "was_pressure boolean")
    row = team_week_fingerprint(plays, participation=part).first()
    assert row["plays_charted_coverage"] == 2
    assert row["man_rate"] == pytest.approx(0.5)
    assert row["zone_rate"] == pytest.approx(0.5)
    assert row["avg_defenders_in_box"] == pytest.approx(6.5)
    assert row["plays_charted_pressure"] == 2
    assert row["pressure_rate"] == pytest.approx(0.5)


def test_ftn_block(spark, plays):
    ftn = spark.createDataFrame(
        [("g", "1", True, True, False, False, 1, 5), ("g", "2", False, True, False, False, 0, 4),
         ("g", "3", False, False, False, False, 0, 4), ("g", "4", False, False, False, False, 2, 6)],
        "game_id string, play_id string, is_play_action boolean, is_motion boolean, is_rpo boolean, "
        "is_screen_pass boolean, n_blitzers long, n_pass_rushers long")
    row = team_week_fingerprint(plays, ftn=ftn).first()
    assert row["plays_charted_ftn"] == 4
    assert row["play_action_rate"] == pytest.approx(0.25)
    assert row["motion_rate"] == pytest.approx(0.5)
    assert row["blitz_rate"] == pytest.approx(0.5)
    assert row["avg_pass_rushers"] == pytest.approx(4.75)
    assert row["rpo_rate"] == 0.0  # charted, none: a true zero


def test_null_not_zero(spark, plays):
    # participation rows joined, none charted -> denominator 0, rates NULL
    part = spark.createDataFrame([("g", 1, "  ", None, None)],
                                 "game_id string, play_id long, defense_man_zone_type string, "
                                 "defenders_in_box double, was_pressure boolean")
    row = team_week_fingerprint(plays, participation=part).first()
    assert row["plays_charted_coverage"] == 0
    assert row["man_rate"] is None and row["zone_rate"] is None
    # no row joined at all -> the whole block is NULL, including the denominator
    other = spark.createDataFrame([("h", 1, "MAN_COVERAGE", 6.0, True)],
                                  "game_id string, play_id long, defense_man_zone_type string, "
                                  "defenders_in_box double, was_pressure boolean")
    row = team_week_fingerprint(plays, participation=other).first()
    assert row["plays_charted_coverage"] is None and row["man_rate"] is None


def test_personnel_block_by_era(spark):
    plays = spark.createDataFrame(
        [(2023, 1, "KC", "g", 1.0, "pass", 1, 0, 1.0, 0.1), (2023, 1, "KC", "g", 2.0, "run", 0, 0, 1.0, 0.1),
         (2019, 1, "KC", "h", 1.0, "pass", 1, 0, 1.0, 0.1)], PLAY_SCHEMA)
    part = spark.createDataFrame(
        [("g", 1, "C;G;QB;RB;T;T;T;TE;TE;WR;WR", None), ("g", 2, "C;G;G;QB;RB;T;T;TE;WR;WR;WR", None),
         ("h", 1, None, "2 RB, 1 TE, 2 WR")],
        "game_id string, play_id long, offense_positions string, offense_personnel string")
    out = {r["season"]: r for r in team_week_fingerprint(plays, participation=part, personnel=True).collect()}
    assert out[2023]["plays_with_personnel"] == 2
    assert out[2023]["personnel_11_rate"] == pytest.approx(0.5)
    assert out[2023]["personnel_12_rate"] == pytest.approx(0.5)
    assert out[2023]["personnel_source"] == "offense_positions"
    assert out[2019]["personnel_21_rate"] == pytest.approx(1.0)
    assert out[2019]["personnel_source"] == "offense_personnel"


def test_one_row_per_team_week_and_duplicate_label_refused(spark, plays):
    coaches = spark.createDataFrame([(2019, 1, "GB", "A"), (2019, 1, "GB", "B")],
                                    "season long, week long, team string, head_coach string")
    r = team_week_fingerprint(plays, coaches=coaches).collect()
    assert len(r) == 1 and r[0]["head_coach"] is None


def test_charting_rows_reduced_before_join(spark, plays):
    part = spark.createDataFrame([("g", 1, "MAN_COVERAGE", 6.0, True)],
                                 "game_id string, play_id long, defense_man_zone_type string, "
                                 "defenders_in_box double, was_pressure boolean")
    plan = team_week_fingerprint(plays, participation=part)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
