import pytest

from huddlekit.operators.scoring import dense_rank_desc, points_weekly


def test_points_weekly_half_and_rank(spark):
    stats = spark.createDataFrame(
        [(2024, 1, "a", "A", "WR", "X", 10, 20.0, 30.0), (2024, 1, "b", "B", "WR", "X", 4, 12.0, 16.0),
         (2024, 1, "c", "C", "RB", "X", 2, 8.0, 10.0), (2024, 1, "d", "D", "RB", "X", 0, 15.0, 15.0)],
        "season long, week long, player_id string, player_name string, position string, team string, "
        "receptions long, fantasy_points double, fantasy_points_ppr double")
    out = {r["gsis_id"]: r for r in points_weekly(stats).collect()}
    assert out["a"]["fantasy_points_half_ppr"] == pytest.approx(25.0)
    assert out["b"]["fantasy_points_half_ppr"] == pytest.approx(14.0)
    assert out["c"]["fantasy_points_half_ppr"] == pytest.approx(9.0)
    assert out["d"]["fantasy_points_half_ppr"] == pytest.approx(15.0)
    # half-PPR is the midpoint of standard and PPR when PPR is standard + receptions
    for r in out.values():
        assert r["fantasy_points_half_ppr"] == pytest.approx(
            (r["fantasy_points_standard"] + r["fantasy_points_ppr"]) / 2)
    assert [out[k]["position_rank_ppr"] for k in "abcd"] == [1, 2, 2, 1]


def test_carried_ppr_not_recomputed(spark):
    stats = spark.createDataFrame([(2024, 1, "a", None, "WR", None, 5, 10.0, 99.0)],
                                  "season long, week long, player_id string, player_name string, "
                                  "position string, team string, receptions long, fantasy_points double, "
                                  "fantasy_points_ppr double")
    assert points_weekly(stats).first()["fantasy_points_ppr"] == 99.0


def test_null_value_and_null_key_get_null_rank(spark):
    df = spark.createDataFrame(
        [(1, 2024, 1, "WR", 10.0), (2, 2024, 1, "WR", None), (3, 2024, 1, "WR", 10.0),
         (4, 2024, 1, "WR", 7.0), (5, 2024, 1, None, 50.0)],
        "id int, season int, week int, position string, v double")
    got = dict((r["id"], r["r"]) for r in dense_rank_desc(df, "v", out="r").collect())
    assert got == {1: 1, 3: 1, 4: 2, 2: None, 5: None}
