import datetime as dt

import pytest
from pyspark.sql import functions as F

from huddlekit.operators.increment import gate, pending, work_matrix
from huddlekit.operators.quality import (fill_matrix_check, grain_checks, rate_denominator_checks,
                                         reconcile_check, resolution_check, summarize)
from huddlekit.operators.trends import before_after, day_over_day, stint_summary, stints


def test_work_matrix_gating_and_resume(spark):
    m = work_matrix(spark, {"source": ["ffc", "mfl"], "season": [2009, 2010, 2011],
                            "format": ["ppr", "2qb"]})
    assert m.count() == 12
    g = gate(m, min_season={"mfl": 2011, "ffc": 2010}, source_col="source",
             allowed={"mfl": ("ppr", "standard")}, format_col="format")
    log = spark.createDataFrame([("ffc", 2010, "ppr", "success"), ("ffc", 2011, "ppr", "failed"),
                                 ("ffc", 2011, "ppr", "empty"), ("ffc", 2010, "2qb", "failed")],
                                "source string, season int, format string, status string")
    got = sorted(tuple(r) for r in pending(g, log, ["source", "season", "format"]).collect())
    assert got == [("ffc", 2010, "2qb"), ("ffc", 2011, "2qb"), ("mfl", 2011, "ppr")]


def test_checks(spark):
    adp = spark.createDataFrame([("ffc", "a"), ("ffc", None), ("mfl", "b")], "source string, gsis_id string")
    res = {r.check: (r.rate, r.passed) for r in resolution_check(adp).collect()}
    assert res == {"resolution_rate[ffc]": (0.5, False), "resolution_rate[mfl]": (1.0, True)}
    g = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a int, b int")
    gc = {r.check: (r.dup_groups, r.max_rows, r.passed) for r in grain_checks(g, ["a", "b"], "x").collect()}
    assert gc == {"no_duplicates[x]": (1, 2, False), "snapshot_idempotent[x]": (1, 2, False)}
    empty = grain_checks(g.limit(0), ["a"], "e").collect()
    assert not any(r.passed for r in empty)          # zero rows is a failure
    pts = spark.createDataFrame([(2024, 10.0, 3, 13.0), (2024, 10.0, 3, 13.5)],
                                "season int, fantasy_points_standard double, receptions long, "
                                "fantasy_points_ppr double")
    rc = reconcile_check(pts).first()
    assert (rc.n, rc.n_unreconciled, rc.passed) == (2, 1, False)
    fp = spark.createDataFrame([(2024, 0.5, 2, 1.5, None)], "season int, man_rate double, "
                               "plays_charted_coverage long, zone_rate double, x long")
    rd = {r.check: (r.null_denominator, r.over_one) for r in rate_denominator_checks(
        fp, pairs=(("man_rate", "plays_charted_coverage"), ("zone_rate", "x"))).collect()}
    assert rd == {"scheme_denominators[man_rate]": (0, 0), "scheme_denominators[zone_rate]": (1, 1)}
    fill = spark.createDataFrame([(2016, None), (2016, None), (2018, "MAN"), (2018, None)],
                                 "season int, v string")
    fm = {r.season: (r.fill_rate, r.passed) for r in fill_matrix_check(
        fill, F.col("v").isNotNull(), zero_groups=(2016, 2017), ceiling=0.496).collect()}
    assert fm == {2016: (0.0, True), 2018: (0.5, False)}
    s = summarize(resolution_check(adp), grain_checks(g, ["a"], "y")).first()
    assert (s.checks, s.passed_checks, s.all_passed) == (4, 1, False)


def test_an_empty_scope_fails_every_check(spark):
    pts = spark.createDataFrame([(2024, None, 3, 13.0)], "season int, fantasy_points_standard double, "
                                "receptions long, fantasy_points_ppr double")
    r = reconcile_check(pts).first()
    assert (r.n, r.passed) == (0, False)                 # nothing that could be checked
    adp = spark.createDataFrame([("ffc", "a", 2024)], "source string, gsis_id string, season int")
    fp = spark.createDataFrame([(2024, 0.5, 2)], "season int, man_rate double, plays_charted_coverage long")
    pairs = (("man_rate", "plays_charted_coverage"),)
    empty = [resolution_check(adp, season=2099), reconcile_check(pts, season=2099),
             rate_denominator_checks(fp, pairs=pairs, season=2099),
             fill_matrix_check(fp.limit(0), F.col("man_rate").isNotNull())]
    for check in empty:
        assert [(x.n, x.passed) for x in check.collect()] == [(0, False)]
    s = summarize(resolution_check(adp, season=2024), *empty).first()
    assert (s.checks, s.passed_checks, s.all_passed) == (5, 1, False)


def test_stints_null_labels_run_together(spark):
    seq = spark.createDataFrame([("GB", 1, None), ("GB", 2, None), ("GB", 3, "B"), ("GB", 4, None)],
                                "team string, wk int, coach string")
    got = [(r.wk, r.stint_no) for r in stints(seq, ["team"], "wk", "coach").orderBy("wk").collect()]
    assert got == [(1, 1), (2, 1), (3, 2), (4, 3)]


def _d(x):
    return dt.date(2024, 1, x)


def test_drift_with_gaps(spark):
    daily = spark.createDataFrame([(1, _d(1), 10.0), (1, _d(2), 12.0), (1, _d(5), 11.0), (2, _d(1), 3.0)],
                                  "u int, day date, v double")
    got = sorted((r.u, r.day.day, r.drift, r.gap_days) for r in day_over_day(daily, ["u"], "day", "v").collect())
    assert got == [(1, 1, None, None), (1, 2, 2.0, 1), (1, 5, -1.0, 3), (2, 1, None, None)]


def test_stints_returning_coach_is_new_stint(spark):
    seq = spark.createDataFrame([("GB", 1, "A", 1.0), ("GB", 2, "A", 3.0), ("GB", 3, "B", 5.0),
                                 ("GB", 4, "A", 7.0), ("KC", 1, "C", 1.0)], "team string, wk int, coach string, v double")
    summ = stint_summary(stints(seq, ["team"], "wk", "coach"), ["team"], "wk", "coach", value="v")
    got = sorted((r.team, r.stint_no, r.coach, r.start, r.end, r.n) for r in summ.collect())
    assert got == [("GB", 1, "A", 1, 2, 2), ("GB", 2, "B", 3, 3, 1), ("GB", 3, "A", 4, 4, 1),
                   ("KC", 1, "C", 1, 1, 1)]
    ba = {(r.team, r.stint_no): (r.prev_coach, r.delta) for r in before_after(summ, ["team"], "coach").collect()}
    assert ba[("GB", 2)] == ("A", 3.0) and ba[("GB", 1)] == (None, None)
