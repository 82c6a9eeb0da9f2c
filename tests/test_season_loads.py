"""The registry, and loads of tables x seasons over landed Parquet."""
import uuid

import pytest
from pyspark.sql import functions as F

from huddlekit.operators.season_loads import contract_of, load_tables
from huddlekit.operators.specs import TABLE_NAMES, season_tables, select_tables
from huddlekit.operators.verify import CHECK_GROUPS, verify_tables

PARTICIPATION = ("nflverse_game_id string, play_id {play}, defense_man_zone_type string, defenders_in_box double, "
                 "was_pressure boolean, offense_positions string, offense_personnel string")
FEEDS = {   # feed -> (season -> rows), layout
    "opportunity": ("season string, week double, player_id string, rec_attempt double", [("2022", 1.0, "00-1", 4.0)]),
    "snap_counts": ("week int, team string, pfr_player_id string, offense_snaps double", [(1, "AAA", "XyzA00", 55.0)]),
    "injuries": ("season double, week double, team string, gsis_id string, report_status string",
                 [(2022.0, 1.0, "AAA", "00-1", "Out"), (2022.0, None, "AAA", "00-2", None)]),
    "depth_charts": ("season double, week double, club_code string, gsis_id string, first_name string, last_name string,"
                     " position string, depth_team string, depth_position string, formation string",
                     [(2022.0, 1.0, "AAA", "00-1", "Ann", "Ode", "WR", "1", "WR", "Offense"),
                      (2021.0, 1.0, "AAA", "00-2", "Bo", "Pax", "WR", "2", "WR", "Offense")]),
    "participation": (PARTICIPATION.format(play="double"),
                      [("2022_01_AAA_BBB", 1.0, "MAN_COVERAGE", 6.0, True, None, "1 RB, 1 TE, 3 WR"),
                       ("2022_01_AAA_BBB", 2.0, "", 7.0, None, None, "2 RB, 1 TE, 2 WR")]),
    "ftn_charting": ("week int, nflverse_game_id string, nflverse_play_id int, is_play_action boolean, is_motion boolean,"
                     " is_rpo boolean, is_screen_pass boolean, n_blitzers int, n_pass_rushers int",
                     [(1, "2022_01_AAA_BBB", 1, True, False, False, False, 1, 5)]),
    "schedules": ("game_id string, season long, week long, gameday string, home_team string, away_team string, "
                  "home_coach string, away_coach string",
                  [("2022_01_AAA_BBB", 2022, 1, "2022-09-11", "BBB", "AAA", "Coach B", "Coach A")]),
    "player_stats": ("season long, week long, player_id string, player_name string, position string, team string, "
                     "receptions long, fantasy_points double, fantasy_points_ppr double",
                     [(2022, 1, "00-1", "A O", "WR", "AAA", 5, 10.0, 15.0), (2022, 1, "00-2", "B P", "WR", "AAA", 2, 9.0, 11.0)]),
    "play_by_play": ("season long, week long, posteam string, game_id string, play_id double, play_type string, "
                     "shotgun double, no_huddle double, pass_oe double, epa double",
                     [(2022, 1, "AAA", "2022_01_AAA_BBB", 1.0, "pass", 1.0, 0.0, 5.0, 0.5),
                      (2022, 1, "AAA", "2022_01_AAA_BBB", 2.0, "run", 0.0, 0.0, -5.0, -0.1)]),
}


class Site:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.key = spark, folder, uuid.uuid4().hex[:8]
        self.log, self.quarantine = f"{folder}/log", f"{folder}/quarantine"
        self.specs = season_tables(self.path)

    def path(self, feed, season):
        return f"{self.folder}/{feed}/season={season}"

    def land(self, feed, season=2022, rows=None, ddl=None):
        self.spark.createDataFrame(FEEDS[feed][1] if rows is None else rows, ddl or FEEDS[feed][0]).coalesce(1) \
            .write.mode("overwrite").parquet(self.path(feed, season))

    def table_of(self, name):
        return f"{name}_{self.key}"

    def load(self, names, seasons, **options):
        log = load_tables(self.spark, select_tables(self.specs, names), seasons, self.log, table_of=self.table_of,
                          quarantine=self.quarantine, **options)
        return {(r.table_name, r.season): r for r in log.collect()}

    def stored(self, name):
        return self.spark.table(self.table_of(name))

    def place(self, name, season):
        """Where the stored partition's files are."""
        rows = self.stored(name).where(F.col("season") == season).select("_metadata.file_path").distinct().collect()
        return {r[0].rsplit("/", 1)[0] for r in rows}


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, str(tmp_path))


def test_registry_order_and_choice(site):
    assert tuple(s.name for s in site.specs) == TABLE_NAMES and len(TABLE_NAMES) == 9
    by_name = {s.name: s for s in site.specs}
    assert all(TABLE_NAMES.index(i) < TABLE_NAMES.index(s.name) for s in site.specs for i in s.inputs)
    assert by_name["ftn_charting"].min_season == 2022 and by_name["participation"].cluster_by[0] == "week"
    assert [s.name for s in select_tables(site.specs, ["team_scheme_week", "injuries"])] == ["injuries", "team_scheme_week"]
    with pytest.raises(ValueError, match="injurys"):
        select_tables(site.specs, ["injurys"])


def test_all_nine_tables_load(site, spark):
    for feed in FEEDS:
        site.land(feed)
    got = site.load(None, [1998, 2022])
    assert list(got) == [(n, s) for n in TABLE_NAMES for s in (1998, 2022)]      # registry order
    assert {(r.status, r.rows) for (_, s), r in got.items() if s == 1998} == {("empty", 0)}
    assert {n: (r.status, r.rows, r.dropped, r.offending) for (n, s), r in got.items() if s == 2022} == {
        "ff_opportunity": ("success", 1, 0, []), "snap_counts": ("success", 1, 0, []), "injuries": ("success", 2, 0, []),
        "depth_charts": ("success", 1, 1, [2021]), "participation": ("success", 2, 0, []),
        "ftn_charting": ("success", 1, 0, []), "nfl_coaches": ("success", 2, 0, []),
        "ff_points_weekly": ("success", 2, 0, []), "team_scheme_week": ("success", 1, 0, [])}
    assert all(r.version and r.log_written for r in got.values())
    types = {f.name: f.dataType.simpleString() for f in site.stored("injuries").schema.fields}
    assert types == {"week": "bigint", "team": "string", "gsis_id": "string", "report_status": "string",
                     "ingested_at": "timestamp", "season": "bigint"}
    assert sorted((r.player_id, r.position_rank_ppr, r.fantasy_points_half_ppr)
                  for r in site.stored("ff_points_weekly").collect()) == [("00-1", 1, 12.5), ("00-2", 2, 10.0)]
    week = site.stored("team_scheme_week").first()
    assert (week.team, week.head_coach, week.plays, week.plays_with_personnel, week.personnel_11_rate,
            week.personnel_21_rate, week.personnel_source) == ("AAA", "Coach A", 2, 2, 0.5, 0.5, "offense_personnel")
    assert (week.plays_charted_coverage, week.man_rate, week.plays_charted_ftn, week.blitz_rate) == (1, 1.0, 1, 1.0)
    assert all(week[c] is not None for c in site.stored("team_scheme_week").columns)
    put_aside = spark.read.parquet(site.quarantine).first()
    assert (put_aside.table_name, put_aside.season, put_aside.reason) == (
        site.table_of("depth_charts"), 2022, "foreign season")
    assert '"gsis_id":"00-2"' in put_aside.row


def test_a_failing_pair_fails_alone_and_is_loaded_on_resume(site):
    site.land("schedules")
    site.land("player_stats")
    got = site.load(["nfl_coaches", "injuries", "ff_points_weekly"], [2021, 2022])
    assert {k: r.status for k, r in got.items()} == {
        ("injuries", 2021): "failed", ("injuries", 2022): "failed", ("nfl_coaches", 2021): "failed",
        ("nfl_coaches", 2022): "success", ("ff_points_weekly", 2021): "failed", ("ff_points_weekly", 2022): "success"}
    assert "nothing has landed" in got["injuries", 2022].error and "season=2021" in got["nfl_coaches", 2021].error
    site.land("injuries")
    again = site.load(["nfl_coaches", "injuries", "ff_points_weekly"], [2022], resume=True)
    assert {k: r.status for k, r in again.items()} == {("injuries", 2022): "success"}


def test_required_nulls_keep_the_stored_season(site, spark):
    site.land("schedules")
    site.load(["nfl_coaches"], [2022])
    site.land("schedules", rows=[("2022_02_AAA_BBB", 2022, 2, None, "BBB", None, "Coach B", "Coach A")])
    got = site.load(["nfl_coaches"], [2022])["nfl_coaches", 2022]
    assert got.status == "failed" and "'team': 1" in got.error and got.rows is None
    assert {r.game_id for r in site.stored("nfl_coaches").collect()} == {"2022_01_AAA_BBB"}
    assert [r.reason for r in spark.read.parquet(site.quarantine).collect()] == ["NULL in team"]


def test_derived_table_waits_for_inputs_and_follows_reloads(site):
    for season in (2021, 2022):
        for feed in ("play_by_play", "participation", "schedules"):
            site.land(feed, season)
    names = ["participation", "nfl_coaches", "team_scheme_week"]
    first = site.load(["team_scheme_week"], [2021])
    assert first["team_scheme_week", 2021].status == "failed" and "has not been loaded" in first["team_scheme_week", 2021].error
    # the charting of 2022 is missing, that of 2021 does not exist
    got = site.load([*names, "ftn_charting"], [2021, 2022])
    assert (got["team_scheme_week", 2021].status, got["team_scheme_week", 2022].status) == ("success", "failed")
    site.land("ftn_charting")
    assert list(site.load([*names, "ftn_charting"], [2021, 2022], resume=True)) == [
        ("ftn_charting", 2022), ("team_scheme_week", 2022)]
    kept, moved = site.place("team_scheme_week", 2021), site.place("team_scheme_week", 2022)
    assert site.load(["team_scheme_week"], [2021, 2022], resume=True) == {}      # nothing newer
    site.land("participation", 2022, FEEDS["participation"][1][:1])
    site.load(["participation"], [2022])
    assert list(site.load(["team_scheme_week"], [2021, 2022], resume=True)) == [("team_scheme_week", 2022)]
    assert site.place("team_scheme_week", 2021) == kept and site.place("team_scheme_week", 2022) != moved
    assert {r.season: r.plays_with_personnel for r in site.stored("team_scheme_week").collect()} == {2021: 2, 2022: 1}


def test_vintages_of_several_types_and_new_columns(site, spark):
    rows = FEEDS["participation"][1]
    site.land("participation", 2020, [(r[0], int(r[1]), *r[2:]) for r in rows], PARTICIPATION.format(play="int"))
    site.land("participation", 2021, [(r[0], str(r[1]), *r[2:], "n") for r in rows],
              PARTICIPATION.format(play="string") + ", notes string")
    spec = select_tables(site.specs, ["participation"])[0]
    assert contract_of(spark, spec, [2020])["play_id"].dataType.simpleString() == "bigint"
    site.load(["participation"], [2020])
    assert "notes" not in site.stored("participation").columns
    got = site.load(["participation"], [2020, 2021])
    assert {r.status for r in got.values()} == {"success"}
    assert sorted((r.season, r.play_id, r.week, r.notes) for r in site.stored("participation").collect()) == [
        (2020, 1, 1, None), (2020, 2, 1, None), (2021, 1, 1, "n"), (2021, 2, 1, "n")]


def test_a_log_that_cannot_be_written_is_told(site, tmp_path):
    site.land("schedules")
    (tmp_path / "blocked").write_text("a file")
    site.log = f"{tmp_path}/blocked/log"
    got = site.load(["nfl_coaches"], [2022])["nfl_coaches", 2022]
    assert got.status == "success" and got.log_written is False


def test_an_emptied_feed_clears_the_season(site):
    site.land("schedules")
    site.load(["nfl_coaches"], [2022])
    site.land("schedules", rows=[])
    got = site.load(["nfl_coaches"], [2022])["nfl_coaches", 2022]
    assert (got.status, got.rows, site.stored("nfl_coaches").count()) == ("success", 0, 0)


def test_check_groups_over_stored_tables(site, spark, tmp_path):
    for feed in ("player_stats", "participation"):
        site.land(feed)
    site.load(["ff_points_weekly", "participation"], [2022])
    spark.createDataFrame(
        [("ffc", 2022, "ppr", 12, "2022-08-01", "1", "00-1"), ("ffc", 2022, "ppr", 12, "2022-08-01", "1", "00-1"),
         ("mfl", 2022, "ppr", 12, "2022-08-01", "2", None)],
        "source string, season long, scoring_format string, teams long, snapshot_date string, source_player_id string, "
        "gsis_id string").createOrReplaceTempView("adp_view")
    groups = {"points-weekly": site.table_of("ff_points_weekly"), "participation-coverage": site.table_of("participation"),
              "adp": "adp_view"}
    log = f"{tmp_path}/checks"
    got = {(r.check, r.season): (r.n, r.passed, r.detail) for r in
           verify_tables(spark, groups, [2022, 2023], log).collect()}
    assert got["ppr_reconciles", 2022] == (2, True, "known=2 off=0")
    assert got["coverage_matrix", 2022] == (2, False, "charted=1")
    assert got["resolution_rate[ffc]", 2022] == (2, True, "resolved=2")
    assert got["resolution_rate[mfl]", 2022] == (1, False, "resolved=0")
    assert got["no_duplicates", 2022] == (3, False, "keys=1") and got["snapshot_idempotent", 2022] == (3, False, "most=2")
    assert {got[c, 2023] for g in groups for c in CHECK_GROUPS[g][1]} == {(0, False, "no rows")}
    assert spark.read.parquet(log).count() == len(got)
    with pytest.raises(ValueError, match="point-weekly"):
        verify_tables(spark, {"point-weekly": "x"}, [2022])


@pytest.mark.parametrize("query", ["vintage_drift", "load_seasons"])
def test_line_items_are_joined_with_their_orders_once(spark, tmp_path, monkeypatch, query):
    """Every feed of line items comes from one joined, written copy."""
    from huddlekit.plans import season_loads
    day = "timestamp_ntz'%d-03-01 00:00:00'"
    tables = {
        "nation": "select explode(sequence(0, 24)) n_nationkey, 'N' n_name",
        "customer": "select explode(sequence(0, 9)) c_custkey, 1 c_nationkey",
        "orders": "select id o_orderkey, id % 10 o_custkey, 'F' o_orderstatus, 2.0D o_totalprice, '1-URGENT' o_orderpriority, "
                  f"element_at(array({', '.join(day % y for y in range(1995, 2002))}), cast(id % 7 + 1 as int)) o_orderdate "
                  "from range(70)",
        "lineitem": "select id % 70 l_orderkey, cast(id / 70 as int) + 1 l_linenumber, 'R' l_returnflag, 'F' l_linestatus, "
                    "5.0D l_quantity, 0.05D l_discount from range(210)",
        "events": "select id event_id, timestamp_ntz'2024-01-02 00:00:00' ts, 1 user_id, 'view' event_type, 2.0D value, "
                  "'{\"k\": 1}' props from range(5)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b
    given = season_loads.table

    def table(session, folder, name):
        rows = given(session, folder, name)
        return rows.mapInArrow(counted, rows.schema) if name == "lineitem" else rows
    monkeypatch.setattr(season_loads, "table", table)
    assert season_loads.__dict__[query](spark, str(tmp_path)).count() == {"vintage_drift": 10, "load_seasons": 34}[query]
    assert read.value == 210
