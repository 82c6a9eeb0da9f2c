"""Season loads bound to the driver's tables: feeds are landed as Parquet, one
folder per feed and season, and loaded into written tables.

A season is the order year + 22 (2017 to 2023), a week the order month, a game
a customer's month (``YYYY_WW_custkey``), a play an order.

* play_by_play: orders with their customer's nation as team (24: no team).
* participation: every line item charts its play. The play id is an int in odd
  seasons, a double in even ones and text in 2020; ``defense_notes`` exists
  from 2021 on.
* ftn_charting: every line item again; the table begins in 2022.
* schedules: nation 2k plays at home against nation 2k + 1 in each month that
  has orders; the coach is the nation's name.
* depth_charts: events in two layouts (``layouts``), landed for 2023; 'error'
  rows belong to 2024 and are foreign.

Queries: ``load_seasons`` (the run log of four tables and the depth charts),
``quarantined_rows``, ``vintage_drift`` and ``vintage_rows`` (participation),
``team_week_written`` (the derived table after 2019's participation changed
and a resumed run rebuilt what depends on it) and ``verify_stored`` (the check
groups over the stored tables, one season of them empty).
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from huddlekit.operators.season_loads import load_tables
from huddlekit.operators.specs import season_tables, select_tables
from huddlekit.operators.verify import verify_tables
from huddlekit.plans.layouts import (SNAP_COLUMNS_SQL, SQL_LEGACY_LABS, SQL_LEGACY_NUMS, SQL_MODERN_TOKENS,
                                     _era_frames, _sql_legacy_select, _sql_modern_select, snap_encodings)
from huddlekit.plans.tables import rounded, table
from huddlekit.session import remove_path, scratch_path
from huddlekit.sources.store import drop_table, kept_copy
from huddlekit.sources.vintages import drift_report, footers, read_vintages

SHIFT = 22
SEASONS = tuple(range(2017, 2024))
CHANGED = 2019      # the season whose participation is landed again
TABLES = ["participation", "ftn_charting", "nfl_coaches", "team_scheme_week"]


def _season() -> Column:
    return (F.year("o_orderdate") + SHIFT).cast("long")


def _game_id() -> Column:
    return F.concat_ws("_", _season().cast("string"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"),
                       F.col("o_custkey").cast("string"))


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    priority = F.col("o_orderpriority")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        _season().alias("feed"), F.month("o_orderdate").cast("long").alias("week"),
        F.nullif(F.col("c_nationkey"), F.lit(24)).cast("string").alias("posteam"), _game_id().alias("game_id"),
        F.col("o_orderkey").cast("double").alias("play_id"),
        F.when(F.col("o_orderstatus") == "F", "pass").when(F.col("o_orderstatus") == "O", "run")
        .otherwise("special").alias("play_type"),
        priority.isin("1-URGENT", "2-HIGH").cast("long").alias("shotgun"),
        (priority == "3-MEDIUM").cast("long").alias("no_huddle"),
        F.when(priority != "5-LOW", F.col("o_totalprice")).alias("pass_oe"), F.col("o_totalprice").alias("epa"))


def _lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Line items with the season, month and game of their order."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"), _season().alias("feed"), F.month("o_orderdate").alias("week"), _game_id().alias("nflverse_game_id"))
    return (table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select("feed", "week", "nflverse_game_id", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag",
                    "l_linestatus", *more))


def participation(lines: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    return snap_encodings(lines).select(
        "feed", "nflverse_game_id", F.col("l_orderkey").alias("play_id"),
        F.when(flag == "R", "MAN_COVERAGE").when(flag == "A", "ZONE_COVERAGE")
        .when(F.col("l_linenumber") % 2 == 0, "  ").alias("defense_man_zone_type"),
        F.col("l_quantity").alias("defenders_in_box"),
        F.when(flag != "N", F.col("l_linestatus") == "F").alias("was_pressure"),
        "offense_positions", "offense_personnel", F.col("l_linenumber").alias("line"))


def charting(lines: DataFrame) -> DataFrame:
    return lines.select(
        "feed", "week", "nflverse_game_id", F.col("l_orderkey").cast("int").alias("nflverse_play_id"),
        (F.col("l_returnflag") == "R").alias("is_play_action"), (F.col("l_returnflag") == "A").alias("is_motion"),
        (F.col("l_linestatus") == "O").alias("is_rpo"), (F.col("l_discount") >= 0.08).alias("is_screen_pass"),
        F.nullif(F.col("l_linenumber") - 2, F.lit(0)).alias("n_blitzers"), F.col("l_linenumber").alias("n_pass_rushers"))


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("home"), F.col("n_name").alias("home_coach"))
    away = home.select(F.col("home").alias("away"), F.col("home_coach").alias("away_coach"))
    played = (plays(spark, sf_dir).where(F.col("posteam").isNotNull())
              .select("feed", "week", (F.floor(F.col("posteam").cast("long") / 2) * 2).alias("home")).distinct())
    return played.join(home, "home").join(away, F.col("away") == F.col("home") + 1).select(
        "feed", F.concat_ws("_", "feed", F.lpad(F.col("week").cast("string"), 2, "0"), "home", "away").alias("game_id"),
        "week", F.col("home").cast("string").alias("home_team"), F.col("away").cast("string").alias("away_team"),
        "home_coach", "away_coach", F.lit("2020-01-01").alias("gameday"))


def _write(rows: DataFrame, folder: str, mode: str = "append") -> None:
    """One folder per season: ``folder/feed=S``."""
    rows.write.option("compression", "zstd").partitionBy("feed").mode(mode).parquet(folder)


def land_participation(lines: DataFrame, folder: str) -> None:
    """``lines`` are staged by season: each vintage reads its own seasons."""
    rows = participation(lines).drop("line")
    year = F.col("feed")
    for which, type_ in ((year % 2 == 1, "int"), ((year % 2 == 0) & (year != 2020), "double"), (year == 2020, "string")):
        vintage = rows.where(which).withColumn("play_id", F.col("play_id").cast(type_))
        _write(vintage.where(year < 2021), folder)
        _write(vintage.where(year >= 2021).withColumn("defense_notes", F.lit("x")), folder)


class Landing:
    """Feeds landed below a folder of their own, and tables of their own."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.key = spark, sf_dir, uuid.uuid4().hex[:12]
        self.folder = scratch_path(spark, f"season-loads-{self.key}")
        self.log, self.quarantine = f"{self.folder}/log", f"{self.folder}/quarantine"
        self.made: set[str] = set()
        self.staged: DataFrame | None = None

    def path(self, feed: str, season: int) -> str:
        return f"{self.folder}/{feed}/feed={season}"

    def table_of(self, name: str) -> str:
        return f"{name}_{self.key}"

    def lines(self, *more: str) -> DataFrame:
        """Line items joined with their orders once, written by season; every
        feed of line items is landed from this copy."""
        if self.staged is None:
            rows = _lines(self.spark, self.sf_dir, *more)
            _write(rows, f"{self.folder}/lines")
            self.staged = self.spark.read.schema(rows.schema).parquet(f"{self.folder}/lines")
        return self.staged

    def land_participation(self) -> None:
        land_participation(self.lines(), f"{self.folder}/participation")

    def land(self) -> None:
        lines = self.lines("l_discount")
        _write(plays(self.spark, self.sf_dir), f"{self.folder}/play_by_play")
        self.land_participation()
        _write(charting(lines), f"{self.folder}/ftn_charting")
        _write(schedules(self.spark, self.sf_dir), f"{self.folder}/schedules")

    def land_depth_charts(self) -> None:
        legacy, modern = _era_frames(self.spark, self.sf_dir)
        both = legacy.unionByName(modern, allowMissingColumns=True)
        both.write.parquet(self.path("depth_charts", 2023))

    def load(self, names: list[str], seasons, **options) -> DataFrame:
        self.made.update(names)
        return load_tables(self.spark, select_tables(season_tables(self.path), names), list(seasons), self.log,
                           table_of=self.table_of, quarantine=self.quarantine, **options)

    def stored(self, name: str) -> DataFrame:
        return self.spark.table(self.table_of(name))

    def result(self, rows: DataFrame) -> DataFrame:
        """Keep the rows, drop all else."""
        rows = kept_copy(rows, "season-loads-result")
        for name in self.made:
            if self.spark.catalog.tableExists(self.table_of(name)):
                drop_table(self.spark, self.table_of(name))
        remove_path(self.spark, self.folder)
        return rows


def load_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = Landing(spark, sf_dir)
    landing.land()
    landing.land_depth_charts()
    landing.load(TABLES, [2015, *SEASONS])
    landing.load(["depth_charts"], [2022, 2023])
    log = spark.read.parquet(landing.log)
    return landing.result(log.select("table_name", "season", "status", "rows", "dropped",
                                     F.concat_ws(",", F.col("offending").cast("array<string>")).alias("offending"),
                                     F.col("error").isNotNull().alias("has_error")))


_ORDERS_SQL = f"""
orders_of AS (
  SELECT CAST(year(o_orderdate) + {SHIFT} AS BIGINT) AS season, CAST(month(o_orderdate) AS BIGINT) AS week,
         o_orderkey AS play_id, o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS price,
         nullif(c_nationkey, 24) AS nation
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

_DEPTH_SQL = """
depth AS (
  SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN CASE WHEN event_type = 'error' THEN 2024 ELSE 2023 END
              ELSE year(ts) - CASE WHEN month(ts) <= 2 THEN 1 ELSE 0 END END AS season,
         event_id, event_type, user_id, ts FROM events)"""

LOAD_SEASONS_SQL = f"""
WITH {_ORDERS_SQL},
{_DEPTH_SQL.strip()},
counts AS (
  SELECT 'participation' AS table_name, season, count(*) AS n FROM lineitem JOIN orders_of ON l_orderkey = play_id
  GROUP BY season
  UNION ALL
  SELECT 'ftn_charting', season, count(*) FROM lineitem JOIN orders_of ON l_orderkey = play_id
  WHERE season >= 2022 GROUP BY season
  UNION ALL
  SELECT 'nfl_coaches', season, 2 * count(DISTINCT week * 100 + nation // 2) FROM orders_of WHERE nation IS NOT NULL
  GROUP BY season
  UNION ALL
  SELECT 'team_scheme_week', season, count(DISTINCT week * 100 + nation) FROM orders_of
  WHERE nation IS NOT NULL AND status IN ('F', 'O') GROUP BY season),
chunks AS (
  SELECT t.table_name, y.season FROM (SELECT unnest({TABLES}) AS table_name) t,
         (SELECT unnest({[2015, *SEASONS]}) AS season) y)
SELECT table_name, CAST(season AS BIGINT) AS season,
       CASE WHEN table_name = 'participation' AND season < 2016 OR table_name = 'ftn_charting' AND season < 2022
              THEN 'empty' WHEN season < 2017 THEN 'failed' ELSE 'success' END AS status,
       CAST(CASE WHEN table_name = 'participation' AND season < 2016 OR table_name = 'ftn_charting' AND season < 2022
              THEN 0 ELSE n END AS BIGINT) AS rows,
       CAST(CASE WHEN season < 2017 AND table_name IN ('nfl_coaches', 'team_scheme_week') THEN NULL ELSE 0 END AS BIGINT)
         AS dropped,
       '' AS offending, season < 2017 AND table_name IN ('nfl_coaches', 'team_scheme_week') AS has_error
FROM chunks LEFT JOIN counts USING (table_name, season)
UNION ALL
SELECT 'depth_charts', 2022, 'failed', NULL, NULL, '', true
UNION ALL
SELECT 'depth_charts', 2023, 'success', count(*) FILTER (WHERE season = 2023), count(*) FILTER (WHERE season <> 2023),
       (SELECT string_agg(CAST(s AS VARCHAR), ',' ORDER BY s) FROM (SELECT DISTINCT season AS s FROM depth WHERE season <> 2023)),
       false
FROM depth
"""


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows the season guard put aside, as they would have been stored."""
    landing = Landing(spark, sf_dir)
    landing.land_depth_charts()
    landing.load(["depth_charts"], [2023])
    kept = F.from_json("row", "season long, team string, gsis_id string, source_era string")
    return landing.result(spark.read.parquet(landing.quarantine).select(
        F.col("season").alias("chunk"), "reason", kept.alias("r")).select("chunk", "reason", "r.*"))


QUARANTINED_ROWS_SQL = f"""
WITH {_DEPTH_SQL}
SELECT CAST(2023 AS BIGINT) AS chunk, 'foreign season' AS reason, CAST(season AS BIGINT) AS season, event_type AS team,
       CAST(user_id AS VARCHAR) AS gsis_id,
       CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'legacy' ELSE 'modern' END AS source_era
FROM depth WHERE season <> 2023
"""


# --- vintages -----------------------------------------------------------------

def vintage_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = Landing(spark, sf_dir)
    landing.land_participation()
    report = drift_report(spark, footers(spark, lambda s: landing.path("participation", s), [2016, *SEASONS]))
    return landing.result(report.select(
        "column", "type", F.concat_ws(",", F.col("seasons").cast("array<string>")).alias("seasons"), "common_type",
        "drifts", F.concat_ws(",", F.col("absent").cast("array<string>")).alias("absent")))


VINTAGE_DRIFT_SQL = f"""
WITH s AS (SELECT DISTINCT year(o_orderdate) + {SHIFT} AS season FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
columns AS (
  SELECT unnest(['nflverse_game_id', 'defense_man_zone_type', 'offense_positions', 'offense_personnel', 'defenders_in_box',
                 'was_pressure', 'play_id', 'defense_notes']) AS "column"),
seen AS (
  SELECT "column", season,
         CASE WHEN "column" = 'was_pressure' THEN 'BOOL' WHEN "column" = 'defenders_in_box' THEN 'FLOAT64'
              WHEN "column" <> 'play_id' OR season = 2020 THEN 'STRING'
              WHEN season % 2 = 1 THEN 'INT64' ELSE 'FLOAT64' END AS type
  FROM columns, s WHERE "column" <> 'defense_notes' OR season >= 2021)
SELECT "column", type, string_agg(CAST(season AS VARCHAR), ',' ORDER BY season) AS seasons,
       CASE WHEN "column" = 'play_id' THEN 'STRING' ELSE type END AS common_type, "column" = 'play_id' AS drifts,
       CASE WHEN "column" = 'defense_notes'
            THEN (SELECT string_agg(CAST(season AS VARCHAR), ',' ORDER BY season) FROM s WHERE season < 2021)
            ELSE '' END AS absent
FROM seen GROUP BY "column", type
"""


def vintage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = Landing(spark, sf_dir)
    landing.land_participation()
    rows = read_vintages(spark, lambda s: landing.path("participation", s), SEASONS)
    return landing.result(rows.select("feed_season", "nflverse_game_id", "play_id", "defenders_in_box", "was_pressure",
                                      "defense_notes"))


VINTAGE_ROWS_SQL = f"""
SELECT CAST(year(o_orderdate) + {SHIFT} AS BIGINT) AS feed_season,
       concat_ws('_', CAST(year(o_orderdate) + {SHIFT} AS VARCHAR), lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0'),
                 CAST(o_custkey AS VARCHAR)) AS nflverse_game_id,
       CAST(l_orderkey AS VARCHAR) AS play_id, l_quantity AS defenders_in_box,
       CASE WHEN l_returnflag <> 'N' THEN l_linestatus = 'F' END AS was_pressure,
       CASE WHEN year(o_orderdate) + {SHIFT} >= 2021 THEN 'x' END AS defense_notes
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


# --- the derived table ----------------------------------------------------------

def _changed_landing(spark: SparkSession, sf_dir: str) -> Landing:
    """All tables loaded, one season of participation landed and loaded again,
    and the derived table brought up to date by a resumed run."""
    landing = Landing(spark, sf_dir)
    landing.land()
    landing.load(TABLES, SEASONS)
    again = participation(landing.lines()).where((F.col("feed") == CHANGED) & (F.col("line") <= 3))
    again.drop("line", "feed").write.mode("overwrite").parquet(landing.path("participation", CHANGED))
    landing.load(["participation"], [CHANGED])
    landing.load(["team_scheme_week"], SEASONS, resume=True)
    return landing


def team_week_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _changed_landing(spark, sf_dir)
    return rounded(landing.result(landing.stored("team_scheme_week").drop("ingested_at")))


_LINE = "l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity"
_SNAPS = f"(SELECT {_LINE}, {SNAP_COLUMNS_SQL.strip()} FROM lineitem)"
# line items with their personnel counts, by either encoding
_PERSONNEL_SQL = f"""
parsed AS (
  SELECT {_LINE}, 'modern' AS era, {_sql_modern_select()} FROM (SELECT *, {SQL_MODERN_TOKENS} AS tok FROM {_SNAPS})
  UNION ALL
  SELECT {_LINE}, 'legacy' AS era, {_sql_legacy_select()}
  FROM (SELECT *, {SQL_LEGACY_NUMS} AS nums, {SQL_LEGACY_LABS} AS labs FROM {_SNAPS}))"""

TEAM_WEEK_WRITTEN_SQL = f"""
WITH {_ORDERS_SQL},
{_PERSONNEL_SQL.strip()},
plays AS (SELECT * FROM orders_of WHERE status IN ('F', 'O') AND nation IS NOT NULL),
base AS (
  SELECT season, week, nation, count(*) AS plays,
         avg(CASE WHEN priority IN ('1-URGENT', '2-HIGH') THEN 1.0 ELSE 0 END) AS shotgun_rate,
         avg(CASE WHEN priority = '3-MEDIUM' THEN 1.0 ELSE 0 END) AS no_huddle_rate,
         avg(CASE WHEN status = 'F' THEN 1.0 ELSE 0 END) AS pass_rate,
         avg(CASE WHEN priority <> '5-LOW' THEN price END) AS proe, avg(price) AS epa_per_play
  FROM plays GROUP BY season, week, nation),
part AS (
  SELECT season, week, nation,
         count(*) FILTER (WHERE plausible) AS personnel,
         count(*) FILTER (WHERE plausible AND n_rb = 1 AND n_te = 1) AS n11,
         count(*) FILTER (WHERE plausible AND n_rb = 1 AND n_te = 2) AS n12,
         count(*) FILTER (WHERE plausible AND n_rb = 2 AND n_te = 1) AS n21,
         count(*) FILTER (WHERE l_returnflag IN ('R', 'A')) AS charted,
         count(*) FILTER (WHERE l_returnflag = 'R') AS man, count(*) FILTER (WHERE l_returnflag = 'A') AS zone,
         avg(l_quantity) FILTER (WHERE l_returnflag IN ('R', 'A')) AS box,
         count(*) FILTER (WHERE l_returnflag <> 'N') AS p_charted,
         count(*) FILTER (WHERE l_returnflag <> 'N' AND l_linestatus = 'F') AS pressure
  FROM parsed JOIN plays ON l_orderkey = play_id
  WHERE era = CASE WHEN season >= 2023 THEN 'modern' ELSE 'legacy' END
    AND (season <> {CHANGED} OR l_linenumber <= 3)
  GROUP BY season, week, nation),
ftn AS (
  SELECT season, week, nation, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS action,
         count(*) FILTER (WHERE l_returnflag = 'A') AS motion, count(*) FILTER (WHERE l_linestatus = 'O') AS rpo,
         count(*) FILTER (WHERE l_discount >= 0.08) AS screen,
         count(*) FILTER (WHERE coalesce(nullif(l_linenumber - 2, 0), 0) >= 1) AS blitz, avg(l_linenumber) AS rush
  FROM lineitem JOIN plays ON l_orderkey = play_id WHERE season >= 2022 GROUP BY season, week, nation)
SELECT b.season, b.week, CAST(b.nation AS VARCHAR) AS team, n_name AS head_coach, CAST(b.plays AS BIGINT) AS plays,
       round(shotgun_rate, 6) AS shotgun_rate, round(no_huddle_rate, 6) AS no_huddle_rate,
       round(pass_rate, 6) AS pass_rate, round(proe, 6) AS proe, round(epa_per_play, 6) AS epa_per_play,
       CAST(personnel AS BIGINT) AS plays_with_personnel, round(n11 / nullif(personnel, 0), 6) AS personnel_11_rate,
       round(n12 / nullif(personnel, 0), 6) AS personnel_12_rate,
       round(n21 / nullif(personnel, 0), 6) AS personnel_21_rate,
       CASE WHEN personnel IS NOT NULL THEN CASE WHEN b.season >= 2023 THEN 'offense_positions'
            ELSE 'offense_personnel' END END AS personnel_source,
       CAST(charted AS BIGINT) AS plays_charted_coverage, round(man / nullif(charted, 0), 6) AS man_rate,
       round(zone / nullif(charted, 0), 6) AS zone_rate, round(box, 6) AS avg_defenders_in_box,
       CAST(p_charted AS BIGINT) AS plays_charted_pressure, round(pressure / nullif(p_charted, 0), 6) AS pressure_rate,
       CAST(f.n AS BIGINT) AS plays_charted_ftn, round(action / nullif(f.n, 0), 6) AS play_action_rate,
       round(motion / nullif(f.n, 0), 6) AS motion_rate, round(rpo / nullif(f.n, 0), 6) AS rpo_rate,
       round(screen / nullif(f.n, 0), 6) AS screen_rate, round(blitz / nullif(f.n, 0), 6) AS blitz_rate,
       round(rush, 6) AS avg_pass_rushers
FROM base b JOIN nation ON n_nationkey = b.nation LEFT JOIN part p USING (season, week, nation)
LEFT JOIN ftn f USING (season, week, nation)
"""


# --- checks over stored tables ------------------------------------------------------

def verify_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check groups over two stored tables and a season that has no rows."""
    landing = Landing(spark, sf_dir)
    landing.land()
    landing.load(TABLES, SEASONS)
    groups = {"scheme-denominators": landing.table_of("team_scheme_week"),
              "participation-coverage": landing.table_of("participation")}
    checks = verify_tables(spark, groups, [*SEASONS, 2030], log_path=f"{landing.folder}/checks")
    return rounded(landing.result(checks.select("check_group", "check", "season", "n", "passed",
                                                "detail")))


_UNCHANGED_SQL = TEAM_WEEK_WRITTEN_SQL.replace(f"    AND (season <> {CHANGED} OR l_linenumber <= 3)\n", "")
VERIFY_STORED_SQL = f"""
WITH written AS ({_UNCHANGED_SQL}),
{_ORDERS_SQL.strip()},
pairs AS (
  SELECT season, unnest([
    {{'r': 'personnel_11_rate', 'v': personnel_11_rate, 'd': plays_with_personnel}},
    {{'r': 'personnel_12_rate', 'v': personnel_12_rate, 'd': plays_with_personnel}},
    {{'r': 'personnel_21_rate', 'v': personnel_21_rate, 'd': plays_with_personnel}},
    {{'r': 'man_rate', 'v': man_rate, 'd': plays_charted_coverage}},
    {{'r': 'zone_rate', 'v': zone_rate, 'd': plays_charted_coverage}},
    {{'r': 'pressure_rate', 'v': pressure_rate, 'd': plays_charted_pressure}},
    {{'r': 'play_action_rate', 'v': play_action_rate, 'd': plays_charted_ftn}},
    {{'r': 'motion_rate', 'v': motion_rate, 'd': plays_charted_ftn}},
    {{'r': 'rpo_rate', 'v': rpo_rate, 'd': plays_charted_ftn}},
    {{'r': 'screen_rate', 'v': screen_rate, 'd': plays_charted_ftn}},
    {{'r': 'blitz_rate', 'v': blitz_rate, 'd': plays_charted_ftn}}]) AS p FROM written),
seasons AS (SELECT unnest({[*SEASONS, 2030]}) AS season),
scheme AS (
  SELECT season, p.r AS r, count(*) AS n, count(*) FILTER (WHERE p.v IS NOT NULL AND p.d IS NULL) AS loose,
         count(*) FILTER (WHERE p.v > 1) AS over FROM pairs GROUP BY season, p.r),
coverage AS (
  SELECT season, count(*) AS n, count(*) FILTER (WHERE l_returnflag IN ('R', 'A')) AS charted
  FROM lineitem JOIN orders_of ON l_orderkey = play_id GROUP BY season)
SELECT 'scheme-denominators' AS check_group, 'denominator[' || names.r || ']' AS "check", CAST(s.season AS BIGINT) AS season,
       CAST(coalesce(n, 0) AS BIGINT) AS n, coalesce(loose = 0 AND over = 0, false) AS passed,
       coalesce('loose=' || loose || ' over=' || over, 'no rows') AS detail
FROM seasons s CROSS JOIN (SELECT DISTINCT p.r AS r FROM pairs) names
LEFT JOIN scheme ON scheme.season = s.season AND scheme.r = names.r
UNION ALL
SELECT 'participation-coverage', 'coverage_matrix', CAST(s.season AS BIGINT), CAST(coalesce(n, 0) AS BIGINT),
       coalesce(CASE WHEN s.season = 2017 THEN charted / n <= 0.001 ELSE charted / n <= 0.497 END, false),
       coalesce('charted=' || charted, 'no rows')
FROM seasons s LEFT JOIN coverage USING (season)
"""
