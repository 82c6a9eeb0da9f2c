"""Team-week scheme fingerprint bound to the driver's order tables.

Mapping: an order is a play (``orders`` joined to ``customer``); status F is a
pass, O a run, P a special-teams snap that the fingerprint filters out. The
season is the order year, the week the order month, the team the customer's
nation (nation 24 stands for a play with no team). Every line item is a row of
both charting feeds, with its personnel as text (``layouts``). Nation names are
the team-week labels.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddlekit.operators.fingerprint import team_week_fingerprint
from huddlekit.plans.layouts import (SNAP_COLUMNS_SQL, SQL_LEGACY_LABS, SQL_LEGACY_NUMS, _sql_legacy_select,
                                     snap_encodings)
from huddlekit.plans.tables import rounded, table


def plays_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    prio = F.col("o_orderpriority")
    return (o.join(cu, o.o_custkey == cu.c_custkey, "inner")
            .select(F.year("o_orderdate").cast("long").alias("season"),
                    F.month("o_orderdate").cast("long").alias("week"),
                    F.nullif(F.col("c_nationkey"), F.lit(24)).cast("string").alias("team"),
                    F.col("o_orderkey").cast("double").alias("play_id"),
                    F.when(F.col("o_orderstatus") == "F", "pass")
                     .when(F.col("o_orderstatus") == "O", "run")
                     .otherwise("special").alias("play_type"),
                    prio.isin("1-URGENT", "2-HIGH").cast("long").alias("shotgun"),
                    (prio == "3-MEDIUM").cast("long").alias("no_huddle"),
                    F.when(prio != "5-LOW", F.col("o_totalprice")).alias("pass_oe"),
                    F.col("o_totalprice").alias("epa")))


def participation_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = snap_encodings(table(spark, sf_dir, "lineitem"))
    rf = F.col("l_returnflag")
    return li.select(
        F.col("l_orderkey").alias("play_id"),
        F.when(rf == "R", "MAN_COVERAGE").when(rf == "A", "ZONE_COVERAGE")
         .when(F.col("l_linenumber") % 2 == 0, "  ").alias("defense_man_zone_type"),
        F.col("l_quantity").alias("defenders_in_box"),
        F.when(rf != "N", F.col("l_linestatus") == "F").alias("was_pressure"),
        "offense_positions", "offense_personnel")


def ftn_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("play_id"),
        (F.col("l_returnflag") == "R").alias("is_play_action"),
        (F.col("l_returnflag") == "A").alias("is_motion"),
        (F.col("l_linestatus") == "O").alias("is_rpo"),
        (F.col("l_discount") >= 0.08).alias("is_screen_pass"),
        F.nullif(F.col("l_linenumber") - 2, F.lit(0)).alias("n_blitzers"),
        F.col("l_linenumber").alias("n_pass_rushers"))


def team_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("string").alias("team"),
                    F.col("n_name").alias("head_coach"))


def team_week_fingerprint_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    fp = team_week_fingerprint(plays_from_orders(spark, sf_dir),
                               participation_from_lineitem(spark, sf_dir),
                               ftn_from_lineitem(spark, sf_dir),
                               team_labels(spark, sf_dir), personnel=True)
    return rounded(fp)


# line items with their personnel counts (all seasons here are of the summary encoding)
_PERSONNEL_SQL = f"""SELECT l_orderkey, l_linenumber, {_sql_legacy_select()}
  FROM (SELECT *, {SQL_LEGACY_NUMS} AS nums, {SQL_LEGACY_LABS} AS labs
        FROM (SELECT l_orderkey, l_linenumber, {SNAP_COLUMNS_SQL.strip()} FROM lineitem))"""

TEAM_WEEK_FINGERPRINT_SQL = """
WITH plays AS (
  SELECT CAST(year(o.o_orderdate) AS BIGINT) AS season,
         CAST(month(o.o_orderdate) AS BIGINT) AS week,
         CAST(nullif(c.c_nationkey, 24) AS VARCHAR) AS team,
         CAST(o.o_orderkey AS BIGINT) AS play_id,
         o.o_orderstatus = 'F' AS is_pass,
         CASE WHEN o.o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1 ELSE 0 END AS shotgun,
         CASE WHEN o.o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END AS no_huddle,
         CASE WHEN o.o_orderpriority <> '5-LOW' THEN o.o_totalprice END AS pass_oe,
         o.o_totalprice AS epa
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderstatus IN ('F','O')
),
base AS (
  SELECT season, week, team, count(play_id) AS plays,
         avg(shotgun) AS shotgun_rate, avg(no_huddle) AS no_huddle_rate,
         avg(CAST(is_pass AS DOUBLE)) AS pass_rate, avg(pass_oe) AS proe,
         avg(epa) AS epa_per_play
  FROM plays WHERE team IS NOT NULL GROUP BY season, week, team
),
ref AS (SELECT DISTINCT play_id, season, week, team FROM plays WHERE team IS NOT NULL),
cov AS (
  SELECT r.season, r.week, r.team,
         count(*) FILTER (WHERE t.mz IS NOT NULL AND regexp_replace(t.mz, '\\s', '', 'g') <> '') AS charted,
         count(*) FILTER (WHERE t.mz = 'MAN_COVERAGE') AS n_man,
         count(*) FILTER (WHERE t.mz = 'ZONE_COVERAGE') AS n_zone,
         avg(CASE WHEN t.mz IS NOT NULL AND regexp_replace(t.mz, '\\s', '', 'g') <> '' THEN t.dib END) AS avg_dib,
         count(t.wp) AS p_charted,
         count(*) FILTER (WHERE t.wp) AS n_pressure
  FROM (SELECT l_orderkey AS play_id,
               CASE WHEN l_returnflag = 'R' THEN 'MAN_COVERAGE'
                    WHEN l_returnflag = 'A' THEN 'ZONE_COVERAGE'
                    WHEN l_linenumber % 2 = 0 THEN '  ' END AS mz,
               l_quantity AS dib,
               CASE WHEN l_returnflag <> 'N' THEN l_linestatus = 'F' END AS wp
        FROM lineitem) t
  JOIN ref r ON t.play_id = r.play_id
  GROUP BY r.season, r.week, r.team
),
pers AS (
  SELECT r.season, r.week, r.team, count(*) FILTER (WHERE plausible) AS n,
         count(*) FILTER (WHERE plausible AND n_rb = 1 AND n_te = 1) AS n11,
         count(*) FILTER (WHERE plausible AND n_rb = 1 AND n_te = 2) AS n12,
         count(*) FILTER (WHERE plausible AND n_rb = 2 AND n_te = 1) AS n21
  FROM (PERSONNEL) t JOIN ref r ON t.l_orderkey = r.play_id
  GROUP BY r.season, r.week, r.team
),
ftn AS (
  SELECT r.season, r.week, r.team, count(t.play_id) AS n,
         count(*) FILTER (WHERE t.pa) AS n_pa, count(*) FILTER (WHERE t.mo) AS n_mo,
         count(*) FILTER (WHERE t.rpo) AS n_rpo, count(*) FILTER (WHERE t.scr) AS n_scr,
         count(*) FILTER (WHERE coalesce(t.nb, 0) >= 1) AS n_blitz,
         avg(t.nr) AS avg_rush
  FROM (SELECT l_orderkey AS play_id, l_returnflag = 'R' AS pa, l_returnflag = 'A' AS mo,
               l_linestatus = 'O' AS rpo, l_discount >= 0.08 AS scr,
               nullif(l_linenumber - 2, 0) AS nb, l_linenumber AS nr
        FROM lineitem) t
  JOIN ref r ON t.play_id = r.play_id
  GROUP BY r.season, r.week, r.team
)
SELECT b.season, b.week, b.team, n.n_name AS head_coach,
       CAST(b.plays AS BIGINT) AS plays,
       round(b.shotgun_rate, 6) AS shotgun_rate, round(b.no_huddle_rate, 6) AS no_huddle_rate,
       round(b.pass_rate, 6) AS pass_rate, round(b.proe, 6) AS proe,
       round(b.epa_per_play, 6) AS epa_per_play,
       CAST(pers.n AS BIGINT) AS plays_with_personnel, round(pers.n11 / nullif(pers.n, 0), 6) AS personnel_11_rate,
       round(pers.n12 / nullif(pers.n, 0), 6) AS personnel_12_rate,
       round(pers.n21 / nullif(pers.n, 0), 6) AS personnel_21_rate,
       CASE WHEN pers.n IS NOT NULL THEN 'offense_personnel' END AS personnel_source,
       CAST(cov.charted AS BIGINT) AS plays_charted_coverage,
       round(cov.n_man / nullif(cov.charted, 0), 6) AS man_rate,
       round(cov.n_zone / nullif(cov.charted, 0), 6) AS zone_rate,
       round(cov.avg_dib, 6) AS avg_defenders_in_box,
       CAST(cov.p_charted AS BIGINT) AS plays_charted_pressure,
       round(cov.n_pressure / nullif(cov.p_charted, 0), 6) AS pressure_rate,
       CAST(ftn.n AS BIGINT) AS plays_charted_ftn,
       round(ftn.n_pa / nullif(ftn.n, 0), 6) AS play_action_rate,
       round(ftn.n_mo / nullif(ftn.n, 0), 6) AS motion_rate,
       round(ftn.n_rpo / nullif(ftn.n, 0), 6) AS rpo_rate,
       round(ftn.n_scr / nullif(ftn.n, 0), 6) AS screen_rate,
       round(ftn.n_blitz / nullif(ftn.n, 0), 6) AS blitz_rate,
       round(ftn.avg_rush, 6) AS avg_pass_rushers
FROM base b
LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = b.team
LEFT JOIN cov ON cov.season = b.season AND cov.week = b.week AND cov.team = b.team
LEFT JOIN pers ON pers.season = b.season AND pers.week = b.week AND pers.team = b.team
LEFT JOIN ftn ON ftn.season = b.season AND ftn.week = b.week AND ftn.team = b.team
""".replace("PERSONNEL", _PERSONNEL_SQL)
