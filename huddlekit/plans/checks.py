"""Quality checks, trend queries and bridge joins bound to the driver's
tables.

* checks run on the results of other bindings (fingerprint, weekly points,
  mixed resolution) and on line-item grains;
* trends: an event user is an entity captured daily; the day's "coach" is
  the type of its highest-value event;
* joins: events as play-level charting with a double play id on one side
  and a string one on the other; line items as snap rows joined to a
  supplier bridge whose duplicated ids are refused.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddlekit.functions.exprs import is_charted, to_long
from huddlekit.operators.fingerprint import team_week_fingerprint, unique_on
from huddlekit.operators.quality import (fill_matrix_check, grain_checks, rate_denominator_checks,
                                         reconcile_check, resolution_check, summarize)
from huddlekit.operators.scoring import points_weekly
from huddlekit.operators.skew import left_lookup
from huddlekit.operators.trends import (before_after, day_over_day, market_vs_output, stint_summary,
                                        stints)
from huddlekit.plans import players, scheme
from huddlekit.plans.tables import rounded, table

# --- checks -----------------------------------------------------------------


def check_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution_check(players.resolve_mixed(spark, sf_dir))


CHECK_RESOLUTION_SQL = f"""
WITH r AS ({players.RESOLVE_MIXED_SQL})
SELECT 'resolution_rate[' || source || ']' AS "check", count(*) AS n, count(gsis_id) AS n_resolved,
       round(count(gsis_id) / count(*), 6) AS rate, count(gsis_id) / count(*) >= 0.6 AS passed
FROM r GROUP BY source
"""

GRAINS = {"lineitem_line": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
          "lineitem_order_line": ["l_orderkey", "l_linenumber"]}


def check_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    out = None
    for name, grain in GRAINS.items():
        g = grain_checks(li, grain, name)
        out = g if out is None else out.unionByName(g)
    return out


def _sql_grain(name: str, cols: list[str]) -> str:
    k = ", ".join(cols)
    return f"""
SELECT x.* FROM (
  SELECT count(*) AS groups, count(*) FILTER (WHERE c > 1) AS dup_groups, max(c) AS max_rows
  FROM (SELECT {k}, count(*) AS c FROM lineitem GROUP BY {k})) s,
  LATERAL (SELECT 'no_duplicates[{name}]' AS "check", s.groups, s.dup_groups, CAST(s.max_rows AS BIGINT) AS max_rows,
                  s.dup_groups = 0 AND s.groups > 0 AS passed
           UNION ALL
           SELECT 'snapshot_idempotent[{name}]', s.groups, s.dup_groups, CAST(s.max_rows AS BIGINT),
                  s.max_rows <= 1 AND s.groups > 0) x"""


CHECK_GRAIN_SQL = " UNION ALL ".join(_sql_grain(n, c) for n, c in GRAINS.items())


def check_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_check(points_weekly(players._line_stats(spark, sf_dir), rank=False))


CHECK_RECONCILE_SQL = f"""
WITH s AS ({players.LINE_STATS_SQL})
SELECT 'ppr_reconciles' AS "check", season, count(*) AS n,
       count(*) FILTER (WHERE abs(fantasy_points_standard + receptions - fantasy_points_ppr) > 0.01) AS n_unreconciled,
       count(*) FILTER (WHERE abs(fantasy_points_standard + receptions - fantasy_points_ppr) > 0.01) = 0
         AND count(*) > 0 AS passed
FROM s GROUP BY season
"""


def _fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return team_week_fingerprint(scheme.plays_from_orders(spark, sf_dir),
                                 scheme.participation_from_lineitem(spark, sf_dir),
                                 scheme.ftn_from_lineitem(spark, sf_dir),
                                 scheme.team_labels(spark, sf_dir))


def check_rate_denominators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_denominator_checks(_fingerprint(spark, sf_dir))


def _sql_rate_denominators() -> str:
    from huddlekit.operators.quality import RATE_DENOMINATOR_PAIRS
    parts = []
    for rate, den in RATE_DENOMINATOR_PAIRS:
        nd = f"count(*) FILTER (WHERE {rate} IS NOT NULL AND {den} IS NULL)"
        o1 = f"count(*) FILTER (WHERE {rate} IS NOT NULL AND {rate} > 1.0)"
        parts.append(f"SELECT season, count(*) AS n, 'scheme_denominators[{rate}]' AS \"check\", "
                     f"CAST({nd} AS BIGINT) AS null_denominator, CAST({o1} AS BIGINT) AS over_one, "
                     f"{nd} = 0 AND {o1} = 0 AND count(*) > 0 AS passed FROM fp GROUP BY season")
    return f"WITH fp AS ({scheme.TEAM_WEEK_FINGERPRINT_SQL}) " + " UNION ALL ".join(parts)


CHECK_RATE_DENOMINATORS_SQL = _sql_rate_denominators()

FILL_CEILING = 0.75


def check_fill_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    rf = F.col("l_returnflag")
    mz = (F.when(rf == "R", "MAN_COVERAGE").when(rf == "A", "ZONE_COVERAGE")
          .when(F.col("l_linenumber") % 2 == 0, "  "))
    df = li.select(F.year("l_shipdate").cast("long").alias("season"), mz.alias("mz"))
    return fill_matrix_check(df, is_charted(F.col("mz")), ceiling=FILL_CEILING)


CHECK_FILL_MATRIX_SQL = f"""
SELECT 'fill_matrix' AS "check", CAST(year(l_shipdate) AS BIGINT) AS season, count(*) AS n,
       count(*) FILTER (WHERE l_returnflag IN ('R', 'A')) AS n_filled,
       round(count(*) FILTER (WHERE l_returnflag IN ('R', 'A')) / count(*), 6) AS fill_rate,
       count(*) FILTER (WHERE l_returnflag IN ('R', 'A')) / count(*) <= {FILL_CEILING} + 0.001 AS passed
FROM lineitem GROUP BY 2
"""


def check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(check_resolution(spark, sf_dir), check_grain(spark, sf_dir),
                     check_reconcile(spark, sf_dir), check_rate_denominators(spark, sf_dir),
                     check_fill_matrix(spark, sf_dir))


CHECK_SUMMARY_SQL = f"""
WITH a AS (
  SELECT passed FROM ({CHECK_RESOLUTION_SQL})
  UNION ALL SELECT passed FROM ({CHECK_GRAIN_SQL})
  UNION ALL SELECT passed FROM ({CHECK_RECONCILE_SQL})
  UNION ALL SELECT passed FROM ({CHECK_RATE_DENOMINATORS_SQL})
  UNION ALL SELECT passed FROM ({CHECK_FILL_MATRIX_SQL}))
SELECT count(*) AS checks, count(*) FILTER (WHERE passed) AS passed_checks,
       coalesce(bool_and(passed), false) AS all_passed FROM a
"""

# --- trends -----------------------------------------------------------------


def _daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.groupBy("user_id", "event_type", F.to_date("ts").alias("day")) \
        .agg(F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("n_events"))


def drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(day_over_day(_daily_events(spark, sf_dir), ["user_id", "event_type"], "day",
                                "avg_value"))


DRIFT_SQL = """
WITH d AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, avg(value) AS avg_value,
                  count(*) AS n_events FROM events GROUP BY 1, 2, 3)
SELECT user_id, event_type, day, round(avg_value, 6) AS avg_value, n_events,
       round(lag(avg_value) OVER w, 6) AS prev_value,
       round(avg_value - lag(avg_value) OVER w, 6) AS drift,
       CAST(day - lag(day) OVER w AS INTEGER) AS gap_days
FROM d WINDOW w AS (PARTITION BY user_id, event_type ORDER BY day)
"""


def _daily_coach(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.max_by("event_type", F.struct("value", "event_id")).alias("coach"),
        F.avg("value").alias("avg_value"))


def _stint_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = stints(_daily_coach(spark, sf_dir), ["user_id"], "day", "coach")
    return stint_summary(marked, ["user_id"], "day", "coach", value="avg_value")


def tenure_stints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_stint_summary(spark, sf_dir))


_DAILY_COACH_SQL = """
SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, (value, event_id)) AS coach,
       avg(value) AS avg_value FROM events GROUP BY 1, 2
"""

_STINTS_SQL = f"""
WITH d AS ({_DAILY_COACH_SQL}),
m AS (SELECT *, CASE WHEN lag(coach) OVER (PARTITION BY user_id ORDER BY day) = coach THEN 0 ELSE 1 END AS chg
      FROM d),
s AS (SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS stint_no FROM m)
SELECT user_id, CAST(stint_no AS BIGINT) AS stint_no, any_value(coach) AS coach, min(day) AS start,
       max(day) AS "end", count(*) AS n, avg(avg_value) AS avg_value
FROM s GROUP BY user_id, stint_no
"""

TENURE_STINTS_SQL = f"""
SELECT user_id, stint_no, coach, start, "end", n, round(avg_value, 6) AS avg_value FROM ({_STINTS_SQL})
"""


def before_after_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(before_after(_stint_summary(spark, sf_dir), ["user_id"], "coach"))


BEFORE_AFTER_SQL = f"""
WITH s AS ({_STINTS_SQL})
SELECT user_id, stint_no, coach, start, "end", n, round(avg_value, 6) AS avg_value,
       lag(coach) OVER w AS prev_coach, round(lag(avg_value) OVER w, 6) AS prev_avg,
       round(avg_value - lag(avg_value) OVER w, 6) AS delta
FROM s WINDOW w AS (PARTITION BY user_id ORDER BY stint_no)
"""

# --- joins ------------------------------------------------------------------


def play_level_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    part = ev.select(
        F.col("user_id").cast("string").alias("game_id"),
        F.col("event_id").cast("double").alias("play_id"),
        F.col("event_type").alias("participation_type"))
    # the second feed charts the play after, and writes some ids as text no number can be read from
    ftn = ev.select(
        F.col("user_id").cast("string").alias("nflverse_game_id"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("x"), "event_id"))
        .otherwise((F.col("event_id") + F.col("event_id") % 2).cast("string")).alias("nflverse_play_id"),
        F.col("value").alias("ftn_value"))
    p = part.withColumn("play_id", to_long("play_id"))
    f = ftn.withColumn("nflverse_play_id", to_long("nflverse_play_id"))
    j = p.join(f, (p.game_id == f.nflverse_game_id) & (p.play_id == f.nflverse_play_id), "inner")
    return j.select("game_id", "play_id", "participation_type", "ftn_value")


PLAY_LEVEL_JOIN_SQL = """
SELECT CAST(a.user_id AS VARCHAR) AS game_id, a.event_id AS play_id,
       a.event_type AS participation_type, b.value AS ftn_value
FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_id = b.event_id + b.event_id % 2
WHERE b.event_type <> 'error'
"""


def bridge_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    su = table(spark, sf_dir, "supplier")
    snaps = li.select("l_orderkey", "l_linenumber", F.when(
        (F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1), F.lit(None))
        .otherwise(F.concat(F.lit("S"), F.col("l_suppkey"))).alias("pfr_player_id"))
    bridge = su.select(F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("S"), F.col("s_suppkey")))
                       .alias("pfr_id"), F.col("s_name").alias("bridge_name"))
    extra = su.where(F.col("s_nationkey") == 0).select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("pfr_id"),
        F.concat(F.col("s_name"), F.lit(" (alt)")).alias("bridge_name"))
    b = unique_on(bridge.unionByName(extra).where(F.col("pfr_id").isNotNull()), ["pfr_id"])
    j = left_lookup(snaps, b, F.col("pfr_player_id"), "pfr_id")
    return j.select("l_orderkey", "l_linenumber", "pfr_player_id", "bridge_name")


BRIDGE_LEFT_JOIN_SQL = """
WITH b AS (
  SELECT CASE WHEN s_acctbal >= 0 THEN 'S' || s_suppkey END AS pfr_id, s_name AS bridge_name FROM supplier
  UNION ALL
  SELECT 'S' || s_suppkey, s_name || ' (alt)' FROM supplier WHERE s_nationkey = 0),
u AS (SELECT pfr_id, any_value(bridge_name) AS bridge_name FROM b WHERE pfr_id IS NOT NULL
      GROUP BY pfr_id HAVING count(*) = 1),
s AS (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linestatus = 'O' AND l_linenumber = 1 THEN NULL ELSE 'S' || l_suppkey END AS pfr_player_id
      FROM lineitem)
SELECT s.l_orderkey, s.l_linenumber, s.pfr_player_id, u.bridge_name
FROM s LEFT JOIN u ON s.pfr_player_id = u.pfr_id
"""


def adp_vs_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name-resolved market rows (parts) against the weekly points of the
    resolved player (line items of that part)."""
    market = players.resolve_by_name_refusing(spark, sf_dir)
    pts = points_weekly(players._line_stats(spark, sf_dir), rank=False) \
        .withColumn("gsis_id", F.concat(F.lit("P"), F.col("gsis_id")))
    return rounded(market_vs_output(market, pts))


ADP_VS_POINTS_SQL = f"""
WITH m AS ({players.RESOLVE_BY_NAME_SQL}),
p AS (SELECT 'P' || gsis_id AS pid, sum(fantasy_points_ppr) AS total_points, count(*) AS weeks
      FROM ({players.LINE_STATS_SQL}) GROUP BY 1)
SELECT m.p_partkey, m.player_name, m.position, m.gsis_id, round(p.total_points, 6) AS total_points, p.weeks
FROM m LEFT JOIN p ON m.gsis_id = p.pid
"""
