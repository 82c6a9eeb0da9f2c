"""Scoring, ranking and identity bindings on the driver's tables.

* weekly ranks: an event is a player-week stat line; its type is the position
  and the rounded value the points (13 stands for a missing value).
* weekly points: a line item is a player-week stat line (part = player,
  return flag = position, ship month = week); the carried PPR total includes
  a feed-side adjustment for returned lines, so it differs from a recomputation.
* identity: orders carry a dirty customer id (feed B, exact id); parts carry
  a noisy display name (feed A, by name); customers and parts are the bridge.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddlekit.operators.identity import (bridge_index, id_key, index_tally, name_key, resolve_any, resolve_by_id,
                                          resolve_by_name, resolve_ids)
from huddlekit.operators.scoring import dense_rank_desc, points_weekly
from huddlekit.operators.skew import top_by_value
from huddlekit.plans.tables import rounded, table

SQL_NORMALIZE = ("coalesce(regexp_replace(trim(regexp_replace(regexp_replace(lower({x}), "
                 "'[.''’]', '', 'g'), '\\s+', ' ', 'g')), '( (jr|sr|ii|iii|iv|v))+$', ''), '')")


def _events_week(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", F.year("ts").cast("long").alias("season"),
        (F.floor((F.dayofyear("ts") - 1) / 7) + 1).cast("long").alias("week"),
        F.col("event_type").alias("position"),
        F.nullif(F.round("value"), F.lit(13.0)).alias("points"))


def weekly_position_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_week(table(spark, sf_dir, "events"))
    return dense_rank_desc(ev, "points", out="position_rank")


WEEKLY_POSITION_RANK_SQL = """
WITH e AS (
  SELECT event_id, CAST(year(ts) AS BIGINT) AS season,
         CAST(floor((dayofyear(ts) - 1) / 7) + 1 AS BIGINT) AS week,
         event_type AS position, nullif(round(value), 13.0) AS points
  FROM events)
SELECT event_id, season, week, position, points,
       CASE WHEN points IS NOT NULL THEN CAST(dense_rank() OVER (
         PARTITION BY season, week, position, points IS NULL ORDER BY points DESC) AS BIGINT)
       END AS position_rank
FROM e
"""


def top_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three highest values of every position and week, ties included."""
    ev = _events_week(table(spark, sf_dir, "events"))
    return top_by_value(ev, "points", ["season", "week", "position"], 3, "position_rank")


TOP_WEEKLY_SQL = f"SELECT * FROM ({WEEKLY_POSITION_RANK_SQL}) WHERE position_rank <= 3"


def _line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    std = F.col("l_extendedprice") / 1000
    adj = F.when(F.col("l_returnflag") == "R", F.col("l_tax")).otherwise(F.lit(0.0))
    return li.select(
        F.year("l_shipdate").alias("season"), F.month("l_shipdate").alias("week"),
        F.col("l_partkey").cast("string").alias("player_id"),
        F.concat(F.lit("line "), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"))
         .alias("player_name"),
        F.col("l_returnflag").alias("position"), F.col("l_linestatus").alias("team"),
        F.col("l_quantity").cast("long").alias("receptions"),
        std.alias("fantasy_points"),
        (std + F.col("l_quantity") + adj).alias("fantasy_points_ppr"))


def points_weekly_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(points_weekly(_line_stats(spark, sf_dir)))


LINE_STATS_SQL = """
SELECT CAST(year(l_shipdate) AS BIGINT) AS season, CAST(month(l_shipdate) AS BIGINT) AS week,
       CAST(l_partkey AS VARCHAR) AS gsis_id,
       'line ' || l_orderkey || '-' || l_linenumber AS player_name,
       l_returnflag AS position, l_linestatus AS team,
       CAST(l_quantity AS BIGINT) AS receptions,
       l_extendedprice / 1000 AS fantasy_points_standard,
       l_extendedprice / 1000 + l_quantity
         + CASE WHEN l_returnflag = 'R' THEN l_tax ELSE 0.0 END AS fantasy_points_ppr
FROM lineitem
"""

POINTS_WEEKLY_SQL = f"""
WITH s AS ({LINE_STATS_SQL})
SELECT season, week, gsis_id AS player_id, gsis_id, player_name, position, team, receptions,
       round(fantasy_points_standard, 6) AS fantasy_points_standard,
       round(fantasy_points_standard + 0.5 * receptions, 6) AS fantasy_points_half_ppr,
       round(fantasy_points_ppr, 6) AS fantasy_points_ppr,
       CASE WHEN fantasy_points_ppr IS NOT NULL THEN CAST(dense_rank() OVER (
         PARTITION BY season, week, position ORDER BY fantasy_points_ppr DESC) AS BIGINT)
       END AS position_rank_ppr
FROM s
"""


# --- identity -------------------------------------------------------------

def dirty_customer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_custkey").cast("string")
    sid = (F.when(F.col("o_orderpriority") == "5-LOW", F.concat(k, F.lit(".0")))
           .when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderkey") % 7 == 0),
                 F.concat(F.lit("x"), k))
           .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(k, F.lit(".5")))
           .otherwise(k))
    return o.select("o_orderkey", sid.alias("source_player_id"))


DIRTY_IDS_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_custkey AS VARCHAR) || '.0'
            WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderkey % 7 = 0 THEN 'x' || CAST(o_custkey AS VARCHAR)
            WHEN o_orderpriority = '3-MEDIUM' THEN CAST(o_custkey AS VARCHAR) || '.5'
            ELSE CAST(o_custkey AS VARCHAR) END AS source_player_id
FROM orders
"""


def customer_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id bridge from customers: NULL target id for household customers and a
    second, conflicting row for every customer with a negative balance."""
    cu = table(spark, sf_dir, "customer")
    base = cu.select(F.col("c_custkey").alias("mfl_id"),
                     F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_name")).alias("gsis_id"))
    dup = cu.where(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("mfl_id"), F.concat(F.col("c_name"), F.lit("-b")).alias("gsis_id"))
    return base.unionByName(dup)


CUSTOMER_BRIDGE_SQL = """
SELECT c_custkey AS mfl_id, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_name END AS gsis_id FROM customer
UNION ALL
SELECT c_custkey AS mfl_id, c_name || '-b' AS gsis_id FROM customer WHERE c_acctbal < 0
"""


def resolve_exact_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = dirty_customer_ids(spark, sf_dir)
    return resolve_by_id(facts, customer_bridge(spark, sf_dir), out="gsis_id")


def _sql_to_long(x: str) -> str:
    return (f"coalesce(CASE WHEN regexp_matches({x}, '^\\s*[+-]?[0-9]+\\s*$') THEN TRY_CAST(trim({x}) AS BIGINT) END, CASE WHEN TRY_CAST(trim({x}) AS DOUBLE) = "
            f"floor(TRY_CAST(trim({x}) AS DOUBLE)) THEN CAST(TRY_CAST(trim({x}) AS DOUBLE) AS BIGINT) END)")


RESOLVE_EXACT_ID_SQL = f"""
WITH f AS ({DIRTY_IDS_SQL}),
b AS ({CUSTOMER_BRIDGE_SQL}),
u AS (SELECT mfl_id, any_value(gsis_id) AS gid FROM b WHERE gsis_id IS NOT NULL AND mfl_id IS NOT NULL
      GROUP BY mfl_id HAVING count(*) = 1)
SELECT f.o_orderkey, f.source_player_id, u.gid AS gsis_id
FROM f LEFT JOIN u ON {_sql_to_long('f.source_player_id')} = u.mfl_id
"""


def noisy_part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    n = F.col("p_name")
    m = F.col("p_size") % 5
    noisy = (F.when(m == 0, F.concat(F.upper(n), F.lit(" Jr.")))
             .when(m == 1, F.regexp_replace(n, r"^(\S+) ", "$1. "))
             .when(m == 2, F.concat(F.lit("  "), n, F.lit("   III")))
             .when(m == 3, F.concat(F.regexp_replace(n, " ", "  "), F.lit("'")))
             .when(F.col("p_retailprice") > 1500, F.lit(None))
             .otherwise(F.concat(n, F.lit(" v"))))
    pos = F.concat_ws("|", "p_brand", "p_type", F.col("p_size").cast("string"))
    return p.select("p_partkey", noisy.alias("player_name"), pos.alias("position"))


NOISY_NAMES_SQL = """
SELECT p_partkey,
       CASE WHEN p_size % 5 = 0 THEN upper(p_name) || ' Jr.'
            WHEN p_size % 5 = 1 THEN regexp_replace(p_name, '^(\\S+) ', '\\1. ')
            WHEN p_size % 5 = 2 THEN '  ' || p_name || '   III'
            WHEN p_size % 5 = 3 THEN replace(p_name, ' ', '  ') || ''''
            WHEN p_retailprice > 1500 THEN NULL
            ELSE p_name || ' v' END AS player_name,
       p_brand || '|' || p_type || '|' || CAST(p_size AS VARCHAR) AS position
FROM part
"""


def part_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.lit(None).cast("long").alias("mfl_id"),
                    F.concat(F.lit("P"), F.col("p_partkey")).alias("gsis_id"),
                    F.col("p_name").alias("merge_name"),
                    F.concat_ws("|", "p_brand", "p_type", F.col("p_size").cast("string")).alias("position"))


PART_BRIDGE_SQL = """
SELECT CAST(NULL AS BIGINT) AS mfl_id, 'P' || p_partkey AS gsis_id, p_name AS merge_name,
       p_brand || '|' || p_type || '|' || CAST(p_size AS VARCHAR) AS position
FROM part
"""

NAME_UNIQUE_SQL = f"""
SELECT {SQL_NORMALIZE.format(x='merge_name')} AS k_name, coalesce(position, '') AS k_pos,
       any_value(gsis_id) AS gid
FROM bridge WHERE gsis_id IS NOT NULL AND {SQL_NORMALIZE.format(x='merge_name')} <> ''
GROUP BY 1, 2 HAVING count(*) = 1
"""


def resolve_by_name_refusing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_by_name(noisy_part_names(spark, sf_dir), part_bridge(spark, sf_dir),
                           out="gsis_id")


RESOLVE_BY_NAME_SQL = f"""
WITH f AS ({NOISY_NAMES_SQL}),
bridge AS ({PART_BRIDGE_SQL}),
u AS ({NAME_UNIQUE_SQL})
SELECT f.p_partkey, f.player_name, f.position, u.gid AS gsis_id
FROM f LEFT JOIN u ON {SQL_NORMALIZE.format(x='f.player_name')} = u.k_name
  AND coalesce(f.position, '') = u.k_pos AND {SQL_NORMALIZE.format(x='f.player_name')} <> ''
"""


def mixed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_id = dirty_customer_ids(spark, sf_dir).select(
        F.lit("mfl").alias("source"), "source_player_id",
        F.lit(None).cast("string").alias("player_name"),
        F.lit(None).cast("string").alias("position"))
    by_name = noisy_part_names(spark, sf_dir).select(
        F.lit("ffc").alias("source"), F.col("p_partkey").cast("string").alias("source_player_id"),
        "player_name", "position")
    return by_id.unionByName(by_name)


def resolve_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    cb = customer_bridge(spark, sf_dir).select(
        "mfl_id", "gsis_id", F.lit(None).cast("string").alias("merge_name"),
        F.lit(None).cast("string").alias("position"))
    bridge = cb.unionByName(part_bridge(spark, sf_dir))
    facts = mixed_facts(spark, sf_dir).withColumn("gsis_id", F.lit(None).cast("string"))
    return resolve_ids(facts, bridge)


RESOLVE_MIXED_SQL = f"""
WITH f AS (
  SELECT 'mfl' AS source, source_player_id, CAST(NULL AS VARCHAR) AS player_name,
         CAST(NULL AS VARCHAR) AS position FROM ({DIRTY_IDS_SQL})
  UNION ALL
  SELECT 'ffc', CAST(p_partkey AS VARCHAR), player_name, position FROM ({NOISY_NAMES_SQL})),
bridge AS (
  SELECT mfl_id, gsis_id, CAST(NULL AS VARCHAR) AS merge_name, CAST(NULL AS VARCHAR) AS position
  FROM ({CUSTOMER_BRIDGE_SQL})
  UNION ALL {PART_BRIDGE_SQL}),
ui AS (SELECT mfl_id, any_value(gsis_id) AS gid FROM bridge
       WHERE gsis_id IS NOT NULL AND mfl_id IS NOT NULL GROUP BY mfl_id HAVING count(*) = 1),
un AS ({NAME_UNIQUE_SQL})
SELECT f.source, f.source_player_id, f.player_name, f.position,
       CASE WHEN f.source = 'mfl' THEN ui.gid WHEN f.source = 'ffc' THEN un.gid END AS gsis_id
FROM f
LEFT JOIN ui ON f.source = 'mfl' AND {_sql_to_long('f.source_player_id')} = ui.mfl_id
LEFT JOIN un ON f.source = 'ffc' AND {SQL_NORMALIZE.format(x='f.player_name')} = un.k_name
  AND coalesce(f.position, '') = un.k_pos AND {SQL_NORMALIZE.format(x='f.player_name')} <> ''
"""


# --- any id system, refused keys ------------------------------------------------

def _wide_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a bridge with three id systems: a number, a name that is
    unique and a text id that several customers share."""
    cu = table(spark, sf_dir, "customer")
    return cu.select(F.col("c_custkey").alias("mfl_id"), F.concat(F.lit(" "), F.col("c_name")).alias("yahoo_id"),
                     F.concat_ws("-", "c_mktsegment", (F.col("c_custkey") / 3).cast("long").cast("string")).alias("pfr_id"),
                     F.when(F.col("c_nationkey") != 7, F.concat(F.lit("00-"), F.col("c_custkey"))).alias("gsis_id"))


def _asked_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that name their customer in one system or another."""
    cu = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders").join(cu, F.col("o_custkey") == F.col("c_custkey"))
    p = F.substring("o_orderpriority", 1, 1)
    system = (F.when(p == "1", "mfl_id").when(p == "2", "yahoo_id").when(p == "3", "pfr_id").when(p == "4", "espn_id"))
    key = (F.when(p == "1", F.concat(F.lit("0"), F.col("o_custkey"), F.lit(".0"))).when(p == "2", F.col("c_name"))
           .otherwise(F.concat_ws("-", "c_mktsegment", (F.col("c_custkey") / 3).cast("long").cast("string"))))
    return o.select("o_orderkey", system.alias("id_system"),
                    F.when(F.col("o_orderstatus") != "P", key).alias("id"))


def resolve_any_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_any(_asked_ids(spark, sf_dir), _wide_bridge(spark, sf_dir), ["mfl_id", "yahoo_id", "pfr_id"],
                       outcome="outcome")


RESOLVE_ANY_ID_SQL = """
WITH bridge AS (
  SELECT CAST(c_custkey AS VARCHAR) AS mfl, c_name AS yahoo, c_mktsegment || '-' || (c_custkey // 3) AS pfr,
         CASE WHEN c_nationkey <> 7 THEN '00-' || c_custkey END AS gid FROM customer),
index AS (
  SELECT system, k, count(*) AS n, min(gid) AS gid FROM (
    SELECT 'mfl_id' AS system, mfl AS k, gid FROM bridge UNION ALL SELECT 'yahoo_id', yahoo, gid FROM bridge
    UNION ALL SELECT 'pfr_id', pfr, gid FROM bridge) WHERE gid IS NOT NULL GROUP BY system, k),
asked AS (
  SELECT o_orderkey, CASE o_orderpriority[1] WHEN '1' THEN 'mfl_id' WHEN '2' THEN 'yahoo_id' WHEN '3' THEN 'pfr_id'
                          WHEN '4' THEN 'espn_id' END AS id_system,
         CASE WHEN o_orderstatus <> 'P' THEN CASE o_orderpriority[1] WHEN '1' THEN '0' || o_custkey || '.0'
              WHEN '2' THEN c_name ELSE c_mktsegment || '-' || (c_custkey // 3) END END AS id,
         CASE WHEN o_orderstatus <> 'P' THEN CASE o_orderpriority[1] WHEN '1' THEN CAST(o_custkey AS VARCHAR)
              WHEN '2' THEN c_name WHEN '3' THEN c_mktsegment || '-' || (c_custkey // 3) END END AS k
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, id_system, id, CASE WHEN n = 1 THEN gid END AS gsis_id,
       CASE WHEN a.k IS NULL THEN 'no key' WHEN n IS NULL THEN 'unknown' WHEN n > 1 THEN 'refused'
            ELSE 'resolved' END AS outcome
FROM asked a LEFT JOIN index i ON i.system = a.id_system AND i.k = a.k
"""


def refused_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the two bridges and how many of them are refused."""
    names = bridge_index(part_bridge(spark, sf_dir), {"name": name_key("merge_name", "position"),
                                                      "name alone": name_key("merge_name", F.lit(""))})
    ids = bridge_index(customer_bridge(spark, sf_dir), {"id": id_key("mfl_id")})
    return index_tally(names).unionByName(index_tally(ids))


REFUSED_KEYS_SQL = f"""
WITH bridge AS ({PART_BRIDGE_SQL}), ids AS ({CUSTOMER_BRIDGE_SQL}),
keys AS (
  SELECT 'name' AS system, {SQL_NORMALIZE.format(x='merge_name')} || '|' || coalesce(position, '') AS k FROM bridge
  WHERE {SQL_NORMALIZE.format(x='merge_name')} <> ''
  UNION ALL
  SELECT 'name alone', {SQL_NORMALIZE.format(x='merge_name')} FROM bridge WHERE {SQL_NORMALIZE.format(x='merge_name')} <> ''
  UNION ALL
  SELECT 'id', CAST(mfl_id AS VARCHAR) FROM ids WHERE gsis_id IS NOT NULL)
SELECT system, count(*)::BIGINT AS keys, (count(*) FILTER (WHERE n > 1))::BIGINT AS refused
FROM (SELECT system, k, count(*) AS n FROM keys GROUP BY ALL) GROUP BY system
"""
