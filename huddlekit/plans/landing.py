"""Feed-document bindings: every event is turned into one landed ADP
document (feed A: nested JSON with a players list; feed B: string-typed JSON
whose player node is missing, an object or a list), then parsed and
conformed. The k value in ``props`` decides the document shape."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddlekit.sources.feeds import (FEED_A_FORMATS, FEED_B_FORMATS, conform_feed_a,
                                     conform_feed_b, parse_feed_a)
from huddlekit.plans.tables import rounded, table

SNAPSHOT_DATE = "2024-02-01"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def feed_a_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    k = F.col("k")

    def player(offset: int, bump: float):
        return F.struct(
            (F.col("event_id") + offset).alias("player_id"),
            F.concat(F.lit("u"), F.col("user_id")).alias("name"),
            F.col("event_type").alias("position"),
            F.upper(F.substring("event_type", 1, 3)).alias("team"),
            (F.col("value") + bump).alias("adp"),
            F.col("value").cast("string").alias("adp_formatted"),
            k.cast("long").alias("times_drafted"),
            (k % 5 + 1).cast("long").alias("high"),
            (k + 5).cast("long").alias("low"),
            (F.col("value") / 10).alias("stdev"),
            (k % 14).cast("long").alias("bye"))

    no_players = F.filter(F.array(player(0, 0.0)), lambda x: F.lit(False))
    players = (F.when((k % 10 == 0), no_players)
               .when(k % 10 == 5, F.lit(None))
               .when(k % 2 == 0, F.array(player(0, 0.0), player(1_000_000_000, 1.0)))
               .otherwise(F.array(player(0, 0.0))))
    doc = F.struct(
        F.when(k % 10 == 5, "Error").otherwise("Success").alias("status"),
        F.lit(None).cast("string").alias("errors"),
        F.struct(F.lit("adp").alias("type"),
                 (10 + 2 * (F.col("user_id") % 2)).cast("long").alias("teams"),
                 F.lit(15).cast("long").alias("rounds"),
                 F.when(k % 10 != 5, F.col("user_id") * 3).alias("total_drafts"),
                 F.date_format("ts", "yyyy-MM-dd").alias("start_date"),
                 F.when(k % 7 == 0, F.lit("soon"))
                  .otherwise(F.date_format(F.date_add(F.to_date("ts"), 3), "yyyy-MM-dd"))
                  .alias("end_date")).alias("meta"),
        players.alias("players"))
    fmt = F.element_at(F.array(*[F.lit(x) for x in FEED_A_FORMATS]),
                       (F.col("user_id") % len(FEED_A_FORMATS) + 1).cast("int"))
    return ev.select(F.year("ts").cast("long").alias("season"), fmt.alias("scoring_format"),
                     (10 + 2 * (F.col("user_id") % 2)).cast("long").alias("teams"),
                     F.to_json(doc).alias("raw"))


def conform_feed_a_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = feed_a_documents(spark, sf_dir)
    parsed = docs.select("season", "scoring_format", "teams", parse_feed_a(F.col("raw")).alias("d")) \
        .select("season", "scoring_format", "teams", "d.*")
    return rounded(conform_feed_a(parsed, SNAPSHOT_DATE).drop("ingested_at"))


_FMT_A = "[" + ", ".join(f"'{x}'" for x in FEED_A_FORMATS) + "]"
_FMT_B = "[" + ", ".join(f"'{x}'" for x in FEED_B_FORMATS) + "]"

CONFORM_FEED_A_SQL = f"""
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
p AS (
  SELECT e.*, 0 AS off, 0.0 AS bump FROM e WHERE k % 10 NOT IN (0, 5)
  UNION ALL
  SELECT e.*, 1000000000 AS off, 1.0 AS bump FROM e WHERE k % 10 NOT IN (0, 5) AND k % 2 = 0)
SELECT 'ffc' AS source, CAST(year(ts) AS BIGINT) AS season,
       {_FMT_A}[user_id % {len(FEED_A_FORMATS)} + 1] AS scoring_format,
       CAST(10 + 2 * (user_id % 2) AS BIGINT) AS teams, DATE '{SNAPSHOT_DATE}' AS snapshot_date,
       CAST(event_id + off AS VARCHAR) AS source_player_id, CAST(NULL AS VARCHAR) AS gsis_id,
       'u' || user_id AS player_name, event_type AS position, upper(substr(event_type, 1, 3)) AS team,
       round(value + bump, 6) AS adp, CAST(value AS VARCHAR) AS adp_formatted,
       round(value / 10, 6) AS adp_stdev, CAST(k % 5 + 1 AS BIGINT) AS adp_earliest_pick,
       CAST(k + 5 AS BIGINT) AS adp_latest_pick, CAST(k AS BIGINT) AS times_drafted,
       CAST(NULL AS DOUBLE) AS draft_selected_pct, CAST(NULL AS BIGINT) AS source_rank,
       CAST(user_id * 3 AS BIGINT) AS total_drafts, CAST(k % 14 AS BIGINT) AS bye,
       CAST(ts AS DATE) AS window_start_date,
       CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(ts AS DATE) + 3 END AS window_end_date,
       CAST(NULL AS BOOLEAN) AS is_keeper, CAST(NULL AS BOOLEAN) AS is_mock
FROM p
"""


def feed_b_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    k = F.col("k")

    def obj(offset: int, bump: float):
        avg = F.when(F.col("event_type") == "error", F.lit("n/a")) \
            .otherwise((F.col("value") + bump).cast("string"))
        return F.to_json(F.struct(
            (F.col("event_id") + offset).cast("string").alias("id"),
            k.cast("string").alias("rank"), avg.alias("averagePick"),
            (k % 5 + 1).cast("string").alias("minPick"),
            (k + 5).cast("string").alias("maxPick"),
            (F.col("user_id") * 2).cast("string").alias("draftsSelectedIn"),
            F.concat(k.cast("string"), F.lit(".5")).alias("draftSelPct")))

    head = F.concat(F.lit('{"adp":{"totalDrafts":"'), F.col("user_id").cast("string"), F.lit('"'))
    raw = (F.when(k % 4 == 0, F.concat(head, F.lit(',"player":'), obj(0, 0.0), F.lit("}}")))
           .when(k % 4 == 1, F.concat(head, F.lit(',"player":['), obj(0, 0.0), F.lit(","),
                                      obj(1_000_000_000, 1.0), F.lit("]}}")))
           .when(k % 4 == 2, F.concat(head, F.lit("}}")))
           .otherwise(F.lit('{"version":"1.0"}')))
    fmt = F.element_at(F.array(*[F.lit(x) for x in FEED_B_FORMATS]),
                       (F.col("user_id") % len(FEED_B_FORMATS) + 1).cast("int"))
    return ev.select(F.year("ts").cast("long").alias("season"), fmt.alias("scoring_format"),
                     F.lit(12).cast("long").alias("teams"), raw.alias("raw"))


def conform_feed_b_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(conform_feed_b(feed_b_documents(spark, sf_dir), SNAPSHOT_DATE).drop("ingested_at"))


CONFORM_FEED_B_SQL = f"""
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
p AS (
  SELECT e.*, 0 AS off, 0.0 AS bump FROM e WHERE k % 4 IN (0, 1)
  UNION ALL
  SELECT e.*, 1000000000 AS off, 1.0 AS bump FROM e WHERE k % 4 = 1)
SELECT 'mfl' AS source, CAST(year(ts) AS BIGINT) AS season,
       {_FMT_B}[user_id % {len(FEED_B_FORMATS)} + 1] AS scoring_format,
       CAST(12 AS BIGINT) AS teams, DATE '{SNAPSHOT_DATE}' AS snapshot_date,
       CAST(event_id + off AS VARCHAR) AS source_player_id, CAST(NULL AS VARCHAR) AS gsis_id,
       CAST(NULL AS VARCHAR) AS player_name, CAST(NULL AS VARCHAR) AS position,
       CAST(NULL AS VARCHAR) AS team,
       CASE WHEN event_type = 'error' THEN NULL ELSE round(value + bump, 6) END AS adp,
       CAST(NULL AS VARCHAR) AS adp_formatted, CAST(NULL AS DOUBLE) AS adp_stdev,
       CAST(k % 5 + 1 AS BIGINT) AS adp_earliest_pick, CAST(k + 5 AS BIGINT) AS adp_latest_pick,
       CAST(user_id * 2 AS BIGINT) AS times_drafted, round(CAST(k AS DOUBLE) + 0.5, 6) AS draft_selected_pct,
       CAST(k AS BIGINT) AS source_rank, CAST(user_id AS BIGINT) AS total_drafts,
       CAST(NULL AS BIGINT) AS bye, CAST(NULL AS DATE) AS window_start_date,
       CAST(NULL AS DATE) AS window_end_date,
       CAST(NULL AS BOOLEAN) AS is_keeper, CAST(NULL AS BOOLEAN) AS is_mock
FROM p
"""
