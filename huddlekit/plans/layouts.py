"""Reshape, key-parsing, personnel and page bindings on the driver's tables.

* unpivot: a line item is a game between its part (home) and its supplier
  (away); the return flag and line status are the two coaches' labels; an
  unscheduled game (flag N, line 7) has the date 'TBD'.
* two eras: events before 2024-01-16 arrive in the legacy layout, later ones
  in the modern layout; the chunk being loaded is season 2023 (January games
  belong to the previous season). Legacy 'error' rows carry a wrong upstream
  season and are dropped by the season guard.
* keys: an order yields a game id ``YYYY_MM_<cust>_<prio>``; pending orders
  use '-' separators and every 11th open order has no year, so both parse to
  NULL.
* personnel: a line item is a charted snap; its list and summary encodings
  are built from line number, quantity and return flag.
* pages: title / heading / first navigation link of each page.
* wiki pages: every page is a capture of a team-season page (its id gives
  season and team, a larger id is a later capture) whose infobox names the
  host or the address as coordinator, as a link, a labelled link with a small
  note, or plain text; an address with ``=`` reads as a bled field. The job
  asks for all teams and seasons and one team that does not exist.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddlekit.functions.exprs import season_week_from_key
from huddlekit.functions.personnel import parse_legacy, parse_modern, with_personnel
from huddlekit.operators.jobs import sync_coordinators_from_pages
from huddlekit.operators.pages import TEAM_PAGE_NAMES, page_title, role_rows
from huddlekit.operators.reshape import reconcile_eras, season_guard, unpivot_sides
from huddlekit.plans.loads import taken
from huddlekit.plans.tables import table


# --- unpivot ----------------------------------------------------------------

def unpivot_sides_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    sched = li.select(
        F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
         .alias("game_id"),
        F.year("l_shipdate").alias("season"), F.month("l_shipdate").alias("week"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 7), F.lit("TBD"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("gameday"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("home_team"),
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("away_team"),
        F.col("l_returnflag").alias("home_coach"), F.col("l_linestatus").alias("away_coach"))
    return unpivot_sides(sched)


UNPIVOT_SIDES_SQL = """
WITH s AS (
  SELECT l_orderkey || '_' || l_linenumber AS game_id,
         CAST(year(l_shipdate) AS BIGINT) AS season, CAST(month(l_shipdate) AS BIGINT) AS week,
         CASE WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN 'TBD'
              ELSE strftime(l_shipdate, '%Y-%m-%d') END AS gameday,
         'P' || l_partkey AS home_team, 'S' || l_suppkey AS away_team,
         l_returnflag AS home_coach, l_linestatus AS away_coach
  FROM lineitem)
SELECT game_id, season, week, TRY_CAST(gameday AS DATE) AS game_date,
       home_team AS team, away_team AS opponent, true AS is_home, home_coach AS head_coach FROM s
UNION ALL
SELECT game_id, season, week, TRY_CAST(gameday AS DATE) AS game_date,
       away_team AS team, home_team AS opponent, false AS is_home, away_coach AS head_coach FROM s
"""


# --- two eras ---------------------------------------------------------------

ERA_SPLIT = "2024-01-16"
CHUNK_SEASON = 2023


def _era_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = table(spark, sf_dir, "events")
    legacy = ev.where(F.col("ts") < F.lit(ERA_SPLIT).cast("timestamp_ntz")).select(
        F.when(F.col("event_type") == "error", F.lit(2024)).otherwise(F.lit(2023))
         .cast("double").alias("season"),
        (F.floor((F.dayofyear("ts") - 1) / 7) + 1).cast("double").alias("week"),
        F.col("event_type").alias("club_code"),
        F.col("user_id").cast("string").alias("gsis_id"),
        F.concat(F.lit("u"), F.col("user_id")).alias("first_name"),
        F.when(F.col("value") >= 5, F.concat(F.lit("n"), F.col("event_id"))).alias("last_name"),
        F.col("event_type").alias("position"),
        F.round("value").cast("long").cast("string").alias("depth_team"),
        F.substring("props", 7, 1).alias("depth_position"),
        F.lit("Offense").alias("formation"))
    modern = ev.where(F.col("ts") >= F.lit(ERA_SPLIT).cast("timestamp_ntz")).select(
        F.col("ts").alias("dt"), F.col("event_type").alias("team"),
        F.col("user_id").cast("string").alias("gsis_id"),
        F.concat(F.lit("u"), F.col("user_id"), F.lit(" n"), F.col("event_id")).alias("player_name"),
        F.col("event_type").alias("pos_abb"),
        F.round("value").cast("long").alias("pos_rank"),
        F.substring("props", 7, 1).alias("pos_name"),
        (F.col("event_id") % 4).cast("string").alias("pos_slot"))
    return legacy, modern


def two_era_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    legacy, modern = _era_frames(spark, sf_dir)
    both = legacy.unionByName(modern, allowMissingColumns=True)
    core = reconcile_eras(both, season_arg=CHUNK_SEASON)
    kept, _, _ = season_guard(core, CHUNK_SEASON)
    return kept


TWO_ERA_SQL = f"""
WITH legacy AS (
  SELECT CASE WHEN event_type = 'error' THEN 2024 ELSE 2023 END AS season,
         CAST(floor((dayofyear(ts) - 1) / 7) + 1 AS BIGINT) AS week,
         event_type AS team, CAST(user_id AS VARCHAR) AS gsis_id,
         trim('u' || user_id || ' ' || coalesce(CASE WHEN value >= 5 THEN 'n' || event_id END, '')) AS player_name,
         event_type AS position, CAST(round(value) AS BIGINT) AS depth_rank,
         substr(props, 7, 1) AS depth_position, 'Offense' AS formation,
         CAST(NULL AS VARCHAR) AS pos_slot, 'legacy' AS source_era
  FROM events WHERE ts < TIMESTAMP '{ERA_SPLIT}'),
modern AS (
  SELECT CAST(year(ts) - CASE WHEN month(ts) <= 2 THEN 1 ELSE 0 END AS BIGINT) AS season,
         CAST(NULL AS BIGINT) AS week, event_type AS team, CAST(user_id AS VARCHAR) AS gsis_id,
         'u' || user_id || ' n' || event_id AS player_name, event_type AS position,
         CAST(round(value) AS BIGINT) AS depth_rank, substr(props, 7, 1) AS depth_position,
         CAST(NULL AS VARCHAR) AS formation, CAST(event_id % 4 AS VARCHAR) AS pos_slot,
         'modern' AS source_era
  FROM events WHERE ts >= TIMESTAMP '{ERA_SPLIT}')
SELECT * FROM (SELECT * FROM legacy UNION ALL SELECT * FROM modern) WHERE season = {CHUNK_SEASON}
"""


# --- keys -------------------------------------------------------------------

def key_from_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    parts = [F.year("o_orderdate").cast("string"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"),
             F.col("o_custkey").cast("string"), F.substring("o_orderpriority", 1, 1)]
    good = F.concat_ws("_", *parts)
    gid = (F.when(F.col("o_orderstatus") == "P", F.concat_ws("-", *parts))
           .when((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 11 == 0),
                 F.concat(F.lit("XXXX_"), F.concat_ws("_", *parts[1:])))
           .otherwise(good))
    keyed = o.select("o_orderkey", gid.alias("game_id"))
    s, w = season_week_from_key("game_id")
    return keyed.select("o_orderkey", "game_id", s.alias("season"), w.alias("week"))


KEY_FROM_ID_SQL = """
WITH k AS (
  SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'P' THEN concat_ws('-', CAST(year(o_orderdate) AS VARCHAR),
              lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0'), CAST(o_custkey AS VARCHAR), substr(o_orderpriority, 1, 1))
         WHEN o_orderstatus = 'O' AND o_orderkey % 11 = 0 THEN 'XXXX_' || concat_ws('_',
              lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0'), CAST(o_custkey AS VARCHAR), substr(o_orderpriority, 1, 1))
         ELSE concat_ws('_', CAST(year(o_orderdate) AS VARCHAR),
              lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0'), CAST(o_custkey AS VARCHAR), substr(o_orderpriority, 1, 1))
    END AS game_id
  FROM orders),
p AS (SELECT o_orderkey, game_id,
             TRY_CAST(string_split(game_id, '_')[1] AS BIGINT) AS s,
             TRY_CAST(string_split(game_id, '_')[2] AS BIGINT) AS w FROM k)
SELECT o_orderkey, game_id,
       CASE WHEN s IS NOT NULL AND w IS NOT NULL THEN s END AS season,
       CASE WHEN s IS NOT NULL AND w IS NOT NULL THEN w END AS week
FROM p
"""


# --- personnel --------------------------------------------------------------

PERSONNEL_MODERN_FROM = 1996


def snap_encodings(lines: DataFrame) -> DataFrame:
    """Line items with their list and summary encodings."""
    rb = F.col("l_linenumber") % 3
    te = F.col("l_quantity").cast("int") % 3
    wr = F.lit(5) - rb - te
    rf = F.col("l_returnflag")
    qb = F.when(rf == "R", "QB").when(rf == "A", "QB;QB").otherwise("CB")
    positions = F.concat(F.lit("C;G;G;T;T;"), qb, F.expr("repeat('; RB', l_linenumber % 3)"),
                         F.expr("repeat(';TE ', cast(l_quantity as int) % 3)"),
                         F.expr("repeat(';WR', 5 - l_linenumber % 3 - cast(l_quantity as int) % 3)"),
                         F.when(F.col("l_linestatus") == "O", ";;").otherwise(""))
    sep = F.when(F.col("l_linestatus") == "O", "").otherwise(" ")
    personnel = F.concat(rb.cast("string"), F.lit(" RB, "), te.cast("string"), F.lit(" te, "),
                         wr.cast("string"), sep, F.lit("WR"),
                         F.when(rf == "N", ", 2 CB").when(rf == "A", ", 1 fb").otherwise(""))
    return lines.withColumns({"offense_positions": positions, "offense_personnel": personnel})


def _snap_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snap_encodings(table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_linenumber", F.year("l_shipdate").alias("season"), "offense_positions", "offense_personnel")


SNAP_COLUMNS_SQL = """
  'C;G;G;T;T;' || CASE WHEN l_returnflag = 'R' THEN 'QB' WHEN l_returnflag = 'A' THEN 'QB;QB' ELSE 'CB' END
    || repeat('; RB', l_linenumber % 3) || repeat(';TE ', CAST(l_quantity AS INTEGER) % 3)
    || repeat(';WR', 5 - l_linenumber % 3 - CAST(l_quantity AS INTEGER) % 3)
    || CASE WHEN l_linestatus = 'O' THEN ';;' ELSE '' END AS offense_positions,
  CAST(l_linenumber % 3 AS VARCHAR) || ' RB, ' || CAST(CAST(l_quantity AS INTEGER) % 3 AS VARCHAR) || ' te, '
    || CAST(5 - l_linenumber % 3 - CAST(l_quantity AS INTEGER) % 3 AS VARCHAR)
    || CASE WHEN l_linestatus = 'O' THEN '' ELSE ' ' END || 'WR'
    || CASE WHEN l_returnflag = 'N' THEN ', 2 CB' WHEN l_returnflag = 'A' THEN ', 1 fb' ELSE '' END
    AS offense_personnel
"""

SNAP_ENCODINGS_SQL = f"""
SELECT l_orderkey, l_linenumber, year(l_shipdate) AS season, {SNAP_COLUMNS_SQL.strip()}
FROM lineitem
"""


def _counts_frame(df: DataFrame, parsed: dict, extra: tuple = ()) -> DataFrame:
    return df.select("l_orderkey", "l_linenumber", *extra,
                     *[parsed[k].alias(k) for k in ("n_rb", "n_te", "n_wr", "n_qb", "plausible")])


def personnel_modern(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _snap_encodings(spark, sf_dir)
    return _counts_frame(df, parse_modern("offense_positions"))


def personnel_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _snap_encodings(spark, sf_dir)
    return _counts_frame(df, parse_legacy("offense_personnel"))


def personnel_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_personnel(_snap_encodings(spark, sf_dir), "season", "offense_positions",
                        "offense_personnel", modern_from=PERSONNEL_MODERN_FROM)
    return df.select("l_orderkey", "l_linenumber", "personnel_source", "n_rb", "n_te", "n_wr",
                     "n_qb", "plausible")


SQL_MODERN_TOKENS = ("list_filter(list_transform(string_split(coalesce(offense_positions, ''), ';'), "
                     "lambda t: trim(t)), lambda t: t <> '')")
SQL_LEGACY_NUMS = r"regexp_extract_all(upper(offense_personnel), '(\d+)\s*([A-Za-z]+)', 1)"
SQL_LEGACY_LABS = r"regexp_extract_all(upper(offense_personnel), '(\d+)\s*([A-Za-z]+)', 2)"


def _sql_modern_select() -> str:
    cnt = ", ".join(f"CAST(len(list_filter(tok, lambda t: t = '{lab}')) AS BIGINT) AS n_{lab.lower()}"
                    for lab in ("RB", "TE", "WR", "QB"))
    return (f"{cnt}, len(tok) = 11 AND len(list_filter(tok, lambda t: t = 'QB')) = 1 AS plausible")


def _sql_legacy_select() -> str:
    cnt = ", ".join(
        f"CAST(coalesce(list_sum(list_transform(range(1, len(labs) + 1), "
        f"lambda i: CASE WHEN labs[i] = '{lab}' THEN CAST(nums[i] AS BIGINT) ELSE 0 END)), 0) AS BIGINT) "
        f"AS n_{lab.lower()}" for lab in ("RB", "TE", "WR", "QB"))
    return (f"{cnt}, len(labs) > 0 AND len(list_filter(labs, lambda l: l NOT IN "
            f"('QB', 'RB', 'FB', 'TE', 'WR'))) = 0 AS plausible")


PERSONNEL_MODERN_SQL = f"""
SELECT l_orderkey, l_linenumber, {_sql_modern_select()}
FROM (SELECT *, {SQL_MODERN_TOKENS} AS tok FROM ({SNAP_ENCODINGS_SQL}))
"""

PERSONNEL_LEGACY_SQL = f"""
SELECT l_orderkey, l_linenumber, {_sql_legacy_select()}
FROM (SELECT *, {SQL_LEGACY_NUMS} AS nums, {SQL_LEGACY_LABS} AS labs FROM ({SNAP_ENCODINGS_SQL}))
"""

PERSONNEL_DISPATCH_SQL = f"""
SELECT l_orderkey, l_linenumber, 'offense_positions' AS personnel_source, {_sql_modern_select()}
FROM (SELECT *, {SQL_MODERN_TOKENS} AS tok FROM ({SNAP_ENCODINGS_SQL})) WHERE season >= {PERSONNEL_MODERN_FROM}
UNION ALL
SELECT l_orderkey, l_linenumber, 'offense_personnel' AS personnel_source, {_sql_legacy_select()}
FROM (SELECT *, {SQL_LEGACY_NUMS} AS nums, {SQL_LEGACY_LABS} AS labs FROM ({SNAP_ENCODINGS_SQL}))
WHERE season < {PERSONNEL_MODERN_FROM}
"""


# --- pages ------------------------------------------------------------------

PAGE_ROLES = {"TITLE": "title", "HEADING": "h1", "NAV": "li"}


def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return role_rows(pages, "html", PAGE_ROLES, syntax="html", keep=("page_id",))


def _sql_page_role(role: str, tag: str) -> str:
    pat = f"<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>"
    raw = f"CASE WHEN regexp_matches(html, '{pat}', 's') THEN regexp_extract(html, '{pat}', 1, 's') END"
    return f"SELECT page_id, '{role}' AS role, {raw} AS raw FROM pages"


PAGE_FIELDS_SQL = f"""
WITH r AS ({' UNION ALL '.join(_sql_page_role(r, t) for r, t in PAGE_ROLES.items())}),
c AS (SELECT page_id, role, raw,
             regexp_replace(regexp_replace(raw, '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g') AS name
      FROM r WHERE raw IS NOT NULL)
SELECT page_id, role, name,
       CASE WHEN regexp_matches(regexp_replace(raw, '^\\s+|\\s+$', '', 'g'), '^<a(?:\\s[^>]*)?>[^<]*</a>$')
            THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.75 AS DOUBLE) END AS confidence
FROM c WHERE name <> '' AND NOT regexp_matches(name, '[|=]')
"""


WIKI_SEASONS = tuple(range(2000, 2025))


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    teams = F.array(*[F.lit(t) for t in TEAM_PAGE_NAMES])
    team = F.element_at(teams, (F.col("page_id") % len(TEAM_PAGE_NAMES) + 1).cast("int"))
    season = F.col("page_id") % len(WIKI_SEASONS) + WIKI_SEASONS[0]
    host = F.regexp_extract("url", "//([^/?#]+)", 1)
    kind = F.col("page_id") % 5
    off = (F.when(kind == 0, F.concat(F.lit("| off_coach = [["), host, F.lit("]]\n")))
           .when(kind == 1, F.concat(F.lit("| off_coach = [[Site|"), host, F.lit("]] {{small|(interim)}}\n")))
           .when(kind == 2, F.concat(F.lit("| off_coach =  "), "url", F.lit("  \n")))
           .when(kind == 3, F.lit("| off_coach =\n")).otherwise(F.lit("")))
    box = F.concat(F.lit("{{Infobox season\n| record = 1\n"), off, F.lit("| def_coach = "), host, F.lit("\n}}\ntext"))
    return pages.select(F.replace(page_title(season, team), F.lit("_"), F.lit(" ")).alias("title"),
                        F.when(F.col("page_id") % 11 != 0, box).alias("wikitext"),
                        F.timestamp_seconds("page_id").alias("landed_at"))


def coordinators_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored coordinators after the pages were synced, twice."""
    name = f"coordinators_{uuid.uuid4().hex[:12]}"
    landed = _captures(spark, sf_dir)
    for _ in range(2):
        sync_coordinators_from_pages(spark, name, landed, list(WIKI_SEASONS), [*TEAM_PAGE_NAMES, "XX"])
    return taken(spark, name, ["season", "team", "role", "name", "source", "confidence"])


COORDINATORS_WRITTEN_SQL = f"""
WITH captures AS (
  SELECT {len(WIKI_SEASONS)} AS n, page_id, {WIKI_SEASONS[0]} + page_id % {len(WIKI_SEASONS)} AS season,
         {list(TEAM_PAGE_NAMES)}[page_id % {len(TEAM_PAGE_NAMES)} + 1] AS team,
         regexp_extract(url, '//([^/?#]+)', 1) AS host, url, page_id % 5 AS kind
  FROM pages WHERE page_id % 11 <> 0),
newest AS (SELECT * FROM captures QUALIFY row_number() OVER (PARTITION BY season, team ORDER BY page_id DESC) = 1),
raw AS (
  SELECT season, team, 'DC' AS role, host AS name, 0.75 AS confidence FROM newest
  UNION ALL
  SELECT season, team, 'OC', CASE WHEN kind IN (0, 1) THEN host WHEN kind = 2 THEN trim(url) END,
         CASE WHEN kind = 0 THEN 1.0 ELSE 0.75 END FROM newest)
SELECT CAST(season AS BIGINT) AS season, team, role, name, 'wikipedia' AS source, CAST(confidence AS DOUBLE) AS confidence
FROM raw WHERE name <> '' AND NOT regexp_matches(name, '[|=]')
"""
