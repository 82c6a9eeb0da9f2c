"""Load-side bindings: snapshot upsert, season replacement and chunk planning
on the driver's tables (as plans, and as written tables).

* upsert: ``part`` is the stored table; a batch re-prices large parts and
  adds a new part for every size-50 part.
* replace: ``orders`` partitioned by order year; the 1995 chunk carries
  fulfilled orders of 1995 and of 1996 (foreign, dropped); the 1998 chunk is
  empty, which clears 1998.
* ``upsert_written`` and ``replace_written`` run the same through the writing
  operators, on a table of their own, each batch twice: a rerun changes
  nothing.
* pending: segments x seasons x priorities minus the chunks a run log (one
  row per segment, year and priority, derived from the orders) completed.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddlekit.operators.increment import gate, pending, work_matrix
from huddlekit.session import scratch_path
from huddlekit.sources.store import (create_table_if_missing, drop_table, kept_copy, merge_upsert, replace_season,
                                     replaced, upsert)
from huddlekit.plans.tables import rounded, table


def _part_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    repriced = p.where(F.col("p_size") >= 45).withColumn("p_retailprice", F.col("p_retailprice") * 1.1)
    added = p.where(F.col("p_size") == 50).select(
        (F.col("p_partkey") + 1_000_000_000).alias("p_partkey"),
        F.concat(F.col("p_name"), F.lit(" (new)")).alias("p_name"),
        "p_brand", "p_type", "p_size", "p_retailprice")
    return repriced.unionByName(added)


def upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "part")
    return rounded(merge_upsert(target, _part_batch(spark, sf_dir), ["p_partkey"]))


UPSERT_RESULT_SQL = """
WITH batch AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice * 1.1 AS p_retailprice
  FROM part WHERE p_size >= 45
  UNION ALL
  SELECT p_partkey + 1000000000, p_name || ' (new)', p_brand, p_type, p_size, p_retailprice
  FROM part WHERE p_size = 50)
SELECT p_partkey, p_name, p_brand, p_type, p_size, round(p_retailprice, 6) AS p_retailprice
FROM part t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.p_partkey = t.p_partkey)
UNION ALL
SELECT p_partkey, p_name, p_brand, p_type, p_size, round(p_retailprice, 6) FROM batch
"""


def replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.year("o_orderdate").cast("long").alias("season"))
    chunk_1995 = (o.where(F.col("season").isin(1995, 1996) & (F.col("o_orderstatus") == "F"))
                  .withColumn("o_totalprice", F.col("o_totalprice") * 2))
    chunk_1998 = o.where((F.col("season") == 1998) & (F.col("o_orderstatus") == "X"))
    return rounded(replaced(replaced(o, chunk_1995, 1995), chunk_1998, 1998))


REPLACE_PARTITION_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                  CAST(year(o_orderdate) AS BIGINT) AS season FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, season
FROM o WHERE season NOT IN (1995, 1998)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice * 2, 6), season
FROM o WHERE season = 1995 AND o_orderstatus = 'F'
"""



def taken(spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
    """The rows of a table made for one query, which is dropped."""
    rows = kept_copy(spark.table(name).select(*columns), f"result-{name}")
    drop_table(spark, name)
    return rows


def upsert_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored parts after the batch, a rerun of it and an empty batch."""
    stored, batch = table(spark, sf_dir, "part"), _part_batch(spark, sf_dir)
    name, path = f"part_{uuid.uuid4().hex[:12]}", scratch_path(spark, f"upsert-{uuid.uuid4().hex}")
    create_table_if_missing(spark, name, stored.schema, location=path)
    for rows in (stored, batch, batch, batch.where("false")):
        upsert(spark, name, rows, ["p_partkey"], cluster_by=("p_partkey",))
    return rounded(taken(spark, name, stored.columns))


UPSERT_WRITTEN_SQL = UPSERT_RESULT_SQL


def replace_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored orders by season after 1995 was replaced by a chunk that
    lacks the price and holds foreign rows, twice, and 1998 was emptied."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.year("o_orderdate").cast("long").alias("season"))
    name, path = f"orders_{uuid.uuid4().hex[:12]}", scratch_path(spark, f"replace-{uuid.uuid4().hex}")
    create_table_if_missing(spark, name, o.schema, partition_by=("season",), location=path)
    upsert(spark, name, o, ["o_orderkey", "season"], partition_by=("season",))
    chunk = o.where(F.col("season").isin(1995, 1996) & (F.col("o_orderstatus") == "F")).drop("o_totalprice")
    for rows, season in ((chunk, 1995), (chunk, 1995), (o.where("false"), 1998)):
        replace_season(spark, name, rows, season, required=("o_orderkey",))
    return rounded(taken(spark, name, o.columns))


REPLACE_WRITTEN_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice,
                  CAST(year(o_orderdate) AS BIGINT) AS season FROM orders)
SELECT * FROM o WHERE season NOT IN (1995, 1998)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(NULL AS DOUBLE), season
FROM o WHERE season = 1995 AND o_orderstatus = 'F'
"""

# The load arguments (market segments, seasons, priorities)
# and the per-source gating rules.
SOURCES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
SEASONS = tuple(range(1990, 2000))
FORMATS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
MIN_SEASON = {"AUTOMOBILE": 1994}
ALLOWED_FORMATS = {"MACHINERY": ("1-URGENT", "2-HIGH")}


def run_log_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    g = (o.join(c, o.o_custkey == c.c_custkey)
         .groupBy(F.col("c_mktsegment").alias("source"),
                  F.year("o_orderdate").cast("long").alias("season"),
                  F.col("o_orderpriority").alias("format"))
         .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("n_p")))
    status = (F.when((F.col("n_p") * 20 > F.col("n")) | (F.col("format") == "5-LOW"), "failed")
              .when(F.col("n_p") == 0, "empty").otherwise("success"))
    return g.select("source", "season", "format", status.alias("status"))


def pending_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = work_matrix(spark, {"source": list(SOURCES), "season": list(SEASONS),
                                 "format": list(FORMATS)})
    chunks = chunks.withColumn("season", F.col("season").cast("long"))
    gated = gate(chunks, min_season=MIN_SEASON, source_col="source", allowed=ALLOWED_FORMATS,
                 format_col="format")
    return pending(gated, run_log_from_orders(spark, sf_dir), ["source", "season", "format"])


def _sql_list(xs) -> str:
    return "[" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in xs) + "]"


PENDING_CHUNKS_SQL = f"""
WITH m AS (
  SELECT s.source, CAST(y.season AS BIGINT) AS season, f.format
  FROM (SELECT unnest({_sql_list(SOURCES)}) AS source) s,
       (SELECT unnest({_sql_list(SEASONS)}) AS season) y,
       (SELECT unnest({_sql_list(FORMATS)}) AS format) f),
log AS (
  SELECT c.c_mktsegment AS source, CAST(year(o.o_orderdate) AS BIGINT) AS season,
         o.o_orderpriority AS format,
         CASE WHEN count(*) FILTER (WHERE o.o_orderstatus = 'P') * 20 > count(*) OR o.o_orderpriority = '5-LOW'
                THEN 'failed'
              WHEN count(*) FILTER (WHERE o.o_orderstatus = 'P') = 0 THEN 'empty'
              ELSE 'success' END AS status
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2, 3)
SELECT m.source, m.season, m.format FROM m
WHERE NOT (m.source = 'AUTOMOBILE' AND m.season < 1994)
  AND NOT (m.source = 'MACHINERY' AND m.format NOT IN ('1-URGENT', '2-HIGH'))
  AND NOT EXISTS (SELECT 1 FROM log WHERE log.status IN ('success', 'empty')
                  AND log.source = m.source AND log.season = m.season AND log.format = m.format)
"""
