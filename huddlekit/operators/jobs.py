"""Load jobs composed from the operators, written idempotently. The snapshot
jobs are one Spark plan over all requested chunks, with the run log derived
from the same data by a grouping; season loads (``season_loads``) are one job
per table and season, so that seasons fail alone.

* ``sync_adp``: feed documents -> conform -> resolve ids -> upsert on the
  six-column grain (partitioned by snapshot day) -> run log per chunk.
* ``load_seasons``: the requested seasons of one season-chunked table.
* ``sync_bridge`` / ``sync_rankings`` / ``sync_coordinators``: snapshot
  upserts.
* ``run_tallies``: counts per status from a run log.
"""
from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddlekit.operators.contracts import (ADP_GRAIN, ADP_SCHEMA, ColumnSpec, align_to_schema,
                                           ingested_at_spec, to_struct)
from huddlekit.operators.identity import resolve_ids
from huddlekit.operators.pages import coordinators
from huddlekit.operators.season_loads import load_tables
from huddlekit.operators.specs import RANKINGS, TableSpec
from huddlekit.sources.feeds import conform_feed_a, conform_feed_b, feed_a_damage, feed_b_damage
from huddlekit.sources.store import (add_columns, append_run_log, create_table_if_missing, kept_copy, run_log_rows,
                                     staged_copy, upsert)

# --- the id bridge contract ---------------------------------------------------

# The bridge's id systems and attributes, by type.
_BRIDGE_INT = ("mfl_id", "sleeper_id", "espn_id", "fleaflicker_id", "cbs_id", "rotowire_id",
               "rotoworld_id", "ktc_id", "stats_id", "fantasy_data_id", "swish_id", "nfl_id",
               "stats_global_id", "draft_year", "draft_round")
_BRIDGE_STR = ("sportradar_id", "fantasypros_id", "gsis_id", "pff_id", "yahoo_id", "pfr_id",
               "cfbref_id", "name", "merge_name", "position", "team")
BRIDGE_SPECS = ([ColumnSpec(c, "INT64", "REQUIRED" if c == "mfl_id" else "NULLABLE") for c in _BRIDGE_INT]
                + [ColumnSpec(c, "STRING") for c in _BRIDGE_STR]
                + [ColumnSpec("birthdate", "DATE"), ColumnSpec("age", "FLOAT64"), ingested_at_spec()])
BRIDGE_SCHEMA = to_struct(BRIDGE_SPECS)


def conform_bridge(df: DataFrame) -> DataFrame:
    """Drop rows without the key, align to the bridge contract. No dedupe:
    a duplicated key is refused later by the upsert's key check."""
    return align_to_schema(df.where(F.col("mfl_id").isNotNull()), BRIDGE_SCHEMA)


def load_seasons(spark: SparkSession, spec: TableSpec, table: str, seasons: list[int], log_path: str,
                 **options) -> DataFrame:
    """Seasons of one table; see ``season_loads.load_tables``."""
    if spec.schema is None and spec.overlay is None:
        spec = replace(spec, schema=spark.table(table).schema)
    return load_tables(spark, [spec], seasons, log_path, table_of=lambda name: table if name == spec.name else name,
                       **options)


# --- snapshot jobs -------------------------------------------------------------------

CHUNK_KEYS = ["source", "season", "scoring_format", "teams"]
ADP_CLUSTER = ("season", "source", "scoring_format", "teams")


def sync_adp(spark: SparkSession, table: str, snapshot_date: str, bridge: DataFrame, log_path: str, *,
             feed_a_docs: DataFrame | None = None, feed_b_docs: DataFrame | None = None) -> DataFrame:
    """All landed documents of one capture day in one plan. Returns the run
    log rows appended: 'success' with rows written, 'empty' for a chunk whose
    documents had no players, 'failed' for a chunk with a damaged document, a
    NULL in a REQUIRED column or two rows of one player. A failed chunk is
    kept out of the upsert and stays pending; the others still load."""
    create_table_if_missing(spark, table, ADP_SCHEMA, partition_by=("snapshot_date",), cluster_by=ADP_CLUSTER)
    frames, chunks = [], []
    if feed_a_docs is not None:
        frames.append(conform_feed_a(feed_a_docs, snapshot_date))
        chunks.append(feed_a_damage(feed_a_docs).select(
            F.lit("ffc").alias("source"), F.col("season").cast("long").alias("season"),
            "scoring_format", F.col("teams").cast("long").alias("teams"), "damaged"))
    if feed_b_docs is not None:
        frames.append(conform_feed_b(feed_b_docs, snapshot_date))
        chunks.append(feed_b_damage(feed_b_docs).select(
            F.lit("mfl").alias("source"), F.col("season").cast("long").alias("season"),
            "scoring_format", F.col("teams").cast("long").alias("teams"), "damaged"))
    if not frames:
        raise ValueError("no feed documents given")
    adp = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    all_chunks = chunks[0] if len(chunks) == 1 else chunks[0].unionByName(chunks[1])
    with staged_copy(spark, resolve_ids(adp, bridge), "adp") as staged:
        log = kept_copy(_adp_log(staged, all_chunks, snapshot_date), "adp-log")
        clean = log.where("status = 'success'").select(*CHUNK_KEYS)
        upsert(spark, table, staged.join(clean, CHUNK_KEYS, "left_semi"), list(ADP_GRAIN),
               partition_by=("snapshot_date",), cluster_by=ADP_CLUSTER)
    written = append_run_log(log, log_path)
    return log.withColumn("log_written", F.lit(written))


def _adp_log(staged: DataFrame, all_chunks: DataFrame, snapshot_date: str) -> DataFrame:
    """Run-log rows of the chunks, from the staged rows and the documents."""
    # Contract violations are counted per chunk, through one pre-aggregation on
    # the grain (the chunk columns are part of it).
    required = [f.name for f in ADP_SCHEMA.fields if not f.nullable and f.name != "ingested_at"]
    violation = F.lit(False)
    for c in required:
        violation = violation | F.col(c).isNull()
    per_chunk = (staged.groupBy(*ADP_GRAIN).agg(F.count(F.lit(1)).alias("n"), F.count_if(violation).alias("nulls"),
                                                F.count("gsis_id").alias("resolved"))
                 .groupBy(*CHUNK_KEYS).agg(
                     F.sum("n").alias("rows"), F.sum("nulls").alias("violations"),
                     F.count_if(F.col("n") > 1).alias("duplicates"),
                     (F.sum("resolved") / F.sum("n")).alias("resolution_rate")))
    all_chunks = all_chunks.groupBy(*CHUNK_KEYS).agg(F.count("damaged").alias("n_damaged"),
                                                     F.max("damaged").alias("damaged"))
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"p.{k}")) for k in CHUNK_KEYS]
    on = same[0] & same[1] & same[2] & same[3]
    problems = F.concat_ws("; ",
        F.when(F.col("n_damaged") > 0, F.concat(F.col("n_damaged").cast("string"),
                                                F.lit(" damaged document(s): "), F.col("damaged"))),
        F.when(F.col("violations") > 0, F.concat(
            F.col("violations").cast("string"), F.lit(f" row(s) with NULL in a required column {required}"))),
        F.when(F.col("duplicates") > 0, F.concat(
            F.col("duplicates").cast("string"), F.lit(f" duplicated key(s) {list(ADP_GRAIN)}"))))
    seen = (all_chunks.alias("c").join(per_chunk.alias("p"), on, "left")
            .select(*[F.col(f"c.{k}").alias(k) for k in CHUNK_KEYS], F.nullif(problems, F.lit("")).alias("_error"),
                    F.coalesce("rows", F.lit(0)).cast("long").alias("_rows"), "resolution_rate",
                    F.lit(snapshot_date).cast("date").alias("snapshot_date")))
    status = (F.when(F.col("_error").isNotNull(), "failed").when(F.col("_rows") > 0, "success").otherwise("empty"))
    return run_log_rows(seen, status, F.when(F.col("_error").isNull(), F.col("_rows")), F.col("_error")).drop(
        "_error", "_rows")


def sync_bridge(spark: SparkSession, table: str, raw: DataFrame) -> int:
    create_table_if_missing(spark, table, BRIDGE_SCHEMA)
    return upsert(spark, table, conform_bridge(raw), ["mfl_id"])


RANKINGS_KEYS = ["scrape_date", "ecr_type", "id"]
RANKINGS_CLUSTER = ("ecr_type", "pos")


def sync_rankings(spark: SparkSession, table: str, rankings: DataFrame) -> int:
    """Snapshot upsert; the affected partitions are the scrape days present.
    The contract is that of the given rankings: a missing table is created by
    it, and an existing one gets the columns it lacks."""
    contract = RANKINGS.contract(rankings.schema, "ff_rankings")
    clusters = tuple(c for c in RANKINGS_CLUSTER if c in rankings.columns)
    create_table_if_missing(spark, table, contract, partition_by=("scrape_date",), cluster_by=clusters)
    stored = spark.table(table).columns
    add_columns(spark, table, [f for f in contract.fields if f.name not in stored and f.name != "ingested_at"])
    return upsert(spark, table, align_to_schema(rankings, spark.table(table).schema), RANKINGS_KEYS,
                  partition_by=("scrape_date",), cluster_by=clusters)


COORDINATOR_SCHEMA = to_struct([
    ColumnSpec("season", "INT64", "REQUIRED"), ColumnSpec("team", "STRING", "REQUIRED"),
    ColumnSpec("role", "STRING", "REQUIRED", valid_values=("OC", "DC")),
    ColumnSpec("name", "STRING"), ColumnSpec("source", "STRING"),
    ColumnSpec("confidence", "FLOAT64"), ColumnSpec("retrieved_at", "TIMESTAMP", "REQUIRED"),
    ingested_at_spec()])


COORDINATOR_CLUSTER = ("season", "team")


def sync_coordinators(spark: SparkSession, table: str, pages: DataFrame, source: str = "wikipedia") -> int:
    """Team-season pages (season, team, wikitext, retrieved_at) -> OC/DC rows
    upserted on (season, team, role)."""
    create_table_if_missing(spark, table, COORDINATOR_SCHEMA, cluster_by=COORDINATOR_CLUSTER)
    rows = coordinators(pages, keep=("season", "team", "retrieved_at")).withColumn("source", F.lit(source))
    return upsert(spark, table, align_to_schema(rows, COORDINATOR_SCHEMA), ["season", "team", "role"],
                  cluster_by=COORDINATOR_CLUSTER)


def coordinator_pages(spark: SparkSession, landed: DataFrame, seasons: list[int],
                      teams: list[str]) -> DataFrame:
    """The requested season x team pages (work matrix of the arguments) next
    to the landed page documents, matched on the page title (spaces and
    underscores are the same). A page that was not landed, or came back as
    an error, keeps its row with NULL wikitext and ``missing`` set. Of several
    captures of one title the newest (``landed_at``, where given) is used."""
    from huddlekit.operators.increment import work_matrix
    from huddlekit.operators.pages import page_title
    work = work_matrix(spark, {"season": [int(s) for s in seasons], "team": list(teams)}) \
        .withColumn("title_key", page_title(F.col("season").cast("long"), "team"))
    newest = F.struct(*[F.col(c) for c in ("landed_at", "wikitext") if c in landed.columns])
    docs = (landed.where(F.col("wikitext").isNotNull())
            .groupBy(F.replace(F.col("title"), F.lit(" "), F.lit("_")).alias("title_key"))
            .agg(F.max_by("wikitext", newest).alias("wikitext")))
    return (work.join(docs, "title_key", "left")
            .select(F.col("season").cast("long").alias("season"), "team", "title_key", "wikitext",
                    F.col("wikitext").isNull().alias("missing")))


def sync_coordinators_from_pages(spark: SparkSession, table: str, landed: DataFrame, seasons: list[int],
                                 teams: list[str]) -> DataFrame:
    """JOB-3: requested pages -> OC/DC rows upserted; returns the tally
    (pages requested, found, missing, rows written) as one row."""
    pages = coordinator_pages(spark, landed, seasons, teams)
    found = pages.where(~F.col("missing")).withColumn("retrieved_at", F.current_timestamp())
    n = sync_coordinators(spark, table, found)
    return pages.agg(F.count(F.lit(1)).alias("requested"),
                     F.count_if(~F.col("missing")).alias("found"),
                     F.count_if("missing").alias("missing"),
                     F.lit(n).cast("long").alias("rows_written"))


def run_tallies(log: DataFrame) -> DataFrame:
    """Rows per status in a run log, plus whether the run failed overall
    (nothing succeeded and something failed), how many foreign rows season
    loads dropped and, for the rows a job returned, how many could not be
    appended to the log."""
    lost = (F.count_if(~F.col("log_written")) if "log_written" in log.columns else F.lit(0)).alias("_lost")
    dropped = (F.sum("dropped") if "dropped" in log.columns else F.lit(0)).alias("_dropped")
    g = log.groupBy("status").agg(F.count(F.lit(1)).alias("n"), lost, dropped)
    ok = F.coalesce(F.sum(F.when(F.col("status").isin("success", "empty"), F.col("n"))), F.lit(0))
    bad = F.coalesce(F.sum(F.when(F.col("status") == "failed", F.col("n"))), F.lit(0))
    return g.agg(F.map_from_entries(F.collect_list(F.struct("status", "n"))).alias("by_status"),
                 ((ok == 0) & (bad > 0)).alias("run_failed"),
                 F.sum("_lost").cast("long").alias("log_failures"),
                 F.coalesce(F.sum("_dropped"), F.lit(0)).cast("long").alias("dropped"))
