"""Landed-file sources: the two ADP feeds (JSON), wiki pages (JSON) and the id
bridge (CSV); season feeds are in ``vintages``. Network fetching is out of
scope; these read what was landed."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huddlekit.functions.exprs import lenient_date, strict_long, to_double, to_long
from huddlekit.operators.contracts import ADP_SCHEMA, align_to_schema

# Scoring formats feed A publishes, and the subset feed B has.
FEED_A_FORMATS = ("standard", "ppr", "half-ppr", "2qb", "dynasty", "rookie")
FEED_B_FORMATS = ("ppr", "standard")

# Values arrive as numbers or as text, so all are read as text and parsed.
FEED_A_PLAYER = T.StructType([T.StructField(name, T.StringType()) for name in (
    "player_id", "name", "position", "team", "adp", "adp_formatted", "times_drafted", "high", "low",
    "stdev", "bye")])
FEED_A_DOC = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("errors", T.StringType()),
    T.StructField("meta", T.StructType([
        T.StructField("type", T.StringType()), T.StructField("teams", T.StringType()),
        T.StructField("rounds", T.StringType()), T.StructField("total_drafts", T.StringType()),
        T.StructField("start_date", T.StringType()), T.StructField("end_date", T.StringType())])),
    T.StructField("players", T.ArrayType(FEED_A_PLAYER)),
])
FEED_B_PLAYER = ("array<struct<id:string,rank:string,averagePick:string,minPick:string,"
                 "maxPick:string,draftsSelectedIn:string,draftSelPct:string>>")


CORRUPT = "_corrupt_record"


def check_formats(formats, allowed=FEED_A_FORMATS) -> None:
    bad = sorted(set(formats) - set(allowed))
    if bad:
        raise ValueError(f"unknown scoring formats {bad}; allowed {list(allowed)}")


# --- feed A -----------------------------------------------------------------

def read_feed_a(spark: SparkSession, path: str) -> DataFrame:
    """Landed feed A documents, one JSON document per file, laid out as
    ``season=/scoring_format=/teams=`` directories (partition columns). A
    document that is not valid JSON keeps its row, with its text in
    ``_corrupt_record``."""
    docs = read_text_documents(spark, path)
    schema = T.StructType([*FEED_A_DOC.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("raw", schema, {"columnNameOfCorruptRecord": CORRUPT})
    return (docs.select(F.col("season").cast("long").alias("season"),
                        F.col("scoring_format").cast("string").alias("scoring_format"),
                        F.col("teams").cast("long").alias("teams"), "raw", parsed.alias("d"))
            .select("season", "scoring_format", "teams", *[f"d.{f.name}" for f in FEED_A_DOC.fields],
                    F.coalesce(f"d.{CORRUPT}", F.when(F.col("d").isNull(), F.col("raw"))).alias(CORRUPT)))


def parse_feed_a(raw: Column) -> Column:
    return F.from_json(raw, FEED_A_DOC)


def conform_feed_a(docs: DataFrame, snapshot_date: str) -> DataFrame:
    """Feed A documents (columns of FEED_A_DOC + season, scoring_format, teams)
    -> conformed ADP rows. A document without players yields no rows
    (whatever its status says). ``high`` is the earliest pick, ``low`` the
    latest; feed-B-only columns are NULL."""
    p = docs.select("*", F.explode(F.coalesce(F.col("players"), F.array())).alias("p"))
    out = p.select(
        F.lit("ffc").alias("source"), "season", "scoring_format", "teams",
        F.lit(snapshot_date).cast("date").alias("snapshot_date"),
        to_long(F.col("p.player_id")).cast("string").alias("source_player_id"),
        F.col("p.name").alias("player_name"), F.col("p.position").alias("position"),
        F.col("p.team").alias("team"), to_double(F.col("p.adp")).alias("adp"),
        F.col("p.adp_formatted").alias("adp_formatted"),
        to_double(F.col("p.stdev")).alias("adp_stdev"),
        to_long(F.col("p.high")).alias("adp_earliest_pick"),
        to_long(F.col("p.low")).alias("adp_latest_pick"),
        to_long(F.col("p.times_drafted")).alias("times_drafted"),
        to_long(F.col("meta.total_drafts")).alias("total_drafts"),
        to_long(F.col("p.bye")).alias("bye"),
        lenient_date(F.col("meta.start_date")).alias("window_start_date"),
        lenient_date(F.col("meta.end_date")).alias("window_end_date"))
    return align_to_schema(out, ADP_SCHEMA)


def feed_a_document_totals(docs: DataFrame) -> DataFrame:
    """Per document: player count and total drafts (0 is distinct from NULL,
    an empty document still carries its totals)."""
    return docs.select("season", "scoring_format", "teams",
                       F.coalesce(F.size("players"), F.lit(0)).alias("n_players"),
                       to_long(F.col("meta.total_drafts")).alias("total_drafts"),
                       (F.coalesce(F.size("players"), F.lit(0)) == 0).alias("is_empty"))


def feed_a_damage(docs: DataFrame) -> DataFrame:
    """One row per document: its chunk, and the text of a document that could
    not be parsed (else NULL)."""
    text = F.col(CORRUPT) if CORRUPT in docs.columns else F.lit(None).cast("string")
    return docs.select("season", "scoring_format", "teams", text.alias("damaged"))


# --- feed B -----------------------------------------------------------------

def feed_b_players(raw: Column) -> Column:
    """``adp.player`` may be missing, one object or a list: the object and the
    list both parse to an array; missing is an empty array."""
    node = F.get_json_object(raw, "$.adp.player")
    return F.coalesce(F.from_json(node, FEED_B_PLAYER), F.array().cast(FEED_B_PLAYER))


def conform_feed_b(docs: DataFrame, snapshot_date: str, *, raw: str = "raw",
                   is_keeper: bool | None = None, is_mock: bool | None = None) -> DataFrame:
    """Feed B documents (a raw JSON text column + season, scoring_format,
    teams) -> conformed ADP rows. Every numeric arrives as a string."""
    r = F.col(raw)
    p = docs.select("season", "scoring_format", "teams",
                    strict_long(F.get_json_object(r, "$.adp.totalDrafts")).alias("total_drafts"),
                    F.explode(feed_b_players(r)).alias("p"))
    out = p.select(
        F.lit("mfl").alias("source"), "season", "scoring_format", "teams",
        F.lit(snapshot_date).cast("date").alias("snapshot_date"),
        F.col("p.id").alias("source_player_id"),
        to_double(F.col("p.averagePick")).alias("adp"),
        to_long(F.col("p.minPick")).alias("adp_earliest_pick"),
        to_long(F.col("p.maxPick")).alias("adp_latest_pick"),
        to_long(F.col("p.draftsSelectedIn")).alias("times_drafted"),
        to_double(F.col("p.draftSelPct")).alias("draft_selected_pct"),
        to_long(F.col("p.rank")).alias("source_rank"),
        "total_drafts",
        F.lit(is_keeper).cast("boolean").alias("is_keeper"),
        F.lit(is_mock).cast("boolean").alias("is_mock"))
    return align_to_schema(out, ADP_SCHEMA)


def feed_b_damage(docs: DataFrame, *, raw: str = "raw") -> DataFrame:
    """One row per document: its chunk, and the text of a document that is
    missing or not valid JSON (else NULL)."""
    broken = F.try_parse_json(F.col(raw)).isNull()
    return docs.select("season", "scoring_format", "teams",
                       F.when(broken, F.coalesce(F.col(raw), F.lit(""))).alias("damaged"))


def read_text_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole-file JSON text (one document per file) with the path's partition
    columns, for feeds whose shape varies per document."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "raw")


# --- wiki pages ---------------------------------------------------------------

WIKI_DOC = "parse struct<title:string,wikitext:string>, error struct<code:string,info:string>"


def read_wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed page documents -> (title, wikitext); a missing page (an error
    object, no parse) keeps its row with NULL wikitext. A damaged document
    has error code ``damaged``. ``landed_at`` is the file's write time."""
    docs = (spark.read.schema(f"{WIKI_DOC}, {CORRUPT} string").option("multiLine", True)
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    return docs.select(F.col("parse.title").alias("title"),
                       F.col("parse.wikitext").alias("wikitext"),
                       F.when(F.col(CORRUPT).isNotNull(), F.lit("damaged"))
                       .otherwise(F.col("error.code")).alias("error_code"),
                       F.col("_metadata.file_modification_time").alias("landed_at"))


def read_bridge_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)
