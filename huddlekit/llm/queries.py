"""The registered queries of this subpackage, each an operator applied to its
whole table with production parameters."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from huddlekit.llm import (decontamination, hmm, jaccard_join, lexical_search, license_scan, mixing, quality, sharding,
                           spelling, token_counts, toxicity, vector_tree, warc)
from huddlekit.llm.common import read


def id_crc(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"), k=3, percent=90)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read(spark, sf_dir, "pages"), least_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op4_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.hmm_scores(read(spark, sf_dir, "documents"), id_crc() % 5 == 1)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_vector_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_tree.nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = id_crc() % 5 == 0
    model = toxicity.fit_toxicity(docs, read(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_labels(read(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.pack_shards(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(id_crc() % 4 == 2, F.lit(False))
    machine = quality.fit_quality(docs, read(spark, sf_dir, "labels"), ~held_out)
    return quality.score_quality(docs, machine).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=50)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_mix_sources": op2_mix_sources,
    "op3_warc": op3_warc,
    "op4_hidden_markov": op4_hidden_markov,
    "op5_decontamination": op5_decontamination,
    "op6_vector_tree": op6_vector_tree,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_license_scan": op9_license_scan,
    "op10_sharding": op10_sharding,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_lexical_search": op12_lexical_search,
    "op13_spelling_variants": op13_spelling_variants,
}

# SHA-1 in base32: five hexadecimal digits at a time are four letters
WARC_SQL = """
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, url, octet_length(payload)::BIGINT AS payload_bytes, upper(sha1(payload)) AS hex FROM p),
b AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id,
         list_aggregate(list_transform(range(0, 8), lambda g: list_aggregate(list_transform([15, 10, 5, 0], lambda k:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((CAST('0x' || substr(hex, CAST(5 * g + 1 AS BIGINT), 5) AS BIGINT) >> k) & 31) + 1, 1)),
           'string_agg', '')), 'string_agg', '') AS payload_digest FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to, url
FROM b
"""

ORACLE_SQL: dict[str, str] = {
    "op3_warc": WARC_SQL,
    "op12_lexical_search": lexical_search.SEARCH_SQL,
    "op13_spelling_variants": spelling.SPELLING_SQL,
}
