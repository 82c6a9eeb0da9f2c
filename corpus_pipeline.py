"""From raw documents to training shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written and read back before the next. All but the last return the columns of
``documents``; every column passes through untouched.

1. ``toxicity``: documents that the classifier scores 0.5 or more go. It is
   fitted on the labelled rows whose crc32(doc_id) mod 5 is not 0.
2. ``near_duplicates``: of each group linked by five-word shingles with a
   Jaccard similarity of 0.8 or more, the document of smallest id stays.
3. ``decontaminate``: documents that hold a benchmark passage go.
4. ``mix``: sources are repeated towards shares that follow the square root
   of their sizes, by Poisson replication, and shuffled.
5. ``shard``: copies are packed into 16 shards balanced in bytes, tokens and
   rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddlekit.llm import decontamination, jaccard_join, mixing, sharding, toxicity
from huddlekit.llm.common import cut, read
from huddlekit.llm.queries import id_crc


BATCH_ROWS = 1000       # whole texts handed to Python at a time


def small_batches(spark: SparkSession) -> None:
    """A stage writes its rows while the next ones are in Python, so the Arrow
    buffers on both sides count; this session setting bounds them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score 0.5 or more go; null and empty texts are scored as empty
    ones, null and repeated ids do not matter."""
    small_batches(spark)
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"), id_crc() % 5 != 0)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without words or with a null id stay; rows that repeat a kept id
    stay with it."""
    small_batches(spark)
    return jaccard_join.one_per_component(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts stay, and so does every row if there are no items."""
    small_batches(spark)
    return decontamination.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are repeated or left out by their source's rate; a null source is a
    source."""
    return mixing.mix_sources(docs).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets one shard and slot; a null text has size 1."""
    return sharding.pack_shards(docs).select("doc_id", "size", "tokens", "text_crc32", F.col("shard"), "slot")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontaminate", decontaminate),
          ("mix", mix), ("shard", shard)]

#: A fitted classifier and a greedy packing have no SQL form; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
