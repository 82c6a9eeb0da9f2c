"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate (target share of the mix over its own
share). A document's number of copies is a Poisson draw with that mean, found
by inverting the distribution at a uniform number that is a hash of the seed
and the document. Rows are then exploded by their counts and shuffled
globally by another hash.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huddlekit.llm.common import cut

BUCKETS = 16.0 ** 13


def unit_hash(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 13 hex digits of an MD5."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(BUCKETS)


def poisson_inverse(u: Column, rate: Column, tail: int = 12) -> Column:
    """Smallest k with P(X <= k) > u for X ~ Poisson(rate), with generated
    code and array functions only.

    P(X = k) is exp(k ln(rate) - rate - ln k!), with ln k! from a running
    sum, so large rates do not underflow. The search covers k up to
    rate + tail * sqrt(rate) + 20, past which the tail is below 1e-16."""
    top = F.ceil(rate + F.lit(tail) * F.sqrt(rate) + F.lit(20)).cast("int")
    zero = F.struct(F.lit(0).alias("k"), (-rate).alias("log_p"), F.lit(0.0).alias("below"))
    # one step of the scan: add P(X = k) while the sum is still <= u
    step = F.aggregate(
        F.sequence(F.lit(0), top), zero,
        lambda s, k: F.when(s["below"] + F.exp(s["log_p"]) <= u, F.struct(
            (k + 1).alias("k"), (s["log_p"] + F.log(rate) - F.log((k + 1).cast("double"))).alias("log_p"),
            (s["below"] + F.exp(s["log_p"])).alias("below"))).otherwise(F.struct(
                s["k"].alias("k"), s["log_p"].alias("log_p"), s["below"].alias("below"))),
        lambda s: s["k"])
    return F.when(rate > 0, step).otherwise(F.lit(0)).cast("int")


def source_rates(docs: DataFrame, weights: DataFrame | None = None, *, temperature: float = 0.5,
                 source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``source_key, rate``: mean copies per document of each source.

    ``weights(source, weight)`` gives target shares (relative, null counts as
    0, repeated sources add up; a source without a weight gets rate 0).
    Without it, a source's target share is its byte share to the power
    ``temperature``. The mix keeps the input's number of bytes. A null source
    is a source of its own."""
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + 1
    per = (docs.select(F.col(source_col).alias("source_key"), size.cast("double").alias("size"))
           .groupBy("source_key").agg(F.sum("size").alias("bytes")))
    if weights is None:
        per = per.withColumn("weight", F.pow("bytes", F.lit(temperature)))
    else:
        want = (weights.groupBy(F.col("source").alias("wanted"))
                .agg(F.sum(F.coalesce(F.col("weight").cast("double"), F.lit(0.0))).alias("weight")))
        per = (per.join(want, F.col("source_key").eqNullSafe(F.col("wanted")), "left")
               .select("source_key", "bytes", F.coalesce("weight", F.lit(0.0)).alias("weight")))
    total = per.agg(F.sum("bytes").alias("all_bytes"), F.sum("weight").alias("all_weight"))
    one = total.withColumn("one", F.lit(1))
    return (per.withColumn("one", F.lit(1)).join(one, "one")
            .select("source_key", F.coalesce(F.col("weight") / F.col("all_weight") * F.col("all_bytes")
                                             / F.col("bytes"), F.lit(0.0)).alias("rate")))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, *, seed: str = "mix-1",
                temperature: float = 0.5, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``mix_rate, mix_copies, mix_copy`` (from
    0) and ``mix_order`` in [0, 1): one row per drawn copy, shuffled over all
    partitions by ``mix_order``.

    The draw depends on seed and id alone, so repeated rows get equal counts
    and a rerun or a retried task gives the same rows. A null id draws as the
    text 'null'. An empty table gives an empty mix. Clashing columns named
    like the four new ones are replaced.
    """
    docs = docs.drop("mix_rate", "mix_copies", "mix_copy", "mix_order")
    rates = source_rates(docs, weights, temperature=temperature, source_col=source_col, text_col=text_col)
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    # one row per source, written first so that Spark knows its size: broadcast below
    # the session's threshold, else a shuffle join whose skewed partitions are split
    rates = cut(rates, "rates")
    joined = docs.join(rates.withColumnRenamed("rate", "mix_rate"),
                       F.col(source_col).eqNullSafe(F.col("source_key")), "left").drop("source_key")
    counted = (joined.withColumn("mix_rate", F.coalesce("mix_rate", F.lit(0.0)))
               .withColumn("mix_copies", poisson_inverse(unit_hash(F.lit(seed), ident), F.col("mix_rate")))
               .filter("mix_copies > 0"))
    copies = counted.withColumn("mix_copy", F.explode(F.sequence(F.lit(0), F.col("mix_copies") - 1)))
    ordered = copies.withColumn("mix_order", unit_hash(F.lit(seed), F.lit("order"), ident,
                                                       F.col("mix_copy").cast("string")))
    return ordered.repartition(F.col("mix_order")).sortWithinPartitions("mix_order")
