"""Skew-aware building blocks.

* ``left_lookup``: a left join that spreads its NULL-key rows. A NULL key can
  never match, yet a shuffle join hashes every NULL to one reducer; with a
  third of the rows unresolved that reducer would get a third of the data. A
  second join key is 0 on the right and, on the left, 0 for rows with a key
  and a hash of the row for rows without: they stay in the one join, read
  once, and go to many reducers.
* ``dense_rank_by_value``: dense rank computed over the *distinct* values of
  each group, range-partitioned so that even a group with a third of all
  distinct values is ranked by many tasks (local ranks plus per-slice
  offsets), then joined back on (group, value); AQE can split that join when
  one (group, value) is hot.
* ``top_by_value``: the rows of the k highest distinct values of each group,
  cut down in every task before the shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


SALTS = 1024


def left_lookup(left: DataFrame, right: DataFrame, left_key: Column, right_key: str,
                extra_condition: Column | None = None) -> DataFrame:
    """``left`` LEFT JOIN ``right`` ON left_key = right[right_key] (and the
    extra condition); the output has left's columns then right's columns."""
    hashable = [F.col(f"`{f.name}`") for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    salt = F.pmod(F.xxhash64(*hashable), F.lit(SALTS)) + 1 if hashable else F.lit(1).cast("long")
    keyed = left.withColumn("_lk", left_key).withColumn(
        "_ls", F.when(F.col("_lk").isNull(), salt).otherwise(F.lit(0).cast("long")))
    # always 0, but not a literal: it has to stay a join key
    plain = right.withColumn("_rs", F.pmod(F.xxhash64(right_key), F.lit(1).cast("long")))
    on = (F.col("_lk") == F.col(right_key)) & (F.col("_ls") == F.col("_rs"))
    if extra_condition is not None:
        on = on & extra_condition
    return keyed.join(plain, on, "left").drop("_lk", "_ls", "_rs")


def dense_rank_by_value(df: DataFrame, value: str, group: list[str], out: str) -> DataFrame:
    """Dense rank of ``value`` descending within ``group``; rows with a NULL
    value or a NULL group key get a NULL rank.

    1. distinct (group, value) pairs (aggregation with map-side combine);
    2. range-partition them on (group, value desc): a group holding a third
       of the values spans many partitions instead of one task;
    3. rank inside each (partition, group) slice, and shift the slice by the
       number of the group's values in earlier partitions (a small table,
       one row per slice);
    4. join the ranks back on (group, value).
    The range-partitioned values, with their partition id as a column, are
    written once to the shared checkpoint folder and read back, so both uses
    see the same partition ids (and a lost executor recomputes nothing
    upstream)."""
    from huddlekit.sources.store import kept_copy
    rankable = F.col(value).isNotNull()
    for g in group:
        rankable = rankable & F.col(g).isNotNull()
    values = df.where(rankable).select(*group, value).distinct()
    ordered = kept_copy(values.repartitionByRange(*[F.col(g).asc() for g in group], F.col(value).desc())
                        .withColumn("_pid", F.spark_partition_id()), "rank-slices")
    in_slice = Window.partitionBy("_pid", *group).orderBy(F.col(value).desc())
    local = ordered.withColumn("_local", F.row_number().over(in_slice))
    slices = ordered.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    ranks = local.join(offsets, ["_pid", *group]).select(
        *group, value, (F.col("_off") + F.col("_local")).cast("long").alias(out))
    keys = [*group, value]
    ranked = df.where(rankable).join(ranks, keys, "inner")
    unranked = df.where(~rankable).withColumn(out, F.lit(None).cast("long"))
    return ranked.unionByName(unranked).select(*df.columns, out)


def top_by_value(df: DataFrame, value: str, group: list[str], k: int, out: str) -> DataFrame:
    """The rows whose dense rank of ``value`` descending within ``group`` is
    at most ``k``, ties included; rows with a NULL value or group key have no
    rank. Every task keeps only its own k highest values of each group before
    the shuffle (Spark's group limit), so what meets in a group's task is at
    most k values of each task; no other row is ranked."""
    rankable = F.col(value).isNotNull()
    for g in group:
        rankable = rankable & F.col(g).isNotNull()
    order = Window.partitionBy(*group).orderBy(F.col(value).desc())
    return (df.where(rankable).withColumn(out, F.dense_rank().over(order)).where(F.col(out) <= k)
            .withColumn(out, F.col(out).cast("long")))
