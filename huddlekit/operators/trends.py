"""Consumer queries over the snapshot and team-week grains: day-over-day
drift, tenure stints (gaps and islands) and before/after deltas.

Each window runs over a pre-aggregated grain (one row per entity per day or
per stint), so a window partition holds at most one row per calendar day of
one entity, however many raw rows that entity has.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def day_over_day(daily: DataFrame, keys: list[str], day: str, value: str) -> DataFrame:
    """Change of ``value`` since the entity's previous captured day; a gap
    day is a real gap (``gap_days`` > 1), not an interpolation."""
    w = Window.partitionBy(*keys).orderBy(day)
    prev_v = F.lag(value).over(w)
    prev_d = F.lag(day).over(w)
    return daily.select("*", prev_v.alias("prev_value"), (F.col(value) - prev_v).alias("drift"),
                        F.datediff(F.col(day), prev_d).alias("gap_days"))


def stints(seq: DataFrame, keys: list[str], order: str, label: str) -> DataFrame:
    """Consecutive runs of the same ``label`` per entity (gaps and islands).
    A label that returns after another one starts a new stint; adjacent NULL
    labels are one stint."""
    w = Window.partitionBy(*keys).orderBy(order)
    first = F.row_number().over(w) == 1
    changed = (first | ~F.lag(label).over(w).eqNullSafe(F.col(label))).cast("int")
    marked = seq.withColumn("_chg", changed).withColumn(
        "stint_no", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
    return marked.drop("_chg")


def stint_summary(marked: DataFrame, keys: list[str], order: str, label: str,
                  value: str | None = None) -> DataFrame:
    aggs = [F.first(label).alias(label), F.min(order).alias("start"), F.max(order).alias("end"),
            F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.avg(value).alias("avg_value"))
    return marked.groupBy(*keys, "stint_no").agg(*aggs)


def before_after(summary: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Each stint against the one before it: previous label and the change in
    the stint average."""
    w = Window.partitionBy(*keys).orderBy("stint_no")
    return summary.select("*", F.lag(label).over(w).alias(f"prev_{label}"),
                          F.lag("avg_value").over(w).alias("prev_avg"),
                          (F.col("avg_value") - F.lag("avg_value").over(w)).alias("delta"))


def market_vs_output(market: DataFrame, output: DataFrame, *, id_col: str = "gsis_id",
                     value: str = "fantasy_points_ppr") -> DataFrame:
    """Each market row next to the realised output of its resolved player:
    output is totalled per player first (partial aggregation), then looked up
    with a NULL-guarded left join, so unresolved rows neither match nor pile
    onto one reducer."""
    from huddlekit.operators.skew import left_lookup
    totals = (output.where(F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_pid"))
              .agg(F.sum(value).alias("total_points"), F.count(F.lit(1)).alias("weeks")))
    return left_lookup(market, totals, F.col(id_col), "_pid").drop("_pid")
