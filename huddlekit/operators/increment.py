"""Incremental load planning: the work matrix of chunks, era gating, and the
anti-join against the run log."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddlekit.sources.store import completed


def work_matrix(spark: SparkSession, dims: dict[str, list]) -> DataFrame:
    """All combinations of the requested dimension values (the arguments of a
    load, e.g. sources x seasons x formats). Built by exploding literal
    arrays: its size is the product of the argument lists, never of data."""
    df = spark.range(1).select()
    for name, values in dims.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def gate(chunks: DataFrame, *, season_col: str = "season", min_season: dict | int | None = None,
         source_col: str | None = None, allowed: dict | None = None,
         format_col: str | None = None) -> DataFrame:
    """Adds ``gated``: 'empty' when the season is below the feed's first
    season (recorded, never read), 'skip' when the source does not publish
    the format, else NULL (to be loaded)."""
    gated = F.lit(None).cast("string")
    if allowed and source_col and format_col:
        for src, fmts in allowed.items():
            gated = F.when((F.col(source_col) == src) & ~F.col(format_col).isin(*fmts),
                           F.lit("skip")).otherwise(gated)
    if isinstance(min_season, int):
        gated = F.when(F.col(season_col) < min_season, F.lit("empty")).otherwise(gated)
    elif isinstance(min_season, dict) and source_col:
        for src, m in min_season.items():
            gated = F.when((F.col(source_col) == src) & (F.col(season_col) < m),
                           F.lit("empty")).otherwise(gated)
    return chunks.withColumn("gated", gated)


def pending(chunks: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks still to load: not gated and not completed in the run log.

    ``keys`` decides what counts as done. A daily snapshot capture must
    include the capture day in its keys (or not resume at all): keyed on
    (source, season, format, teams) alone, a resumed run would skip every
    chunk already captured on an earlier day."""
    todo = chunks.where(F.col("gated").isNull()).drop("gated")
    return todo.join(completed(log, keys), keys, "left_anti")
