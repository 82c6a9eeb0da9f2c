"""Weekly fantasy scoring and positional ranks."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huddlekit.operators.skew import dense_rank_by_value

RANK_GROUP = ("season", "week", "position")


def half_ppr(standard, receptions) -> Column:
    """Half-PPR = standard + 0.5 * receptions; NULL propagates."""
    s = F.col(standard) if isinstance(standard, str) else standard
    r = F.col(receptions) if isinstance(receptions, str) else receptions
    return s.cast("double") + F.lit(0.5) * r.cast("double")


def dense_rank_desc(df: DataFrame, value: str, group: tuple[str, ...] | list[str] = RANK_GROUP,
                    out: str = "position_rank_ppr") -> DataFrame:
    """Dense rank of ``value`` (highest first) inside ``group``. A row with a
    NULL value or a NULL group key gets a NULL rank and takes no rank from
    the others. Ranked over distinct values (see ``skew.dense_rank_by_value``)
    so a hot group is not sorted whole in one task."""
    return dense_rank_by_value(df, value, list(group), out)


def points_weekly(stats: DataFrame, *, rank: bool = True, season: int | None = None) -> DataFrame:
    """Player stats -> weekly points. The feed's player id is the gsis id
    (both are kept); PPR is carried from the feed, never recomputed;
    half-PPR is derived; rank is by PPR within (season, week, position).
    ``season`` stamps the load's season instead of the feed's column."""
    df = stats.select(
        (F.lit(season) if season is not None else F.col("season")).cast("long").alias("season"),
        F.col("week").cast("long").alias("week"),
        F.col("player_id").cast("string").alias("player_id"),
        F.col("player_id").cast("string").alias("gsis_id"),
        F.col("player_name"), F.col("position"), F.col("team"),
        F.col("receptions").cast("long").alias("receptions"),
        F.col("fantasy_points").cast("double").alias("fantasy_points_standard"),
        half_ppr("fantasy_points", "receptions").alias("fantasy_points_half_ppr"),
        F.col("fantasy_points_ppr").cast("double").alias("fantasy_points_ppr"))
    return dense_rank_desc(df, "fantasy_points_ppr") if rank else df
