"""Reshaping operators: side-by-side unpivot, two-era layout reconciliation
and the season guard applied before a partition is replaced."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huddlekit.functions.exprs import first_present, lenient_date, season_from_date, to_long


def unpivot_sides(schedules: DataFrame, season: int | None = None) -> DataFrame:
    """One game row with home/away columns -> two team rows (``team``,
    ``opponent``, ``is_home``, ``head_coach``). A single pass: ``inline`` over
    a two-element array, no union and no second scan. Empty in, empty out.
    ``season`` stamps the load's season; without it the schedule's own
    ``season`` column is kept."""
    date = lenient_date(first_present(schedules, "gameday", "game_date", dtype="string"))
    home = F.struct(F.col("home_team").alias("team"), F.col("away_team").alias("opponent"),
                    F.lit(True).alias("is_home"), F.col("home_coach").alias("head_coach"))
    away = F.struct(F.col("away_team").alias("team"), F.col("home_team").alias("opponent"),
                    F.lit(False).alias("is_home"), F.col("away_coach").alias("head_coach"))
    return (schedules
            .select("game_id", (F.lit(season) if season is not None else F.col("season"))
                    .cast("long").alias("season"),
                    F.col("week").cast("long").alias("week"), date.alias("game_date"),
                    F.inline(F.array(home, away))))


def legacy_name(first: Column, last: Column) -> Column:
    """first + ' ' + last, trimmed; a missing part is ''. Two missing parts give
    '' (not NULL)."""
    return F.trim(F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit(""))))


DEPTH_COLUMNS = ("season", "week", "team", "gsis_id", "player_name", "position", "depth_rank",
                 "depth_position", "formation", "pos_slot", "source_era")


def reconcile_eras(df: DataFrame, season_arg: int | None = None) -> DataFrame:
    """Reconcile the legacy layout (season, week, club_code, first/last name,
    position, depth_team, depth_position, formation) and the modern layout (dt,
    team, player_name, pos_abb, pos_rank, pos_name, pos_slot) into one core
    (``DEPTH_COLUMNS``).

    Era per row: legacy iff the upstream ``season`` is set. Season precedence:
    upstream season, then the season of ``dt``, then the load argument. The
    display name falls back to first + last (so two missing parts give '').
    ``pos_slot`` is text (its upstream type differs between vintages).
    """
    from pyspark.sql import types as T

    from huddlekit.operators.contracts import coerce
    up_season = to_long(first_present(df, "season"))
    dt = first_present(df, "dt")
    arg = F.lit(season_arg).cast("long")
    legacy = up_season.isNotNull()
    name = F.coalesce(first_present(df, "player_name", dtype="string"),
                      legacy_name(first_present(df, "first_name", dtype="string"),
                                  first_present(df, "last_name", dtype="string")))
    slot = coerce(df, "pos_slot", T.StringType()) if "pos_slot" in df.columns else F.lit(None).cast("string")
    return df.select(
        F.coalesce(up_season, season_from_date(dt), arg).alias("season"),
        to_long(first_present(df, "week")).alias("week"),
        F.coalesce(first_present(df, "club_code", dtype="string"),
                   first_present(df, "team", dtype="string")).alias("team"),
        first_present(df, "gsis_id", dtype="string").alias("gsis_id"),
        name.alias("player_name"),
        F.coalesce(first_present(df, "position", dtype="string"),
                   first_present(df, "pos_abb", dtype="string")).alias("position"),
        F.coalesce(to_long(first_present(df, "depth_team")),
                   to_long(first_present(df, "pos_rank"))).alias("depth_rank"),
        F.coalesce(first_present(df, "depth_position", dtype="string"),
                   first_present(df, "pos_name", dtype="string")).alias("depth_position"),
        first_present(df, "formation", dtype="string").alias("formation"),
        slot.alias("pos_slot"),
        F.when(legacy, F.lit("legacy")).otherwise(F.lit("modern")).alias("source_era"))


def season_guard(df: DataFrame, season: int, column: str = "season") -> tuple[DataFrame, Column, Column]:
    """Rows that belong to partition ``season``; also returns aggregate
    expressions for the written and dropped counts (foreign or NULL season),
    so a caller can ``observe`` them on the same pass."""
    keep = F.col(column) == F.lit(season)
    written = F.count_if(F.coalesce(keep, F.lit(False))).alias("written")
    dropped = F.count_if(~F.coalesce(keep, F.lit(False))).alias("dropped")
    return df.where(keep), written, dropped
