"""Declared tables: contract, layout, transform and first season of each.

A table's contract is either written out (``schema``) or built from the
schemas of its feed's landed vintages under an ``Overlay`` that fixes the
columns whose type must not follow the feed. Where the feed's width is not
known beforehand, columns are whatever has landed.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huddlekit.functions.exprs import season_week_from_key, to_long_in
from huddlekit.operators.contracts import TYPES, ColumnSpec, ingested_at_spec, specs_from_frame, to_struct
from huddlekit.operators.fingerprint import FINGERPRINT_SCHEMA, team_week_fingerprint
from huddlekit.operators.reshape import reconcile_eras, unpivot_sides
from huddlekit.operators.scoring import points_weekly


@dataclass(frozen=True)
class Overlay:
    """What is laid over the schema of a feed: columns the transform adds,
    types that must hold, required columns, documentation, columns left out.
    A name that neither the feed nor ``added`` has is an error."""
    added: dict[str, str] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    enrichment: dict[str, dict] = field(default_factory=dict)
    drop: tuple[str, ...] = ()

    def contract(self, feed: T.StructType, table: str) -> T.StructType:
        more = [T.StructField(c, TYPES[t]) for c, t in self.added.items() if c not in feed.fieldNames()]
        return to_struct(specs_from_frame(T.StructType([*feed.fields, *more]), table=table, drop=self.drop,
                                          enrichment=self.enrichment, required=self.required,
                                          type_overrides={**self.added, **self.types}))


def _unchanged(df: DataFrame, season: int) -> DataFrame:
    return df


@dataclass(frozen=True)
class TableSpec:
    """A season-chunked table. ``transform`` conforms the feed rows of one
    season. A table with ``inputs`` is derived: ``derive`` gets its feed rows
    and the stored rows of that season of each input."""
    name: str
    path_for_season: Callable[[int], str]
    min_season: int
    transform: Callable[[DataFrame, int], DataFrame] = _unchanged
    schema: T.StructType | None = None
    partition: str = "season"
    cluster_by: tuple[str, ...] = ()
    overlay: Overlay | None = None
    inputs: tuple[str, ...] = ()
    derive: Callable[[DataFrame, dict[str, DataFrame], int], DataFrame] | None = None


# --- transforms ---------------------------------------------------------------

def stamp_season(df: DataFrame, season: int) -> DataFrame:
    """The load's season, whatever the feed says."""
    return df.withColumn("season", F.lit(season).cast("long"))


def conform_participation(df: DataFrame, season: int) -> DataFrame:
    """Stamp the load season, parse the week from the game id, make the play
    id a bigint (its type drifts between vintages)."""
    _, week = season_week_from_key("nflverse_game_id")
    return stamp_season(df, season).withColumns({"week": week, "play_id": to_long_in(df, "play_id")})


def conform_charting(df: DataFrame, season: int) -> DataFrame:
    return stamp_season(df, season).withColumn("nflverse_play_id", to_long_in(df, "nflverse_play_id"))


def conform_schedules(df: DataFrame, season: int) -> DataFrame:
    return unpivot_sides(df, season)


def conform_player_stats(df: DataFrame, season: int) -> DataFrame:
    return points_weekly(df, season=season)


def derive_team_week(plays: DataFrame, stored: dict[str, DataFrame], season: int) -> DataFrame:
    """Fingerprint of one season from its plays and the stored charting and
    coach rows; plays are keyed by (game, play). An input from before the
    input's first season has no rows, and its block is NULL."""
    participation, ftn = stored.get("participation"), stored.get("ftn_charting")
    coaches = stored["nfl_coaches"].select("season", "week", "team", "head_coach")
    return team_week_fingerprint(
        stamp_season(plays, season).withColumnRenamed("posteam", "team"),
        participation.withColumnRenamed("nflverse_game_id", "game_id") if participation is not None else None,
        ftn.withColumnsRenamed({"nflverse_game_id": "game_id", "nflverse_play_id": "play_id"})
        if ftn is not None else None,
        coaches, personnel=True)


# --- contracts ----------------------------------------------------------------

def _columns(required: tuple[str, ...], **types: str) -> T.StructType:
    return to_struct([*(ColumnSpec(c, t, "REQUIRED" if c in required else "NULLABLE") for c, t in types.items()),
                      ingested_at_spec()])


DEPTH_CHARTS_SCHEMA = _columns(
    ("season", "source_era"), season="INT64", week="INT64", team="STRING", gsis_id="STRING", player_name="STRING",
    position="STRING", depth_rank="INT64", depth_position="STRING", formation="STRING", pos_slot="STRING",
    source_era="STRING")
COACHES_SCHEMA = _columns(
    ("game_id", "season", "team"), game_id="STRING", season="INT64", week="INT64", game_date="DATE", team="STRING",
    opponent="STRING", is_home="BOOL", head_coach="STRING")
POINTS_WEEKLY_SCHEMA = _columns(
    ("season",), season="INT64", week="INT64", player_id="STRING", gsis_id="STRING", player_name="STRING",
    position="STRING", team="STRING", receptions="INT64", fantasy_points_standard="FLOAT64",
    fantasy_points_half_ppr="FLOAT64", fantasy_points_ppr="FLOAT64", position_rank_ppr="INT64")
TEAM_WEEK_SCHEMA = _columns(
    ("season", "week", "team"),
    **{c: {"bigint": "INT64", "double": "FLOAT64", "string": "STRING"}[t] for c, t in FINGERPRINT_SCHEMA})
SEASON_KEY = {"season": "INT64"}
WEEK = {"week": "INT64"}
ID = {"tags": ("identifier", "join_key")}
RANKINGS = Overlay(types={"scrape_date": "DATE"}, required=("scrape_date", "ecr_type", "id"),
                   enrichment={"id": {"description": "Player id of the rankings' publisher.", **ID}})

#: Season-chunked tables in load order; each comes after its inputs.
TABLE_NAMES = ("ff_opportunity", "snap_counts", "injuries", "depth_charts", "participation", "ftn_charting",
               "nfl_coaches", "ff_points_weekly", "team_scheme_week")


def season_tables(path_of: Callable[[str, int], str]) -> list[TableSpec]:
    """The nine season-chunked tables; ``path_of(feed, season)`` says where a
    season of a feed is landed."""
    def landed(feed: str) -> Callable[[int], str]:
        return lambda season: path_of(feed, season)

    return [
        TableSpec("ff_opportunity", landed("opportunity"), 2006, stamp_season, cluster_by=("week", "player_id"),
                  overlay=Overlay(SEASON_KEY, WEEK, ("season",), {"player_id": ID})),
        TableSpec("snap_counts", landed("snap_counts"), 2013, stamp_season,
                  cluster_by=("week", "team", "pfr_player_id"),
                  overlay=Overlay(SEASON_KEY, WEEK, ("season",), {"pfr_player_id": ID})),
        TableSpec("injuries", landed("injuries"), 2009, stamp_season, cluster_by=("week", "team", "gsis_id"),
                  overlay=Overlay(SEASON_KEY, WEEK, ("season",), {"gsis_id": ID})),
        TableSpec("depth_charts", landed("depth_charts"), 2001, reconcile_eras, DEPTH_CHARTS_SCHEMA,
                  cluster_by=("team", "gsis_id", "source_era")),
        TableSpec("participation", landed("participation"), 2016, conform_participation,
                  cluster_by=("week", "nflverse_game_id", "play_id"),
                  overlay=Overlay({**SEASON_KEY, **WEEK}, {"play_id": "INT64"}, ("season",),
                                  {"nflverse_game_id": ID, "play_id": ID})),
        TableSpec("ftn_charting", landed("ftn_charting"), 2022, conform_charting,
                  cluster_by=("week", "nflverse_game_id"),
                  overlay=Overlay(SEASON_KEY, {"nflverse_play_id": "INT64", **WEEK}, ("season",),
                                  {"nflverse_game_id": ID, "nflverse_play_id": ID})),
        TableSpec("nfl_coaches", landed("schedules"), 1999, conform_schedules, COACHES_SCHEMA,
                  cluster_by=("team", "game_id")),
        TableSpec("ff_points_weekly", landed("player_stats"), 1999, conform_player_stats, POINTS_WEEKLY_SCHEMA,
                  cluster_by=("week", "position", "gsis_id")),
        TableSpec("team_scheme_week", landed("play_by_play"), 1999, schema=TEAM_WEEK_SCHEMA,
                  cluster_by=("week", "team"), inputs=("participation", "ftn_charting", "nfl_coaches"),
                  derive=derive_team_week),
    ]


def select_tables(specs: list[TableSpec], names: list[str] | None) -> list[TableSpec]:
    """The specs of the given names, in registry order; an unknown name is an
    error that lists the known ones."""
    known = [s.name for s in specs]
    unknown = [n for n in names or [] if n not in known]
    if unknown:
        raise ValueError(f"unknown tables {unknown}; known are {known}")
    return [s for s in specs if not names or s.name in names]
