"""Check groups over stored tables, season by season.

Each group reads its table once, pruned to the requested seasons: all checks
of the group are counts of one aggregation by season, unpivoted to one row per
check and season. A requested season without rows fails every check of its
group. The rows are appended to a check log.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from huddlekit import __version__
from huddlekit.functions.exprs import is_charted
from huddlekit.operators.contracts import ADP_GRAIN
from huddlekit.operators.quality import RATE_DENOMINATOR_PAIRS, RECONCILE_TOLERANCE, RESOLUTION_FLOOR
from huddlekit.sources.store import append_run_log, kept_copy

# Documented bounds of the share of plays with coverage charting.
COVERAGE_ZERO_SEASONS = (2016, 2017)
COVERAGE_CEILING = 0.496
COVERAGE_TOLERANCE = 0.001


@dataclass(frozen=True)
class Check:
    """A check of an aggregated season: whether it passed, and what was seen."""
    name: str
    passed: Column
    detail: Column


def _said(*parts: tuple[str, Column]) -> Column:
    return F.concat_ws(" ", *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in parts])


def _by_season(rows: DataFrame, counts: dict[str, Column], checks: list[Check]) -> DataFrame:
    """One aggregation by season, one row per check."""
    seen = rows.groupBy(F.col("season").cast("long").alias("season")).agg(
        F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in counts.items()])
    lines = F.array(*[F.struct(F.lit(c.name).alias("check"), c.passed.alias("passed"), c.detail.alias("detail"))
                      for c in checks])
    return seen.select("season", "n", F.inline(lines)).select("check", "season", "n", "passed", "detail")


def points_weekly_checks(rows: DataFrame) -> DataFrame:
    """Standard points and receptions make up the feed's PPR points, wherever
    all three are known; some row must be."""
    parts = [F.col(c) for c in ("fantasy_points_standard", "receptions", "fantasy_points_ppr")]
    known = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    counts = {"known": F.count_if(known),
              "off": F.count_if(known & (F.abs(parts[0] + parts[1] - parts[2]) > RECONCILE_TOLERANCE))}
    return _by_season(rows, counts, [Check("ppr_reconciles", (F.col("known") > 0) & (F.col("off") == 0),
                                           _said(("known", F.col("known")), ("off", F.col("off"))))])


def scheme_checks(rows: DataFrame) -> DataFrame:
    """No rate without its denominator, none above 1; all pairs in one pass."""
    counts, checks = {}, []
    for rate, den in RATE_DENOMINATOR_PAIRS:
        has = F.col(rate).isNotNull()
        counts[f"{rate}_loose"] = F.count_if(has & F.col(den).isNull())
        counts[f"{rate}_over"] = F.count_if(has & (F.col(rate) > 1.0))
        loose, over = F.col(f"{rate}_loose"), F.col(f"{rate}_over")
        checks.append(Check(f"denominator[{rate}]", (loose == 0) & (over == 0), _said(("loose", loose), ("over", over))))
    return _by_season(rows, counts, checks)


def coverage_checks(rows: DataFrame) -> DataFrame:
    """Share of plays with coverage charting against its documented bounds."""
    charted = F.col("charted")
    rate = charted / F.col("n")
    ok = F.when(F.col("season").isin(*COVERAGE_ZERO_SEASONS), rate <= COVERAGE_TOLERANCE).otherwise(
        rate <= COVERAGE_CEILING + COVERAGE_TOLERANCE)
    return _by_season(rows, {"charted": F.count_if(is_charted(F.col("defense_man_zone_type")))},
                      [Check("coverage_matrix", ok, _said(("charted", charted)))])


def adp_checks(rows: DataFrame) -> DataFrame:
    """Resolved share per source, rows per grain key. The rows are counted by
    grain key first (a hot key is combined map-side), sources and seasons from
    those counts."""
    per_key = rows.groupBy(*ADP_GRAIN).agg(F.count(F.lit(1)).alias("c"), F.count("gsis_id").alias("r"))
    by_source = per_key.groupBy(F.col("season").cast("long").alias("season"), "source").agg(
        F.sum("c").alias("n"), F.sum("r").alias("resolved"), F.count_if(F.col("c") > 1).alias("dups"),
        F.max("c").alias("worst"))
    # a handful of rows: sources x seasons
    season = Window.partitionBy("season")
    seen = by_source.select(
        "*", F.sum("n").over(season).alias("all_n"), F.sum("dups").over(season).alias("all_dups"),
        F.max("worst").over(season).alias("all_worst"), (F.col("source") == F.min("source").over(season)).alias("one"))

    def line(name: Column, n: str, passed: Column, detail: Column) -> Column:
        return F.struct(name.alias("check"), F.col(n).alias("n"), passed.alias("passed"), detail.alias("detail"))
    own = line(F.concat(F.lit("resolution_rate["), "source", F.lit("]")), "n",
               F.col("resolved") / F.col("n") >= RESOLUTION_FLOOR, _said(("resolved", F.col("resolved"))))
    keys = [line(F.lit("no_duplicates"), "all_n", F.col("all_dups") == 0, _said(("keys", F.col("all_dups")))),
            line(F.lit("snapshot_idempotent"), "all_n", F.col("all_worst") <= 1, _said(("most", F.col("all_worst"))))]
    lines = F.when(F.col("one"), F.array(own, *keys)).otherwise(F.array(own))
    return seen.select("season", F.inline(lines)).select("check", "season", "n", "passed", "detail")


CHECK_GROUPS: dict[str, tuple[Callable[[DataFrame], DataFrame], tuple[str, ...]]] = {
    "adp": (adp_checks, ("resolution_rate", "no_duplicates", "snapshot_idempotent")),
    "points-weekly": (points_weekly_checks, ("ppr_reconciles",)),
    "scheme-denominators": (scheme_checks, tuple(f"denominator[{r}]" for r, _ in RATE_DENOMINATOR_PAIRS)),
    "participation-coverage": (coverage_checks, ("coverage_matrix",)),
}


def verify_tables(spark: SparkSession, tables: dict[str, str], seasons, log_path: str | None = None, *,
                  version: str = __version__) -> DataFrame:
    """``check_group, table_name, check, season, n, passed, detail,
    checked_at, version``: a row for every check and requested season of the
    given groups (group -> stored table), as appended to ``log_path``. An
    unknown group is an error before anything is read."""
    unknown = [g for g in tables if g not in CHECK_GROUPS]
    if unknown or not tables:
        raise ValueError(f"unknown check groups {unknown}; known are {list(CHECK_GROUPS)}")
    wanted = sorted({int(s) for s in seasons})
    asked = spark.createDataFrame([(s,) for s in wanted], "season long")
    out = None
    for group, table in tables.items():
        checks, names = CHECK_GROUPS[group]
        seen = checks(spark.table(table).where(F.col("season").isin(wanted)))
        # seasons without rows: as many rows as arguments
        none = F.col("check").isNull()
        lines = F.when(none, F.array(*[F.lit(n) for n in names])).otherwise(F.array("check"))
        rows = asked.join(seen, "season", "left").select(
            F.lit(group).alias("check_group"), F.lit(table).alias("table_name"), F.explode(lines).alias("check"), "season",
            F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("passed", F.lit(False)).alias("passed"),
            F.when(none, F.lit("no rows")).otherwise(F.col("detail")).alias("detail"))
        out = rows if out is None else out.unionByName(rows)
    out = kept_copy(out.select("*", F.current_timestamp().alias("checked_at"), F.lit(version).alias("version"))
                    .coalesce(1), "checks")
    if log_path:
        append_run_log(out, log_path)
    return out
