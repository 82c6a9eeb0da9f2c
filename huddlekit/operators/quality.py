"""Data-quality checks returned as DataFrames of ``(check, passed, ...)`` rows.
Each check is one aggregation pass. Zero rows in scope is a failure: a grouped
report over an empty scope holds one failed row (n = 0), never no row."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Every (rate, denominator) pair of the fingerprint whose rate
# is a charted sample.
RATE_DENOMINATOR_PAIRS = (
    ("personnel_11_rate", "plays_with_personnel"),
    ("personnel_12_rate", "plays_with_personnel"),
    ("personnel_21_rate", "plays_with_personnel"),
    ("man_rate", "plays_charted_coverage"),
    ("zone_rate", "plays_charted_coverage"),
    ("pressure_rate", "plays_charted_pressure"),
    ("play_action_rate", "plays_charted_ftn"),
    ("motion_rate", "plays_charted_ftn"),
    ("rpo_rate", "plays_charted_ftn"),
    ("screen_rate", "plays_charted_ftn"),
    ("blitz_rate", "plays_charted_ftn"),
)
RESOLUTION_FLOOR = 0.60
RECONCILE_TOLERANCE = 0.01


def scoped(df: DataFrame, season: int | None, column: str = "season") -> DataFrame:
    """Restrict a check to one season (a partition filter on a table
    partitioned by season, so only that partition is read)."""
    return df if season is None else df.where(F.col(column) == F.lit(season))


def _or_failed(report: DataFrame, rows: DataFrame, *checks: str) -> DataFrame:
    """``report``, plus one failed row per check when ``rows`` is empty
    (found by reading a single row)."""
    none = rows.limit(1).agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    none = none.select("n", F.explode(F.array(*[F.lit(c) for c in checks])).alias("check"),
                       F.lit(False).alias("passed"))
    return report.unionByName(none.select(*[
        (F.col(f.name) if f.name in none.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in report.schema.fields]))


def resolution_check(df: DataFrame, *, source: str = "source", id_col: str = "gsis_id",
                     floor: float = RESOLUTION_FLOOR, season: int | None = None) -> DataFrame:
    """Resolved share per source against a floor; report ordered by source."""
    rows = scoped(df, season)
    g = rows.groupBy(source).agg(F.count(F.lit(1)).alias("n"), F.count(id_col).alias("n_resolved"))
    rate = F.try_divide(F.col("n_resolved").cast("double"), F.col("n").cast("double"))
    report = g.select(F.concat(F.lit("resolution_rate["), F.col(source), F.lit("]")).alias("check"),
                      "n", "n_resolved", F.round(rate, 6).alias("rate"),
                      (F.coalesce(rate, F.lit(0.0)) >= floor).alias("passed"))
    return _or_failed(report, rows, "resolution_rate").orderBy("check")


def grain_checks(df: DataFrame, grain: list[str], name: str, *, season: int | None = None) -> DataFrame:
    """Duplicate groups at the grain and the largest group, one pass. Two
    check rows: no duplicates, and snapshot idempotency (max rows = 1)."""
    per = scoped(df, season).groupBy(*grain).agg(F.count(F.lit(1)).alias("_c"))
    s = per.agg(F.count(F.lit(1)).alias("groups"),
                F.count_if(F.col("_c") > 1).cast("long").alias("dup_groups"),
                F.max("_c").cast("long").alias("max_rows"))
    return s.select(F.inline(F.array(
        F.struct(F.lit(f"no_duplicates[{name}]").alias("check"), "groups", "dup_groups", "max_rows",
                 ((F.col("dup_groups") == 0) & (F.col("groups") > 0)).alias("passed")),
        F.struct(F.lit(f"snapshot_idempotent[{name}]").alias("check"), "groups", "dup_groups",
                 "max_rows", ((F.col("max_rows") <= 1) & (F.col("groups") > 0)).alias("passed")))))


def reconcile_check(df: DataFrame, *, by: str = "season", standard: str = "fantasy_points_standard",
                    receptions: str = "receptions", ppr: str = "fantasy_points_ppr",
                    tol: float = RECONCILE_TOLERANCE, season: int | None = None) -> DataFrame:
    """Only rows with all three values can be checked and count towards n;
    a group without any such row fails."""
    rows = scoped(df, season)
    known = F.col(standard).isNotNull() & F.col(receptions).isNotNull() & F.col(ppr).isNotNull()
    bad = F.abs((F.col(standard) + F.col(receptions)) - F.col(ppr)) > tol
    report = (rows.groupBy(by).agg(F.count_if(known).cast("long").alias("n"),
                                   F.count_if(known & bad).cast("long").alias("n_unreconciled"))
              .select(F.lit("ppr_reconciles").alias("check"), by, "n", "n_unreconciled",
                      ((F.col("n_unreconciled") == 0) & (F.col("n") > 0)).alias("passed")))
    return _or_failed(report, rows, "ppr_reconciles")


def rate_denominator_checks(df: DataFrame, *, by: str = "season",
                            pairs=RATE_DENOMINATOR_PAIRS, season: int | None = None) -> DataFrame:
    """All pairs in one scan (2 counts per pair), then unpivoted to one row
    per (group, pair)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for rate, den in pairs:
        aggs.append(F.count_if(F.col(rate).isNotNull() & F.col(den).isNull()).alias(f"{rate}__nd"))
        aggs.append(F.count_if(F.col(rate).isNotNull() & (F.col(rate) > 1.0)).alias(f"{rate}__o1"))
    scope = scoped(df, season)
    g = scope.groupBy(by).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(f"scheme_denominators[{rate}]").alias("check"),
                              F.col(f"{rate}__nd").cast("long").alias("null_denominator"),
                              F.col(f"{rate}__o1").cast("long").alias("over_one"))
                     for rate, _ in pairs])
    report = (g.select(by, "n", F.inline(rows))
              .withColumn("passed", (F.col("null_denominator") == 0) & (F.col("over_one") == 0)
                          & (F.col("n") > 0)))
    return _or_failed(report, scope, *[f"scheme_denominators[{rate}]" for rate, _ in pairs])


def fill_matrix_check(df: DataFrame, filled, *, by: str = "season", zero_groups=(),
                      ceiling: float = 1.0, tolerance: float = 0.001) -> DataFrame:
    """Fill rate of a column per group against documented bounds: exactly 0
    in ``zero_groups``, at most ``ceiling`` elsewhere (within tolerance).
    Report ordered by group."""
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.count_if(filled).cast("long").alias("n_filled"))
    rate = F.col("n_filled") / F.col("n")
    zero = F.col(by).isin(*zero_groups) if zero_groups else F.lit(False)
    ok = F.when(zero, F.abs(rate) <= tolerance).otherwise(rate <= ceiling + tolerance)
    report = g.select(F.lit("fill_matrix").alias("check"), by, "n", "n_filled",
                      F.round(rate, 6).alias("fill_rate"), ok.alias("passed"))
    return _or_failed(report, df, "fill_matrix").orderBy(by)


def summarize(*checks: DataFrame) -> DataFrame:
    """One row: total checks, passed checks, whether all passed."""
    rows = reduce(lambda a, b: a.unionByName(b),
                  [c.select("check", "passed") for c in checks])
    return rows.agg(F.count(F.lit(1)).alias("checks"),
                    F.count_if("passed").cast("long").alias("passed_checks"),
                    F.coalesce(F.bool_and("passed"), F.lit(False)).alias("all_passed"))
