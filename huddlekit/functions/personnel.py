"""Offensive personnel parsing as column expressions (no Python UDF).

Two upstream encodings exist: a modern per-player list (``'C;G;QB;RB;...'``)
and a legacy count summary (``'1 RB, 1 TE, 3 WR'``). Each parser yields
``n_rb, n_te, n_wr, n_qb, plausible``.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define plausibility (must match the upstream contract):
# a modern row lists exactly 11 players with exactly 1 QB; a legacy row may
# only carry offensive skill labels QB, RB, FB, TE, WR.
MODERN_PLAYER_COUNT = 11
MODERN_QB_COUNT = 1
LEGACY_ALLOWED = ("QB", "RB", "FB", "TE", "WR")
LEGACY_TOKEN_PATTERN = r"(\d+)(?U:\s*)([A-Za-z]+)"
MODERN_FROM_SEASON = 2023

COUNT_LABELS = ("RB", "TE", "WR", "QB")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _token_array(x) -> Column:
    """Tokens with surrounding (Unicode) whitespace trimmed and empty tokens
    dropped, using one regex pass and plain array functions (generated code;
    no per-element lambda)."""
    s = F.coalesce(_c(x).cast("string"), F.lit(""))
    s = F.regexp_replace(s, r"(?U)\s*(;)\s*|^\s+|\s+$", "$1")
    return F.array_remove(F.split(s, ";"), "")


def parse_modern(x) -> dict[str, Column]:
    tokens = _token_array(x)
    n = F.size(tokens)
    out = {f"n_{lab.lower()}": (n - F.size(F.array_remove(tokens, lab))).cast("long")
           for lab in COUNT_LABELS}
    out["plausible"] = (n == MODERN_PLAYER_COUNT) & (out["n_qb"] == MODERN_QB_COUNT)
    return out


def parse_legacy(x) -> dict[str, Column]:
    """Count summary -> per-label totals. When no label repeats (the normal
    case) the totals are read from a label -> count map; a repeated label is
    summed with an array fold, evaluated only for those rows."""
    up = F.upper(_c(x).cast("string"))
    empty = F.array().cast("array<string>")
    nums = F.coalesce(F.regexp_extract_all(up, F.lit(LEGACY_TOKEN_PATTERN), 1), empty)
    labs = F.coalesce(F.regexp_extract_all(up, F.lit(LEGACY_TOKEN_PATTERN), 2), empty)
    distinct = F.size(F.array_distinct(labs)) == F.size(labs)
    by_label = F.map_from_arrays(labs, nums)

    def total(label: str) -> Column:
        direct = F.coalesce(F.try_element_at(by_label, F.lit(label)).try_cast("long"), F.lit(0).cast("long"))
        parts = F.zip_with(nums, labs, lambda n, lab: F.when(lab == F.lit(label), n.try_cast("long"))
                           .otherwise(F.lit(0).cast("long")))
        folded = F.aggregate(parts, F.lit(0).cast("long"), lambda acc, v: acc + v)
        return F.when(distinct, direct).otherwise(folded).cast("long")

    out = {f"n_{lab.lower()}": total(lab) for lab in COUNT_LABELS}
    allowed = F.array(*[F.lit(v) for v in LEGACY_ALLOWED])
    out["plausible"] = (F.size(labs) > 0) & (F.size(F.array_except(labs, allowed)) == 0)
    return out


def with_personnel(df, season, positions, personnel, modern_from: int = MODERN_FROM_SEASON):
    """``df`` plus n_rb, n_te, n_wr, n_qb, plausible, personnel_source.

    The era is a property of the season, so rows are split by season into
    two branches, each running only its own parser, and the branches are
    unioned (no shuffle). When the input is partitioned by season each
    branch prunes to its own seasons' files, so nothing is read twice; and
    each branch keeps a small expression tree that stays in generated code
    (one CASE over both parsers' structs grows past the codegen size limit
    and runs interpreted)."""
    is_modern = F.coalesce(_c(season) >= F.lit(modern_from), F.lit(False))
    names = ["n_rb", "n_te", "n_wr", "n_qb", "plausible"]
    m, lg = parse_modern(positions), parse_legacy(personnel)
    modern = df.where(is_modern).select(*df.columns, *[m[k].alias(k) for k in names],
                                         F.lit("offense_positions").alias("personnel_source"))
    legacy = df.where(~is_modern).select(
        *df.columns, *[lg[k].alias(k) for k in names],
        F.when(_c(season).isNotNull(), F.lit("offense_personnel")).alias("personnel_source"))
    return modern.unionByName(legacy)


def personnel_counts(season, positions, personnel,
                     modern_from: int = MODERN_FROM_SEASON) -> dict[str, Column]:
    """Era dispatch by season: modern list from ``modern_from`` on, legacy
    summary before; ``personnel_source`` records which column was parsed.

    The chosen era's result is one struct expression shared by every output
    field, so a projection evaluates it once per row (common subexpression)
    and evaluates only the parser of the row's era."""
    is_modern = _c(season) >= F.lit(modern_from)
    m, lg = parse_modern(positions), parse_legacy(personnel)
    names = list(m)
    chosen = F.when(is_modern, F.struct(*[m[k].alias(k) for k in names])) \
        .otherwise(F.struct(*[lg[k].alias(k) for k in names]))
    out = {k: chosen.getField(k) for k in names}
    out["personnel_source"] = F.when(is_modern, F.lit("offense_positions")) \
        .when(_c(season).isNotNull(), F.lit("offense_personnel"))
    return out
