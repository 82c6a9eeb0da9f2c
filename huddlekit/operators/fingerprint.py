"""Per-team, per-week scheme fingerprint.

Inputs (columns the caller maps onto its own data):

* ``plays``: ``season, week, team, play_id, play_type, shotgun, no_huddle,
  pass_oe, epa`` and optionally ``game_id``. ``play_id`` may arrive as
  double, int or string; it is parsed with ``to_long``.
* ``participation`` (optional): play key + ``defense_man_zone_type,
  defenders_in_box, was_pressure`` and/or ``offense_positions,
  offense_personnel``.
* ``ftn`` (optional): play key + ``is_play_action, is_motion, is_rpo,
  is_screen_pass, n_blitzers, n_pass_rushers``.
* ``coaches`` (optional): ``season, week, team, head_coach`` (unique on the
  three keys; a duplicate would fan the team-week row out, so it is refused).

Every rate carries its own denominator; a rate is NULL, never 0.0, when its
denominator is 0, and a whole block is NULL when no charting row joined.

Plan shape (what makes it hold at scale): each charting source is reduced to
one partial row per play *before* the join, with map-side partial
aggregation, so the join moves one row per charted play instead of every
charting row and a hot play key collapses on the map side. The distinct play
reference is hash-partitioned on the play key so the distinct and the join
share one exchange. Everything after the join is at team-week grain.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huddlekit.functions.exprs import count_true, is_charted, optional, safe_rate, to_double_in, to_long_in
from huddlekit.functions.personnel import MODERN_FROM_SEASON, parse_legacy, parse_modern

# The play types a fingerprint is computed over.
PLAY_TYPES = ("pass", "run")
GROUP = ("season", "week", "team")

# Output columns and types, in order. ingested_at is stamped by the writer.
_L, _D, _S = "bigint", "double", "string"
FINGERPRINT_SCHEMA = (
    ("season", _L), ("week", _L), ("team", _S), ("head_coach", _S),
    ("plays", _L), ("shotgun_rate", _D), ("no_huddle_rate", _D), ("pass_rate", _D),
    ("proe", _D), ("epa_per_play", _D),
    ("plays_with_personnel", _L), ("personnel_11_rate", _D), ("personnel_12_rate", _D),
    ("personnel_21_rate", _D), ("personnel_source", _S),
    ("plays_charted_coverage", _L), ("man_rate", _D), ("zone_rate", _D),
    ("avg_defenders_in_box", _D), ("plays_charted_pressure", _L), ("pressure_rate", _D),
    ("plays_charted_ftn", _L), ("play_action_rate", _D), ("motion_rate", _D),
    ("rpo_rate", _D), ("screen_rate", _D), ("blitz_rate", _D), ("avg_pass_rushers", _D),
)
FINGERPRINT_COLUMNS = tuple(c for c, _ in FINGERPRINT_SCHEMA)


def _keys(df: DataFrame) -> list[str]:
    return (["game_id"] if "game_id" in df.columns else []) + ["play_id"]


def filtered_plays(plays: DataFrame) -> DataFrame:
    """Offensive snaps only, with a stable bigint play id. Rows without a team
    or week are dropped explicitly (they would form a NULL group otherwise)."""
    return (plays
            .where(F.col("play_type").isin(*PLAY_TYPES))
            .withColumn("play_id", to_long_in(plays, "play_id")))


def base_metrics(fp: DataFrame) -> DataFrame:
    return (fp.where(F.col("team").isNotNull() & F.col("week").isNotNull())
            .groupBy(*GROUP)
            .agg(F.count("play_id").alias("plays"),
                 F.avg(F.col("shotgun").cast("double")).alias("shotgun_rate"),
                 F.avg(F.col("no_huddle").cast("double")).alias("no_huddle_rate"),
                 F.avg((F.col("play_type") == "pass").cast("double")).alias("pass_rate"),
                 F.avg(F.col("pass_oe").cast("double")).alias("proe"),
                 F.avg(F.col("epa").cast("double")).alias("epa_per_play")))


def play_reference(fp: DataFrame) -> DataFrame:
    """Distinct (play key, season, week, team), hash-partitioned on the play
    key so the following join needs no second exchange on this side."""
    keys = _keys(fp)
    return (fp.where(F.col("team").isNotNull() & F.col("week").isNotNull())
            .select(*keys, *GROUP)
            .repartition(*keys)
            .dropDuplicates())


def _sum_where(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value))


def participation_partials(part: DataFrame, with_personnel: bool = False) -> DataFrame:
    """One row per play: coverage, pressure and (optionally) personnel counts."""
    keys = _keys(part)
    p = part.withColumn("play_id", to_long_in(part, "play_id"))
    mz = optional(p, "defense_man_zone_type", "string")
    charted = is_charted(mz)
    dib = to_double_in(p, "defenders_in_box")
    wp = optional(p, "was_pressure", "boolean")
    aggs = [
        F.count(F.lit(1)).alias("_part_rows"),
        count_true(charted).alias("_cov_charted"),
        count_true(charted & (mz == "MAN_COVERAGE")).alias("_n_man"),
        count_true(charted & (mz == "ZONE_COVERAGE")).alias("_n_zone"),
        _sum_where(charted, dib).alias("_dib_sum"),
        F.count(F.when(charted, dib)).alias("_dib_n"),
        count_true(wp.isNotNull()).alias("_pr_charted"),
        count_true(wp.isNotNull() & wp).alias("_n_pressure"),
    ]
    if with_personnel and ("offense_positions" in p.columns or "offense_personnel" in p.columns):
        # The era is decided by the play's season, known only after the join,
        # so both parsers' counts are carried and picked afterwards.
        for era, parsed in (("m", parse_modern(optional(p, "offense_positions", "string"))),
                            ("l", parse_legacy(optional(p, "offense_personnel", "string")))):
            ok = F.coalesce(parsed["plausible"], F.lit(False))
            aggs += [
                count_true(ok).alias(f"_pers_ok_{era}"),
                count_true(ok & (parsed["n_rb"] == 1) & (parsed["n_te"] == 1)).alias(f"_n11_{era}"),
                count_true(ok & (parsed["n_rb"] == 1) & (parsed["n_te"] == 2)).alias(f"_n12_{era}"),
                count_true(ok & (parsed["n_rb"] == 2) & (parsed["n_te"] == 1)).alias(f"_n21_{era}"),
            ]
    return p.where(F.col("play_id").isNotNull()).groupBy(*keys).agg(*aggs)


def ftn_partials(ftn: DataFrame) -> DataFrame:
    keys = _keys(ftn)
    f = ftn.withColumn("play_id", to_long_in(ftn, "play_id"))
    blitzers = to_double_in(f, "n_blitzers")
    rushers = to_double_in(f, "n_pass_rushers")

    def flag(name: str) -> Column:
        return count_true(F.coalesce(optional(f, name, "boolean"), F.lit(False)))

    return (f.where(F.col("play_id").isNotNull()).groupBy(*keys)
            .agg(F.count("play_id").alias("_ftn_rows"),
                 flag("is_play_action").alias("_n_pa"),
                 flag("is_motion").alias("_n_motion"),
                 flag("is_rpo").alias("_n_rpo"),
                 flag("is_screen_pass").alias("_n_screen"),
                 count_true(F.coalesce(blitzers, F.lit(0.0)) >= 1).alias("_n_blitz"),
                 F.sum(rushers).alias("_rush_sum"),
                 F.count(rushers).alias("_rush_n")))


def charting_metrics(ref: DataFrame, partials: list[DataFrame], with_personnel: bool,
                     modern_from: int = MODERN_FROM_SEASON) -> DataFrame:
    keys = _keys(ref)
    for p in partials:
        if _keys(p) != keys:
            raise ValueError(f"charting source keyed by {_keys(p)}, plays by {keys}")
    per_play = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), partials)
    j = per_play.join(ref, keys, "inner")
    s = {c: F.sum(c).cast("long") for c in
         ("_part_rows", "_cov_charted", "_n_man", "_n_zone", "_dib_n", "_pr_charted",
          "_n_pressure", "_ftn_rows", "_n_pa", "_n_motion", "_n_rpo", "_n_screen",
          "_n_blitz", "_rush_n") if c in per_play.columns}
    aggs = [v.alias(k) for k, v in s.items()]
    for c in ("_dib_sum", "_rush_sum"):
        if c in per_play.columns:
            aggs.append(F.sum(c).alias(c))
    with_personnel = with_personnel and "_pers_ok_m" in per_play.columns
    if with_personnel:
        aggs += [F.sum(f"{c}_{e}").cast("long").alias(f"{c}_{e}")
                 for c in ("_pers_ok", "_n11", "_n12", "_n21") for e in ("m", "l")]
    g = j.groupBy(*GROUP).agg(*aggs)
    if with_personnel:
        modern = F.col("season") >= F.lit(modern_from)
        g = g.select("*", *[F.when(modern, F.col(f"{c}_m")).otherwise(F.col(f"{c}_l")).alias(c)
                            for c in ("_pers_ok", "_n11", "_n12", "_n21")],
                     F.when(modern, F.lit("offense_positions"))
                      .otherwise(F.lit("offense_personnel")).alias("_pers_src"))

    cols = [F.col(c) for c in GROUP]
    if "_part_rows" in g.columns:
        part_seen = F.coalesce(F.col("_part_rows"), F.lit(0)) > 0

        def p(c: Column) -> Column:
            return F.when(part_seen, c)

        if with_personnel:
            cols += [
                p(F.col("_pers_ok")).alias("plays_with_personnel"),
                p(safe_rate("_n11", "_pers_ok")).alias("personnel_11_rate"),
                p(safe_rate("_n12", "_pers_ok")).alias("personnel_12_rate"),
                p(safe_rate("_n21", "_pers_ok")).alias("personnel_21_rate"),
                p(F.col("_pers_src")).alias("personnel_source"),
            ]
        cols += [
            p(F.col("_cov_charted")).alias("plays_charted_coverage"),
            p(safe_rate("_n_man", "_cov_charted")).alias("man_rate"),
            p(safe_rate("_n_zone", "_cov_charted")).alias("zone_rate"),
            p(safe_rate("_dib_sum", "_dib_n")).alias("avg_defenders_in_box"),
            p(F.col("_pr_charted")).alias("plays_charted_pressure"),
            p(safe_rate("_n_pressure", "_pr_charted")).alias("pressure_rate"),
        ]
    if "_ftn_rows" in g.columns:
        ftn_seen = F.coalesce(F.col("_ftn_rows"), F.lit(0)) > 0

        def q(c: Column) -> Column:
            return F.when(ftn_seen, c)

        cols += [
            q(F.col("_ftn_rows")).alias("plays_charted_ftn"),
            q(safe_rate("_n_pa", "_ftn_rows")).alias("play_action_rate"),
            q(safe_rate("_n_motion", "_ftn_rows")).alias("motion_rate"),
            q(safe_rate("_n_rpo", "_ftn_rows")).alias("rpo_rate"),
            q(safe_rate("_n_screen", "_ftn_rows")).alias("screen_rate"),
            q(safe_rate("_n_blitz", "_ftn_rows")).alias("blitz_rate"),
            q(safe_rate("_rush_sum", "_rush_n")).alias("avg_pass_rushers"),
        ]
    return g.select(*cols)


def unique_on(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Keep only keys that occur once; a duplicated key is refused (dropped)
    instead of fanning out a join. An aggregation, so a hot key is combined
    map-side rather than buffered in one task."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in rest])
            .where("_n = 1").select(*df.columns))


def team_week_fingerprint(plays: DataFrame, participation: DataFrame | None = None,
                          ftn: DataFrame | None = None, coaches: DataFrame | None = None,
                          *, personnel: bool = False) -> DataFrame:
    fp = filtered_plays(plays)
    out = base_metrics(fp)
    if coaches is not None:
        ck = [k for k in GROUP if k in coaches.columns]
        c = unique_on(coaches.select(*ck, "head_coach"), ck)
        out = out.join(c, ck, "left")
    partials = []
    if participation is not None:
        partials.append(participation_partials(participation, with_personnel=personnel))
    if ftn is not None:
        partials.append(ftn_partials(ftn))
    with_personnel = participation is not None and personnel
    if partials:
        ref = play_reference(fp)
        out = out.join(charting_metrics(ref, partials, with_personnel), list(GROUP), "left")
    present = set(out.columns)
    return out.select(*[(F.col(c) if c in present else F.lit(None)).cast(t).alias(c)
                        for c, t in FINGERPRINT_SCHEMA])
