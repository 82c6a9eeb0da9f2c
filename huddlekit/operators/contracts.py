"""Declared table contracts and schema conformance.

A contract is a ``StructType``; per-column documentation (descriptions,
tags, valid ranges/values, gotchas, upstream field) travels in
``StructField.metadata``. Ranges and value lists are documentation only: no
code filters on them.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huddlekit.functions.exprs import lenient_date, to_double, to_long

# The closed set of declared types and modes.
TYPES = {
    "INT64": T.LongType(), "FLOAT64": T.DoubleType(), "STRING": T.StringType(),
    "BOOL": T.BooleanType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
    "NUMERIC": T.DecimalType(38, 9),
}
MODES = ("REQUIRED", "NULLABLE", "REPEATED")
INGESTED_AT = "ingested_at"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    mode: str = "NULLABLE"
    description: str = ""
    tags: tuple[str, ...] = ()
    valid_range: tuple[float, float] | None = None
    valid_values: tuple[str, ...] | None = None
    gotchas: tuple[str, ...] = ()
    source_field: str | None = None
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.type not in TYPES:
            raise ValueError(f"{self.name}: unknown type {self.type!r}")
        if self.mode not in MODES:
            raise ValueError(f"{self.name}: unknown mode {self.mode!r}")

    def to_field(self) -> T.StructField:
        dtype = TYPES[self.type]
        if self.mode == "REPEATED":
            dtype = T.ArrayType(dtype)
        meta = {"description": self.description, "mode": self.mode}
        if self.tags:
            meta["tags"] = list(self.tags)
        if self.valid_range is not None:
            meta["valid_range"] = list(self.valid_range)
        if self.valid_values is not None:
            meta["valid_values"] = list(self.valid_values)
        if self.gotchas:
            meta["gotchas"] = list(self.gotchas)
        if self.source_field:
            meta["source_field"] = self.source_field
        return T.StructField(self.name, dtype, self.mode != "REQUIRED", meta)


def ingested_at_spec() -> ColumnSpec:
    return ColumnSpec(INGESTED_AT, "TIMESTAMP", "REQUIRED", "UTC time the row was loaded.")


def to_struct(specs: list[ColumnSpec]) -> T.StructType:
    return T.StructType([s.to_field() for s in specs])


def spec_names(specs: list[ColumnSpec]) -> list[str]:
    return [s.name for s in specs]


def declared_type(dtype: T.DataType) -> str:
    """Spark type of an observed column -> declared type name."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "INT64"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "FLOAT64"
    if isinstance(dtype, T.BooleanType):
        return "BOOL"
    if isinstance(dtype, T.DateType):
        return "DATE"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dtype, T.DecimalType):
        return "NUMERIC"
    return "STRING"


_OVERLAID = ("type", "mode", "description", "tags", "valid_range", "valid_values", "gotchas", "source_field")


def specs_from_frame(schema: T.StructType, *, table: str, enrichment: dict | None = None,
                     type_overrides: dict | None = None, required: tuple[str, ...] = (),
                     drop: tuple[str, ...] = ()) -> list[ColumnSpec]:
    """Specs of an observed schema (e.g. a sample file's footer) under
    overlays. ``enrichment`` gives a column's spec fields by name and has the
    last word on type and mode too, before ``type_overrides`` and
    ``required``; what is no spec field travels in ``extra``. An overlay that
    names a column the sample lacks raises."""
    enrichment, type_overrides = enrichment or {}, type_overrides or {}
    observed = {f.name: declared_type(f.dataType) for f in schema.fields}
    strangers = {c for overlay in (enrichment, type_overrides, required, drop) for c in overlay} - observed.keys()
    if strangers:
        raise ValueError(f"{table}: the sample has no column {', '.join(sorted(strangers))}")

    def spec(name: str) -> ColumnSpec:
        given = {"type": type_overrides.get(name, observed[name]),
                 "mode": "REQUIRED" if name in required else "NULLABLE", **enrichment.get(name, {})}
        own = {k: given.pop(k) for k in _OVERLAID if k in given}
        for k in ("tags", "gotchas"):
            own[k] = tuple(own.get(k, ()))
        return ColumnSpec(name, **own, extra=given)

    return [*(spec(c) for c in observed if c not in drop and c != INGESTED_AT), ingested_at_spec()]


def coerce(df: DataFrame, name: str, target: T.DataType) -> Column:
    """Lenient cast of column ``name`` to ``target``: bad values become NULL,
    never an error, and a stringified NULL stays NULL."""
    src = df.schema[name].dataType
    c = F.col(name)
    if isinstance(target, T.LongType):
        return c.cast("long") if isinstance(src, (T.IntegerType, T.LongType, T.ShortType,
                                                   T.ByteType)) else to_long(c)
    if isinstance(target, (T.DoubleType, T.DecimalType)):
        d = c.cast("double") if isinstance(src, T.NumericType) else to_double(c)
        return d.cast(target) if isinstance(target, T.DecimalType) else d
    if isinstance(target, T.BooleanType):
        return c if isinstance(src, T.BooleanType) else F.trim(c.cast("string")).try_cast("boolean")
    if isinstance(target, T.DateType):
        return c.cast("date") if isinstance(src, (T.DateType, T.TimestampType,
                                                  T.TimestampNTZType)) else lenient_date(c)
    if isinstance(target, T.TimestampType):
        if isinstance(src, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return c.cast("timestamp")
        return F.trim(c.cast("string")).try_cast("timestamp")
    if isinstance(target, T.StringType):
        if isinstance(src, (T.FloatType, T.DoubleType)):
            # 1.0 -> '1', keep non-integral values as they are
            return F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))
        return c.cast("string")
    return c.cast(target)


def align_to_schema(df: DataFrame, schema: T.StructType, *, stamp: bool = True) -> DataFrame:
    """Reorder to the contract, add missing columns as typed NULLs, drop
    extras, cast leniently; ``ingested_at`` is stamped with the load time."""
    cols = []
    for f in schema.fields:
        if f.name == INGESTED_AT:
            if stamp:
                cols.append(F.current_timestamp().alias(INGESTED_AT))
            elif INGESTED_AT in df.columns:
                cols.append(F.col(INGESTED_AT).cast("timestamp").alias(INGESTED_AT))
            continue
        if f.name in df.columns:
            cols.append(coerce(df, f.name, f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def contract_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Documented ranges and value lists checked in one pass: one row per
    constrained column with the count of values outside the documentation.
    A report only; rows are never filtered on it."""
    checks = []
    for f in schema.fields:
        if f.name not in df.columns:
            continue
        c = F.col(f.name)
        if "valid_range" in f.metadata:
            lo, hi = f.metadata["valid_range"]
            checks.append((f.name, "valid_range", c.isNotNull() & ((c < lo) | (c > hi))))
        if "valid_values" in f.metadata:
            checks.append((f.name, "valid_values", c.isNotNull() & ~c.isin(*f.metadata["valid_values"])))
    if not checks:
        return df.sparkSession.createDataFrame([], "column string, rule string, outside bigint")
    agg = df.agg(*[F.count_if(cond).alias(f"_{i}") for i, (_, _, cond) in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(r).alias("rule"),
                              F.col(f"_{i}").cast("long").alias("outside"))
                     for i, (n, r, _) in enumerate(checks)])
    return agg.select(F.inline(rows))


# --- the conformed ADP snapshot contract ----------------------------------

ADP_GRAIN = ("source", "season", "scoring_format", "teams", "snapshot_date", "source_player_id")

ADP_SPECS = [
    ColumnSpec("source", "STRING", "REQUIRED", "Feed the row came from.", valid_values=("ffc", "mfl")),
    ColumnSpec("season", "INT64", "REQUIRED", "Draft season."),
    ColumnSpec("scoring_format", "STRING", "REQUIRED", "Scoring format of the drafts."),
    ColumnSpec("teams", "INT64", "REQUIRED", "League size."),
    ColumnSpec("snapshot_date", "DATE", "REQUIRED", "UTC capture day."),
    ColumnSpec("source_player_id", "STRING", "REQUIRED", "Feed's own player id."),
    ColumnSpec("gsis_id", "STRING", description="Resolved id; NULL when unresolved or refused."),
    ColumnSpec("player_name", "STRING"),
    ColumnSpec("position", "STRING"),
    ColumnSpec("team", "STRING"),
    ColumnSpec("adp", "FLOAT64", "REQUIRED", "Average draft position."),
    ColumnSpec("adp_formatted", "STRING"),
    ColumnSpec("adp_stdev", "FLOAT64"),
    ColumnSpec("adp_earliest_pick", "INT64"),
    ColumnSpec("adp_latest_pick", "INT64"),
    ColumnSpec("times_drafted", "INT64"),
    ColumnSpec("draft_selected_pct", "FLOAT64"),
    ColumnSpec("source_rank", "INT64"),
    ColumnSpec("total_drafts", "INT64"),
    ColumnSpec("bye", "INT64"),
    ColumnSpec("window_start_date", "DATE"),
    ColumnSpec("window_end_date", "DATE"),
    ColumnSpec("is_keeper", "BOOL"),
    ColumnSpec("is_mock", "BOOL"),
    ingested_at_spec(),
]
ADP_SCHEMA = to_struct(ADP_SPECS)
