"""Season feeds whose columns drift from vintage to vintage.

A vintage is the landed Parquet of one season. Its own footer says which
columns it has and of which type; the feed's common schema has every column of
any vintage with the least type that holds all of its types. A single read
over all vintages fails on an int/double conflict (or silently takes one
file's types), so each is read with its own types, cast to the common schema
and united by name.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huddlekit.operators.contracts import TYPES, align_to_schema, declared_type
from huddlekit.session import path_exists

# Declared types in the order in which they widen. Two types of
# one chain meet in the later one; types of different chains meet in text.
WIDENING = (("INT64", "NUMERIC", "FLOAT64"), ("DATE", "TIMESTAMP"), ("BOOL",))


def wider(a: str, b: str) -> str:
    """Least declared type that holds values of both."""
    for chain in WIDENING:
        if a in chain and b in chain:
            return chain[max(chain.index(a), chain.index(b))]
    return a if a == b else "STRING"


def footers(spark: SparkSession, path_for_season: Callable[[int], str], seasons: Iterable[int], *,
            side_by_side: int = 8) -> dict[int, T.StructType]:
    """Schema of each landed vintage, from the Parquet footers alone, several
    at a time. A season that was not landed is left out."""
    def footer(season: int) -> T.StructType | None:
        path = path_for_season(season)
        return spark.read.parquet(path).schema if path_exists(spark, path) else None
    seasons = sorted(set(seasons))
    with ThreadPoolExecutor(side_by_side) as pool:
        found = list(pool.map(footer, seasons))
    return {s: f for s, f in zip(seasons, found) if f is not None}


def observed_types(vintages: dict[int, T.StructType]) -> dict[str, dict[str, list[int]]]:
    """column -> declared type -> seasons, columns in order of first sight. A
    column that a vintage holds as void (only NULLs) says nothing of its type."""
    seen: dict[str, dict[str, list[int]]] = {}
    for season in sorted(vintages):
        for f in vintages[season].fields:
            types = seen.setdefault(f.name, {})
            if not isinstance(f.dataType, T.NullType):
                types.setdefault(declared_type(f.dataType), []).append(season)
    return seen


def common_schema(vintages: dict[int, T.StructType]) -> T.StructType:
    """All columns of any vintage, each with the least common type."""
    return T.StructType([T.StructField(name, TYPES[reduce(wider, types) if types else "STRING"])
                         for name, types in observed_types(vintages).items()])


def drift_report(spark: SparkSession, vintages: dict[int, T.StructType]) -> DataFrame:
    """``column, type, seasons, common_type, drifts, absent``: a row for each
    type a column has, with the seasons that hold it so, whether the column
    has several, and the seasons that lack it."""
    rows = []
    for name, types in observed_types(vintages).items():
        held = {f for f in vintages if name in vintages[f].fieldNames()}
        common = reduce(wider, types) if types else "STRING"
        for type_, seasons in (types or {"VOID": sorted(held)}).items():
            rows.append((name, type_, seasons, common, len(types) > 1, sorted(set(vintages) - held)))
    return spark.createDataFrame(rows, "column string, type string, seasons array<long>, common_type string, "
                                       "drifts boolean, absent array<long>")


def read_vintages(spark: SparkSession, path_for_season: Callable[[int], str], seasons: Iterable[int],
                  schema: T.StructType | None = None) -> DataFrame:
    """One table of all landed vintages under the common schema (or the given
    one): each is read with its own types and cast, absent columns are NULL,
    and ``feed_season`` is the season it was landed for."""
    vintages = footers(spark, path_for_season, seasons)
    if not vintages:
        raise ValueError("no landed vintage among the requested seasons")
    schema = schema or common_schema(vintages)
    parts = [align_to_schema(spark.read.schema(own).parquet(path_for_season(s)), schema, stamp=False)
             .withColumn("feed_season", F.lit(s).cast("long")) for s, own in vintages.items()]
    return reduce(DataFrame.unionByName, parts)
