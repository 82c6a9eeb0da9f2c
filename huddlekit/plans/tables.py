"""Readers for the driver's parquet tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for comparisons across engines)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                       for f in df.schema.fields])


def c(name: str) -> Column:
    return F.col(name)
