"""Literal rows as DataFrames, for seeds and fixtures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rows(spark: SparkSession, schema: str, values: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(values), schema)


def with_config(df: DataFrame, column: str = "scraping_config") -> DataFrame:
    """A JSON text column as a variant; absent configuration is an empty object."""
    return df.withColumn(column, F.parse_json(F.coalesce(F.col(column), F.lit("{}"))))


def config_value(column: str, path: str, default: str):
    """A member of a configuration with a default."""
    return F.coalesce(F.try_variant_get(F.col(column), path, "string"), F.lit(default))
