"""Stored tables: Parquet by name, and any other built-in format by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_any(spark: SparkSession, path: str, kind: str = "parquet", schema: T.StructType | None = None, **options) -> DataFrame:
    """A file source with a declared schema: none is inferred from text formats."""
    reader = spark.read.format(kind).options(**options)
    if schema is None and kind in ("csv", "json"):
        raise ValueError(f"{kind} needs a schema")
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_database(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options) -> DataFrame:
    """A live relational table, read in ranges of an integer key."""
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high, numPartitions=parts, properties=options)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def alive(spark: SparkSession) -> bool:
    return spark.sql("SELECT 1 AS one").first()["one"] == 1


def to_json_rows(df: DataFrame) -> DataFrame:
    """The JSON sink: one object a row, nulls kept."""
    from pyspark.sql import functions as F

    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))
