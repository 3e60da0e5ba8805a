"""Declared rules: which rows would a constraint reject, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = {
    "house": ("active", "inactive", "maintenance"),
    "auction": ("upcoming", "active", "completed", "cancelled"),
    "log": ("started", "completed", "failed", "cancelled"),
}
AUCTION_TYPES = ("live", "online", "hybrid")

Rules = dict[str, Column]


def artist_rules() -> Rules:
    return {
        "birth_year": F.col("birth_year").between(1000, 2100),
        "death_year": F.col("death_year").between(1000, 2100),
        "name_length": F.char_length("name").between(1, 255),
    }


def auction_rules() -> Rules:
    return {
        "status": F.col("status").isin(*STATUSES["auction"]),
        "auction_type": F.col("auction_type").isin(*AUCTION_TYPES),
        "dates": F.col("end_date") >= F.col("start_date"),
    }


def lot_rules() -> Rules:
    return {
        "estimate_min": F.col("estimated_price_min") >= 0,
        "estimate_max": F.col("estimated_price_max") >= F.col("estimated_price_min"),
        "final_price": F.col("final_price") >= 0,
        "sold_price": ~F.col("sold") | F.col("final_price").isNotNull(),
    }


def checked(df: DataFrame, rules: Rules) -> DataFrame:
    """Adds ``violations``: names of rules that are false; unknown passes, as in CHECK."""
    names = [F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("violations", F.array_compact(F.array(*names)))


def split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined)."""
    rows = checked(df, rules)
    return rows.filter(F.size("violations") == 0).drop("violations"), rows.filter(F.size("violations") > 0)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row; NULL keys never collide."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def dangling(child: DataFrame, parent: DataFrame, foreign: str, key: str = "id") -> DataFrame:
    return child.filter(F.col(foreign).isNotNull()).join(parent.select(F.col(key).alias(foreign)).distinct(), foreign, "left_anti")
