"""Aggregate expressions shared by all reports: filtered counts, sums and ratios.

Sums of money are exact decimals cast to double at the end; a mean is that double sum
over the count of values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sold_price() -> Column:
    return F.when(F.col("sold"), F.col("final_price"))


def lot_mark() -> Column:
    """A constant that is NULL where a left join finds no lot: cheaper to count than an id."""
    return F.lit(1).alias("lot")


def sold_count(name: str = "lots_sold") -> Column:
    return F.count_if("sold").alias(name)


def sold_sum(name: str = "total_sales") -> Column:
    return F.sum(sold_price()).cast("double").alias(name)


def sold_mean(name: str = "avg_sale_price") -> Column:
    value = sold_price()
    return F.try_divide(F.sum(value).cast("double"), F.count(value)).alias(name)


def sold_max(name: str = "max_sale_price") -> Column:
    return F.max(sold_price()).cast("double").alias(name)


def sold_min(name: str = "min_sale_price") -> Column:
    return F.min(sold_price()).cast("double").alias(name)


def rate_or_null(part: Column, whole: Column) -> Column:
    """A percentage that is NULL without a base."""
    return part.cast("double") / F.nullif(whole, F.lit(0)) * 100


def rate_or_zero(part: Column, whole: Column) -> Column:
    """A percentage that is 0 without a base."""
    return F.when(whole > 0, part.cast("double") / whole * 100).otherwise(F.lit(0.0))


def whole_days(earlier: Column, later: Column) -> Column:
    """Full 24-hour days between two times."""
    return F.timestamp_diff("DAY", earlier, later)


def at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def before(moment: str, span: str) -> Column:
    """``moment`` less an interval such as "24 MONTHS" (calendar-aware)."""
    return at(moment) - F.expr(f"INTERVAL {span}")


def after(moment: str, span: str) -> Column:
    return at(moment) + F.expr(f"INTERVAL {span}")
