"""Optional filters: a criterion that isn't given adds nothing to the plan.

Values are dropped when falsy (0 and '' count as not given), booleans when None.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def equal(name: str, value) -> Column | None:
    return F.col(name) == value if value else None


def flag(name: str, value: bool | None) -> Column | None:
    return F.col(name) == value if value is not None else None


def at_least(name: str, value) -> Column | None:
    return F.col(name) >= F.lit(value) if value else None


def at_most(name: str, value) -> Column | None:
    return F.col(name) <= F.lit(value) if value else None


def like(name: str, value: str | None) -> Column | None:
    """Case-insensitive containment; % and _ in the value are wildcards."""
    return F.col(name).ilike(f"%{value}%") if value else None


def one_of(name: str, values: Iterable | None) -> Column | None:
    values = list(values or [])
    return F.col(name).isin(values) if values else None


def where(df: DataFrame, *criteria: Column | None) -> DataFrame:
    given = [c for c in criteria if c is not None]
    return df.filter(reduce(lambda a, b: a & b, given)) if given else df


def page(df: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """One page of an ordered frame; Spark plans it as a top-k."""
    if limit < 1 or offset < 0:
        raise ValueError("limit must be positive and offset not negative")
    return (df.offset(offset) if offset else df).limit(limit)


def page_numbers(total: int, limit: int, offset: int) -> tuple[int, int]:
    """(page, pages) of an envelope."""
    return offset // limit + 1, -(-total // limit)
