"""Inserts, updates, deletes and upserts as table rewrites.

Each function returns the affected rows (as RETURNING does) or, where named ``*_state``,
the whole table after the change; ``write_state`` replaces a stored table with one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import measures as M
from ..plans.market import NOW, Market


def with_new_ids(existing: DataFrame, new: DataFrame, order: list[str], key: str = "id", in_order: bool = True) -> DataFrame:
    """Consecutive ids after the largest one.

    In the stated order the new rows are ranked in one task, which suits a client's batch.
    Otherwise they are ranked within hash slices whose sizes are summed, so that no task
    holds them all; only the sizes reach the driver."""
    top = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).first()[0]
    if in_order:
        return new.withColumn(key, F.lit(top) + F.row_number().over(Window.orderBy(*order)))
    sliced = new.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(64)))
    sizes = {r["_slice"]: r["count"] for r in sliced.groupBy("_slice").count().collect()}
    start, before = {}, top
    for number in sorted(sizes):
        start[number], before = before, before + sizes[number]
    if not start:
        return new.withColumn(key, F.lit(None).cast("long"))
    offsets = F.create_map(*[F.lit(x).cast("long") for pair in start.items() for x in pair])
    rank = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    return sliced.withColumn(key, F.element_at(offsets, F.col("_slice")) + rank).drop("_slice")


def insert(existing: DataFrame, new: DataFrame, order: list[str], defaults: dict[str, Column] | None = None) -> DataFrame:
    """The inserted rows, with defaults for absent columns and new ids."""
    for name, value in (defaults or {}).items():
        new = new.withColumn(name, F.coalesce(F.col(name), value) if name in new.columns else value)
    return with_new_ids(existing, new, order)


def update(df: DataFrame, which: Column, values: dict[str, object], stamp: str | None = None, now: str = NOW) -> DataFrame:
    """The updated rows.  Values of None are not set; nothing to set returns the rows as they are."""
    given = {k: v for k, v in values.items() if v is not None}
    rows = df.filter(which)
    if not given:
        return rows
    types = dict(df.dtypes)
    rows = rows.withColumns({k: (v if isinstance(v, Column) else F.lit(v)).cast(types[k]) for k, v in given.items()})
    return rows.withColumn(stamp, M.at(now)) if stamp else rows


def update_state(df: DataFrame, which: Column, values: dict[str, object]) -> DataFrame:
    types = dict(df.dtypes)
    given = {k: v for k, v in values.items() if v is not None}
    hit = F.coalesce(which, F.lit(False))
    return df.withColumns({k: F.when(hit, F.lit(v).cast(types[k])).otherwise(F.col(k)) for k, v in given.items()})


def delete_state(df: DataFrame, which: Column) -> DataFrame:
    """What stays; rows for which the condition is unknown stay."""
    return df.filter(~F.coalesce(which, F.lit(False)))


def delete_cascade(parent: DataFrame, child: DataFrame, which: Column, foreign: str, key: str = "id") -> tuple[DataFrame, DataFrame]:
    gone = parent.filter(which).select(F.col(key).alias(foreign))
    return delete_state(parent, which), child.join(gone, foreign, "left_anti")


def newest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the first in the order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], columns: list[str], order: list[Column]) -> DataFrame:
    """The table after ON CONFLICT (keys) DO UPDATE: new values win on ``columns``; of new
    rows with one key the first in ``order`` counts; NULL keys never conflict."""
    first = newest(new, keys, order).select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_new"))
    both = existing.join(first, keys, "full_outer")
    return both.select(*keys, *[F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in columns])


def absent(existing: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """New rows whose key isn't there yet, first of each key.  A NULL key never matches, so
    such rows come in again on every run, all of them."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    keyed = newest(new.filter(known), keys, order)
    return keyed.join(existing.select(*keys).distinct(), keys, "left_anti").unionByName(new.filter(~known))


def find_or_create(dimension: DataFrame, names: DataFrame, name: str = "name") -> DataFrame:
    """(name, id, created) for each distinct name, matched without case; new ones get ids."""
    wanted = names.select(F.lower(name).alias("_low"), F.col(name)).groupBy("_low").agg(F.min(name).alias(name))
    known = dimension.select(F.lower(name).alias("_low"), "id").groupBy("_low").agg(F.min("id").alias("id"))
    both = wanted.join(known, "_low", "left")
    old = both.filter("id IS NOT NULL").select(name, "id", F.lit(False).alias("created"))
    new = with_new_ids(dimension, both.filter("id IS NULL").select(name), [name], in_order=False).select(name, "id", F.lit(True).alias("created"))
    return old.unionByName(new)


def auction_rollup(m: Market) -> DataFrame:
    """Denormalised counters of each auction, 0 for none; the sums stay NULL."""
    per = m.plain_lots.groupBy("auction_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("estimated_price_min").cast("double").alias("total_estimate_min"),
        F.sum("estimated_price_max").cast("double").alias("total_estimate_max"),
        M.sold_sum("total_realized"),
        M.sold_count("n_sold"),
    )
    rate = F.round(F.col("n_sold") * F.lit("100.0").cast("decimal(4,1)") / F.col("n"), 2).cast("double")
    return m.auctions.select("id").join(per, F.col("id") == F.col("auction_id"), "left").select(
        "id", F.coalesce("n", F.lit(0)).alias("total_lots"), "total_estimate_min", "total_estimate_max", "total_realized",
        F.when(F.col("n") > 0, rate).otherwise(F.lit(0.0)).alias("sale_rate"),
    )


def run_log(changes: DataFrame) -> DataFrame:
    """Events as a run log: runs and failures by source."""
    return changes.groupBy("house_id").agg(
        F.count(F.lit(1)).alias("items_processed"),
        F.count_if(F.col("kind") == "error").alias("failed"),
        F.min("at").alias("start_time"),
        F.max("at").alias("end_time"),
    )


def run_log_rows(runs: DataFrame) -> DataFrame:
    """The rows runs append to a log: one that says started and, for an ended run, one that says
    completed or, with an error message, failed.  ``runs`` holds house_id, task_type, started_at,
    ended_at, items_processed, items_created and error_message."""
    names = ["status", "start_time", "end_time", "items_processed", "items_created", "error_message"]
    none = F.lit(None).cast("timestamp_ntz")
    ended = F.when(F.col("error_message").isNull(), "completed").otherwise("failed")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("items_processed", "items_created")]
    first = [F.lit("started"), F.col("started_at"), none, F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(None).cast("string")]
    last = [ended, F.col("ended_at"), F.col("ended_at"), *counts, F.col("error_message")]
    entries = F.array(*[F.struct(*[v.alias(n) for n, v in zip(names, row)]) for row in (first, last)])
    return runs.select("house_id", "task_type", F.inline(F.filter(entries, lambda e: e["start_time"].isNotNull())))


def write_state(df: DataFrame, path: str) -> str:
    """Write a rewritten table beside its source, never over what the plan still reads."""
    target = f"{path.rstrip('/')}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(target)
    return target


def append(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
