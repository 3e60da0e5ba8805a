"""Roll-ups that are kept up by changes instead of being computed anew.

``RollupState`` stores the counters of ``changes.auction_rollup`` for each auction, and its lowest and highest
price, in a ``FileTable`` ordered by auction.  A batch of signed rows (+1: came in, -1: went out; an
update is both) is summed by auction and added to the stored sums; only files that hold one of these
auctions are read or rewritten.  Sums and counts are exact decimals and whole numbers, so any order of batches
gives the same state.  A minimum or maximum that loses the row it came from is found again among the rows of
those auctions alone.

``DistinctRollup`` stores distinct values as bitmaps, one for each day, house and range of 64 values, so that values far from
each other take no more room than a number each; they are merged to any coarser grain by or, without reading the facts again and without expanding a row for
each of several counts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import measures as M
from .file_table import FileTable

WIDE = "decimal(20,2)"
SUMS = ["total_lots", "n_sold", "n_min", "n_max", "n_realized", "total_estimate_min", "total_estimate_max", "total_realized"]
SCHEMA = (
    "auction_id long, " + ", ".join(f"{c} long" for c in SUMS[:5]) + ", " + ", ".join(f"{c} {WIDE}" for c in SUMS[5:]) + ", low decimal(12,2), high decimal(12,2)"
)


def _sums(sign: Column) -> list[Column]:
    """Signed counts and sums of lots; amounts that are absent count as 0 and are not counted."""
    paid = M.sold_price()
    amounts = [F.col("estimated_price_min"), F.col("estimated_price_max"), paid]
    counts = [sign, F.when(F.col("sold"), sign), *[F.when(v.isNotNull(), sign) for v in amounts]]
    totals = [(F.coalesce(v, F.lit(0)) * sign.cast("decimal(1,0)")).cast(WIDE) for v in amounts]
    return [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for c, n in zip(counts, SUMS)] + [
        F.sum(t).cast(WIDE).alias(n) for t, n in zip(totals, SUMS[5:])
    ]


class RollupState:
    def __init__(self, table: FileTable):
        self.table = table

    @classmethod
    def create(cls, lots: DataFrame, folder: str, files: int = 16) -> RollupState:
        first = lots.groupBy("auction_id").agg(*_sums(F.lit(1)), F.min(M.sold_price()).alias("low"), F.max(M.sold_price()).alias("high"))
        empty = lots.sparkSession.createDataFrame([], SCHEMA)
        return cls(FileTable.create(empty.unionByName(first), folder, ["auction_id"], files))

    def apply(self, changes: DataFrame, lots: DataFrame):
        """Adds signed rows (sign, and the columns of lots).  ``lots`` is the table after the changes; it is read for
        auctions that lost their lowest or highest price.  Returns what the file table says of the change."""
        paid, out = M.sold_price(), F.col("sign") < 0
        delta = changes.groupBy("auction_id").agg(
            *_sums(F.col("sign")), F.min(F.when(~out, paid)).alias("in_low"), F.max(F.when(~out, paid)).alias("in_high"),
            F.min(F.when(out, paid)).alias("out_low"), F.max(F.when(out, paid)).alias("out_high"),
        )
        delta = self._stored(delta.withColumnsRenamed({c: f"_{c}" for c in SUMS}), "delta")
        first, last = delta.agg(F.min("auction_id"), F.max("auction_id")).first()
        reach = F.col("auction_id").between(F.lit(first), F.lit(last))  # prunes what is read
        both = delta.join(self.table.read().filter(reach), "auction_id", "left")
        lost = (F.col("out_low") <= F.col("low")) | (F.col("out_high") >= F.col("high"))
        summed = both.select(
            "auction_id", *[(F.coalesce(F.col(c), F.lit(0)) + F.col(f"_{c}")).cast(WIDE if c in SUMS[5:] else "long").alias(c) for c in SUMS],
            F.least("low", "in_low").alias("low"), F.greatest("high", "in_high").alias("high"), F.coalesce(lost, F.lit(False)).alias("lost"),
        )
        summed = self._stored(summed, "summed")
        if summed.filter("lost").isEmpty():
            return self.table.upsert(summed.drop("lost"), ["auction_id"], [*SUMS, "low", "high"], [F.col("total_lots")])
        keys = summed.filter("lost").select("auction_id")
        again = lots.filter(reach).join(keys, "auction_id", "left_semi").groupBy("auction_id").agg(F.min(paid).alias("_low"), F.max(paid).alias("_high"))
        new = summed.join(again, "auction_id", "left").select(
            "auction_id", *SUMS, F.when(F.col("lost"), F.col("_low")).otherwise(F.col("low")).alias("low"), F.when(F.col("lost"), F.col("_high")).otherwise(F.col("high")).alias("high")
        )
        return self.table.upsert(new, ["auction_id"], [*SUMS, "low", "high"], [F.col("total_lots")])

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        """What several steps of a change read is made once, in the table's folder, where no reader of the table looks."""
        path = f"{self.table.folder}/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return self.table.spark.read.schema(df.schema).parquet(path)

    def rollup(self) -> DataFrame:
        """The published counters: sums of nothing are NULL, as in a recomputation; auctions without lots have 0."""
        state = self.table.read()
        rate = F.round(F.col("n_sold") * F.lit("100.0").cast("decimal(4,1)") / F.nullif("total_lots", F.lit(0)), 2).cast("double")
        amount = lambda n, c: F.when(F.col(n) > 0, F.col(c)).cast("double").alias(c)
        return state.select(
            "auction_id", "total_lots", amount("n_min", "total_estimate_min"), amount("n_max", "total_estimate_max"), amount("n_realized", "total_realized"),
            F.coalesce(rate, F.lit(0.0)).alias("sale_rate"), F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"),
        )


class DistinctRollup:
    """Bitmaps of ``value`` by ``day`` and further keys, in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @classmethod
    def create(cls, rows: DataFrame, folder: str, keys: list[str], values: list[str]) -> DistinctRollup:
        """``values`` are whole-number columns; each has bitmaps of its own, NULLs are in none.  The rows are reduced
        before the shuffle to a bitmap for each task, key and range of values."""
        each = F.inline(F.array(*[F.struct(F.lit(v).alias("counted"), F.col(v).cast("long").alias("value")) for v in values]))
        long = rows.select(*keys, each).filter("value IS NOT NULL")
        bit = F.expr("shiftleft(1L, cast(value & 63 AS int))")
        bitmaps = long.groupBy(*keys, "counted", F.shiftright("value", 6).alias("bucket")).agg(F.bit_or(bit).alias("bits"))
        bitmaps.write.parquet(folder)
        return cls(rows.sparkSession, folder)

    def counts(self, grain: list[Column], values: list[str]) -> DataFrame:
        """The distinct values of each group of ``grain``: bitmaps of a range are merged, then ranges are summed."""
        names = self.spark.read.parquet(self.folder)
        merged = names.groupBy(*grain, "counted", "bucket").agg(F.bit_or("bits").alias("bits"))
        group = [c for c in merged.columns if c not in ("counted", "bucket", "bits")]
        sums = [F.coalesce(F.sum(F.when(F.col("counted") == v, F.bit_count("bits"))), F.lit(0)).alias(v) for v in values]
        return merged.groupBy(*group).agg(*sums)
