"""Places in an order: pages far from its start, and consecutive ids, without a single task that sees all rows.

``OrderedPages`` stores a table sorted over range partitions with the rows of each, so that a page reads
only the partitions it lies in, however large its offset.  ``IdCounter`` deals blocks of ids from a stored
counter; rows take theirs by the counts of their partitions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.versions import Conflict, Manifest, new_folder

ROW_BITS = 33  # of monotonically_increasing_id, below the partition's number


def _numbered(df: DataFrame, path: str) -> tuple[DataFrame, dict[int, int], int]:
    """Writes ``df`` with its partition and row; reads it back with the rows before each partition, one number each,
    and their total."""
    spark = df.sparkSession
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    df.select("*", row.alias("_row"), F.spark_partition_id().alias("_part")).write.partitionBy("_part").parquet(path)
    own = [T.StructField("_row", T.LongType()), T.StructField("_part", T.IntegerType())]
    known = spark.read.schema(T.StructType([*df.schema.fields, *own])).parquet(path)
    sizes = {r["_part"]: r["count"] for r in known.groupBy("_part").count().collect()}
    before, total = {}, 0
    for part in sorted(sizes):
        before[part], total = total, total + sizes[part]
    return known, before, total


def _starts(before: dict[int, int]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in (before or {0: 0}).items() for x in pair]), F.col("_part").cast("long"))


class OrderedPages:
    def __init__(self, df: DataFrame, order: list[Column], parts: int | None = None):
        spark = df.sparkSession
        parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.order, self.columns = order, df.columns
        ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        self.rows, self.before, self.total = _numbered(ranged, new_folder(spark, "pages"))

    def parts_of(self, limit: int, offset: int) -> list[int]:
        """The partitions that the page lies in."""
        ends = [*list(self.before.values())[1:], self.total]
        return [p for (p, start), end in zip(self.before.items(), ends) if start < offset + limit and end > offset]

    def page(self, limit: int, offset: int = 0) -> DataFrame:
        place = _starts(self.before) + F.col("_row")
        near = self.rows.filter(F.col("_part").isin(self.parts_of(limit, offset)))  # partition folders
        found = near.withColumn("_place", place).filter((F.col("_place") >= offset) & (F.col("_place") < offset + limit))
        return found.orderBy("_place").select(self.columns)


class IdCounter:
    """The next id of a table, in a manifest; a block is dealt by the commit of a version, so never twice."""

    def __init__(self, spark: SparkSession, folder: str, first: int = 1):
        self.manifest, self.first = Manifest(spark, folder, "name string, n long"), first

    def reserve(self, n: int) -> int:
        """The first of ``n`` ids that are the caller's own."""
        while True:
            version, rows = self.manifest.rows()
            start = rows[0]["n"] if rows else self.first
            try:
                self.manifest.commit(version, [(f"block-{uuid.uuid4().hex[:12]}", start + n)])
                return start
            except Conflict:
                continue


def with_block_ids(new: DataFrame, counter: IdCounter, key: str = "id") -> DataFrame:
    """Consecutive ids for the rows of ``new``, in no stated order: their partitions are counted, a block of that size
    is reserved, and each row takes its place in it."""
    rows, before, total = _numbered(new.drop(key), new_folder(new.sparkSession, "ids"))
    start = counter.reserve(total)
    return rows.withColumn(key, F.lit(start) + _starts(before) + F.col("_row")).drop("_row", "_part")
