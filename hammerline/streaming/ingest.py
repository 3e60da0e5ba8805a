"""Incremental ingest: change events as a stream into tables.

Windows and watermarks are an extension: the batch model only re-reads its sources at
intervals, which ``availableNow`` triggers express.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

RUN = "batch long, status string, start_time timestamp, end_time timestamp, items_processed long, items_created long"


def read_events(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """A file stream; watermarks need a zoned time."""
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def unique_events(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event once while it can still be late."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def tumbling(events: DataFrame, width: str = "6 hours", late: str | None = "1 hour") -> DataFrame:
    """Counts and sums by window and kind; works on streams and on tables."""
    if late and events.isStreaming:
        events = events.withWatermark("ts", late)
    return (
        events.groupBy(F.window("ts", width).alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
        .select(F.col("w.start").alias("window_start"), "event_type", "n", "value")
    )


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    return (
        events.groupBy(F.session_window("ts", gap).alias("s"), "user_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")
    )


def insert_absent(batch: DataFrame, path: str, keys: list[str], within: str | None = None) -> int:
    """Append rows whose keys the table at ``path`` lacks and say how many; a replayed batch adds nothing.

    ``within`` names a key whose values arrive roughly in order, such as a time: the table is then read only
    between the batch's bounds, which partitions and row group statistics prune."""
    spark = batch.sparkSession
    new = batch.dropDuplicates(keys)
    try:
        known = spark.read.schema(batch.schema).parquet(path)
    except AnalysisException as error:  # the first batch finds no table
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None
    if known is not None and within:
        low, high = batch.agg(F.min(within), F.max(within)).first()
        known = known.filter(F.col(within).between(F.lit(low), F.lit(high)))
    if known is not None:
        new = new.join(known.select(*keys), keys, "left_anti")
    seen = Observation()
    new.observe(seen, F.count(F.lit(1)).alias("created")).write.mode("append").parquet(path)
    return seen.get["created"]


def ingest_once(
    events: DataFrame, path: str, checkpoint: str, keys: list[str], within: str | None = None, log: str | None = None
) -> StreamingQuery:
    """Everything that has arrived, in one run.  ``log`` is a table that gets a row for each batch:
    its number, status, times, rows read and rows created."""

    def batch(rows: DataFrame, number: int) -> None:
        began = datetime.now()
        created = insert_absent(rows, path, keys, within)
        if log:
            line = (number, "completed", began, datetime.now(), rows.count(), created)
            rows.sparkSession.createDataFrame([line], RUN).write.mode("append").parquet(log)

    stream = events.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return stream.foreachBatch(batch).start()


def live(events: DataFrame, kinds: list[str]) -> DataFrame:
    return events.filter(F.col("event_type").isin(kinds))
