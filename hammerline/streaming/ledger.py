"""Batches that count once: a ledger of commits, retries of failed rows, metrics of streams.

A batch is named by its query and number.  Whatever it writes lies in folders of that name, which a replay
replaces: first the rows, then the rows that failed, last the ledger's line, which is also the run log.  A batch whose
line says completed is answered without any work; one that died in between writes the same again.  One
writer a target is assumed."""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

LINE = "status string, start_time timestamp, end_time timestamp, items_processed long, items_created long, items_failed long, error_message string"
NAMED = "query string, batch long"


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, partitioned by query and batch; empty where there is none yet."""
    try:
        return spark.read.schema(f"{schema}, {NAMED}").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, {NAMED}")


class Ledger:
    """A sink of keyed rows in ``folder`` with its commits and its retries.

    ``keys`` name a row; rows with a key that the target has are not added.  ``valid`` says which rows may come in: the
    others go to the retry table, with their attempt and the time they are due again, the wait doubling."""

    def __init__(self, folder: str, query: str, schema: str, keys: list[str], valid: Column | None = None, wait: float = 60.0, attempts: int = 5):
        self.folder, self.query, self.schema, self.keys = folder.rstrip("/"), query, schema, keys
        self.valid, self.wait, self.attempts = valid, wait, attempts
        self.after_rows: Callable[[], None] = lambda: None  # where tests let a batch die

    def _place(self, table: str, batch: int) -> str:
        return f"{self.folder}/{table}/query={self.query}/batch={batch}"

    def rows(self, spark: SparkSession) -> DataFrame:
        """What has been committed; rows of a batch without a line don't count yet."""
        done = self.lines(spark).filter("status = 'completed'").select("query", "batch")
        return stored(spark, f"{self.folder}/rows", self.schema).join(done, ["query", "batch"], "left_semi")

    def lines(self, spark: SparkSession) -> DataFrame:
        return stored(spark, f"{self.folder}/ledger", LINE)

    def retries(self, spark: SparkSession) -> DataFrame:
        return stored(spark, f"{self.folder}/retry", f"{self.schema}, attempt int, due timestamp")

    def _line(self, spark: SparkSession, batch: int, line: tuple) -> None:
        spark.createDataFrame([line], LINE).coalesce(1).write.mode("overwrite").parquet(self._place("ledger", batch))

    def commit(self, given: DataFrame, batch: int, now: datetime | None = None) -> bool:
        """Takes in a batch; false if it had been before.  ``given`` may have a column attempt."""
        spark = given.sparkSession
        own = (F.col("query") == self.query) & (F.col("batch") == batch)
        if not self.lines(spark).filter(own & (F.col("status") == "completed")).isEmpty():
            return False
        began = now or datetime.now(timezone.utc).replace(tzinfo=None)
        given = given.persist()
        try:
            if "attempt" not in given.columns:
                given = given.withColumn("attempt", F.lit(0))
            names = [c.strip().split(" ")[0] for c in self.schema.split(",")]
            good = F.coalesce(self.valid, F.lit(False)) if self.valid is not None else F.lit(True)
            known = stored(spark, f"{self.folder}/rows", self.schema).filter(~own).select(*self.keys)
            new = given.filter(good).select(names).dropDuplicates(self.keys).join(known, self.keys, "left_anti")
            new.write.mode("overwrite").parquet(self._place("rows", batch))
            self.after_rows()
            seconds = F.lit(self.wait) * F.pow(F.lit(2.0), F.col("attempt"))
            due = F.timestamp_seconds(F.lit(began.replace(tzinfo=timezone.utc).timestamp()) + seconds)
            failed = given.filter(~good).select(*names, (F.col("attempt") + 1).cast("int").alias("attempt"), due.alias("due"))
            failed.write.mode("overwrite").parquet(self._place("retry", batch))
            made = spark.read.schema(self.schema).parquet(self._place("rows", batch)).count()
            left = spark.read.schema("attempt int").parquet(self._place("retry", batch)).count()
            self._line(spark, batch, ("completed", began, datetime.now(timezone.utc).replace(tzinfo=None), given.count(), made, left, None))
            return True
        except Exception as error:
            self._line(spark, batch, ("failed", began, datetime.now(timezone.utc).replace(tzinfo=None), 0, 0, 0, str(error)[:1000]))
            raise
        finally:
            given.unpersist()

    def due(self, spark: SparkSession, now: datetime) -> DataFrame:
        """Rows to try again: due by ``now``, below the last attempt, not in the target; of a key its last failure."""
        latest = self.retries(spark).groupBy(*self.keys).agg(F.max_by(F.struct("*"), "attempt").alias("r")).select("r.*")
        found = latest.filter((F.col("due") <= F.lit(now)) & (F.col("attempt") < self.attempts))
        return found.drop("query", "batch", "due").join(self.rows(spark).select(*self.keys), self.keys, "left_anti")

    def retry(self, spark: SparkSession, now: datetime, repair: Callable[[DataFrame], DataFrame]) -> bool:
        """Tries the due rows again, after ``repair``, as a batch of their own: negative numbers, one for each time."""
        return self.commit(repair(self.due(spark, now)), -int(now.timestamp()), now)

    def ingest(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Everything that has arrived, in one run."""
        writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        return writer.foreachBatch(lambda rows, number: self.commit(rows, number) and None).start()


PROGRESS = (
    "run string, name string, batch long, at string, rows_read long, rows_a_second double, took_ms long, watermark string, "
    "late_rows long, state_rows long, state_bytes long, error string"
)


class ProgressTable(StreamingQueryListener):
    """Keeps the progress of all streams of a session; ``flush`` writes what has come to a table.

    The listener itself only notes numbers, so that it doesn't hold up the streams."""

    def __init__(self, path: str):
        self.path = path
        self._noted: list[tuple] = []
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def _note(self, row: tuple) -> None:
        with self._lock:
            self._noted.append(row)

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        sums = [sum(getattr(s, n) for s in state) for n in ("numRowsDroppedByWatermark", "numRowsTotal", "memoryUsedBytes")]
        took = p.durationMs.get("triggerExecution")
        self._note((str(p.runId), p.name, p.batchId, p.timestamp, p.numInputRows, float(p.processedRowsPerSecond), took, p.eventTime.get("watermark"), *sums, None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self._note((str(event.runId), None, None, None, 0, 0.0, None, None, 0, 0, 0, str(event.exception)[:1000]))
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        """Until all events of an ended query have come."""
        return self._end(str(query.runId)).wait(seconds)

    def flush(self, spark: SparkSession) -> int:
        with self._lock:
            rows, self._noted = self._noted, []
        if rows:
            spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
        return len(rows)
