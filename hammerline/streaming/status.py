"""Auction status as events: upcoming, active, completed, by timers on event time.

``schedules`` are rows (auction_id, ts, start_date, end_date, cancelled): what a source said at ``ts`` about an
auction.  An auction's state is the newest schedule and the status last published.  A schedule that is older than
the one known changes nothing, however late it comes; no event at all is needed for a status to change,
as the watermark passing start or end does it."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SCHEDULE = "auction_id long, ts timestamp, start_date timestamp, end_date timestamp, cancelled boolean"
CHANGE = "auction_id long, status string, at timestamp"
STATE = "ts timestamp, start_date timestamp, end_date timestamp, cancelled boolean, status string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _millis(moment) -> int:
    return int(pd.Timestamp(moment).timestamp() * 1000)


def _moment(millis: int) -> datetime:
    return datetime.fromtimestamp(millis / 1000, timezone.utc).replace(tzinfo=None)


class StatusProcessor(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("schedule", STATE)

    def _plan(self) -> None:
        """Only the timers of the schedule in force remain."""
        for moment in list(self.handle.listTimers()):
            self.handle.deleteTimer(moment)
        ts, start, end, cancelled, status = self.state.get()
        if not cancelled:
            for moment in (start, end):
                if moment is not None:
                    self.handle.registerTimer(_millis(moment))

    def _publish(self, key, status: str, at) -> Iterator[pd.DataFrame]:
        known = self.state.get()
        if known[4] != status:
            self.state.update((*known[:4], status))
            yield pd.DataFrame({"auction_id": [key[0]], "status": [status], "at": [pd.Timestamp(at)]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        given = pd.concat(list(rows)).sort_values("ts", kind="stable")
        newest = given.iloc[-1]
        known = self.state.get() if self.state.exists() else None
        if known is not None and pd.Timestamp(known[0]) >= newest["ts"]:
            return
        plain = [None if pd.isna(newest[c]) else newest[c].to_pydatetime() for c in ("ts", "start_date", "end_date")]
        self.state.update((*plain, bool(newest["cancelled"]), known[4] if known else None))
        self._plan()
        if newest["cancelled"]:
            yield from self._publish(key, "cancelled", newest["ts"])
        elif known is None or known[3]:
            yield from self._publish(key, "upcoming", newest["ts"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        moment = _moment(expiredTimerInfo.getExpiryTimeInMs())
        ts, start, end, cancelled, status = self.state.get()
        if not cancelled and end is not None and _millis(end) <= _millis(moment):
            yield from self._publish(key, "completed", end)
        elif not cancelled and start is not None and _millis(start) <= _millis(moment):
            yield from self._publish(key, "active", start)

    def close(self) -> None:
        pass


def status_changes(schedules: DataFrame, late: str = "1 hour") -> DataFrame:
    """The stream of changes (auction_id, status, at); the session needs the RocksDB state store (``ROCKSDB``)."""
    marked = schedules.withWatermark("ts", late)
    return marked.groupBy("auction_id").transformWithStateInPandas(
        statefulProcessor=StatusProcessor(), outputStructType=CHANGE, outputMode="Append", timeMode="EventTime"
    )


def status_history(schedules: DataFrame, now: Column) -> DataFrame:
    """The batch form, for one schedule an auction (of several the newest): what has been published by ``now``."""
    newest = Window.partitionBy("auction_id").orderBy(F.col("ts").desc(), F.col("start_date").desc_nulls_last())
    one = schedules.withColumn("_n", F.row_number().over(newest)).filter("_n = 1")
    on, going = F.coalesce("cancelled", F.lit(False)), F.lit(True)
    change = lambda status, at: F.struct(F.lit(status).alias("status"), at.alias("at"))
    begins = ~on & (F.col("start_date") <= now) & (F.col("end_date").isNull() | (F.col("start_date") < F.col("end_date")))
    steps = F.array(
        F.when(on, change("cancelled", F.col("ts"))).otherwise(change("upcoming", F.col("ts"))),
        F.when(begins & going, change("active", F.col("start_date"))),
        F.when(~on & (F.col("end_date") <= now), change("completed", F.col("end_date"))),
    )
    return one.select("auction_id", F.inline(F.array_compact(steps)))
