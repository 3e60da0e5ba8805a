"""Kill and replay, retries, stream metrics, and status by timers."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hammerline.streaming import status as S
from hammerline.streaming.ledger import Ledger, ProgressTable

ROW = "id long, v long"


def ledger(folder, **how):
    return Ledger(folder, "q", ROW, ["id"], **how)


def rows(spark, values):
    return spark.createDataFrame(values, ROW)


class Killed(BaseException):
    """As a lost driver: nothing behind it runs."""


def test_a_batch_that_dies_between_its_writes(spark, tmp_path):
    sink = ledger(f"file://{tmp_path}/t")
    sink.commit(rows(spark, [(1, 1), (2, 2)]), 0)

    def die():
        raise Killed

    sink.after_rows = die
    second = rows(spark, [(2, 9), (3, 3), (3, 3)])
    with pytest.raises(Killed):
        sink.commit(second, 1)
    assert sorted(r["id"] for r in sink.rows(spark).collect()) == [1, 2]
    sink.after_rows = lambda: None
    assert sink.commit(second, 1) and not sink.commit(second, 1) and not sink.commit(second, 0)
    assert sorted((r["id"], r["v"]) for r in sink.rows(spark).collect()) == [(1, 1), (2, 2), (3, 3)]
    lines = {r["batch"]: (r["status"], r["items_processed"], r["items_created"]) for r in sink.lines(spark).collect()}
    assert lines == {0: ("completed", 2, 2), 1: ("completed", 3, 1)}


def test_a_batch_that_fails_leaves_a_line(spark, tmp_path):
    sink = ledger(f"file://{tmp_path}/t")

    def fail():
        raise ValueError("disk full")

    sink.after_rows = fail
    with pytest.raises(ValueError):
        sink.commit(rows(spark, [(1, 1)]), 0)
    line = sink.lines(spark).first()
    assert (line["status"], line["error_message"]) == ("failed", "disk full") and sink.rows(spark).count() == 0
    sink.after_rows = lambda: None
    assert sink.commit(rows(spark, [(1, 1)]), 0)
    assert [r["status"] for r in sink.lines(spark).collect()] == ["completed"] and sink.rows(spark).count() == 1


def test_failed_rows_are_tried_again_when_due(spark, tmp_path):
    sink = ledger(f"file://{tmp_path}/t", valid=F.col("v") > 0, wait=60, attempts=3)
    start = datetime(2024, 1, 1)
    sink.commit(rows(spark, [(1, 1), (2, -2), (3, None)]), 0, start)
    assert sink.due(spark, start).count() == 0 and sink.due(spark, start + timedelta(seconds=60)).count() == 2
    fix = lambda df: df.withColumn("v", F.when(F.col("id") == 2, 22).otherwise(F.col("v")))
    at = start + timedelta(seconds=61)
    assert sink.retry(spark, at, fix) and not sink.retry(spark, at, fix)
    assert {r["id"]: r["v"] for r in sink.rows(spark).collect()} == {1: 1, 2: 22}
    again = sink.retries(spark).filter("attempt = 2").collect()
    assert [(r["id"], r["due"]) for r in again] == [(3, at + timedelta(seconds=120))]
    sink.retry(spark, at + timedelta(seconds=500), lambda df: df)
    assert sink.due(spark, at + timedelta(days=1)).count() == 0  # no attempt is left


def test_progress_of_good_and_failed_streams(spark, tmp_path):
    for n, values in enumerate(([(1, 1), (2, 2)], [(2, 2), (3, 3), (4, 4)])):
        rows(spark, values).coalesce(1).write.parquet(f"file://{tmp_path}/in/{n}")
    table = ProgressTable(f"file://{tmp_path}/progress")
    spark.streams.addListener(table)
    try:
        stream = lambda: spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in/*")
        sink = ledger(f"file://{tmp_path}/t")
        query = sink.ingest(stream(), f"file://{tmp_path}/check")
        query.awaitTermination()
        assert table.wait(query)
        bad = ledger(f"file://{tmp_path}/bad", valid=F.raise_error(F.lit("broken row")).cast("boolean"))
        query = bad.ingest(stream(), f"file://{tmp_path}/check2")
        with pytest.raises(Exception, match="broken row"):
            query.awaitTermination()
        assert table.wait(query)
    finally:
        spark.streams.removeListener(table)
    assert table.flush(spark) > 0 and table.flush(spark) == 0
    found = spark.read.parquet(table.path)
    assert found.filter("error IS NULL").agg(F.sum("rows_read")).first()[0] >= 5
    assert found.filter("error IS NOT NULL AND batch IS NULL").count() == 1
    assert sorted(r["id"] for r in sink.rows(spark).collect()) == [1, 2, 3, 4]
    assert bad.lines(spark).first()["status"] == "failed"


def test_status_by_timers_with_late_and_missing_events(spark, tmp_path):
    day = datetime(2024, 5, 1)
    hour = lambda n: day + timedelta(hours=n)
    batches = [
        [(1, hour(0), hour(10), hour(20), False), (2, hour(0), hour(10), hour(30), False), (3, hour(0), hour(12), hour(13), False)],
        [(2, hour(5), hour(15), hour(40), False), (3, hour(6), hour(12), hour(13), True), (9, hour(13), hour(99), None, False)],
        [(2, hour(4), hour(6), hour(7), False), (9, hour(26), hour(99), None, False)],  # an older schedule comes late
        [(9, hour(60), hour(99), None, False)],
        [(9, hour(61), hour(99), None, False)],
    ]
    for n, values in enumerate(batches):
        spark.createDataFrame(values, S.SCHEDULE).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in/{n}")
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", S.ROCKSDB)
    try:
        stream = spark.readStream.schema(S.SCHEDULE).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(f"file://{tmp_path}/in/*")
        changes = S.status_changes(stream).writeStream.format("parquet").option("path", f"file://{tmp_path}/out")
        changes.option("checkpointLocation", f"file://{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    found = spark.read.schema(S.CHANGE).parquet(f"file://{tmp_path}/out")
    got = sorted((r["auction_id"], r["at"], r["status"]) for r in found.filter("auction_id < 9").collect())
    assert got == [
        (1, hour(0), "upcoming"), (1, hour(10), "active"), (1, hour(20), "completed"), (2, hour(0), "upcoming"), (2, hour(15), "active"),
        (2, hour(40), "completed"), (3, hour(0), "upcoming"), (3, hour(6), "cancelled"),
    ]
    schedules = spark.createDataFrame([r for b in batches for r in b], S.SCHEDULE)
    batch = S.status_history(schedules, F.lit(hour(60))).filter("auction_id < 9 AND status IN ('active', 'completed', 'cancelled')")
    assert sorted((r["auction_id"], r["at"], r["status"]) for r in batch.collect()) == [g for g in got if g[2] != "upcoming"]
