from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hammerline.operators import changes as C
from hammerline.streaming import ingest


@pytest.fixture()
def table(spark):
    return spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z")], "id long, name string, v string")


def test_null_keys_come_in_again(spark, table):
    new = spark.createDataFrame([("a", 1), ("n", 2), ("n", 3), (None, 4), (None, 5)], "name string, k int")
    rows = C.absent(table, new, ["name"], [F.col("k")]).collect()
    assert sorted((r["name"] or "", r["k"]) for r in rows) == [("", 4), ("", 5), ("n", 2)]


def test_upsert_takes_the_first_new_row(spark, table):
    new = spark.createDataFrame([("a", "n2"), ("a", "n1"), ("c", "n3")], "name string, v string")
    out = {r["name"]: r["v"] for r in C.upsert(table, new, ["name"], ["v"], [F.col("v")]).collect()}
    assert out == {"a": "n1", "b": "y", None: "z", "c": "n3"}


def test_update_without_values_is_a_read(table):
    assert C.update(table, F.col("id") == 1, {"v": None}).collect() == table.filter("id = 1").collect()


def test_delete_keeps_unknown(table):
    assert {r["id"] for r in C.delete_state(table, F.col("name") == "a").collect()} == {2, 3}


def test_ids_are_consecutive_without_order_too(spark, table):
    new = spark.createDataFrame([(f"n{i}",) for i in range(500)], "name string")
    ids = [r["id"] for r in C.with_new_ids(table, new, ["name"], in_order=False).collect()]
    assert sorted(ids) == list(range(4, 504))
    assert C.with_new_ids(table, new.limit(0), ["name"], in_order=False).count() == 0


def test_find_or_create_ignores_case(spark, table):
    names = spark.createDataFrame([("A",), ("a",), ("New",), ("new",)], "name string")
    rows = {r["name"]: (r["id"], r["created"]) for r in C.find_or_create(table, names).collect()}
    assert rows == {"A": (1, False), "New": (4, True)}


def test_streamed_ingest_is_idempotent(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(source)
    for run in ("one", "two"):  # a fresh checkpoint replays everything
        stream = ingest.read_events(spark, source)
        ingest.ingest_once(stream, target, f"{tmp_path}/{run}", ["event_id", "ts"], "ts", f"{tmp_path}/log").awaitTermination()
        assert spark.read.parquet(target).count() == events.count()
    log = spark.read.parquet(f"{tmp_path}/log").orderBy("start_time").collect()
    assert {r["items_processed"] for r in log} == {events.count()}
    assert [r["items_created"] for r in log] == [events.count(), 0]


def test_run_log_rows_say_how_a_run_ended(spark):
    schema = "house_id long, task_type string, started_at timestamp_ntz, ended_at timestamp_ntz, items_processed long, items_created long, error_message string"
    at = datetime(2001, 1, 1)
    runs = spark.createDataFrame([(1, "a", at, at, 3, 2, None), (2, "a", at, at, None, None, "no page"), (3, "a", at, None, None, None, None)], schema)
    rows = [(r["house_id"], r["status"], r["items_processed"], r["error_message"]) for r in C.run_log_rows(runs).collect()]
    assert sorted(rows, key=lambda r: (r[0], r[1])) == [
        (1, "completed", 3, None), (1, "started", 0, None), (2, "failed", 0, "no page"), (2, "started", 0, None), (3, "started", 0, None),
    ]


def test_stream_windows(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(f"{tmp_path}/in")
    counts = ingest.tumbling(ingest.unique_events(ingest.read_events(spark, f"{tmp_path}/in")), late=None)
    query = counts.writeStream.format("memory").queryName("windows").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("windows").count() > 0
