"""Copy on write by files: what is rewritten, what readers see, results against plain state changes."""

import pytest
from pyspark.sql import functions as F

from hammerline.operators import changes as C
from hammerline.operators.file_table import FileTable
from hammerline.sources.versions import Conflict


@pytest.fixture()
def rows(spark):
    return spark.range(1000).select(F.col("id"), F.when(F.col("id") % 10 > 0, F.concat(F.lit("n"), F.col("id"))).alias("name"), (F.col("id") % 7).alias("v"))


@pytest.fixture()
def table(rows, tmp_path):
    return FileTable.create(rows, f"file://{tmp_path}/t", ["id"], 10)


def same(a, b):
    assert sorted(a.collect(), key=repr) == sorted(b.select(a.columns).collect(), key=repr)


def names(table, version=None):
    return {e["name"] for e in table.files(version)}


def test_update_of_one_row_rewrites_one_file(rows, table):
    before = names(table)
    done = table.update(F.col("id") == 421, {"v": 99, "name": None})
    assert (done.rewritten, done.rows, len(names(table) & before)) == (1, 1, len(before) - 1)
    same(table.read(), C.update_state(rows, F.col("id") == 421, {"v": 99}))
    same(table.read(1), rows)


def test_delete_of_unknown_and_whole_files(rows, table):
    done = table.delete(F.col("name").isin("n421", "n422"))
    assert (done.rewritten, done.rows) == (1, 2)
    same(table.read(), C.delete_state(rows, F.col("name").isin("n421", "n422")))
    first = min(table.files(), key=lambda e: int(e["low"]))
    before = names(table)
    done = table.delete(F.col("id") <= int(first["high"]))
    assert done.rewritten == 0 and names(table) == before - {first["name"]}
    assert table.delete(F.col("id") == -1).rows == 0
    assert table.delete(F.lit(True)).rewritten == 0 and table.read().count() == 0


def test_upsert(spark, rows, table):
    new = spark.createDataFrame([(5, "five"), (5, "fi"), (2000, "new"), (None, "none"), (None, "none")], "id long, name string")
    before = names(table)
    done = table.upsert(new, ["id"], ["name"], [F.col("name")])
    assert (done.rewritten, done.rows) == (1, 1) and len(before - names(table)) == 1
    out = {(r["id"], r["name"], r["v"]) for r in table.read().filter("id IN (5, 2000) OR id IS NULL").collect()}
    assert out == {(5, "fi", 5), (2000, "new", None), (None, "none", None)} and table.read().count() == 1003


def test_readers_see_the_old_or_the_new_state(rows, table):
    """Files written without a manifest, as by a writer that died, are no part of the table."""
    reader = table.read()
    table._write(rows.limit(5))
    same(table.read(), rows)
    table.update(F.col("id") < 300, {"v": -1})
    same(reader, rows)
    assert table.read().filter("v = -1").count() == 300


def test_two_writers(rows, table, monkeypatch):
    version, entries = table.manifest.rows()
    table.update(F.col("id") == 1, {"v": 50})
    monkeypatch.setattr(table.manifest, "rows", lambda v=None: (version, entries))
    with pytest.raises(Conflict):
        table.delete(F.col("id") == 2)
    monkeypatch.undo()
    assert table.read().filter("v = 50").count() == 1 and table.read().count() == 1000


def test_the_condition_reaches_the_scan(table):
    plan = table._with_file(table.files()).filter(F.col("id") == 5).groupBy("_file").count()._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,5)" in plan and "name" not in plan.split("ReadSchema")[1]
