"""Roll-ups by signed changes and by bitmaps against full recomputation."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from hammerline.operators.rollup_state import DistinctRollup, RollupState

LOT = "auction_id long, id long, sold boolean, final_price decimal(12,2), estimated_price_min decimal(12,2), estimated_price_max decimal(12,2)"


def lots(spark, rows):
    return spark.createDataFrame(rows, LOT)


def published(state):
    return sorted(map(tuple, state.rollup().collect()))


def test_state_after_each_batch_equals_recomputation(spark, tmp_path):
    some = random.Random(4)
    money = lambda: None if some.random() < 0.3 else Decimal(some.randrange(1, 9))
    new = lambda a: (a, some.randrange(10**9), some.random() < 0.7, money(), money(), money())
    now = [new(some.randrange(200)) for _ in range(800)]
    state = RollupState.create(lots(spark, now), f"file://{tmp_path}/s", 8)
    for step in range(5):
        gone = some.sample(now, 60) if step else [r for r in now if r[0] in (3, 4)]  # auctions that lose all
        came = [new(some.randrange(150, 260)) for _ in range(50)]
        changes = [(-1, *r) for r in gone] + [(1, *r) for r in came]
        now = [r for r in now if r not in gone] + came
        state.apply(spark.createDataFrame(changes, f"sign int, {LOT}"), lots(spark, now))
        full = {r[0]: r for r in published(RollupState.create(lots(spark, now), f"file://{tmp_path}/full{step}"))}
        for row in published(state):
            assert row == full.get(row[0], (row[0], 0, None, None, None, 0.0, None, None))
        assert set(full) <= {r[0] for r in published(state)}


def test_only_touched_files_change(spark, tmp_path):
    now = [(a, a, True, Decimal(a), None, None) for a in range(1, 400)]
    state = RollupState.create(lots(spark, now), f"file://{tmp_path}/s", 8)
    before = {e["name"] for e in state.table.files()}
    done = state.apply(spark.createDataFrame([(1, 7, 1000, True, Decimal(2), None, None)], f"sign int, {LOT}"), lots(spark, now))
    assert done.rewritten == 1 and len(before - {e["name"] for e in state.table.files()}) == 1
    row = state.rollup().filter("auction_id = 7").first()
    assert (row["total_lots"], row["low"], row["high"], row["total_realized"]) == (2, 2.0, 7.0, 9.0)


def test_bitmaps_at_several_grains(spark, tmp_path):
    some = random.Random(8)
    rows = [(some.randrange(30), some.choice([1, 2, None]), some.choice([None, 0, -5, some.randrange(200_000)]), some.randrange(5)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "day int, house int, v long, w long")
    stored = DistinctRollup.create(df, f"file://{tmp_path}/b", ["day", "house"], ["v", "w"])
    for grain in ([F.col("house")], [F.floor(F.col("day") / 7).alias("week"), F.col("house")], []):
        plain = df.groupBy(*grain).agg(F.countDistinct("v").alias("v"), F.countDistinct("w").alias("w"))
        found = stored.counts(grain, ["v", "w"])
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_a_change_reads_its_rows_once(spark, tmp_path):
    """Signed rows are summed once, whatever the number of steps that need the sums."""
    now = [(a, a, True, Decimal(a), None, None) for a in range(1, 50)]
    state = RollupState.create(lots(spark, now), f"file://{tmp_path}/s", 4)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    changes = spark.createDataFrame([(1, 7, 1000, True, Decimal(2), None, None), (-1, 8, 8, True, Decimal(8), None, None)], f"sign int, {LOT}")
    after = [r for r in now if r[0] != 8] + [(7, 1000, True, Decimal(2), None, None)]
    state.apply(changes.mapInPandas(count, changes.schema), lots(spark, after))
    assert seen.value == 2
    found = {r["auction_id"]: (r["total_lots"], r["low"], r["high"]) for r in state.rollup().collect()}
    assert found[7] == (2, 2.0, 7.0) and found[8] == (0, None, None) and found[9] == (1, 9.0, 9.0)


def test_values_far_apart_take_a_number_each(spark, tmp_path):
    """No buffer of a wide range for each value, and the whole range of numbers."""
    far = [i * 1_000_003 for i in range(-500, 500)] + [2**63 - 1, -(2**63), 2**63 - 64, 63, 64, -1, -64, -65]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(far * 2)], "day int, v long")
    stored = DistinctRollup.create(df, f"file://{tmp_path}/far", ["day"], ["v"])
    assert dict(spark.read.parquet(stored.folder).dtypes)["bits"] == "bigint"
    assert [r["v"] for r in stored.counts([], ["v"]).collect()] == [len(set(far))]
