"""Similar lots of all lots against every pair scored in Python: groups of one price, missing keys and prices."""

import random
from decimal import Decimal

import pytest

from hammerline.operators import similar
from hammerline.operators.similar import similar_lots_all


class Lots:
    def __init__(self, lots):
        self.lots = lots


SCHEMA = "id string, artist_id long, category_id long, final_price decimal(12,2), estimated_price_max decimal(12,2), estimated_price_min decimal(12,2)"


def brute(rows, limit):
    out = []
    for x in rows:
        p = next((v for v in x[3:] if v), Decimal(1000))
        found = []
        for y in rows:
            if y[0] != x[0]:
                score = 3 * (x[1] is not None and x[1] == y[1]) + 2 * (x[2] is not None and x[2] == y[2])
                score += y[3] is not None and p / 2 <= y[3] <= p * 3 / 2
                if score:
                    found.append((-score, y[3] is None, -(y[3] or 0), y[0]))
        out += [(x[0], n, y[3], -y[0]) for n, y in enumerate(sorted(found)[:limit], 1)]
    return sorted(out)


def merged(rows, limit):
    """The same where lots that share an id share an answer: pairs that score and cost alike count once."""
    found = {}
    for x in rows:
        p = next((v for v in x[3:] if v), Decimal(1000))
        for y in rows:
            score = 3 * (x[1] is not None and x[1] == y[1]) + 2 * (x[2] is not None and x[2] == y[2]) + (y[3] is not None and p / 2 <= y[3] <= p * 3 / 2)
            if score and x[0] != y[0]:
                found.setdefault(x[0], set()).add((-score, y[3] is None, -(y[3] or 0), y[0]))
    return sorted((x, n, y[3], -y[0]) for x, ys in found.items() for n, y in enumerate(sorted(ys)[:limit], 1))


@pytest.mark.parametrize("prices, keys", [(6, 3), (200, 2), (1, 2), (30, 40)])
def test_every_pair(spark, prices, keys):
    some = random.Random(prices)
    money = lambda: None if some.random() < 0.2 else Decimal(some.randrange(prices) * 50) / 4
    key = lambda: None if some.random() < 0.2 else some.randrange(keys)
    rows = [(f"l{i}", key(), key(), money(), money(), money()) for i in range(130)]
    for limit in (3, 10):
        found = similar_lots_all(Lots(spark.createDataFrame(rows, SCHEMA)), limit)
        assert sorted(tuple(r) for r in found.collect()) == brute(rows, limit)


def test_no_loop_join_and_no_lots(spark):
    found = similar_lots_all(Lots(spark.createDataFrame([], SCHEMA)))
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_small_groups_move_no_lists(spark, monkeypatch):
    """Lots with enough others of their artist and category are answered where these lie: no list is asked for them."""
    some = random.Random(7)
    money = lambda: None if some.random() < 0.2 else Decimal(some.randrange(9000)) / 4
    rows = [(f"l{i}", i % 9, i % 3, money(), money(), money()) for i in range(180)] + [("x", None, 1, None, None, None), ("y", 77, 2, Decimal(5), None, None)]
    asked = []
    listed = similar._listed
    monkeypatch.setattr(similar, "_listed", lambda lots, asks, *rest: asked.append(asks) or listed(lots, asks, *rest))
    found = similar_lots_all(Lots(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 10)
    assert sorted({r["id"] for asks in asked for r in asks.select("id").collect()}) == ["x", "y"]


def test_large_groups_and_repeated_ids(spark, monkeypatch):
    """Groups beyond the bound of comparison go by lists; lots that share an id are merged and count once in a list."""
    monkeypatch.setattr(similar, "LOCAL", 20)
    some = random.Random(3)
    money = lambda: None if some.random() < 0.2 else Decimal(some.randrange(400)) / 4
    rows = [(f"l{i}", i % 2, i % 3 // 2, money(), money(), money()) for i in range(150)] + [(f"m{i}", 5, 5, money(), money(), money()) for i in range(15)]
    found = similar_lots_all(Lots(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 10)
    twice = [(*r[:3], r[3], Decimal(1), Decimal(1)) for r in rows]
    found = similar_lots_all(Lots(spark.createDataFrame([r for r in twice for _ in range(3)], SCHEMA)))
    assert sorted(tuple(r) for r in found.collect()) == brute(twice, 10)


def test_bands_and_groups_across_parts(spark, monkeypatch):
    """Parts of a few rows, read a few rows at a time: bands, groups and one price of many lots lie in several of them."""
    monkeypatch.setattr(similar, "LOCAL", 12)
    monkeypatch.setattr(similar, "PART", 12)
    monkeypatch.setattr(similar, "CHUNK", 7)
    some = random.Random(11)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        for prices in (300, 3):
            money = lambda: None if some.random() < 0.3 else Decimal(some.randrange(prices) * 100) / 4  # noqa: B023, E731
            key = lambda n: None if some.random() < 0.4 else some.randrange(n)
            rows = [(f"l{i}", key(4), key(2), money(), money(), money()) for i in range(90)]
            rows += [(f"m{i}", None, 3, Decimal(50), None, None) for i in range(40)] + [("n1", None, 4, Decimal(70), None, None), ("n2", None, 4, None, None, None)]
            found = similar_lots_all(Lots(spark.createDataFrame(rows, SCHEMA)), 3)
            assert sorted(tuple(r) for r in found.collect()) == brute(rows, 3)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_lists_dont_move(spark):
    """Lots of one list each are shuffled and stored as entries and as what asks, not with all that is found."""
    some = random.Random(5)
    rows = [(f"lot-{i}", None, i % 3, Decimal(some.randrange(10**7)) / 100, None, None) for i in range(20_000)]
    lots = spark.createDataFrame(rows, SCHEMA)
    store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = lambda: {s.stageId(): s.shuffleWriteBytes() + s.diskBytesSpilled() + s.outputBytes() for s in map(listed().apply, range(listed().size()))}
    listed = lambda: store.stageList(None, False, False, none, None)
    before = stages()
    similar_lots_all(Lots(lots)).write.format("noop").mode("overwrite").save()
    moved = sum(n for stage, n in stages().items() if stage not in before)
    assert 0 < moved < 200 * len(rows)


def test_a_repeated_id_merges_only_its_own_lots(spark, monkeypatch):
    """Lots beside those that share an id are answered from one list, in which such an id counts once at a price."""
    some = random.Random(9)
    money = lambda: None if some.random() < 0.2 else Decimal(some.randrange(60)) / 4
    rows = [(f"l{i}", None, i % 2, money(), Decimal(9), None) for i in range(80)]
    rows += [r for r in rows[:12] for _ in range(2)] + [("l3", None, 1, Decimal(7), None, None), ("l4", 1, 0, Decimal(2), None, None)]
    asked = []
    listed = similar._listed
    monkeypatch.setattr(similar, "_listed", lambda lots, asks, *rest: asked.append(asks) or listed(lots, asks, *rest))
    found = sorted(tuple(r) for r in similar_lots_all(Lots(spark.createDataFrame(rows, SCHEMA)), 4).collect())
    assert {r["id"] for r in asked[0].filter("NOT alone").collect()} == {f"l{i}" for i in range(12)}
    assert found == merged(rows, 4)
