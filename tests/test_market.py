"""Traps of the model on hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hammerline.functions.predicates import page, page_numbers
from hammerline.operators import analytics as A
from hammerline.operators import listings as L
from hammerline.operators import quality as Q
from hammerline.operators import reports as R
from hammerline.plans.market import ARTIST, AUCTION, CATEGORY, HOUSE, LOT, TITLE, Market

D = dt.datetime(2001, 7, 15)


def lot(i, auction=1, number="1", artist=1, sold=True, price="100.00", low="10.00", high="20.00", category=1):
    value = Decimal(price) if price and sold else None
    return (f"l{i}", auction, number, artist, "O", sold, value, Decimal(low), Decimal(high), D, i), (i, f"Title {i}", category)


def market(spark, lots, auctions=None, houses=None, artists=None):
    auctions = auctions or [(1, 1, "A", D, D, "completed", "live", None, "x1")]
    houses = houses or [(1, "H1", "ASIA", "active", None)]
    artists = artists or [(1, "Ann", "FR", True), (2, "Bob", None, False)]
    return Market(
        spark.createDataFrame(houses, HOUSE),
        spark.createDataFrame(auctions, AUCTION),
        spark.createDataFrame([x[0] for x in lots], LOT),
        spark.createDataFrame([x[1] for x in lots], TITLE),
        spark.createDataFrame(artists, ARTIST),
        spark.createDataFrame([(1, "Painting", 0)], CATEGORY),
    )


def test_unsold_artist_ranks_first(spark):
    m = market(spark, [lot(1, artist=1, price="500.00"), lot(2, artist=2, sold=False, price=None)])
    rows = A.top_artists(m).collect()
    assert [r["name"] for r in rows] == ["Bob", "Ann"]
    assert rows[0]["total_sales"] is None


def test_edges_count_twice(spark):
    prices = ["999.99", "1000.00", "5000.00", "25000.00", "100000.00", None]
    m = market(spark, [lot(i, price=p, sold=True) for i, p in enumerate(prices)])
    row = R.auction_price_ranges(m, 1).first()
    assert row.asDict() == {"under_1k": 1, "range_1k_5k": 2, "range_5k_25k": 2, "range_25k_100k": 2, "over_100k": 1}


def test_falsy_criteria_are_dropped_and_false_is_not(spark):
    m = market(spark, [lot(1), lot(2, sold=False, price=None)])
    assert L.lots(m, price_min=0, house_id=0).count() == 2
    assert [r["id"] for r in L.lots(m, sold=False).collect()] == ["l2"]


def test_natural_order(spark):
    numbers = ["10", "2", "1", "2A", "N/A"]
    m = market(spark, [lot(i, number=n) for i, n in enumerate(numbers)])
    assert [r["lot_number"] for r in L.auction_lots(m, 1).collect()] == ["1", "2", "10", "2A", "N/A"]
    wide = market(spark, [lot(1, number="99999999999")])
    assert L.auction_lots(wide, 1).first()["sort_number"] is None


def test_similar_lots_without_artist_or_price(spark):
    lots = [lot(1, artist=None, sold=False, price=None, low="0.00", high="0.00", category=None),
            lot(2, price="1000.00"), lot(3, price="1600.00"), lot(4, artist=None, price="499.00")]
    found = L.similar_lots(market(spark, lots), "l1").collect()
    assert [(r["id"], r["similarity_score"]) for r in found] == [("l2", 1)]  # 1000 is the fallback price


def test_house_without_auctions_and_auction_without_lots(spark):
    houses = [(1, "H1", "ASIA", "active", None), (2, "H2", "EUROPE", "active", None)]
    m = market(spark, [lot(1, auction=99)], houses=houses)
    rows = A.house_performance(m).collect()
    assert [(r["name"], r["total_lots"], r["sale_rate"]) for r in rows] == [("H1", 0, None)]
    assert R.auction_basic(m, 1).first()["sale_rate"] == 0.0
    assert {r["name"]: r["total_auctions"] for r in L.houses(m).collect()} == {"H1": 1, "H2": 0}


def test_prediction_needs_five_sales(spark):
    row = A.price_prediction(market(spark, [lot(1)])).first()
    assert row["predicted_price"] is None and row["confidence"] == "low" and row["sample_size"] == 1


def test_empty_tables(spark):
    m = market(spark, [])
    assert A.summary(m).first()["total_lots"] == 0
    assert A.price_trends(m).count() == 0
    assert A.price_trend_arrays(m).first()["dates"] == []


@pytest.mark.parametrize(("total", "limit", "offset", "expected"), [(0, 50, 0, (1, 0)), (101, 50, 50, (2, 3)), (100, 50, 99, (2, 2))])
def test_page_numbers(total, limit, offset, expected):
    assert page_numbers(total, limit, offset) == expected


def test_page_refuses_nonsense(spark):
    with pytest.raises(ValueError):
        page(spark.range(3), 0)


def test_checks_pass_unknown_values(spark):
    rows = spark.createDataFrame([("bad", "live"), (None, "live"), ("active", "x")], "status string, auction_type string")
    rows = rows.withColumn("start_date", F.lit(D)).withColumn("end_date", F.lit(None).cast("timestamp"))
    good, bad = Q.split(rows, Q.auction_rules())
    assert good.count() == 1 and {r["violations"][0] for r in bad.collect()} == {"status", "auction_type"}


def test_plans_prune_and_push_down(spark):
    from hammerline.plans.market import from_tables

    m = from_tables(spark, "/root/testdata/sf0.001")
    plan = A.price_trends(m)._jdf.queryExecution().toString()
    assert "p_name" not in plan.split("== Physical Plan ==")[1]
    assert "PushedFilters: [IsNotNull" in plan
