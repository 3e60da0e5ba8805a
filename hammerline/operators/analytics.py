"""Market-wide reports: summaries, trends, rankings, forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions.predicates import equal, like, where
from ..plans.market import NOW, Market

UNITS = {"daily": "day", "weekly": "week"}
YEAR = "365 DAYS"


def window(m: DataFrame, start: Column, end: Column, column: str = "start_date") -> DataFrame:
    return m.filter(F.col(column).between(start, end))


def dated(m: Market, start: Column, end: Column) -> DataFrame:
    """Auctions of the period: (auction_id, house_id, start_date)."""
    return window(m.auctions.select(F.col("id").alias("auction_id"), "house_id", "start_date"), start, end)


def bounds(now: str, start: str | None, end: str | None) -> tuple[Column, Column]:
    return (M.at(start) if start else M.before(now, YEAR)), M.at(end or now)


def summary(m: Market) -> DataFrame:
    """One row: distinct houses, auctions and lots, value sold and last change.

    Lots and auctions count if their chain reaches a house, as under left joins from houses."""
    houses = m.houses.select(F.col("id").alias("house_id"), "last_scrape")
    auctions = m.auctions.select(F.col("id").alias("auction_id"), "house_id", "start_date").join(houses, "house_id")
    lots = m.plain_lots.select("id", "auction_id", "sold", "final_price", "created_at").join(auctions, "auction_id")
    none = {"total_houses": "long", "total_auctions": "long", "total_lots": "long", "total_value": "double", "last_update": "timestamp_ntz"}

    def row(df: DataFrame, **found: Column) -> DataFrame:
        return df.agg(*[found.get(k, F.first(F.lit(None))).cast(t).alias(k) for k, t in none.items()])

    parts = (
        row(houses, total_houses=F.countDistinct("house_id"), last_update=F.max("last_scrape"))
        .unionByName(row(auctions, total_auctions=F.countDistinct("auction_id"), last_update=F.max("start_date")))
        .unionByName(
            row(lots, total_lots=F.countDistinct("id"), total_value=F.sum(F.when(F.col("sold"), F.col("final_price"))),
                last_update=F.max(F.greatest("last_scrape", "start_date", "created_at")))
        )
    )
    return parts.agg(*[F.max(k).alias(k) for k in none])


def price_trends(
    m: Market, period: str = "monthly", now: str = NOW, start: str | None = None, end: str | None = None,
    category: str | None = None, artist_id: int | None = None, house_id: int | None = None,
) -> DataFrame:
    """Sold lots by day, week or month; an unknown period means months."""
    lots = (m.lots if category else m.plain_lots).filter("sold")
    if category:
        names = m.categories.select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
        lots = where(lots.join(names, "category_id", "left"), like("category_name", category))
    lots = where(lots, equal("artist_id", artist_id))
    joined = lots.join(where(dated(m, *bounds(now, start, end)), equal("house_id", house_id)), "auction_id")
    houses = m.houses.select(F.col("id").alias("house_id"))
    unit = UNITS.get(period, "month")
    return (
        joined.join(houses, "house_id")
        .groupBy(F.date_trunc(unit, "start_date").alias("period_date"))
        .agg(M.sold_count(), M.sold_mean("avg_price"), M.sold_sum(), F.countDistinct("auction_id").alias("auction_count"))
        .orderBy("period_date")
    )


def price_trend_arrays(m: Market, period: str = "monthly", now: str = NOW) -> DataFrame:
    """The trend as two parallel arrays in date order; a NULL mean counts as 0."""
    rows = price_trends(m, period, now).select(
        F.struct(
            F.date_format("period_date", "yyyy-MM-dd").alias("d"), F.coalesce("avg_price", F.lit(0.0)).alias("v")
        ).alias("x")
    )
    points = F.sort_array(F.collect_list("x"))  # a point a period, not a row a lot
    return rows.agg(points.alias("p")).select(
        F.lit(period).alias("period"), F.col("p.d").alias("dates"), F.col("p.v").alias("values")
    )


def volume_trends(
    m: Market, period: str = "monthly", now: str = NOW, start: str | None = None, end: str | None = None, house_id: int | None = None
) -> DataFrame:
    """Auctions with or without lots, by period."""
    auctions = where(dated(m, *bounds(now, start, end)), equal("house_id", house_id))
    unit = UNITS.get(period, "month")
    return (
        auctions.join(m.plain_lots.select(M.lot_mark(), "auction_id", "sold"), "auction_id", "left")
        .groupBy(F.date_trunc(unit, "start_date").alias("period_date"))
        .agg(F.countDistinct("auction_id").alias("auction_count"), F.count("lot").alias("lot_count"), M.sold_count())
        .orderBy("period_date")
    )


def volume_series(m: Market, period: str = "monthly", now: str = NOW) -> DataFrame:
    """The same as three named series."""
    wide = volume_trends(m, period, now).select(
        F.date_format("period_date", "yyyy-MM-dd").alias("date"),
        *[F.col(c).cast("double").alias(f"{period}_{n}") for c, n in (("auction_count", "auctions"), ("lot_count", "lots"), ("lots_sold", "sold"))],
    )
    return wide.unpivot("date", [c for c in wide.columns if c != "date"], "series", "value")


def _ranked(df: DataFrame, metric: str, least: int, limit: int) -> DataFrame:
    """NULL totals rank first: descending order puts them on top."""
    order = {"avg_price": "avg_sale_price", "lot_count": "lots_sold"}.get(metric, "total_sales")
    if metric == "avg_price":
        df = df.filter(F.col("lots_sold") >= least)
    return df.orderBy(F.col(order).desc_nulls_first(), "id").limit(limit)


def top_artists(
    m: Market, metric: str = "total_sales", now: str = NOW, start: str | None = None, end: str | None = None, limit: int = 20
) -> DataFrame:
    lots = m.plain_lots.select("auction_id", "artist_id", "sold", "final_price")
    by_artist = (
        lots.join(dated(m, *bounds(now, start, end)), "auction_id")
        .filter(F.col("artist_id").isNotNull())
        .groupBy("artist_id")
        .agg(F.count(F.lit(1)).alias("total_lots"), M.sold_count(), M.sold_sum(), M.sold_mean(), M.sold_max(),
             F.countDistinct("auction_id").alias("auction_appearances"))
    )
    named = m.artists.select(F.col("id"), "name", "nationality")
    found = by_artist.join(named, by_artist["artist_id"] == named["id"]).drop("artist_id")
    return _ranked(found, metric, 3, limit)


def top_categories(
    m: Market, metric: str = "total_sales", now: str = NOW, start: str | None = None, end: str | None = None, limit: int = 15
) -> DataFrame:
    lots = m.lots.select("auction_id", "artist_id", "category_id", "sold", "final_price")
    by_category = (
        lots.join(dated(m, *bounds(now, start, end)), "auction_id")
        .filter(F.col("category_id").isNotNull())
        .groupBy("category_id")
        .agg(F.count(F.lit(1)).alias("total_lots"), M.sold_count(), M.sold_sum(), M.sold_mean(),
             F.countDistinct("artist_id").alias("unique_artists"), F.countDistinct("auction_id").alias("auction_count"))
    )
    named = m.categories.select("id", F.col("name").alias("category_name"), "parent_category_id")
    found = by_category.join(named, by_category["category_id"] == named["id"]).drop("category_id")
    return _ranked(found, metric, 5, limit)


def house_performance(m: Market, now: str = NOW, start: str | None = None, end: str | None = None) -> DataFrame:
    """Houses with an auction in the period; the rate is NULL without lots."""
    lots = m.plain_lots.select(M.lot_mark(), "auction_id", "artist_id", "sold", "final_price")
    by_house = (
        dated(m, *bounds(now, start, end))
        .join(lots, "auction_id", "left")
        .groupBy("house_id")
        .agg(F.countDistinct("auction_id").alias("total_auctions"), F.count("lot").alias("total_lots"), M.sold_count(), M.sold_sum(),
             M.sold_mean(), F.countDistinct("artist_id").alias("unique_artists"))
    )
    houses = m.houses.select(F.col("id"), "name", "country")
    return (
        houses.join(by_house, houses["id"] == by_house["house_id"])
        .filter(F.col("total_auctions") > 0)
        .withColumn("sale_rate", M.rate_or_null(F.col("lots_sold"), F.col("total_lots")))
        .drop("house_id")
        .orderBy(F.col("total_sales").desc_nulls_last(), "id")
    )


def market_insights(m: Market, now: str = NOW) -> dict[str, DataFrame]:
    return {
        "top_artists": top_artists(m, "total_sales", now, limit=10),
        "top_categories": top_categories(m, "total_sales", now, limit=10),
        "price_trends": price_trends(m, "monthly", now),
        "house_performance": house_performance(m, now),
    }


def market_insights_rows(m: Market, now: str = NOW) -> DataFrame:
    """The composite report as one tagged union."""
    parts = market_insights(m, now)
    label = {"top_artists": "name", "top_categories": "category_name", "house_performance": "name"}
    rows = None
    for section, df in parts.items():
        named = F.date_format("period_date", "yyyy-MM-dd") if section == "price_trends" else F.col(label[section])
        part = df.select(F.lit(section).alias("section"), named.alias("label"), "lots_sold", "total_sales")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def price_prediction(
    m: Market, artist_id: int | None = None, category_id: int | None = None, months_ahead: int = 6, now: str = NOW
) -> DataFrame:
    """A linear forecast from the last 24 months; nothing is predicted from under 5 sales."""
    lots = where((m.lots if category_id else m.plain_lots).filter("sold"), equal("artist_id", artist_id), equal("category_id", category_id))
    auctions = m.auctions.filter(F.col("start_date") >= M.before(now, "24 MONTHS")).select(F.col("id").alias("auction_id"), "start_date")
    base = lots.join(auctions, "auction_id").agg(
        F.try_divide(F.sum("final_price").cast("double"), F.count("final_price")).alias("mean"),
        F.round(F.stddev_samp(F.col("final_price").cast("double")), 4).alias("spread"),
        F.count(F.lit(1)).alias("sample_size"),
        F.min("start_date").alias("first"),
        F.max("start_date").alias("last"),
    )
    enough = F.coalesce(F.col("mean"), F.lit(0.0)).cast("boolean") & (F.col("sample_size") >= 5)
    predicted = F.col("mean") * F.lit(1 + 0.05 / 12 * months_ahead)
    half = F.coalesce("spread", F.lit(0.0)) * 0.5
    return base.select(
        F.when(enough, F.round(predicted, 2)).alias("predicted_price"),
        F.when(enough, F.round(predicted - half, 2)).alias("price_min"),
        F.when(enough, F.round(predicted + half, 2)).alias("price_max"),
        F.when(enough, F.lit(months_ahead)).cast("long").alias("months_ahead"),
        F.when(enough & (F.col("sample_size") >= 20), "medium").otherwise("low").alias("confidence"),
        F.when(enough, F.round("mean", 2)).alias("avg_price"),
        "sample_size",
        F.when(enough, F.floor(M.whole_days(F.col("first"), F.col("last")) / 30)).cast("long").alias("data_period_months"),
    )


def seasonal_monthly(m: Market, years: int = 3, now: str = NOW) -> DataFrame:
    """By month of the year, over all years; sums and means without sales are 0."""
    auctions = m.auctions.filter(F.col("start_date") >= M.before(now, f"{years} YEARS")).select(F.col("id").alias("auction_id"), "start_date")
    return (
        auctions.join(m.plain_lots.select(M.lot_mark(), "auction_id", "sold", "final_price"), "auction_id", "left")
        .groupBy(F.month("start_date").cast("long").alias("month"), F.quarter("start_date").cast("long").alias("quarter"))
        .agg(F.countDistinct("auction_id").alias("auction_count"), F.count("lot").alias("lot_count"),
             F.coalesce(F.sum(F.when(F.col("sold"), F.col("final_price"))).cast("double"), F.lit(0.0)).alias("total_sales"),
             F.coalesce(M.sold_mean(), F.lit(0.0)).alias("avg_price"))
    )


def seasonal_quarterly(m: Market, years: int = 3, now: str = NOW) -> DataFrame:
    """Rolled up from the months."""
    return seasonal_monthly(m, years, now).groupBy("quarter").agg(
        F.sum("auction_count").alias("auction_count"),
        F.sum("lot_count").alias("lot_count"),
        F.sum(F.col("total_sales").cast("decimal(24,2)")).cast("double").alias("total_sales"),
    )


def geographic(m: Market, now: str = NOW) -> DataFrame:
    """By country, last 12 months; countries without an auction there are absent."""
    auctions = m.auctions.filter(F.col("start_date") >= M.before(now, "12 MONTHS")).select(F.col("id").alias("auction_id"), "house_id")
    houses = m.houses.select(F.col("id").alias("house_id"), "country")
    return (
        auctions.join(houses, "house_id")
        .join(m.plain_lots.select(M.lot_mark(), "auction_id", "sold", "final_price"), "auction_id", "left")
        .groupBy("country")
        .agg(F.countDistinct("house_id").alias("house_count"), F.countDistinct("auction_id").alias("auction_count"),
             F.count("lot").alias("lot_count"), M.sold_count(), M.sold_sum(), M.sold_mean("avg_price"))
        .orderBy(F.col("total_sales").desc_nulls_last(), "country")
    )
