"""Statistics of one artist, auction or house, from a few related aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M
from ..plans.market import NOW, Market, auctions_listed
from .listings import as_double


def _artist_lots(m: Market, artist_id: int) -> DataFrame:
    au = auctions_listed(m).select(F.col("id").alias("auction_id"), "house_id", "start_date", "house_name", F.col("title").alias("auction_title"))
    return m.plain_lots.filter(F.col("artist_id") == artist_id).join(au, "auction_id")


def artist_basic(m: Market, artist_id: int) -> DataFrame:
    return (
        _artist_lots(m, artist_id)
        .agg(F.count(F.lit(1)).alias("total_lots"), M.sold_count(), M.sold_sum(), M.sold_mean(), M.sold_min(), M.sold_max(),
             F.countDistinct("auction_id").alias("total_auctions"), F.countDistinct("house_id").alias("auction_houses"),
             F.min("start_date").alias("first_auction"), F.max("start_date").alias("last_auction"))
        .withColumn("sale_rate", M.rate_or_zero(F.col("lots_sold"), F.col("total_lots")))
    )


def artist_trends(m: Market, artist_id: int, now: str = NOW) -> DataFrame:
    recent = _artist_lots(m, artist_id).filter(F.col("sold") & (F.col("start_date") >= M.before(now, "24 MONTHS")))
    return recent.groupBy(F.date_trunc("month", "start_date").alias("month")).agg(M.sold_count(), M.sold_mean("avg_price"), M.sold_sum())


def artist_top_sales(m: Market, artist_id: int, limit: int = 10) -> DataFrame:
    best = _artist_lots(m, artist_id).filter("sold").orderBy(F.col("final_price").desc_nulls_first(), "id").limit(limit)
    return as_double(best.select("id", "final_price", "auction_title", "start_date", "house_name"))


def artist_by_medium(m: Market, artist_id: int) -> DataFrame:
    return (
        _artist_lots(m, artist_id)
        .filter(F.col("medium").isNotNull())
        .groupBy("medium")
        .agg(F.count(F.lit(1)).alias("lot_count"), M.sold_count("sold_count"), M.sold_mean("avg_price"), M.sold_sum())
        .orderBy(F.col("total_sales").desc_nulls_last(), "medium")
    )


def artist_by_house(m: Market, artist_id: int) -> DataFrame:
    return (
        _artist_lots(m, artist_id)
        .groupBy("house_id", "house_name")
        .agg(F.count(F.lit(1)).alias("total_lots"), M.sold_count("sold_lots"), M.sold_sum(), M.sold_mean("avg_price"))
        .filter("total_lots > 0")
        .orderBy(F.col("total_sales").desc_nulls_last(), "house_id")
    )


def artist_presence(m: Market, artist_id: int) -> DataFrame:
    """Years between first and last auction (at least 1) and auctions a year."""
    basic = artist_basic(m, artist_id)
    days = M.whole_days(F.col("first_auction"), F.col("last_auction"))
    years = F.when(days > 365, F.floor(days / 365)).when(days.isNotNull(), F.lit(1)).cast("long")
    return basic.select(years.alias("years_active"), "total_auctions").withColumn(
        "auction_frequency", F.when(F.col("total_auctions") > 0, F.col("total_auctions").cast("double") / F.col("years_active"))
    )


def trending_artists(m: Market, days: int = 90, limit: int = 20, now: str = NOW) -> DataFrame:
    auctions = m.auctions.filter(F.col("start_date") >= M.before(now, f"{days} DAYS")).select(F.col("id").alias("auction_id"))
    rows = (
        m.plain_lots.filter(F.col("sold") & F.col("artist_id").isNotNull())
        .join(auctions, "auction_id")
        .groupBy("artist_id")
        .agg(M.sold_count("recent_sales"), M.sold_sum(), M.sold_mean("avg_price"), F.countDistinct("auction_id").alias("auction_count"))
        .filter("recent_sales >= 2")
    )
    named = m.artists.select("id", "name", "nationality")
    found = rows.join(named, rows["artist_id"] == named["id"]).drop("artist_id")
    return found.orderBy(F.col("total_sales").desc_nulls_first(), F.col("recent_sales").desc_nulls_first(), "id").limit(limit)


def auction_basic(m: Market, auction_id: int) -> DataFrame:
    return (
        m.lots.filter(F.col("auction_id") == auction_id)
        .agg(F.count(F.lit(1)).alias("total_lots"), M.sold_count(), M.sold_sum(), M.sold_mean(), M.sold_min(), M.sold_max(),
             F.sum("estimated_price_min").cast("double").alias("total_estimate_min"),
             F.sum("estimated_price_max").cast("double").alias("total_estimate_max"),
             F.countDistinct("artist_id").alias("unique_artists"), F.countDistinct("category_id").alias("unique_categories"))
        .withColumn("sale_rate", M.rate_or_zero(F.col("lots_sold"), F.col("total_lots")))
    )


def price_ranges(lots: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sold lots by price; both edges count, so an edge value falls in two ranges."""
    price = F.col("final_price")
    ranges = {
        "under_1k": price < 1000,
        "range_1k_5k": price.between(1000, 5000),
        "range_5k_25k": price.between(5000, 25000),
        "range_25k_100k": price.between(25000, 100000),
        "over_100k": price >= 100000,
    }
    return lots.filter("sold").groupBy(*(by or [])).agg(*[F.count_if(p).alias(n) for n, p in ranges.items()])


def auction_price_ranges(m: Market, auction_id: int) -> DataFrame:
    return price_ranges(m.plain_lots.filter(F.col("auction_id") == auction_id))


def house_price_ranges(m: Market) -> DataFrame:
    au = m.auctions.select(F.col("id").alias("auction_id"), "house_id")
    return price_ranges(m.plain_lots.join(au, "auction_id"), ["house_id"])


def auction_top_lots(m: Market, auction_id: int, limit: int = 10) -> DataFrame:
    a = m.artists.select(F.col("id").alias("artist_id"), F.col("name").alias("artist_name"))
    best = m.lots.filter((F.col("auction_id") == auction_id) & F.col("sold")).join(a, "artist_id", "left")
    return as_double(best.orderBy(F.col("final_price").desc_nulls_first(), "id").limit(limit).select("id", "lot_number", "title", "final_price", "artist_name"))


def auction_categories(m: Market, auction_id: int) -> DataFrame:
    """Lots without a category form a group of their own."""
    c = m.categories.select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
    return (
        m.lots.filter(F.col("auction_id") == auction_id)
        .join(c, "category_id", "left")
        .groupBy("category_id", "category_name")
        .agg(F.count(F.lit(1)).alias("total_lots"), M.sold_count("sold_lots"), M.sold_sum("category_sales"), M.sold_mean("avg_price"))
        .filter("total_lots > 0")
        .orderBy(F.col("category_sales").desc_nulls_last(), "category_id")
    )


def house_basic(m: Market, house_id: int) -> DataFrame:
    auctions = m.auctions.filter(F.col("house_id") == house_id).select(F.col("id").alias("auction_id"), "start_date")
    lots = m.plain_lots.select("id", "auction_id", "artist_id", "sold", "final_price")
    return (
        auctions.join(lots, "auction_id", "left")
        .agg(F.countDistinct("auction_id").alias("total_auctions"), F.countDistinct("id").alias("total_lots"),
             F.countDistinct(F.when(F.col("sold"), F.col("id"))).alias("lots_sold"), M.sold_sum(), M.sold_mean(),
             F.max("start_date").alias("last_auction_date"), F.countDistinct("artist_id").alias("unique_artists"))
        .withColumn("sale_rate", M.rate_or_zero(F.col("lots_sold"), F.col("total_lots")))
    )


def house_recent(m: Market, house_id: int, now: str = NOW) -> DataFrame:
    auctions = m.auctions.filter((F.col("house_id") == house_id) & (F.col("start_date") >= M.before(now, "30 DAYS")))
    return auctions.select(F.col("id").alias("auction_id")).join(m.plain_lots, "auction_id", "left").agg(
        F.countDistinct("auction_id").alias("recent_auctions"), F.countDistinct("id").alias("recent_lots"), M.sold_sum("recent_sales")
    )


def house_categories(m: Market, house_id: int, limit: int = 5) -> DataFrame:
    auctions = m.auctions.filter(F.col("house_id") == house_id).select(F.col("id").alias("auction_id"))
    c = m.categories.select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
    return (
        m.lots.filter("sold")
        .join(auctions, "auction_id")
        .join(c, "category_id", "left")
        .groupBy("category_id", "category_name")
        .agg(F.count(F.lit(1)).alias("lot_count"), M.sold_sum("category_sales"))
        .orderBy(F.col("category_sales").desc_nulls_last(), "category_id")
        .limit(limit)
    )
