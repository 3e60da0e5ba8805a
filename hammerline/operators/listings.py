"""Listings and lookups of lots, auctions, artists and houses."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions.predicates import at_least, at_most, equal, flag, like, one_of, page, page_numbers, where
from ..functions.text import natural_number, slugify
from ..plans.market import NOW, Market, auctions_listed, enrich

LOT_COLUMNS = [
    "id", "auction_id", "lot_number", "title", "artist_id", "category_id", "estimated_price_min", "estimated_price_max",
    "final_price", "sold", "medium", "created_at", "artist_name", "category_name", "auction_title", "house_name",
]
AUCTION_COLUMNS = [
    "id", "house_id", "title", "start_date", "end_date", "status", "auction_type", "external_id", "total_realized",
    "house_name", "house_country",
]


def as_double(df: DataFrame) -> DataFrame:
    """Money columns as double, the form results are published in."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


def _lots(df: DataFrame, *extra: str) -> DataFrame:
    """The listing's columns; the id of an artist, which may be unknown, is published as text."""
    df = df.withColumn("artist_id", F.col("artist_id").cast("string"))
    return as_double(df.select(*LOT_COLUMNS, *extra))


def _shown(m: Market, lots: DataFrame, order: list, limit: int, offset: int = 0, *extra: str) -> DataFrame:
    """A page of lots with everything it shows: rows are ranked on the fact table alone, and
    only the page is joined to the other tables."""
    return _lots(enrich(m, page(lots.orderBy(*order), limit, offset)).orderBy(*order), *extra)


def lots(
    m: Market, limit: int = 50, offset: int = 0, auction_id: int | None = None, artist_id: int | None = None,
    category_id: int | None = None, house_id: int | None = None, sold: bool | None = None, price_min=None, price_max=None,
) -> DataFrame:
    found = where(
        m.plain_lots, equal("auction_id", auction_id), equal("artist_id", artist_id), flag("sold", sold),
        at_least("final_price", price_min), at_most("final_price", price_max),
    )
    if category_id:
        found = found.join(m.titles.filter(F.col("category_id") == category_id), "part_id", "left_semi")
    if house_id:
        own = m.auctions.filter(F.col("house_id") == house_id).select(F.col("id").alias("auction_id"))
        found = found.join(own, "auction_id", "left_semi")
    return _shown(m, found, [F.col("created_at").desc_nulls_first(), F.col("id")], limit, offset)


def lot(m: Market, lot_id: str) -> DataFrame:
    return _lots(enrich(m, m.plain_lots.filter(F.col("id") == lot_id)))


def recent_lots(m: Market, days: int = 30, limit: int = 50, offset: int = 0, now: str = NOW) -> DataFrame:
    found = m.plain_lots.filter(F.col("created_at") >= M.before(now, f"{days} DAYS"))
    return _shown(m, found, [F.col("created_at").desc_nulls_first(), F.col("id")], limit, offset)


def high_value_lots(m: Market, least: int = 10_000, limit: int = 50) -> DataFrame:
    found = m.plain_lots.filter(F.col("sold") & (F.col("final_price") >= least))
    return _shown(m, found, [F.col("final_price").desc_nulls_first(), F.col("id")], limit)


def similar_lots(m: Market, lot_id: str, limit: int = 10) -> DataFrame:
    """Lots that share artist, category or price range (half to one and a half times the
    reference price) with one lot, by additive score.  The one reference row is looked up
    first, so its values are constants that reach the scan; an unknown artist matches nobody."""

    def price(name: str):
        return F.nullif(F.col(name), F.lit(0).cast("decimal(12,2)"))

    base = F.coalesce(price("final_price"), price("estimated_price_max"), price("estimated_price_min"), F.lit(1000).cast("decimal(12,2)"))
    ref = m.lots.filter(F.col("id") == lot_id).select("artist_id", "category_id", base.alias("price")).first()
    if ref is None:
        return _lots(enrich(m, m.lots.filter(F.lit(False))).withColumn("similarity_score", F.lit(0)), "similarity_score")
    low, high = (F.lit(ref["price"] * Decimal(x)).cast("decimal(14,3)") for x in ("0.5", "1.5"))
    near = F.col("final_price").between(low, high)
    same_artist = F.col("artist_id") == F.lit(ref["artist_id"]).cast("long")
    same_category = F.col("category_id") == F.lit(ref["category_id"]).cast("long")
    score = F.when(same_artist, 3).otherwise(0) + F.when(same_category, 2).otherwise(0) + F.when(near, 1).otherwise(0)
    found = m.lots.filter((F.col("id") != lot_id) & (same_artist | same_category | near)).withColumn("similarity_score", score)
    return _shown(m, found, [F.desc("similarity_score"), F.col("final_price").desc_nulls_last(), F.col("id")], limit, 0, "similarity_score")


def auctions(
    m: Market, limit: int = 50, offset: int = 0, house_id: int | None = None, status=None, auction_type: str | None = None,
    country: str | None = None, start_from: str | None = None, start_to: str | None = None,
) -> DataFrame:
    found = _filtered(m, house_id, status, auction_type, country, start_from, start_to)
    return as_double(page(found.orderBy(F.col("start_date").desc_nulls_last(), "id"), limit, offset).select(*AUCTION_COLUMNS))


def _filtered(m: Market, house_id=None, status=None, auction_type=None, country=None, start_from=None, start_to=None) -> DataFrame:
    """``status`` may be one value or a list."""
    by_status = one_of("status", status) if isinstance(status, (list, tuple)) else equal("status", status)
    return where(
        auctions_listed(m), equal("house_id", house_id), by_status, equal("auction_type", auction_type), like("house_country", country),
        F.col("start_date") >= M.at(start_from) if start_from else None, F.col("start_date") <= M.at(start_to) if start_to else None,
    )


def auctions_count(m: Market, **criteria) -> DataFrame:
    return _filtered(m, **criteria).agg(F.count(F.lit(1)).alias("total"))


def auctions_page(m: Market, limit: int = 50, offset: int = 0, **criteria) -> DataFrame:
    """The page envelope without its items."""
    total = F.col("total")
    first, _ = page_numbers(0, limit, offset)
    return auctions_count(m, **criteria).select(
        total, F.lit(first).cast("long").alias("page"), F.lit(limit).cast("long").alias("per_page"), F.ceil(total / limit).cast("long").alias("pages")
    )


def auction(m: Market, auction_id: int) -> DataFrame:
    return as_double(auctions_listed(m).filter(F.col("id") == auction_id).select(*AUCTION_COLUMNS))


def auction_by_slug(m: Market, slug: str) -> DataFrame:
    return as_double(auctions_listed(m).filter(slugify(F.concat_ws("-", "title", "external_id")) == slug).select(*AUCTION_COLUMNS))


def auction_lots(m: Market, auction_id: int, limit: int = 100, offset: int = 0) -> DataFrame:
    """In natural order of the lot number: numbers first by value, then labels."""
    a = m.artists.select(F.col("id").alias("artist_id"), F.col("name").alias("artist_name"))
    c = m.categories.select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
    own = m.lots.filter(F.col("auction_id") == auction_id).join(a, "artist_id", "left").join(c, "category_id", "left")
    ordered = own.withColumn("sort_number", natural_number(F.col("lot_number"))).orderBy("sort_number", "lot_number", "id")
    return as_double(
        page(ordered, limit, offset).select(
            "id", "lot_number", "sort_number", "title", "estimated_price_min", "estimated_price_max", "final_price", "sold", "medium",
            "artist_name", "category_name",
        )
    )


def upcoming_auctions(m: Market, days_ahead: int = 30, limit: int = 50, house_id: int | None = None, now: str = NOW) -> DataFrame:
    """Soonest first; fields that the listing does not load are constants."""
    found = where(
        auctions_listed(m), F.col("status") == "upcoming", F.col("start_date") <= M.after(now, f"{days_ahead} DAYS"),
        F.col("start_date") >= M.at(now), equal("house_id", house_id),
    )
    return found.orderBy(F.col("start_date").asc_nulls_last(), "id").limit(limit).select(
        "id", "house_id", "title", "start_date", "end_date", "auction_type", F.lit(0).cast("long").alias("total_lots"),
        "house_name", "house_country", F.lit("upcoming").alias("status"), F.lit("USD").alias("currency"),
    )


def recent_auctions(m: Market, limit: int = 20, offset: int = 0) -> DataFrame:
    done = auctions_listed(m).filter(F.col("status") == "completed")
    return as_double(page(done.orderBy(F.col("end_date").desc_nulls_last(), "id"), limit, offset).select(*AUCTION_COLUMNS))


def artists(m: Market, nationality: str | None = None, verified: bool | None = None, limit: int = 50, offset: int = 0) -> DataFrame:
    found = where(m.artists, like("nationality", nationality), flag("verified", verified))
    return page(found.orderBy(F.col("name").asc_nulls_last(), "id"), limit, offset)


def artist(m: Market, artist_id: int) -> DataFrame:
    return m.artists.filter(F.col("id") == artist_id)


def artist_by_name(m: Market, name: str) -> DataFrame:
    return m.artists.filter(F.lower("name") == F.lower(F.lit(name)))


def artist_lots(m: Market, artist_id: int, limit: int = 50, offset: int = 0) -> DataFrame:
    au = auctions_listed(m).select(F.col("id").alias("auction_id"), F.col("title").alias("auction_title"), F.col("start_date").alias("auction_date"), "house_name")
    own = m.lots.filter(F.col("artist_id") == artist_id).join(au, "auction_id")
    ordered = own.orderBy(F.col("auction_date").desc_nulls_last(), F.col("final_price").desc_nulls_last(), "id")
    return as_double(
        page(ordered, limit, offset).select(
            "id", "lot_number", "title", "estimated_price_min", "estimated_price_max", "final_price", "sold", "medium",
            "auction_title", "auction_date", "house_name",
        )
    )


def houses(m: Market, country: str | None = None, status: str | None = None, limit: int = 50, offset: int = 0) -> DataFrame:
    return page(_houses(m, like("country", country), equal("status", status)).orderBy(F.col("name").asc_nulls_last(), "id"), limit, offset)


def house(m: Market, house_id: int) -> DataFrame:
    return _houses(m, F.col("id") == house_id)


def _houses(m: Market, *criteria) -> DataFrame:
    """Houses with counts; lots are counted by auction first, so they shuffle once and small."""
    own = where(m.houses, *criteria)
    per_auction = m.plain_lots.groupBy("auction_id").agg(F.countDistinct("id").alias("lots"))
    per_house = (
        m.auctions.select(F.col("id").alias("auction_id"), "house_id", "start_date")
        .join(per_auction, "auction_id", "left")
        .groupBy("house_id")
        .agg(F.countDistinct("auction_id").alias("total_auctions"), F.sum("lots").alias("total_lots"), F.max("start_date").alias("last_auction_date"))
    )
    return own.join(per_house, own["id"] == per_house["house_id"], "left").select(
        "id", "name", "country", "status", F.coalesce("total_auctions", F.lit(0)).alias("total_auctions"),
        F.coalesce("total_lots", F.lit(0)).alias("total_lots"), "last_auction_date",
    )


def house_auctions(m: Market, house_id: int, limit: int = 20, offset: int = 0) -> DataFrame:
    own = m.auctions.filter(F.col("house_id") == house_id)
    return as_double(
        page(own.orderBy(F.col("start_date").desc_nulls_last(), "id"), limit, offset).select(
            "id", "title", "start_date", "end_date", "status", "auction_type", "total_realized"
        )
    )


def category_parents(m: Market) -> DataFrame:
    """Each category with its parent's name (a self-join of the hierarchy)."""
    parent = m.categories.select(F.col("id").alias("parent_category_id"), F.col("name").alias("parent_name"))
    return m.categories.join(parent, "parent_category_id", "left").select("id", "name", "parent_category_id", "parent_name")


def auctions_with_lots(m: Market) -> DataFrame:
    """Existence check as a semi-join, counted by status."""
    return m.auctions.join(m.plain_lots, m.auctions["id"] == m.plain_lots["auction_id"], "left_semi").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def active_and_historical(m: Market) -> DataFrame:
    """Bag union of two lists; duplicates stay."""
    cols = ["id", "title", "status"]
    return m.auctions.filter("status = 'active'").select(cols).unionByName(m.auctions.filter("status <> 'upcoming'").select(cols))
