"""The reduced model (auctions, lots with artist name) and plain counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.market import Market


def auctions(m: Market) -> DataFrame:
    h = m.houses.select(F.col("id").alias("house_id"), F.col("name").alias("house_name"))
    return m.auctions.join(h, "house_id").select("id", "house_id", "title", "start_date", "status", "house_name")


def lots(m: Market) -> DataFrame:
    a = m.artists.select(F.col("id").alias("artist_id"), F.col("name").alias("artist_name"))
    return m.lots.join(a, "artist_id", "left").select(
        "id", "auction_id", "lot_number", "title", "artist_name", F.col("estimated_price_max").cast("double").alias("estimated_price")
    )


def search(m: Market, query: str) -> DataFrame:
    """Containment in title or artist name, without regard to case."""
    q = F.lower(F.lit(query))
    return lots(m).filter(F.contains(F.lower("title"), q) | F.contains(F.lower("artist_name"), q))


def summary(m: Market) -> DataFrame:
    """Row counts and the sum of estimates, one row."""
    none = {"total_houses": "long", "total_auctions": "long", "total_lots": "long", "total_estimated_value": "double"}

    def row(df: DataFrame, **found) -> DataFrame:
        return df.agg(*[found.get(k, F.first(F.lit(None))).cast(t).alias(k) for k, t in none.items()])

    n = F.count(F.lit(1))
    value = F.coalesce(F.sum("estimated_price_max"), F.lit(0).cast("decimal(22,2)"))
    parts = (
        row(m.houses, total_houses=n)
        .unionByName(row(m.auctions, total_auctions=n))
        .unionByName(row(m.plain_lots, total_lots=n, total_estimated_value=value))
    )
    return parts.agg(*[F.max(k).alias(k) for k in none])


def table_counts(m: Market) -> DataFrame:
    named = {"houses": m.houses, "auctions": m.auctions, "lots": m.plain_lots, "artists": m.artists, "categories": m.categories}
    rows = None
    for name, df in named.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        rows = one if rows is None else rows.unionByName(one)
    return rows


def status_breakdown(m: Market) -> DataFrame:
    return m.auctions.groupBy("status").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "status")


def total_sales(m: Market) -> DataFrame:
    return m.plain_lots.filter("sold").agg(F.sum("final_price").cast("double").alias("total_value"), F.count(F.lit(1)).alias("lots_sold"))
