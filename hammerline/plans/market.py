"""The logical tables (houses, auctions, lots, artists, categories, change log).

``Market`` holds one DataFrame each; ``from_tables`` maps the stored star schema onto
them.  Money is decimal inside and double in results; times are UTC without a zone;
"now" is an explicit argument everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import read_table

NOW = "2001-08-01 00:00:00"

HOUSE = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("country", T.StringType(), False),
        T.StructField("status", T.StringType()),
        T.StructField("last_scrape", T.TimestampNTZType()),
    ]
)
AUCTION = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("house_id", T.LongType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("start_date", T.TimestampNTZType()),
        T.StructField("end_date", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("auction_type", T.StringType()),
        T.StructField("total_realized", T.DecimalType(15, 2)),
        T.StructField("external_id", T.StringType()),
    ]
)
LOT = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("auction_id", T.LongType(), False),
        T.StructField("lot_number", T.StringType(), False),
        T.StructField("artist_id", T.LongType()),
        T.StructField("medium", T.StringType()),
        T.StructField("sold", T.BooleanType()),
        T.StructField("final_price", T.DecimalType(12, 2)),
        T.StructField("estimated_price_min", T.DecimalType(12, 2)),
        T.StructField("estimated_price_max", T.DecimalType(12, 2)),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("part_id", T.LongType()),
    ]
)
TITLE = T.StructType(
    [
        T.StructField("part_id", T.LongType(), False),
        T.StructField("title", T.StringType()),
        T.StructField("category_id", T.LongType()),
    ]
)
ARTIST = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("nationality", T.StringType()),
        T.StructField("verified", T.BooleanType()),
    ]
)
CATEGORY = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("parent_category_id", T.LongType()),
    ]
)


def cents(x: Column) -> Column:
    """An amount stored as double, to the nearest cent, as a whole number."""
    return F.floor(x * 100 + 0.5)


def money(whole_cents: Column) -> Column:
    """Exact money from cents; whole numbers and short decimals stay in generated code."""
    return (whole_cents.cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast("decimal(12,2)")


def part_of(whole_cents: Column, hundredths: Column) -> Column:
    """So many hundredths of an amount, rounded half up to a cent."""
    return F.floor((whole_cents * hundredths + 50) / 100)


@dataclass
class Market:
    """``plain_lots`` has a part_id; ``titles`` gives its title and category.  Plans without
    those don't join, and listings join them to the rows of one page only."""

    houses: DataFrame
    auctions: DataFrame
    plain_lots: DataFrame
    titles: DataFrame
    artists: DataFrame
    categories: DataFrame
    changes: DataFrame | None = None

    @cached_property
    def lots(self) -> DataFrame:
        return self.plain_lots.join(self.titles, "part_id", "left")

    @cached_property
    def spark(self) -> SparkSession:
        return self.houses.sparkSession


def from_tables(spark: SparkSession, folder: str) -> Market:
    nation, region = read_table(spark, folder, "nation"), read_table(spark, folder, "region")
    houses = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").cast("long").alias("id"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("country"),
        F.lit("active").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("last_scrape"),
    )
    orders, customer = read_table(spark, folder, "orders"), read_table(spark, folder, "customer")
    first = F.substring("o_orderpriority", 1, 1)
    auctions = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("long").alias("house_id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderdate").alias("start_date"),
        (F.col("o_orderdate") + F.expr("INTERVAL 6 HOURS")).alias("end_date"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "upcoming").otherwise("active").alias("status"),
        F.when(first == "1", "live").when(first == "2", "online").otherwise("hybrid").alias("auction_type"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("total_realized"),
        F.col("o_orderkey").cast("string").alias("external_id"),
    )
    item = read_table(spark, folder, "lineitem")
    sold = F.col("l_returnflag") != "N"
    price = cents(F.col("l_extendedprice"))
    net = part_of(price, F.lit(100) - cents(F.col("l_discount")))
    shape = [
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("id"),
        F.col("l_orderkey").alias("auction_id"),
        F.concat(F.col("l_linenumber").cast("string"), F.when(F.col("l_returnflag") == "A", "A").otherwise("")).alias("lot_number"),
        F.when(F.col("l_linenumber") != 7, F.col("l_suppkey")).alias("artist_id"),
        F.col("l_linestatus").alias("medium"),
        sold.alias("sold"),
        F.when(sold, money(net)).alias("final_price"),
        money(part_of(price, F.lit(80))).alias("estimated_price_min"),
        money(part_of(price, F.lit(120))).alias("estimated_price_max"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_partkey").alias("part_id"),
    ]
    part = read_table(spark, folder, "part")
    brand = F.regexp_extract("p_brand", r"([0-9]+)$", 1).cast("long")
    titles = part.select(F.col("p_partkey").alias("part_id"), F.col("p_name").alias("title"), brand.alias("category_id"))
    categories = (
        part.select(brand.alias("id"), F.col("p_brand").alias("name"))
        .distinct()
        .withColumn("parent_category_id", F.expr("(id - 1) div 5"))
    )
    supplier = read_table(spark, folder, "supplier")
    artists = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("nationality"),
        (F.col("s_acctbal") > 0).alias("verified"),
    )
    events = read_table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("house_id"),
        F.col("ts").alias("at"),
        F.col("event_type").alias("kind"),
        F.col("value"),
        F.get_json_object("props", "$.k").alias("key"),
    )
    return Market(houses, auctions, item.select(*shape), titles, artists, categories, events)


def enrich(m: Market, lots: DataFrame) -> DataFrame:
    """Left joins to everything a listing shows of ``lots``, which all stay."""
    if "title" not in lots.columns:
        lots = lots.join(m.titles, "part_id", "left")
    a = m.artists.select(F.col("id").alias("artist_id"), F.col("name").alias("artist_name"))
    c = m.categories.select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
    au = m.auctions.select(F.col("id").alias("auction_id"), "house_id", F.col("title").alias("auction_title"), "start_date")
    h = m.houses.select(F.col("id").alias("house_id"), F.col("name").alias("house_name"))
    return lots.join(a, "artist_id", "left").join(c, "category_id", "left").join(au, "auction_id", "left").join(h, "house_id", "left")


def lots_enriched(m: Market) -> DataFrame:
    """The denormalised view of all lots."""
    return enrich(m, m.plain_lots)


def auctions_listed(m: Market) -> DataFrame:
    h = m.houses.select(F.col("id").alias("house_id"), F.col("name").alias("house_name"), F.col("country").alias("house_country"))
    return m.auctions.join(h, "house_id")
