"""The named queries of the market model, with their default arguments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import measures as M
from .functions import parsers as P
from .functions import text as T
from .operators import analytics as A
from .operators import basic as B
from .operators import changes as C
from .operators import listings as L
from .operators import quality as Q
from .operators import reports as R
from .operators import search as S
from .operators.file_table import FileTable
from .operators.ordered import IdCounter, OrderedPages, with_block_ids
from .operators.rollup_state import DistinctRollup, RollupState
from .operators.similar import similar_lots_all
from .operators.text_index import TextIndex
from .plans import oracle
from .plans.market import NOW, Market, from_tables
from .sources import html as H
from .sources import seeds
from .sources.tables import read_table, to_json_rows
from .sources.versions import new_folder
from .streaming import ingest as I
from .streaming.ledger import Ledger, ProgressTable
from .streaming.status import status_history

Query = Callable[[SparkSession, str], DataFrame]
ARTIST, AUCTION, HOUSE = 5, 7, 3


def first_lot(m: Market) -> str:
    """The id of one lot that exists in every data set."""
    return m.plain_lots.filter(F.col("auction_id") == AUCTION).agg(F.min("id")).first()[0]


def _changed(df: DataFrame, *columns: str) -> DataFrame:
    return L.as_double(df.select(*columns))


def _insert_auctions(m: Market) -> DataFrame:
    new = seeds.rows(m.spark, "external_id string, title string", [("x1", "First"), ("x2", "Second"), ("x3", "Third")])
    return C.insert(m.auctions, new, ["external_id"], {"status": F.lit("upcoming"), "currency": F.lit("USD")})


def _upsert_houses(m: Market) -> DataFrame:
    new = m.houses.filter("id < 5").select("name", "country", F.lit("maintenance").alias("status"))
    new = new.unionByName(seeds.rows(m.spark, "name string, country string, status string", [("HOUSE_NEW", "ASIA", "active")]))
    return C.upsert(m.houses, new, ["name", "country"], ["status"], [F.col("status")])


def _new_auctions(m: Market) -> DataFrame:
    new = m.changes.select((F.col("id") % 25).alias("house_id"), F.col("id").cast("string").alias("external_id"))
    return C.absent(m.auctions, new, ["house_id", "external_id"], [F.col("external_id")])


def _new_lots(m: Market) -> DataFrame:
    new = m.changes.select((F.col("id") % 2000).alias("auction_id"), (F.col("house_id") % 9).cast("string").alias("lot_number"))
    return C.absent(m.plain_lots, new, ["auction_id", "lot_number"], [F.col("lot_number")])


def _find_or_create(m: Market) -> DataFrame:
    names = m.changes.select(F.concat(F.lit("supplier#"), F.lpad(F.col("house_id").cast("string"), 9, "0")).alias("name"))
    found = C.find_or_create(m.artists, names).select("created", "id").unionByName(m.artists.select(F.lit(None).cast("boolean").alias("created"), "id"))
    return found.agg(
        F.count("created").alias("names"),
        F.count_if(~F.col("created")).alias("found"),
        F.count_if("created").alias("created"),
        F.max("id").alias("last_id"),
    )


def _cascade(m: Market) -> DataFrame:
    auctions, lots = C.delete_cascade(m.auctions, m.plain_lots, F.col("status") == "active", "auction_id")
    a = auctions.agg(F.count(F.lit(1)).alias("auctions_left"), F.lit(None).cast("long").alias("lots_left"))
    b = lots.agg(F.lit(None).cast("long").alias("auctions_left"), F.count(F.lit(1)).alias("lots_left"))
    return a.unionByName(b).agg(F.max("auctions_left").alias("auctions_left"), F.max("lots_left").alias("lots_left"))


def _violations(m: Market) -> DataFrame:
    rules = {
        "status": F.col("status").isin("upcoming", "completed", "cancelled"),
        "dates": F.col("end_date") <= M.at("2001-01-01 00:00:00"),
    }
    rows = Q.checked(m.auctions, rules).select(F.explode("violations").alias("rule"))
    return rows.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def _slug(m: Market) -> DataFrame:
    title = m.auctions.filter(F.col("id") == AUCTION).first()["title"]
    return L.auction_by_slug(m, f"{title.lower().replace(' ', '-')}-{AUCTION}")


def _events(s: SparkSession, d: str) -> DataFrame:
    return read_table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _windows(s: SparkSession, d: str) -> DataFrame:
    exact = _events(s, d).withColumn("value", F.col("value").cast("decimal(18,6)"))
    return I.tumbling(exact).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.col("value").cast("double").alias("value")
    )


def _sessions(s: SparkSession, d: str) -> DataFrame:
    ntz = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")]
    return I.sessions(_events(s, d)).select("user_id", *ntz, "n")


def _html_lots(s: SparkSession, d: str) -> DataFrame:
    lots = H.lots(read_table(s, d, "pages"))
    found = lots.withColumn("price", P.parse_price_info(F.col("price_text"))).withColumn("details", P.lot_details(F.col("text")))
    return found.select(
        "page_id", "lot_number", "title", "description", P.extract_artist(F.concat_ws(" ", "title", "description")).alias("artist_name"),
        "price.min_price", "price.max_price", "price.sold", "price.final_price", "details.dimensions", "details.medium", "details.category",
        F.lit("COP").alias("currency"), "images", "external_id",
    )


def _parsed_pages(s: SparkSession, d: str) -> DataFrame:
    return H.details(read_table(s, d, "pages")).drop("url")


def _runs(m: Market) -> DataFrame:
    """Each change event as a run of its kind; every seventh one hasn't ended."""
    ended = F.when(F.col("id") % 7 != 0, F.col("at") + F.expr("INTERVAL 1 MINUTE"))
    error = F.when(F.col("kind") == "error", F.concat(F.lit("event "), F.col("id").cast("string")))
    return m.changes.select(
        "house_id", F.col("kind").alias("task_type"), F.col("at").cast("timestamp_ntz").alias("started_at"), ended.cast("timestamp_ntz").alias("ended_at"),
        (F.col("id") % 10).alias("items_processed"), (F.col("id") % 3).alias("items_created"), error.alias("error_message"),
    )


def _strategies(m: Market) -> DataFrame:
    """Every other house is configured for static pages, every third for a kind without a parser."""
    text = F.when(F.col("id") % 2 == 0, '{"strategy":"html_static"}').when(F.col("id") % 3 == 0, '{"strategy":"browser"}')
    houses = seeds.with_config(m.houses.withColumn("scraping_config", text))
    configured = seeds.config_value("scraping_config", "$.strategy", "")
    return houses.select("id", "name", configured.alias("configured"), H.strategy(F.col("name"), configured, {"NATION_1": "html_static"}).alias("strategy"))


def _trend_text(m: Market) -> DataFrame:
    """The parallel arrays as comma-joined text, values to four places."""
    values = F.transform("values", lambda v: v.cast("decimal(18,4)").cast("string"))
    return A.price_trend_arrays(m).select("period", F.array_join("dates", ",").alias("dates"), F.array_join(values, ",").alias("values"))


def _shop_text(m: Market) -> DataFrame:
    """Auctions with texts as pages print them, to be parsed back."""
    amount = F.col("total_realized").cast("string")
    day = F.date_format("start_date", "d")
    month = F.element_at(F.array(*[F.lit(x) for x in P.MONTHS]), F.month("start_date"))
    return m.auctions.select(
        "id",
        F.concat(F.lit("$"), amount).alias("price"),
        F.concat(F.lit("$"), amount, F.lit(" - $"), F.col("id").cast("string"), F.when(F.col("status") == "completed", " VENDIDO").otherwise("")).alias("range"),
        F.when(F.col("id") % 2 == 0, F.date_format("start_date", "dd/MM/yyyy")).otherwise(F.date_format("start_date", "yyyy-MM-dd HH:mm")).alias("date"),
        F.concat(day, F.lit(" de "), month, F.lit(" de "), F.date_format("start_date", "yyyy"), F.lit(" 19:30, hasta "),
                 F.date_format("start_date", "dd/MM/yyyy"), F.lit(" 21:00")).alias("dates"),
    )


def _part_text(s: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    kind = F.when(F.col("p_partkey") % 3 == 0, "Óleo sobre tela, pintura").when(F.col("p_partkey") % 3 == 1, "Tinta, grabado").otherwise("Madera")
    return read_table(s, d, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("Cuadro de "), F.initcap("p_name"), F.lit(" (1886)")).alias("artist"),
        F.concat(kind, F.lit(", "), size, F.lit(" x "), size, F.lit(" cm")).alias("details"),
        F.concat(F.lit('<img src="/'), size, F.lit('.jpg"><p><img class="x" data-src="//cdn/'), size, F.lit('.png"></p>')).alias("html"),
    )


def _indexed(docs: DataFrame) -> TextIndex:
    """A stored index that came to be in five additions, with a merge as soon as four are of similar size."""
    index = TextIndex(docs.sparkSession, new_folder(docs.sparkSession, "index"))
    slices = 5
    for i in range(slices):
        index.add(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(slices)) == i))
    return index


def _lot_files(m: Market) -> FileTable:
    """The lots as a table of files, ordered by auction."""
    return FileTable.create(m.plain_lots.drop("part_id"), new_folder(m.spark, "lots"), ["auction_id", "id"])


def _lot_update_files(m: Market) -> DataFrame:
    table = _lot_files(m)
    table.update(F.col("auction_id") == AUCTION, {"sold": True, "final_price": 1234.5})
    return _changed(table.read(), "id", "auction_id", "sold", "final_price")


def _lot_delete_files(m: Market) -> DataFrame:
    table = _lot_files(m)
    table.delete(F.col("auction_id").between(AUCTION, AUCTION + 5) & ~F.col("sold"))
    return _changed(table.read(), "id", "auction_id", "sold", "final_price")


def _lot_upsert_files(m: Market) -> DataFrame:
    """Lots of two auctions, one of them new, under the id as key."""
    table = _lot_files(m)
    own = m.plain_lots.filter(F.col("auction_id") == AUCTION)
    new = own.unionByName(own.withColumns({"id": F.concat(F.lit("new-"), "id"), "auction_id": F.lit(-AUCTION).cast("long")}))
    table.upsert(new.select("id", "auction_id", "lot_number", F.lit("revised").alias("medium")), ["id"], ["auction_id", "lot_number", "medium"], [F.col("lot_number")])
    return _changed(table.read(), "id", "auction_id", "lot_number", "medium", "final_price")


def _rollup_deltas(m: Market) -> DataFrame:
    """Lots up to 1997, then three batches: those of two years, the later ones, and all unsold ones of one medium out again."""
    lots = m.plain_lots.drop("part_id", "id")
    year = F.year("created_at")
    unsold = (F.col("medium") == "F") & ~F.col("sold")
    middle, late = year.isin(1998, 1999), year >= 2000
    state = RollupState.create(lots.filter(year < 1998), new_folder(m.spark, "rollup"))
    signed = lambda which, sign: lots.filter(which).withColumn("sign", F.lit(sign))
    state.apply(signed(middle, 1), lots.filter(year < 2000))
    state.apply(signed(late, 1), lots)
    state.apply(signed(unsold, -1).unionByName(signed(F.lit(False), 1)), lots.filter(~unsold))
    return state.rollup().filter("total_lots > 0")


def _distinct_rollup(m: Market) -> DataFrame:
    """Distinct artists and auctions by month and house, and by year over all houses, from one table of bitmaps."""
    held = m.plain_lots.join(m.auctions.select(F.col("id").alias("auction_id"), "house_id", F.to_date("start_date").alias("day")), "auction_id")
    values = ["artist_id", "auction_id"]
    stored = DistinctRollup.create(held.select("day", "house_id", *values), new_folder(m.spark, "bitmaps"), ["day", "house_id"], values)
    month = stored.counts([F.trunc("day", "month").alias("period"), F.col("house_id")], values)
    year = stored.counts([F.trunc("day", "year").alias("period")], values).withColumn("house_id", F.lit(None).cast("long"))
    both = month.withColumn("grain", F.lit("month")).unionByName(year.withColumn("grain", F.lit("year")))
    return both.select("grain", "period", "house_id", F.col("artist_id").alias("artists"), F.col("auction_id").alias("auctions"))


def _status_history(m: Market) -> DataFrame:
    """Auctions announced a month ahead, the ones that are active taken back, as published by a day in July."""
    at = F.col("start_date").cast("timestamp")
    schedules = m.auctions.select(
        F.col("id").alias("auction_id"), (at - F.expr("INTERVAL 30 DAYS")).alias("ts"), at.alias("start_date"),
        F.col("end_date").cast("timestamp").alias("end_date"), (F.col("status") == "active").alias("cancelled"),
    )
    found = status_history(schedules, F.lit("2001-07-02 00:00:00").cast("timestamp"))
    return found.select("auction_id", "status", F.col("at").cast("timestamp_ntz").alias("at"))


def _ingest_ledger(s: SparkSession, d: str) -> DataFrame:
    """The events as a stream into a ledgered sink, read in one run and then once more from the start; what the ledger,
    the table and the streams' progress say of it."""
    folder = new_folder(s, "ledger")
    progress = ProgressTable(f"{folder}/progress")
    sink = Ledger(folder, "events", "event_id long, user_id long, event_type string, value double", ["event_id"], valid=F.col("event_type") != "error")
    s.streams.addListener(progress)
    try:
        for run in ("first", "second"):  # without the first run's checkpoint the same batches come again; a pattern, as a stream reads folders
            query = sink.ingest(I.read_events(s, f"{d}/event[s].parquet").drop("ts", "props"), f"{folder}/checkpoint-{run}")
            query.awaitTermination()
            progress.wait(query)
    finally:
        s.streams.removeListener(progress)
    progress.flush(s)
    read = s.read.parquet(progress.path).agg(F.sum("rows_read").alias("rows_read"), F.count("error").alias("errors"))
    lines = sink.lines(s).agg(F.sum("items_processed").alias("processed"), F.sum("items_created").alias("created"), F.sum("items_failed").alias("failed"))
    stored = sink.rows(s).agg(F.count(F.lit(1)).alias("rows_stored"), F.countDistinct("event_id").alias("ids_stored"))
    waiting = sink.retries(s).agg(F.count(F.lit(1)).alias("to_retry"), F.max("attempt").alias("attempt"))
    made = [(df.first().asDict()) for df in (read, lines, stored, waiting)]  # one row each
    whole = {k: v for row in made for k, v in row.items()}
    return s.createDataFrame([tuple(whole.values())], ", ".join(f"{k} long" for k in whole))


def _deep_page(m: Market) -> DataFrame:
    """A page of the lots by time that is far from the first."""
    pages = OrderedPages(m.plain_lots.drop("part_id"), [F.col("created_at").desc_nulls_first(), F.col("id"), F.col("final_price")])
    return _changed(pages.page(50, 5000), "id", "auction_id", "created_at", "final_price")


def _dealt_ids(m: Market) -> DataFrame:
    """Ids for all sold lots and then for all others: what lies between the first and the last of each batch."""
    counter = IdCounter(m.spark, new_folder(m.spark, "counter"))
    made = None
    for sold in (True, False):
        batch = with_block_ids(m.plain_lots.filter(F.col("sold") == sold).select("auction_id", "sold"), counter)
        made = batch if made is None else made.unionByName(batch)
    return made.groupBy("sold").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def market_queries() -> dict[str, Callable[[Market], DataFrame]]:
    found: dict[str, Callable[[Market], DataFrame]] = {
        "summary_stats": A.summary,
        "price_trends_daily": lambda m: A.price_trends(m, "daily"),
        "price_trends_weekly": lambda m: A.price_trends(m, "weekly"),
        "price_trends_monthly": A.price_trends,
        "price_trends_filtered": lambda m: A.price_trends(m, category="brand#1", house_id=HOUSE),
        "price_trends_arrays": _trend_text,
        "volume_trends": A.volume_trends,
        "volume_trends_long": A.volume_series,
        "house_performance": A.house_performance,
        "market_insights": A.market_insights_rows,
        "price_prediction": A.price_prediction,
        "price_prediction_artist": lambda m: A.price_prediction(m, artist_id=ARTIST),
        "seasonal_monthly": A.seasonal_monthly,
        "seasonal_quarterly": A.seasonal_quarterly,
        "geographic_analysis": A.geographic,
        "lots_list": lambda m: L.lots(m, 50, 100),
        "lots_deep_page": _deep_page,
        "lot_ids_dealt": _dealt_ids,
        "lots_filtered": lambda m: L.lots(m, house_id=HOUSE, artist_id=ARTIST, sold=False, price_min=0),
        "lots_price_range": lambda m: L.lots(m, sold=True, price_max=30_000),
        "lot_by_id": lambda m: L.lot(m, first_lot(m)),
        "recent_lots": L.recent_lots,
        "high_value_lots": L.high_value_lots,
        "similar_lots": lambda m: L.similar_lots(m, first_lot(m)),
        "similar_lots_all": similar_lots_all,
        "auctions_list": lambda m: L.auctions(m, 50, 50),
        "auctions_filtered": lambda m: L.auctions(
            m, status="completed", auction_type="live", country="a", start_from="1998-01-01", start_to="1999-12-31"
        ),
        "auctions_live": lambda m: L.auctions(m, status="active"),
        "auctions_by_statuses": lambda m: L.auctions(m, status=["active", "upcoming"]),
        "auctions_count": lambda m: L.auctions_count(m, status="upcoming"),
        "auctions_page": lambda m: L.auctions_page(m, 50, 100, status="upcoming"),
        "auction_status_history": _status_history,
        "auction_by_id": lambda m: L.auction(m, AUCTION),
        "auction_by_slug": _slug,
        "auction_lots": lambda m: L.auction_lots(m, AUCTION),
        "upcoming_auctions": lambda m: L.upcoming_auctions(m, now="2001-07-02 00:00:00"),
        "recent_auctions": L.recent_auctions,
        "artists_list": lambda m: L.artists(m, nationality="1", verified=True),
        "artist_by_id": lambda m: L.artist(m, ARTIST),
        "artist_by_name": lambda m: L.artist_by_name(m, "SUPPLIER#000000005"),
        "artist_lots": lambda m: L.artist_lots(m, ARTIST),
        "artist_stats_basic": lambda m: R.artist_basic(m, ARTIST),
        "artist_stats_trends": lambda m: R.artist_trends(m, ARTIST),
        "artist_stats_top_sales": lambda m: R.artist_top_sales(m, ARTIST),
        "artist_stats_medium": lambda m: R.artist_by_medium(m, ARTIST),
        "artist_stats_house": lambda m: R.artist_by_house(m, ARTIST),
        "artist_market_presence": lambda m: R.artist_presence(m, ARTIST),
        "trending_artists": R.trending_artists,
        "auction_stats_basic": lambda m: R.auction_basic(m, AUCTION),
        "auction_stats_price_ranges": lambda m: R.auction_price_ranges(m, AUCTION),
        "house_price_ranges": R.house_price_ranges,
        "auction_stats_top_lots": lambda m: R.auction_top_lots(m, AUCTION),
        "auction_stats_categories": lambda m: R.auction_categories(m, AUCTION),
        "houses_list": lambda m: L.houses(m, country="a", status="active"),
        "house_by_id": lambda m: L.house(m, HOUSE),
        "house_auctions": lambda m: L.house_auctions(m, HOUSE),
        "house_stats_basic": lambda m: R.house_basic(m, HOUSE),
        "house_stats_recent": lambda m: R.house_recent(m, HOUSE),
        "house_stats_categories": lambda m: R.house_categories(m, HOUSE),
        "category_parent": L.category_parents,
        "orders_with_lots_semi": L.auctions_with_lots,
        "union_active_historical": L.active_and_historical,
        "lots_search": lambda m: S.search_lots(m, "small ring", category="brand#1", price_min=5000),
        "lots_search_stored": lambda m: S.search_lots_stored(m, _indexed(S.title_documents(m)), "small ring", category="brand#1", price_min=5000),
        "lots_search_stemmed": lambda m: S.search_lots(m, "the rings smalls", category="brand#1", price_min=5000, english=True),
        "artists_search_stemmed": lambda m: S.search_artists(m, "suppliers of nations 7", english=True),
        "artists_search": lambda m: S.search_artists(m, "supplier#000000007 nation_3"),
        "auction_rollup_refresh": C.auction_rollup,
        "auction_rollup_deltas": _rollup_deltas,
        "distinct_rollup": _distinct_rollup,
        "ingest_log_summary": lambda m: C.run_log(m.changes),
        "run_log_rows": lambda m: C.run_log_rows(_runs(m)),
        "house_strategies": _strategies,
        "houses_json": lambda m: to_json_rows(m.houses.select("id", "name", "country", "status", F.nullif("country", F.lit("ASIA")).alias("abroad"))),
        "artist_update_stamped": lambda m: _changed(
            C.update(m.artists, F.col("id") == ARTIST, {"verified": False}, stamp="updated_at"), "id", "name", "verified", "updated_at"
        ),
        "auction_insert": _insert_auctions,
        "artist_insert": lambda m: C.insert(
            m.artists,
            seeds.rows(m.spark, "name string, nationality string", [("Ana Rivera", "NATION_1"), ("Luis Vega", None)]),
            ["name"],
            {"verified": F.lit(False)},
        ),
        "house_insert": lambda m: C.insert(
            m.houses, seeds.rows(m.spark, "name string, country string", [("New House", "ASIA")]), ["name"], {"status": F.lit("active")}
        ),
        "lot_insert": lambda m: C.insert(
            m.plain_lots.agg(F.count(F.lit(1)).alias("id")),
            seeds.rows(m.spark, "lot_number string, title string", [("1", "Vase"), ("2", "Bowl")]),
            ["lot_number"],
            {"currency": F.lit("USD"), "sold": F.lit(False)},
        ),
        "auction_update": lambda m: _changed(
            C.update(m.auctions, F.col("id") == AUCTION, {"title": "Renamed", "auction_type": "online", "status": None}),
            "id", "house_id", "title", "status", "auction_type",
        ),
        "lot_update": lambda m: _changed(
            C.update(m.plain_lots, F.col("auction_id") == AUCTION, {"sold": True, "final_price": 1234.5}), "id", "auction_id", "sold", "final_price"
        ),
        "house_update": lambda m: _changed(C.update(m.houses, F.col("id") == HOUSE, {"name": "Renamed House"}), "id", "name", "country", "status"),
        "artist_verify": lambda m: C.update(m.artists, F.col("id") == ARTIST, {"verified": True}),
        "house_touch": lambda m: C.update(m.houses, F.col("id") == HOUSE, {"last_scrape": M.at(NOW)}).select("id", "name", "last_scrape"),
        "house_soft_delete": lambda m: C.update_state(
            m.houses, (F.col("id") == HOUSE) & (F.col("status") == "active"), {"status": "inactive"}
        ).select("id", "name", "status"),
        "lot_delete": lambda m: C.delete_state(m.plain_lots, F.col("id") == first_lot(m)).agg(F.count(F.lit(1)).alias("left_over")),
        "lot_update_files": _lot_update_files,
        "lot_delete_files": _lot_delete_files,
        "lot_upsert_files": _lot_upsert_files,
        "auction_delete_cascade": _cascade,
        "upsert_houses": _upsert_houses,
        "ingest_new_auctions": _new_auctions,
        "ingest_new_lots": _new_lots,
        "artist_find_or_create": _find_or_create,
        "dq_violations": _violations,
        "duplicate_lots": lambda m: Q.duplicate_keys(m.plain_lots, ["auction_id", "lot_number"]),
        "simple_auctions": B.auctions,
        "simple_lots": B.lots,
        "simple_search": lambda m: B.search(m, "RED"),
        "simple_summary": B.summary,
        "table_counts": B.table_counts,
        "status_breakdown": B.status_breakdown,
        "total_sales_value": B.total_sales,
        "event_keys": lambda m: m.changes.select("id", "key"),
        "top_artists_null_first": lambda m: A.top_artists(m, start="2001-07-29 00:00:00"),
    }
    found |= {
        "parse_price": lambda m: _shop_text(m).select("id", P.parse_price(F.col("price")).alias("price")),
        "parse_price_info": lambda m: _shop_text(m).withColumn("p", P.parse_price_info(F.col("range"))).select(
            "id", "p.min_price", "p.max_price", "p.sold", F.coalesce("p.final_price", F.lit(0.0)).alias("final_price")
        ),
        "parse_date": lambda m: _shop_text(m).select("id", P.parse_date(F.col("date")).alias("date")),
        "extract_dates": lambda m: _shop_text(m).withColumn("d", P.extract_dates(F.col("dates"))).select("id", "d.start", "d.end"),
    }
    for metric in ("total_sales", "avg_price", "lot_count"):
        found[f"top_artists_{metric}"] = lambda m, k=metric: A.top_artists(m, k)
        found[f"top_categories_{metric}"] = lambda m, k=metric: A.top_categories(m, k)
    return found


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {k: (lambda s, d, f=f: f(from_tables(s, d))) for k, f in market_queries().items()}
    docs = lambda s, d: read_table(s, d, "documents")
    pages = lambda s, d: read_table(s, d, "pages")
    return found | {
        "texts_search": lambda s, d: S.search_texts(docs(s, d), "the license"),
        "texts_search_indexed": lambda s, d: S.search_index(S.inverted_index(docs(s, d)), "the license"),
        "texts_search_stored": lambda s, d: _indexed(docs(s, d).select("doc_id", "text")).search("the license").page,
        "texts_search_stemmed": lambda s, d: S.search_texts_stemmed(docs(s, d), "licenses released"),
        "html_links": lambda s, d: H.links(pages(s, d)),
        "html_auctions": lambda s, d: H.auctions(pages(s, d)).select("page_id", "url", "title", "slug", "external_id", "status", "auction_type", "location"),
        "html_lots": _html_lots,
        "parsed_pages": _parsed_pages,
        "extract_external_id": lambda s, d: pages(s, d).select("page_id", P.external_id(F.col("url")).alias("external_id")),
        "classify_page_type": lambda s, d: pages(s, d).select("page_id", P.page_type(T.page_text(F.col("html"))).alias("auction_type")),
        "extract_artist": lambda s, d: _part_text(s, d).select("id", P.extract_artist(F.col("artist")).alias("artist")),
        "extract_lot_details": lambda s, d: _part_text(s, d).withColumn("x", P.lot_details(F.col("details"))).select("id", "x.*"),
        "extract_images": lambda s, d: _part_text(s, d).select("id", F.explode(H.images(F.col("html"), "https://h")).alias("image")),
        "ingest_ledger": _ingest_ledger,
        "event_windows": _windows,
        "event_sessions": _sessions,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.sql()


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return A.house_performance(from_tables(spark, folder))
