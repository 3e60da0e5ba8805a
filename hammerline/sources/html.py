"""Rows from web pages: links by regular expressions, lots by a streaming parser."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsers import external_id, extract_dates, page_type
from ..functions.text import absolute_url, last_segment, page_text

LINK = r"""(?is)<a\s([^>]*)>(.*?)</a>"""
IMAGE = r"(?is)<img\s[^>]*>"
PLACE = "Bogotá, Colombia"


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute in either kind of quotes, NULL for none or an empty one."""
    pattern = rf"""(?i)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    return F.nullif(F.concat(F.regexp_extract(tag, pattern, 1), F.regexp_extract(tag, pattern, 2)), F.lit(""))


def links(pages: DataFrame, base: str = "") -> DataFrame:
    """One row a link with a text: page_id, href, url, title (without inner markup), slug, external_id, and the
    status a listing gives it: active for titles of current auctions, completed for other links to auctions."""
    hits = pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(0))).alias("a"))
    inner = F.regexp_replace(F.regexp_extract("a", LINK, 2), "<[^>]*>", "")
    tag = F.concat(F.lit("<a "), F.regexp_extract("a", LINK, 1), F.lit(">"))
    parts = hits.select("page_id", _attribute(tag, "href").alias("href"), F.trim(inner).alias("title"), _attribute(tag, "class").alias("names"))
    status = F.when(F.coalesce(F.col("names"), F.lit("")).rlike(r"(^|\s)titulo-subasta(\s|$)"), "active").when(F.col("href").contains("subasta"), "completed")
    return parts.filter(F.col("href").isNotNull() & (F.char_length("title") > 0)).select(
        "page_id", "href", absolute_url(F.col("href"), base).alias("url"), "title",
        last_segment(F.col("href")).alias("slug"), external_id(F.col("href")).alias("external_id"), status.alias("status"),
    )


def images(html: Column, base: str = "") -> Column:
    """Absolute sources of all images of a page, in order; data-src stands in for a missing src."""
    sources = F.transform(F.regexp_extract_all(html, F.lit(IMAGE), F.lit(0)), lambda tag: F.coalesce(_attribute(tag, "src"), _attribute(tag, "data-src")))
    return F.transform(F.filter(sources, lambda s: s.isNotNull()), lambda s: absolute_url(s, base))


def description(html: Column) -> Column:
    """The text of the first div of the classes descripcion-subasta or, without any, description."""
    found = [F.regexp_extract(html, rf"""(?is)<div\s[^>]*class=["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["'][^>]*>(.*?)</div>""", 1) for name in ("descripcion-subasta", "description")]
    return F.coalesce(*[F.nullif(F.trim(page_text(x)), F.lit("")) for x in found])


def details(pages: DataFrame, base: str = "") -> DataFrame:
    """What a page says of its auction: page_id, url, auction_type, start_date, end_date, description, location, images."""
    text = page_text(F.col("html"))
    dates = extract_dates(text)
    return pages.select(
        "page_id", "url", page_type(text).alias("auction_type"), dates["start"].alias("start_date"), dates["end"].alias("end_date"),
        description(F.col("html")).alias("description"), F.when(text.rlike("Bogotá|Colombia|Lugar|Location"), PLACE).alias("location"),
        images(F.col("html"), base).alias("images"),
    )


def auctions(pages: DataFrame, base: str = "") -> DataFrame:
    """One row a link, with the details of the page it leads to; where no page has that url, the defaults hold.
    Of several pages with one url the one with the smallest page_id counts."""
    told = details(pages, base).filter(F.col("url").isNotNull())
    one = told.groupBy("url").agg(F.min_by(F.struct("auction_type", "start_date", "end_date", "description", "location"), "page_id").alias("d"))
    return links(pages, base).join(one, "url", "left").select(
        "page_id", "url", "title", "slug", "external_id", "status", F.coalesce("d.auction_type", F.lit("hybrid")).alias("auction_type"),
        "d.start_date", "d.end_date", "d.description", F.coalesce("d.location", F.lit(PLACE)).alias("location"),
    )


class _Lots(HTMLParser):
    """Collects candidate elements with their title, number, price and description."""

    TITLES, VOID = {"h1", "h2", "h3"}, {"br", "img", "meta", "link", "input", "hr"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str]] = []
        self.found: list[dict] = []
        self.open: list[tuple[int, dict]] = []

    @staticmethod
    def rank(tag: str, names: str) -> int | None:
        """Precedence of selectors: a page's lots are those of the first kind present."""
        words = names.split()
        if tag == "div" and "lote" in words:
            return 0
        if tag == "div" and "lot" in names:
            return 1
        if tag == "div" and "item" in names:
            return 2
        if tag == "article":
            return 3
        return 4 if "auction-lot" in words else None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        names = dict(attrs).get("class") or ""
        source = dict(attrs).get("src") or dict(attrs).get("data-src")
        if tag == "img" and source:
            for _, row in self.open:
                row["images"].append(source)
        if tag in self.VOID:
            return
        self.stack.append((tag, names))
        rank = self.rank(tag, names)
        if rank is not None:
            row = {"rank": rank, "number": "", "title": "", "description": "", "price": "", "text": "", "images": [], "done": set()}
            self.found.append(row)
            self.open.append((len(self.stack), row))
        for depth, row in self.open:
            if len(self.stack) > depth:
                for field, wanted in (
                    ("title", tag in self.TITLES or "title" in names),
                    ("number", "numero" in names or "number" in names),
                    ("price", "precio" in names or "price" in names),
                    ("description", tag == "p" or "descripcion" in names or "description" in names),
                ):
                    if wanted and field not in row["done"] and field + "_at" not in row:
                        row[field + "_at"] = len(self.stack)

    def handle_endtag(self, tag: str) -> None:
        while self.stack and any(t == tag for t, _ in self.stack):
            depth = len(self.stack)
            ended, _ = self.stack.pop()
            for _, row in self.open:
                for field in ("title", "number", "price", "description"):
                    if row.get(field + "_at") == depth:
                        del row[field + "_at"]
                        row["done"].add(field)
            self.open = [(d, r) for d, r in self.open if d < depth]
            if ended == tag:
                break

    def handle_data(self, data: str) -> None:
        for _, row in self.open:
            row["text"] += data
            for field in ("title", "number", "price", "description"):
                if field + "_at" in row:
                    row[field] += data


def page_lots(html: str | None) -> list[tuple]:
    """(lot_number, title, description, price_text, text, image sources) of a page, titled ones only."""
    parser = _Lots()
    parser.feed((html or "").replace("<![", "<!"))
    parser.close()
    for rank in range(5):
        own = [r for r in parser.found if r["rank"] == rank]
        rows = [
            (r["number"].strip() or "N/A", r["title"].strip(), r["description"].strip() or None, r["price"], r["text"], r["images"])
            for r in own
            if r["title"].strip()
        ]
        if rows or (own and rank):
            return rows
    return []


def lots(pages: DataFrame, base: str = "") -> DataFrame:
    """One row a lot of each page; its external_id is that of the page with the lot number, NULL without one."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page_id", "url", "lot_number", "title", "description", "price_text", "text", "images"]
        for batch in batches:
            out = [(i, url, *lot) for i, url, html in zip(batch["page_id"], batch["url"], batch["html"]) for lot in page_lots(html)]
            yield pd.DataFrame(out, columns=names).astype({"page_id": "int64"})

    schema = "page_id long, url string, lot_number string, title string, description string, price_text string, text string, images array<string>"
    found = pages.select("page_id", "url", "html").mapInPandas(rows, schema)
    own = F.concat(external_id(F.col("url")), F.lit("_"), F.col("lot_number"))
    return found.withColumn("images", F.transform("images", lambda s: absolute_url(s, base))).withColumn("external_id", own).drop("url")


PARSERS: dict[str, Callable[[DataFrame, str], DataFrame]] = {"html_static": lots}


def strategy(name: Column, configured: Column, named: dict[str, str]) -> Column:
    """The parser of a house: that of its name, else the configured one; NULL if there is none of that kind."""
    own = F.lit(None).cast("string")
    for house, kind in named.items():
        own = F.when(name == house, kind).otherwise(own)
    found = F.coalesce(own, configured)
    return F.when(found.isin(*PARSERS), found)


def lots_by_strategy(pages: DataFrame, base: str = "") -> DataFrame:
    """The lots of pages that carry the ``strategy`` of their house; pages without a parser give none."""
    parts = [parse(pages.filter(F.col("strategy") == kind), base) for kind, parse in PARSERS.items()]
    return reduce(DataFrame.unionByName, parts)
