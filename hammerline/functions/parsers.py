"""Fields of scraped text as native column expressions.

The quirks of the formats are kept: prices lose all but the last dot, a price text that
says "sold" anywhere counts as sold, later dates overwrite the end, an ISO date in running
text is never understood.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The Spanish names of the months, in order.
MONTHS = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()
#: Techniques and categories looked for, in order of precedence.
MEDIA = ["óleo", "acuarela", "gouache", "tinta", "lápiz", "carboncillo", "mixta", "collage"]
CATEGORIES = [("pintura", "Pintura"), ("grabado", "Grabado"), ("escultura", "Escultura"), ("fotografía", "Fotografía")]
#: Date formats tried in this order, and words that are no artist.
DATE_FORMATS = ["yyyy-M-d H:m", "yyyy-M-d", "d/M/yyyy H:m", "d/M/yyyy", "M/d/yyyy", "MMMM d, yyyy", "d MMMM yyyy"]
NO_ARTIST = ["obra", "pieza", "sin", "título"]
#: Patterns of artist names and of ids in urls, in order of precedence.
_NAME = r"[A-Z][a-záéíóúñü]+"
ARTIST_PATTERNS = [
    rf"por\s+({_NAME}(?:\s+{_NAME})*)",
    rf"de\s+({_NAME}(?:\s+{_NAME})*)",
    rf"({_NAME},\s+{_NAME})",
    r"([A-Z][A-Z\s]+)\s*\(",
]
ID_PATTERNS = [r"/subasta/(\d+)", r"/(\d+)", r"id=(\d+)", r"subasta-(\w+)"]


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, NULL without one."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def parse_price(text: Column) -> Column:
    bare = F.regexp_replace(text, r"[$€£,]", "")
    one_dot = F.regexp_replace(bare, r"\.(?=.*\.)", "")
    return F.when(F.char_length(text) > 0, F.trim(one_dot).try_cast("double"))


def parse_date(text: Column, extra: str | None = None) -> Column:
    tried = ([extra] if extra else []) + DATE_FORMATS
    return F.coalesce(*[F.try_to_timestamp(F.trim(text), F.lit(f)).cast("timestamp_ntz") for f in tried])


def external_id(url: Column) -> Column:
    return F.coalesce(*[first_match(url, p) for p in ID_PATTERNS])


def extract_dates(text: Column) -> Column:
    """struct<start, end>: dates with a time, Spanish ones first, then d/m/Y; the first is
    the start and the last of the others the end."""
    low = F.lower(text)
    spanish = r"(\d{1,2})\s+de\s+([\p{L}0-9_]+)\s+de\s+(\d{4})\s+(\d{1,2}):(\d{2})"
    slashed = r"(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{2})"
    months = F.create_map(*[x for i, name in enumerate(MONTHS, 1) for x in (F.lit(name), F.lit(str(i)))])

    def found(pattern: str) -> Column:
        return F.transform(
            F.regexp_extract_all(low, F.lit(pattern), F.lit(0)),
            lambda hit: F.try_to_timestamp(
                F.concat(
                    F.regexp_extract(hit, pattern, 3), F.lit("-"),
                    F.coalesce(F.try_element_at(months, F.regexp_extract(hit, pattern, 2)), F.regexp_extract(hit, pattern, 2)),
                    F.lit("-"), F.regexp_extract(hit, pattern, 1), F.lit(" "),
                    F.regexp_extract(hit, pattern, 4), F.lit(":"), F.regexp_extract(hit, pattern, 5),
                ),
                F.lit("yyyy-M-d H:m"),
            ).cast("timestamp_ntz"),
        )

    dates = F.filter(F.concat(found(spanish), found(slashed)), lambda d: d.isNotNull())
    return F.struct(
        F.try_element_at(dates, F.lit(1)).alias("start"),
        F.when(F.size(dates) > 1, F.element_at(dates, -1)).alias("end"),
    )


def extract_artist(text: Column) -> Column:
    def accepted(pattern: str) -> Column:
        name = F.trim(first_match(text, pattern))
        return F.when((F.char_length(name) > 3) & ~F.lower(name).isin(NO_ARTIST), name)

    return F.coalesce(*[accepted(p) for p in ARTIST_PATTERNS])


def parse_price_info(text: Column) -> Column:
    """struct<min_price, max_price, sold, final_price>."""
    bare = F.regexp_replace(text, r"[$.,]", "")
    span = r"(\d+)\s*[-–]\s*(\d+)"
    single = first_match(bare, r"(\d+)").try_cast("double")
    low = F.coalesce(first_match(bare, span, 1).try_cast("double"), single)
    high = F.coalesce(first_match(bare, span, 2).try_cast("double"), single)
    sold = F.lower(text).contains("vendido") | F.lower(text).contains("sold")
    return F.struct(low.alias("min_price"), high.alias("max_price"), sold.alias("sold"), F.when(sold, high).alias("final_price"))


def lot_details(text: Column) -> Column:
    """struct<dimensions, medium, category>."""
    low = F.lower(text)
    size = F.coalesce(  # fixed values: the forms in which sizes are written
        first_match(text, r"(?i)(\d+\s*x\s*\d+(?:\s*x\s*\d+)?)\s*cm"),
        first_match(text, r"(?i)(\d+\s*×\s*\d+(?:\s*×\s*\d+)?)\s*cm"),
        first_match(text, r"(?i)Dimensiones?:\s*([^,\n]+)"),
    )
    medium = F.coalesce(*[F.when(low.contains(k), F.lit(k.capitalize())) for k in MEDIA])
    category = F.coalesce(*[F.when(low.contains(k), F.lit(v)) for k, v in CATEGORIES])
    return F.struct(F.trim(size).alias("dimensions"), medium.alias("medium"), category.alias("category"))


def page_type(text: Column) -> Column:
    low = F.lower(text)
    return (
        F.when(low.contains("virtual") | low.contains("online"), "online")
        .when(low.contains("presencial") | low.contains("live"), "live")
        .otherwise("hybrid")
    )
