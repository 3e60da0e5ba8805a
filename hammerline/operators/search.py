"""Full-text search: any-of match, frequency rank, filters, top-k."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import at_least, at_most, like, page, where
from ..functions.text import STOP_WORDS, query_terms, stem, term_rank, tokens
from ..plans.market import Market, enrich
from .listings import as_double
from .text_index import TextIndex


def _terms(query: str, english: bool) -> list[str]:
    terms = query_terms(query)
    return list(dict.fromkeys(stem(t) for t in terms if t not in STOP_WORDS)) if english else terms


def word_forms(texts: DataFrame, terms: list[str]) -> dict[str, str]:
    """The different words of the column text whose stem is one of the terms, with that stem; stop words are none.
    Python sees each word of the corpus once, in rows of one word, and no text.  An English stem has a few forms, as many
    as its endings, so what reaches the driver doesn't grow with the corpus."""

    @F.pandas_udf("string")
    def stems(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield series.map(lambda w: None if w in STOP_WORDS else stem(w))

    words = texts.select(F.explode(tokens(F.col("text"))).alias("word")).distinct()
    found = words.select("word", stems("word").alias("stem")).filter(F.col("stem").isin(terms))
    return {r["word"]: r["stem"] for r in found.collect()}


def match(df: DataFrame, text: Column, query: str, english: bool = False) -> DataFrame:
    """Rows whose text holds any of the query's terms, with the column rank; no term matches nothing.
    ``english`` leaves stop words out and compares stems: each word counts as the term whose stem it has."""
    terms = _terms(query, english)
    forms = word_forms(df.select(text.alias("text")), terms) if english and terms else {t: t for t in terms}
    if not forms:
        return df.withColumn("rank", F.lit(0.0)).filter(F.lit(False))
    kept = df.withColumn("_words", tokens(text)).filter(F.arrays_overlap("_words", F.array(*[F.lit(w) for w in sorted(forms)])))
    words = F.col("_words")
    if english:
        term = F.create_map(*[F.lit(x) for pair in sorted(forms.items()) for x in pair])
        words = F.transform(F.filter(words, lambda w: w.isin(sorted(forms))), lambda w: F.element_at(term, w))
    return kept.withColumn("rank", term_rank(words, terms)).drop("_words")


def _lots_of(m: Market, titles: DataFrame, artist: str | None, category: str | None, house: str | None, price_min, price_max) -> DataFrame:
    """The lots of ranked titles that pass the filters, with everything a listing shows."""
    lots = where(m.plain_lots, at_least("final_price", price_min), at_most("final_price", price_max))
    return where(
        enrich(m, lots.join(titles, "part_id")), like("artist_name", artist), like("category_name", category), like("house_name", house)
    )


SHOWN = ["id", "title", "final_price", "artist_name", "category_name", "house_name", "rank"]


def search_lots(
    m: Market, query: str, limit: int = 50, offset: int = 0, artist: str | None = None, category: str | None = None,
    house: str | None = None, price_min=None, price_max=None, english: bool = False,
) -> DataFrame:
    """Titles are matched before they meet lots, so each is cut into words once and only hits are joined.
    ``english`` leaves stop words out and compares stems."""
    titles = match(m.titles, F.coalesce("title", F.lit("")), query, english)
    found = _lots_of(m, titles, artist, category, house, price_min, price_max)
    ordered = found.orderBy(F.desc("rank"), F.col("final_price").desc_nulls_last(), "id")
    return as_double(page(ordered, limit, offset).select(*SHOWN))


def title_documents(m: Market) -> DataFrame:
    """What an index of lot titles is built from: equal titles of many lots are one document."""
    return m.titles.select(F.col("part_id").alias("doc_id"), F.col("title").alias("text"))


def search_lots_stored(
    m: Market, index: TextIndex, query: str, limit: int = 50, offset: int = 0, artist: str | None = None, category: str | None = None,
    house: str | None = None, price_min=None, price_max=None,
) -> DataFrame:
    """``search_lots`` on a stored index of ``title_documents``: no title is read but those of candidates."""

    def accept(found: DataFrame) -> DataFrame:
        titles = m.titles.join(found.withColumnRenamed("doc_id", "part_id"), "part_id")
        return _lots_of(m, titles, artist, category, house, price_min, price_max)

    found = index.search(query, limit, offset, accept, [F.col("final_price").desc_nulls_last(), F.col("id")])
    return as_double(found.page.select(*SHOWN))


def search_artists(m: Market, query: str, limit: int = 20, offset: int = 0, english: bool = False) -> DataFrame:
    text = F.concat(F.col("name"), F.lit(" "), F.coalesce("nationality", F.lit("")))
    found = match(m.artists, text, query, english)
    return page(found.orderBy(F.desc("rank"), "name", "id"), limit, offset)


def search_texts(docs: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """The same search over any (doc_id, text)."""
    found = match(docs.select("doc_id", "text"), F.coalesce("text", F.lit("")), query)
    return found.select("doc_id", "rank").orderBy(F.desc("rank"), "doc_id").limit(limit)


def search_texts_stemmed(docs: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """English form: stop words left out, words reduced to stems on both sides."""
    found = match(docs.select("doc_id", "text"), F.coalesce("text", F.lit("")), query, english=True)
    return found.select("doc_id", "rank").orderBy(F.desc("rank"), "doc_id").limit(limit)


def inverted_index(docs: DataFrame) -> DataFrame:
    """(token, doc_id, tf): a table to persist where one corpus is searched often."""
    each = docs.select("doc_id", F.explode(tokens(F.coalesce("text", F.lit("")))).alias("token"))
    return each.groupBy("token", "doc_id").agg(F.count(F.lit(1)).alias("tf"))


def search_index(index: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """Search over an inverted index: only postings of the terms are read."""
    from ..functions.text import WEIGHT, ZETA_2

    terms = query_terms(query)
    part = F.aggregate(F.sequence(F.lit(1), F.col("tf").cast("int")), F.lit(0.0), lambda acc, i: acc + 1.0 / (i.cast("double") * i.cast("double")))
    hits = index.filter(F.col("token").isin(terms)).groupBy("doc_id").agg(F.sum(part).alias("s"))
    rank = F.round(F.col("s") * WEIGHT / ZETA_2 / max(1, len(terms)), 6)
    return hits.select("doc_id", rank.alias("rank")).orderBy(F.desc("rank"), "doc_id").limit(limit)


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def store_index(docs: DataFrame, path: str, buckets: int = 64) -> None:
    """Writes the inverted index once, in folders by token hash."""
    index = inverted_index(docs).withColumn("bucket", _bucket(F.col("token"), buckets))
    index.repartition("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(16))).write.mode("overwrite").partitionBy("bucket").parquet(path)


def search_stored(index: DataFrame, query: str, limit: int = 20, buckets: int = 64) -> DataFrame:
    """Search over a stored index: only the folders that the query's terms hash to are read."""
    terms = query_terms(query)
    if not terms:
        return search_index(index.filter(F.lit(False)), query, limit)
    wanted = index.sparkSession.range(1).select(*[_bucket(F.lit(t), buckets) for t in terms]).first()
    return search_index(index.filter(F.col("bucket").isin(sorted(set(wanted)))), query, limit)
