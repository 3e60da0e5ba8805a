"""A stored inverted index with upkeep: posting blocks, top-k search that skips blocks, segments.

A segment holds, for each term and range of document numbers, one block: the postings, how many they are and
the highest term frequency.  Ranges are the same for all terms, so the sum of a range's highest term parts
bounds the rank of every document in it.  A search reads these bounds first (two narrow columns of the
terms' own folders), then only the blocks of ranges whose bound reaches a cut, and lowers the cut until
enough documents pass the caller's filter: the page is exact, whatever the filter.

New documents come as a further segment; as soon as ``fanout`` segments are of similar size they are merged.
Removed documents are listed with the number of the change, hide what older segments say of them, and
vanish with the next merge.  Every change writes its files first and the manifest last."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WEIGHT, ZETA_2, query_terms, tokens
from ..sources.versions import Manifest

BLOCK = "term string, range long, top long, n long, postings array<struct<doc_id: long, tf: long>>, bucket int"
ENTRY = "kind string, name string, number long, n long"
#: Bounds are grouped to three places, so at most 1,645 levels a term reach the driver.
PLACES = 1000
#: Up to so many ranges are written into the plan instead of being joined.
MOST_LISTED = 1000
#: Bytes of a row group: small, as a search reads few blocks of a folder.
ROW_GROUP = 1 << 20


def part(tf: Column) -> Column:
    """What so many occurrences of a term add: the sum of 1/i^2, which grows with tf."""
    return F.aggregate(F.sequence(F.lit(1), tf.cast("int")), F.lit(0.0), lambda acc, i: acc + 1.0 / (i.cast("double") * i.cast("double")))


def posting_blocks(postings: DataFrame, span: int) -> DataFrame:
    """Blocks of (term, doc_id, tf); a block has at most ``span`` postings."""
    ranged = postings.withColumn("range", F.floor(F.col("doc_id") / span))
    return ranged.groupBy("term", "range").agg(
        F.max("tf").alias("top"), F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")
    )


@dataclass
class Found:
    """A page of a search and how much was read for it."""

    page: DataFrame
    rounds: int
    ranges_read: int
    ranges: int


class TextIndex:
    """The index in ``folder`` over documents with a whole number ``doc_id`` each."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 16, span: int = 4096, fanout: int = 4):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.buckets, self.span, self.fanout = buckets, span, fanout
        self.manifest = Manifest(spark, self.folder, ENTRY)

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def _write(self, postings: DataFrame, number: int) -> tuple:
        return self._write_blocks(posting_blocks(postings, self.span), number)

    def _write_blocks(self, blocks: DataFrame, number: int) -> tuple:
        """A segment in folders by term hash; a frequent term's blocks go to several tasks and files."""
        name = f"segment-{uuid.uuid4().hex[:12]}"
        blocks = blocks.withColumn("bucket", self._bucket(F.col("term")))
        spread = blocks.repartition("bucket", F.pmod("range", F.lit(16))).sortWithinPartitions("bucket", "term", "range")
        spread.write.option("parquet.block.size", ROW_GROUP).partitionBy("bucket").parquet(f"{self.folder}/{name}")
        n = self.spark.read.schema(BLOCK).parquet(f"{self.folder}/{name}").agg(F.sum("n")).first()[0] or 0
        return ("segment", name, number, n)

    def _blocks(self, entries: list) -> DataFrame:
        """The blocks of all segments, each with its segment's number."""
        found = None
        for e in entries:
            if e["kind"] == "segment" and e["n"]:
                own = self.spark.read.schema(BLOCK).parquet(f"{self.folder}/{e['name']}").withColumn("number", F.lit(e["number"]))
                found = own if found is None else found.unionByName(own)
        return found if found is not None else self.spark.createDataFrame([], BLOCK).withColumn("number", F.lit(0).cast("long"))

    def _live(self, postings: DataFrame, entries: list) -> DataFrame:
        """Postings (doc_id, number) that no later removal hides."""
        gone = [(f"{self.folder}/{e['name']}", e["number"]) for e in entries if e["kind"] == "removed"]
        if not gone:
            return postings
        hidden = None
        for path, number in gone:
            own = self.spark.read.schema("doc_id long").parquet(path).withColumn("until", F.lit(number))
            hidden = own if hidden is None else hidden.unionByName(own)
        hidden = hidden.groupBy(F.col("doc_id").alias("gone")).agg(F.max("until").alias("until"))
        return postings.join(hidden, (F.col("doc_id") == F.col("gone")) & (F.col("number") < F.col("until")), "left_anti")

    def add(self, docs: DataFrame) -> int:
        """Indexes (doc_id, text) as a new segment and merges what has become of similar size.  A document that
        the index has already must be removed first, see ``replace``."""
        version, entries = self.manifest.rows()
        number = max((e["number"] for e in entries), default=0) + 1
        return self._commit(version, [*map(tuple, entries), self._write(self._postings(docs), number)])

    def _postings(self, docs: DataFrame) -> DataFrame:
        named = docs.filter("doc_id IS NOT NULL").select("doc_id", F.explode(tokens(F.coalesce("text", F.lit("")))).alias("term"))
        return named.groupBy("term", "doc_id").agg(F.count(F.lit(1)).alias("tf"))

    def remove(self, doc_ids: DataFrame) -> int:
        """Hides the documents of (doc_id) from now on."""
        version, entries = self.manifest.rows()
        return self._commit(version, [*map(tuple, entries), self._removal(doc_ids, entries)])

    def replace(self, docs: DataFrame) -> int:
        """New texts for documents, known or not, in one change."""
        version, entries = self.manifest.rows()
        removal = self._removal(docs, entries)
        return self._commit(version, [*map(tuple, entries), removal, self._write(self._postings(docs), removal[2])])

    def _removal(self, doc_ids: DataFrame, entries: list) -> tuple:
        number = max((e["number"] for e in entries), default=0) + 1
        name = f"removed-{uuid.uuid4().hex[:12]}"
        doc_ids.select("doc_id").distinct().write.parquet(f"{self.folder}/{name}")
        return ("removed", name, number, 0)

    def _commit(self, version: int, entries: list[tuple]) -> int:
        version = self.manifest.commit(version, entries)
        while self.merge():
            version += 1
        return version

    def merge(self) -> bool:
        """Merges ``fanout`` segments whose sizes lie in one power of the fanout; whether there were any."""
        version, entries = self.manifest.rows()
        levels: dict[int, list] = {}
        for e in entries:
            if e["kind"] == "segment":
                level, size = 0, e["n"]
                while size >= self.fanout:
                    level, size = level + 1, size // self.fanout
                levels.setdefault(level, []).append(e)
        full = next((own for _, own in sorted(levels.items()) if len(own) >= self.fanout), None)
        if full is None:
            return False
        newest = max(e["number"] for e in full)
        if any(e["kind"] == "removed" for e in entries):
            each = self._blocks(full).select("term", "number", F.inline("postings"))
            merged = self._write(self._live(each, entries).select("term", "doc_id", "tf"), newest)
        else:  # nothing is hidden: blocks of a term and range are joined without taking them apart
            joined = self._blocks(full).groupBy("term", "range").agg(
                F.max("top").alias("top"), F.sum("n").alias("n"), F.array_sort(F.flatten(F.collect_list("postings"))).alias("postings")
            )
            merged = self._write_blocks(joined, newest)
        names = {e["name"] for e in full}
        stay = [e for e in entries if e["name"] not in names]
        oldest = min([e["number"] for e in stay if e["kind"] == "segment"] + [merged[2]])
        stay = [tuple(e) for e in stay if e["kind"] == "segment" or e["number"] > oldest]
        self.manifest.commit(version, [*stay, merged])
        return True

    def search(
        self, query: str, limit: int = 20, offset: int = 0, accept: Callable[[DataFrame], DataFrame] | None = None, order: list[Column] | None = None
    ) -> Found:
        """The page of documents that hold any of the query's terms.  ``accept`` turns candidates (doc_id, rank) into
        the rows that count, for instance by a join and filters; ``order`` follows the rank."""
        terms = query_terms(query)
        accept, order = accept or (lambda found: found), order or [F.col("doc_id")]
        entries = self.manifest.rows()[1]
        blocks = self._blocks(entries)
        wanted = F.lit(False)
        for t in terms:  # the folders are constants of the plan
            wanted = wanted | ((F.col("bucket") == self._bucket(F.lit(t))) & (F.col("term") == t))
        blocks = blocks.filter(wanted)
        bounds = blocks.groupBy("number", "range").agg(F.sum(part(F.col("top"))).alias("bound"), F.sum("n").alias("n"))
        level = F.floor(F.col("bound") * PLACES).cast("long")
        levels = bounds.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("ranges"), F.sum("n").alias("n")).collect()
        levels.sort(key=lambda r: -r["level"])
        goal, rounds = 4 * (limit + offset), 0
        while True:
            rounds += 1
            cut, n, ranges = 0, 0, 0
            for at, row in enumerate(levels):
                n, ranges = n + row["n"], ranges + row["ranges"]
                if n >= goal and at + 1 < len(levels):
                    cut = row["level"]
                    break
            found = accept(self._ranked(blocks, bounds, entries, terms, cut))
            if not cut or found.limit(limit + offset).count() >= limit + offset:
                page = found.orderBy(F.desc("rank"), *order).offset(offset).limit(limit)
                return Found(page, rounds, ranges, sum(r["ranges"] for r in levels))
            goal = 8 * n

    def _ranked(self, blocks: DataFrame, bounds: DataFrame, entries: list, terms: list[str], cut: int) -> DataFrame:
        """All documents whose sum of parts is at least ``cut``, from the ranges that can hold any."""
        if cut:
            near = bounds.filter(F.col("bound") >= cut / PLACES).select("number", "range")
            some = near.limit(MOST_LISTED + 1).collect()
            if len(some) <= MOST_LISTED:  # as constants they reach the scan, which skips row groups and pages
                own: dict[int, list[int]] = {}
                for r in some:
                    own.setdefault(r["number"], []).append(r["range"])
                listed = F.lit(False)
                for number, ranges in own.items():
                    listed = listed | ((F.col("number") == number) & F.col("range").isin(ranges))
                blocks = blocks.filter(listed)
            else:
                blocks = blocks.join(near, ["number", "range"], "left_semi")
        each = self._live(blocks.select("number", F.inline("postings")), entries)
        sums = each.groupBy("doc_id").agg(F.sum(part(F.col("tf"))).alias("s"))
        if cut:  # so far above that no document left out can have the same rank once rounded
            sums = sums.filter(F.col("s") >= cut / PLACES + 4e-5 * len(terms))
        return sums.select("doc_id", F.round(F.col("s") * WEIGHT / ZETA_2 / max(1, len(terms)), 6).alias("rank"))
