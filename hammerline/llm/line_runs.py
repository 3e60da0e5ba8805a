"""Line de-duplication over levelled sorted runs of line hashes.

The known line keys live in runs: tables bucketed and sorted by a 128-bit hash of
the key.  Documents arrive in batches, largest doc_id first.  A batch is reduced to
one row for each key, merge-anti-joined with every run (both sides sorted and
bucketed alike), and what no run knows becomes a new run of level 0 that also records
the largest document holding the key; what a run knows already only adds to the
tally of documents.  As soon as a level holds ``fanout`` runs, they are merged into
one run of the next level, so a key sits in exactly one run and a batch meets few runs.

Defined cases: null and empty texts hold one empty line; keys shorter than
``min_chars`` code points are never dropped; every row counts as one document, so
repeated rows count each; rows that share the largest doc_id all keep the line; a null
doc_id ranks below every other; rows without a doc_id, or with one that repeats, are told apart by their
texts; very long texts take time in proportion to their lines (and the sort of their hashes); an
empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ascii_lower, stage, staged_path

BLANKS = " \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _line_key(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2")]


class LineRuns:
    """The levels of sorted runs.  ``admit`` takes (h1, h2, doc_id, first) rows, first being true
    for one row of each key in a document.

    With as many buckets as shuffle partitions (the default) a bucket is one file, and a
    batch that is grouped by key meets a run without a further exchange on either side."""

    def __init__(self, spark: SparkSession, fanout: int = 2, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.tallies: list[DataFrame] = []
        self.names: list[str] = []

    def _write_run(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.repartition(self.buckets, *KEY)
            .write.bucketBy(self.buckets, *KEY)
            .sortBy(*KEY)
            .option("path", staged_path(self.spark, "run"))
            .saveAsTable(name)
        )
        self.names.append(name)
        return self.spark.table(name)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def forget(self) -> None:
        """Takes the runs out of the catalog once their outcome is staged."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names, self.levels, self.tallies = [], [], []

    def admit(self, batch: DataFrame) -> DataFrame:
        """Add a batch; returns its run of keys that no earlier run held."""
        keys = batch.groupBy(*KEY).agg(F.count_if("first").alias("n_docs"), F.max("doc_id").alias("keep_doc"))
        known = self.runs()
        novel = keys = stage(keys, "batch") if known else keys
        for run in known:
            novel = novel.join(run.select(*KEY).hint("merge"), KEY, "left_anti")
        run = self._write_run(novel)
        for old in known:
            self.tallies.append(keys.join(old.select(*KEY).hint("merge"), KEY, "left_semi").select(*KEY, "n_docs"))
        self._push(0, run)
        return run

    def _push(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self.levels[level][0]
            for other in self.levels[level][1:]:
                merged = merged.unionByName(other)
            self.levels[level] = []
            self._push(level + 1, self._write_run(merged))

    def frequent(self, min_docs: int) -> DataFrame:
        """(h1, h2, keep_doc) of the keys found in at least ``min_docs`` documents."""
        parts = [run.select(*KEY, "n_docs", "keep_doc") for run in self.runs()]
        parts += [t.withColumn("keep_doc", F.lit(None).cast("long")) for t in self.tallies]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return (
            rows.groupBy(*KEY)
            .agg(F.sum("n_docs").alias("n"), F.max("keep_doc").alias("keep_doc"))
            .filter(F.col("n") >= min_docs)
            .select(*KEY, "keep_doc")
        )


def own_text() -> list[Column]:
    """With the doc_id they tell rows apart that have different texts."""
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(7), "text").alias("t2")]


def document_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, t1, t2, h1, h2, at, first): each line whose key is long enough, with its place from 1
    and whether it is the first of its key in the document."""
    keyed = F.transform(text_lines(ascii_lower(F.col("text"))), lambda line, i: F.struct(_line_key(line).alias("key"), (i + 1).alias("at")))
    long = F.filter(keyed, lambda x: F.char_length(x["key"]) >= min_chars)
    hashed = F.sort_array(F.transform(long, lambda x: F.struct(*_hashes(x["key"]), x["at"].alias("at"))))

    def marked(own: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            before = F.get(own, i - 1)
            other = before.isNull() | (before["h1"] != x["h1"]) | (before["h2"] != x["h2"])
            return F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["at"].alias("at"), other.alias("first"))

        return F.transform(own, one)

    entries = F.element_at(F.transform(F.array(hashed), marked), 1)  # bound once, not computed for each line
    return docs.select("doc_id", *own_text(), F.explode(entries).alias("k")).select("doc_id", "t1", "t2", "k.*")


def dedup_lines(
    docs: DataFrame,
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    fanout: int = 2,
    buckets: int | None = None,
) -> DataFrame:
    """``docs`` with the columns clean_text, n_lines and n_dropped added (or replaced).

    ``docs`` needs doc_id and text; other columns pass through.  Lines whose key is
    found in ``min_docs`` documents or more go from all but the largest doc_id.
    """
    cuts = docs.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    number = F.lit(0)
    for cut in sorted(set(cuts)):
        number = number + (F.coalesce(F.col("doc_id"), F.lit(-(2**62))) <= F.lit(cut)).cast("int")
    keys = stage(document_keys(docs, min_chars).withColumn("batch", number), "lines", ["batch"])
    runs = LineRuns(docs.sparkSession, fanout, buckets)
    for batch in range(len(set(cuts)) + 1):
        runs.admit(keys.filter(F.col("batch") == batch))
    frequent = stage(runs.frequent(min_docs), "frequent")
    runs.forget()
    drops = (
        keys.join(frequent, KEY)
        .filter(~F.col("doc_id").eqNullSafe(F.col("keep_doc")))
        .groupBy("doc_id", "t1", "t2")
        .agg(F.collect_set("at").alias("gone"))
    )
    named = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), "doc_id", "text", *own_text())
    same = named["doc_id"].eqNullSafe(drops["doc_id"]) & (named["t1"] == drops["t1"]) & (named["t2"] == drops["t2"])
    joined = named.join(drops, same, "left").select("doc", named["text"].alias("text"), "gone")
    lines = text_lines(F.col("text"))
    places = F.array_except(F.sequence(F.lit(1), F.size(lines)), F.col("gone"))  # by hash, in order
    kept = F.element_at(F.transform(F.array(lines), lambda own: F.array_join(F.transform(places, lambda i: F.get(own, i - 1)), "\n")), 1)
    touched = F.col("gone").isNotNull()
    made = F.struct(
        F.when(touched, kept).otherwise(F.coalesce("text", F.lit(""))).alias("clean_text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.when(touched, F.size("gone")).otherwise(0).cast("long").alias("n_dropped"),
    )
    added = ["clean_text", "n_lines", "n_dropped"]
    passed = [F.col("doc")[c].alias(c) for c in docs.columns if c not in added]
    return joined.select("doc", made.alias("made")).select(*passed, *[F.col("made")[c].alias(c) for c in added])


def op6_line_dedup(docs: DataFrame) -> DataFrame:
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("clean_text"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), lines AS (
  SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), frequent AS (
  SELECT k, max(doc_id) AS keep_doc FROM (SELECT DISTINCT rid, doc_id, k FROM keyed WHERE length(k) >= 20)
  GROUP BY k HAVING count(*) >= 3
), marked AS (
  SELECT d.rid, d.doc_id, d.pos, d.line, (f.k IS NOT NULL AND d.doc_id IS DISTINCT FROM f.keep_doc) AS gone
  FROM keyed d LEFT JOIN frequent f ON d.k = f.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid, doc_id
"""
