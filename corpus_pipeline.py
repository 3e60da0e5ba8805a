"""From raw documents to packed sequences, in five stages.

Each stage takes what its predecessor kept and, but for the last, returns the columns of
``documents``:

1. language_id drops documents without a recognisable language; where no lang is given at all,
   those without a letter;
2. line_dedup takes repeated lines out of the texts;
3. near_dedup leaves one row of each group of SimHash near-duplicates, that with the smallest id;
4. decontamination drops documents that hold a passage of ``benchmark``;
5. packing cuts and packs the rest into sequences of 1024 tokens.

Stages 3 and 4 decide for each row, by its doc_id and the md5 of its text: rows without a
doc_id come last in their group and rows that share an id, or have none, are dropped only for
what is in their own text; of rows that repeat both one stays in stage 3.  ``run`` removes what a stage has staged once the
stage's own result is written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hammerline.llm import decontam, langid, line_runs, packing, shared, simhash

#: Below this share of certainty among up to four languages a prediction says little; among
#: more, below this multiple of chance.
MIN_LANG_SCORE = 0.35
MIN_LANG_LIFT = 4 * MIN_LANG_SCORE
#: The stages together are not one SQL statement; tests compare with a brute-force version.
ORACLE_SQL = None


def text_key() -> Column:
    """With the doc_id it tells rows apart, as far as their content does."""
    return F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def same() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))


def without(keyed: DataFrame, rows: DataFrame) -> DataFrame:
    """``keyed`` (doc_id, text_key) but for ``rows`` (_id, _key), which grow with the corpus: merged at every size."""
    return keyed.join(rows.hint("merge"), same(), "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs, F.lit(True))
    if not model.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(docs, model=model)
    least = min(MIN_LANG_SCORE, MIN_LANG_LIFT / len(model.langs))
    kept = found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("lang_score") >= least))
    return kept.select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_runs.dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    out = out.withColumn("text", F.when(changed, F.col("clean_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.withColumn("text_key", text_key())
    found = shared.stage(simhash.near_duplicates(keyed, with_key=True), "classes")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = found.groupBy("root").agg(F.min(own).alias("first"))
    first = shared.stage(first.select("root", F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key")), "first")
    stays = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    judged = found.join(first, "root").withColumn("stays", stays)
    copies = judged.filter(~F.col("stays")).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    kept = without(keyed, shared.stage(copies, "copies"))
    repeated = judged.filter("stays").groupBy("_id", "_key").count().filter("count > 1").select("_id", "_key")
    repeated = shared.stage(repeated, "repeated")
    if not repeated.isEmpty():
        again = kept.join(repeated, same(), "left_semi").dropDuplicates(["doc_id", "text_key"])
        kept = without(kept, repeated).unionByName(again)
    return kept.select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks = decontam.find_text_leaks(docs, shared.table(spark, sf_dir, "benchmark"))
    hit = shared.stage(leaks.select(F.col("doc_id").alias("_id"), F.col("text_md5").alias("_key")).distinct(), "leaks")
    return without(docs.withColumn("text_key", text_key()), hit).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of ``documents``."""
    docs = shared.table(spark, sf_dir, "documents")
    folder = f"{shared.shared_dir(spark)}/hammerline-pipeline-{uuid.uuid4().hex[:12]}"
    for number, (name, stage) in enumerate(STAGES[:-1], 1):
        path = f"{folder}/{number}-{name}"
        with shared.recorded() as staged:
            stage(spark, docs, sf_dir).write.parquet(path)
        shared.discard(spark, staged)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
