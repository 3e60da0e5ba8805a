from pyspark.sql import functions as F

from hammerline.llm import langid, toxicity
from hammerline.llm.shared import crc32_mod

SF01 = "/root/testdata/sf0.1"


def test_language_accuracy_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.op10_language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd_cases(spark, odd_docs, no_docs):
    found = langid.identify(odd_docs)
    rows = {r["doc_id"]: r["lang_pred"] for r in found.collect()}
    assert [rows[i] for i in (1, 2, 3, 8)] == ["und"] * 4 and rows[4] in ("en", "de", "fr")
    assert found.columns == [*odd_docs.columns, "lang_pred", "lang_score"]
    assert langid.op10_language_id(no_docs).count() == 0
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(unlabelled).collect()} == {"und"}


def test_long_texts_are_read_in_stretches():
    text = "der die das und " * 10
    whole = langid.gram_counts(text)
    stretch, langid.STRETCH = langid.STRETCH, 16
    try:
        cut = langid.gram_counts(text)
    finally:
        langid.STRETCH = stretch
    assert abs(int(whole.sum()) - int(cut.sum())) <= 8 * len(text) // 16


def test_toxicity_on_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.op2_toxicity(docs, labels).join(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id").filter("held_out").collect()
    good = sorted(r["score"] for r in rows if r["toxic"] == 0)
    bad = [r["score"] for r in rows if r["toxic"] == 1]
    auc = sum(sum(g < b for g in good) + 0.5 * sum(g == b for g in good) for b in bad) / (len(good) * len(bad))
    assert auc > 0.95
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) > 0.95


def test_toxicity_odd_cases(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, 0), (99, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    rows = toxicity.op2_toxicity(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.op2_toxicity(no_docs, labels).count() == 0
    empty = labels.limit(0)
    assert {r["predicted"] for r in toxicity.op2_toxicity(odd_docs, empty).collect()} == {0}
    assert toxicity.op2_toxicity(odd_docs, labels).filter(crc32_mod(F.col("doc_id"), 5) == 0).filter("NOT held_out").count() == 0
