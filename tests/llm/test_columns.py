"""Extra columns with the names that operators use themselves."""

import pytest
from pyspark.sql import functions as F

from hammerline.llm import decontam, langid, packing, pii, simhash, toxicity, url_cascade

NAMES = "score fp root held_out uid base spans cands _row _salt _rank _keys _best _said h words word at cell rid text_key component_id".split()


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, f"the words of a text number {i % 3} that go on", "en" if i % 2 else "de") for i in range(12)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.withColumns({n: F.lit("own") for n in NAMES})


def test_operators_on_texts(spark, clashing):
    n = clashing.count()
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, toxic int").withColumn("score", F.lit("x"))
    scored = toxicity.score_documents(clashing, labels)
    assert scored.count() == n and dict(scored.dtypes)["score"] == "double" and scored.columns.count("score") == 1
    named = langid.identify(clashing.withColumn("lang_pred", F.lit(1)))
    assert named.count() == n and dict(named.dtypes)["lang_pred"] == "string"
    assert {r["score"] for r in named.collect()} == {"own"}
    assert packing.pack_documents(clashing).count() == n
    assert pii.find_personal_data(clashing).count() == n
    assert simhash.near_duplicates(clashing).count() == n
    bench = spark.createDataFrame([(1, "words of a text number 1 that go", "own")], "item_id long, text string, cosine string")
    assert {r["doc_id"] % 3 for r in decontam.find_leaks(clashing, bench).collect()} == {1}


def test_operators_on_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", "old", "old")], "page_id long, url string, host string, verdict string")
    out = url_cascade.filter_urls(pages.withColumns({n: F.lit("own") for n in ("key", "at", "word", "bits")}))
    row = out.first()
    assert (row["host"], row["verdict"], row["rule"], row["key"], row["bits"]) == ("a.net", "block", "net/", "own", "own")
    assert out.columns.count("host") == out.columns.count("verdict") == 1
