"""The stored index against plain searches: skipped blocks, added, replaced and removed documents, merges."""

import random

import pytest
from pyspark.sql import functions as F

from hammerline.operators.search import search_texts
from hammerline.operators.text_index import TextIndex
from hammerline.sources.versions import Conflict, Manifest

DOC = "doc_id long, text string"


def made(spark, rows):
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def corpus(spark):
    some = random.Random(2)
    words = ["oil", "canvas", "red", "blue", "boat", "sea", "hill"]
    rows = [(i, " ".join(some.choice(words) for _ in range(some.randint(0, 6)))) for i in range(400)]
    rows += [(i, "oil " * 40 + "canvas " * 6) for i in range(3000, 3030)] + [(9000, None), (9001, "")]
    return rows


def test_search_equals_the_plain_one_and_skips_blocks(spark, corpus, tmp_path):
    docs = made(spark, corpus)
    index = TextIndex(spark, f"file://{tmp_path}/index", span=32)
    index.add(docs)
    for query in ("oil canvas", "boat", "nothing here", "a b"):
        for limit in (5, 100, 2000):
            assert index.search(query, limit).page.collect() == search_texts(docs, query, limit).collect()
    few = index.search("oil canvas", 5)
    assert few.rounds == 1 and few.ranges_read < few.ranges / 3
    plan = few.page._jdf.queryExecution().executedPlan().toString()
    assert "In(range" in plan or "EqualTo(range" in plan


def test_pages_and_filters_are_exact(spark, corpus, tmp_path):
    """A filter that only documents of low rank pass: the cut falls until the page is full."""
    docs = made(spark, corpus)
    index = TextIndex(spark, f"file://{tmp_path}/index", span=16)
    index.add(docs)
    odd = lambda df: df.filter(F.col("doc_id") % 37 == 3)
    plain = odd(search_texts(docs, "sea boat", 10_000)).collect()
    found = index.search("sea boat", 4, 2, odd)
    assert found.page.collect() == plain[2:6] and found.rounds > 1
    assert index.search("sea boat", 50, 0, odd).page.collect() == plain


def test_added_replaced_and_removed(spark, corpus, tmp_path):
    index = TextIndex(spark, f"file://{tmp_path}/index", span=64, fanout=3)
    now = dict(corpus)
    index.add(made(spark, corpus))
    assert index.search("zebra").page.count() == 0
    for step in range(4):
        new = [(10_000 + step, "a zebra boat"), (20_000 + step, "red zebra zebra")]
        now |= dict(new)
        index.add(made(spark, new))
    changed = [(10_000, "no more stripes"), (5, "zebra zebra zebra"), (77_777, "late zebra")]
    now |= dict(changed)
    index.replace(made(spark, changed))
    for gone in (20_001, 3, 3001):
        now.pop(gone)
    index.remove(made(spark, [(20_001, None), (3, None), (3001, None)]))
    again = [(20_001, "zebra is back")]
    now |= dict(again)
    index.add(made(spark, again))
    docs = made(spark, list(now.items()))
    for query in ("zebra", "boat zebra", "oil canvas"):
        assert index.search(query, 30).page.collect() == search_texts(docs, query, 30).collect()
    kinds = [e["kind"] for e in index.manifest.rows()[1]]
    assert kinds.count("segment") < 7  # merged by size
    while index.merge():
        pass
    assert index.search("zebra", 30).page.collect() == search_texts(docs, "zebra", 30).collect()


def test_a_merge_drops_what_is_hidden(spark, tmp_path):
    index = TextIndex(spark, f"file://{tmp_path}/index", fanout=2)
    index.add(made(spark, [(1, "oil"), (2, "oil")]))
    index.remove(made(spark, [(1, None)]))
    index.add(made(spark, [(3, "oil"), (4, "oil")]))
    entries = index.manifest.rows()[1]
    assert [(e["kind"], e["n"]) for e in entries] == [("segment", 3)]


def test_an_empty_index(spark, tmp_path):
    index = TextIndex(spark, f"file://{tmp_path}/index")
    assert index.search("oil").page.count() == 0
    index.add(made(spark, []))
    index.add(made(spark, [(None, "oil"), (1, "oil")]))
    assert [r["doc_id"] for r in index.search("oil").page.collect()] == [1]


def test_a_version_is_written_once(spark, tmp_path):
    manifest = Manifest(spark, f"file://{tmp_path}/m", "name string, n long")
    assert manifest.rows() == (0, [])
    manifest.commit(0, [("a", 1)])
    with pytest.raises(Conflict):
        manifest.commit(0, [("b", 2)])
    assert manifest.rows()[1][0]["name"] == "a"
    manifest.commit(1, [])
    assert manifest.rows() == (2, []) and manifest.rows(1)[1][0]["n"] == 1


def test_a_merge_without_removals_joins_whole_blocks(spark, tmp_path, monkeypatch):
    index = TextIndex(spark, f"file://{tmp_path}/index", span=4, fanout=2)
    index.add(made(spark, [(i, "oil " * (i + 1)) for i in range(0, 12, 2)]))
    postings = index._postings(made(spark, [(i, "oil " * (i + 1)) for i in range(1, 12, 2)]))
    version, entries = index.manifest.rows()
    index.manifest.commit(version, [*map(tuple, entries), index._write(postings, 2)])
    monkeypatch.setattr(index, "_write", None)  # takes postings one by one
    assert index.merge()
    blocks = index._blocks(index.manifest.rows()[1]).filter("term = 'oil'").orderBy("range").collect()
    assert [(b["range"], b["n"], b["top"]) for b in blocks] == [(0, 4, 4), (1, 4, 8), (2, 4, 12)]
    assert [(p["doc_id"], p["tf"]) for b in blocks for p in b["postings"]] == [(i, i + 1) for i in range(12)]
