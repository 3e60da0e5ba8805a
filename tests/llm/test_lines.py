import hashlib
from collections import defaultdict

import pytest

from hammerline.llm import line_runs as R


def brute(rows):
    seen, keep = defaultdict(int), {}
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(R.BLANKS))
    low = -(2**70)
    for doc_id, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= 20:
                seen[k] += 1
                keep[k] = max(keep.get(k, low), low if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        own = low if doc_id is None else doc_id
        kept = [x for x in lines if not (seen[key(x)] >= 3 and keep[key(x)] != own)]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    shared, other = "A line that many documents share", "  Another LINE that is repeated here\t"
    found = [(i, f"own line of document {i} here\n{shared}\n{other if i % 2 else other.upper()}\nshort") for i in range(40)]
    found += [(41, None), (42, ""), (43, "\n\n"), (44, shared), (44, shared), (None, shared), (45, "É" * 20 + "\n" + "é" * 20), (46, "É" * 20), (47, "É" * 20)]
    return found


@pytest.mark.parametrize(("batches", "fanout", "buckets"), [(1, 2, None), (4, 2, None), (5, 3, 3)])
def test_equals_brute_force(spark, rows, batches, fanout, buckets):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = R.dedup_lines(docs, batches=batches, fanout=fanout, buckets=buckets)
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["clean_text"].encode()).hexdigest()) for r in out.collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_runs_are_disjoint_and_compacted(spark):
    runs = R.LineRuns(spark, fanout=2, buckets=4)
    for batch in range(4):
        keys = spark.range(batch * 50, batch * 50 + 100).selectExpr("id AS h1", "id AS h2", "id AS doc_id", "true AS first")
        runs.admit(keys)
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    run = runs.runs()[0]
    assert run.count() == run.distinct().count() == 250
    assert runs.frequent(2).count() == 150


def test_odd_and_extra_columns(odd_docs, no_docs):
    out = R.dedup_lines(odd_docs)
    assert out.columns[: len(odd_docs.columns)] == odd_docs.columns and out.count() == odd_docs.count()
    assert R.op6_line_dedup(no_docs).count() == 0


def test_many_shared_lines_in_a_document(spark):
    import time

    text = "\n".join(f"a shared line with the number {i % 12_000}" for i in range(16_000))
    docs = spark.createDataFrame([(i, text) for i in (1, 2, 3, None, None)], "doc_id long, text string")
    began = time.perf_counter()
    rows = R.op6_line_dedup(docs).collect()
    assert sorted((r["n_lines"], r["n_dropped"]) for r in rows) == [(16_000, 0)] + [(16_000, 16_000)] * 4
    assert time.perf_counter() - began < 60


def test_columns_of_the_same_names(spark):
    line = "a line of more than twenty characters"
    rows = [(i, f"{line}\n{i}", "own", i, i) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, clean_text string, gone int, t1 int")
    out = R.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "gone", "t1", "clean_text", "n_lines", "n_dropped"]
    assert sorted((r["doc_id"], r["gone"], r["t1"], r["clean_text"]) for r in out.collect()) == [(0, 0, 0, "0"), (1, 1, 1, "1"), (2, 2, 2, f"{line}\n2")]
