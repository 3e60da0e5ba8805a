"""The pipeline against a plain version of each stage."""

import pytest

import corpus_pipeline
from compare import SF
from hammerline.llm import decontam, langid, packing, shared
from test_packing import check
from test_simhash import slow_classes, slow_fingerprint


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = shared.table(spark, SF, "documents")
    found = [docs]
    for number, (_name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        found.append(docs)
    return found


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_language_stage_keeps_everything_with_a_language(stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert {i for i, t in before.items() if langid.gram_counts(t) is not None} == set(after)


def test_line_stage(stages):
    from collections import defaultdict

    before, after = rows(stages[1]), rows(stages[2])
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, text in before.items():
        for line in text.split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    for i, text in before.items():
        kept = [x for x in text.split("\n") if len(holders[key(x)]) < 3 or max(holders[key(x)]) == i]
        assert after[i] == "\n".join(kept)


def test_near_stage(stages):
    before, after = sorted(rows(stages[2]).items()), rows(stages[3])
    label = slow_classes([slow_fingerprint(t) for _, t in before], 4)
    assert set(after) == {before[c][0] for c in label}


def test_leak_stage(spark, stages):
    before, after = rows(stages[3]), rows(stages[4])
    items = [decontam.words_of(r["text"]) for r in shared.table(spark, SF, "benchmark").collect()]
    for i, text in before.items():
        words = " ".join(decontam.words_of(text))
        assert (i not in after) == any(" ".join(item) in words for item in items), i


def test_packing_stage(stages):
    packed = stages[5].collect()
    assert {r["doc_id"] for r in packed} == set(rows(stages[4]))
    used, total = check(packed)
    assert used <= -(-total // 1024) + 3
    bpe = packing.encoder(packing.default_vocabulary())
    lengths = {i: len(bpe.encode_ordinary(t)) + 1 for i, t in rows(stages[4]).items()}
    assert sum(lengths.values()) == total


def test_run_equals_the_stages(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SF).select(columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[5].select(columns).collect()))


def test_repeated_ids_leave_one_row(spark, odd_docs):
    out = corpus_pipeline.near_dedup(spark, odd_docs, SF)
    ids = [r["doc_id"] for r in out.collect()]
    assert ids.count(7) == 1 and ids.count(5) == 1 and 6 not in ids and None in ids


def test_decisions_are_by_row(spark, tmp_path):
    item = " ".join(f"bench{i} mark" for i in range(12))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    text = lambda n: " ".join(f"n{n}w{i * i % 97}" for i in range(40))
    given = [
        (None, text(1)), (None, f"{text(2)} {item}"), (None, text(3)), (5, text(4)), (5, f"{text(5)} {item}"),
        (6, text(6)), (None, text(6)), (None, text(7)), (None, text(7)), (8, text(8)), (8, text(8)), (9, text(8)),
    ]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    left = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    left.write.parquet(f"{tmp_path}/left")
    left = spark.read.parquet(f"{tmp_path}/left")
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, left.collect()), key=key) == sorted([*given[:6], given[7], given[9]], key=key)
    clean = corpus_pipeline.decontamination(spark, left, str(tmp_path))
    assert sorted(map(tuple, clean.collect()), key=key) == sorted(
        [given[i] for i in (0, 2, 3, 5, 7, 9)], key=key
    )


def test_language_stage_with_no_or_many_languages(spark, monkeypatch):
    import numpy as np

    rows = [(1, "some words", None), (2, "12 34", None), (3, None, None), (4, "Ωμέγα", None)]
    unnamed = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in corpus_pipeline.language_id(spark, unnamed, SF).collect()} == {1, 4}
    many = langid.Model([f"l{i}" for i in range(40)], np.ones(langid.BUCKETS))
    many.weights, many.bias = np.zeros((40, langid.BUCKETS)), np.append(2.0, np.zeros(39))
    monkeypatch.setattr(langid, "train", lambda *_: many)  # the likeliest of 40 has a score of 0.16
    assert {r["doc_id"] for r in corpus_pipeline.language_id(spark, unnamed, SF).collect()} == {1, 4}
