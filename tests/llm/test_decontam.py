import random

import numpy as np
import pytest

from hammerline.llm import decontam as D


def slow_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_length():
    random.seed(1)
    for _ in range(200):
        a = [random.choice("abcde") for _ in range(random.randrange(1, 80))]
        b = [random.choice("abcdef") for _ in range(random.randrange(0, 90))]
        assert D.common_length(D.place_bits(a), len(a), b) == slow_lcs(a, b)


def test_randomised_svd_spans_the_rows(spark):
    rng = np.random.default_rng(0)
    dense = rng.random((12, 40)) * (rng.random((12, 40)) < 0.4)
    rows = [(i, np.flatnonzero(r).tolist(), r[r != 0].tolist()) for i, r in enumerate(dense)]
    directions = D.randomised_svd(spark.createDataFrame(rows, "number int, at array<int>, value array<double>"), 40, 12)
    assert np.allclose(directions.T @ directions, np.eye(directions.shape[1]), atol=1e-8)
    assert np.allclose(dense @ directions @ directions.T, dense, atol=1e-6)


@pytest.fixture(scope="module")
def planted(spark):
    random.seed(4)
    word = lambda: "".join(random.choice(["ka", "lo", "mi", "ter", "san", "du", "ve"]) for _ in range(3))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(20 + 3 * i)) for i in range(15)]
    docs, truth = [], set()
    for i in range(150):
        body = text(random.randrange(5, 500)).split()
        if i % 3 == 0:
            item, passage = items[i % 15]
            words = passage.split()
            if i % 2:  # a paraphrase: every fifth word is another
                words = [word() if k % 5 == 2 else w for k, w in enumerate(words)]
            at = random.randrange(len(body) + 1)
            body[at:at] = words
            truth.add((i, item))
        elif i % 3 == 1:  # a short quotation is no leak
            body[3:3] = items[i % 15][1].split()[:5]
        docs.append((i, " ".join(body)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), truth


@pytest.mark.parametrize("block_items", [256, 4])
def test_leaks_and_paraphrases(planted, block_items):
    docs, items, truth = planted
    rows = D.find_leaks(docs, items, block_items=block_items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == truth
    assert all(r["overlap"] >= 0.6 for r in rows)


def test_verbatim_passages_of_the_corpus(spark, docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    truth = {(r["doc_id"], i) for r in docs.collect() for i, t in items if t in r["text"]}
    got = {(r["doc_id"], r["item_id"]) for r in D.op8_decontamination(docs, bench).collect()}
    assert truth and truth <= got


def test_odd_cases(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "same text of a few words here"), (None, "x")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.op8_decontamination(odd_docs, bench).collect()}
    assert got == {(5, 3), (6, 3)}
    assert D.op8_decontamination(no_docs, bench).count() == 0
    assert D.op8_decontamination(odd_docs, bench.limit(0)).count() == 0


def test_stretches_of_long_documents(planted, monkeypatch):
    docs, items, truth = planted
    monkeypatch.setattr(D, "CHUNK", 64)
    block = [part for r in items.collect() for part in D.parts_of(r["item_id"], D.words_of(r["text"]), 128)]
    df, total, sample = D.survey(docs, frozenset(w for p in block for w in p.words), 100, 100)
    index = D.build_index(block, df, total, sample, sample.count(), 0.25, 0.75, 64)
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    assert {(n, i) for n, i, *_ in index.find(texts, 0.2, 0.35, 0.6, 0.5)} == truth


def test_long_and_short_items_are_found_only_as_a_whole(spark):
    random.seed(6)
    words = [f"w{i}" for i in range(600)]
    long = [random.choice(words) for _ in range(128)] + ["thing"]
    longer = [random.choice(words) for _ in range(131)] + ["the", "sum", "of"]
    wide = [f"x{i}" for i in range(300)]
    items = [(1, " ".join(long)), (2, " ".join(longer)), (3, "sum of squares"), (4, " ".join(wide))]
    fill = [random.choice(["ka", "lo", "mi"]) for _ in range(60)]
    docs = [
        (10, " ".join(fill + ["thing"] + fill)),
        (11, " ".join(fill + ["the", "ka", "sum", "of"] + fill)),
        (12, " ".join(fill + ["sum", "lo", "of", "squares"] + fill)),
        (13, " ".join(fill + ["Sum", "of", "squares."] + fill)),
        (14, " ".join(fill + long + fill)),
        (15, " ".join(fill + longer[:70] + fill + longer[70:] + fill)),
        (16, " ".join(fill + [w if k % 4 else "ka" for k, w in enumerate(wide)])),
        (17, " ".join(fill + wide[:100] + fill)),
        (18, " ".join(fill + wide[200:] + fill)),
        (19, " ".join(wide[:150])), (19, " ".join(wide[150:])), (None, " ".join(wide[:150])), (None, " ".join(wide[150:])),
    ]
    docs += [(100 + i, " ".join(fill)) for i in range(100)]  # so that the items' words are rare
    docs, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block_items in (256, 2):
        got = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, bench, block_items=block_items, pass_items=4).collect()}
        assert got == {(13, 3), (14, 1), (15, 2), (16, 4)}


def test_passes_and_blocks_are_bounded(spark, monkeypatch):
    sizes, build = [], D.build_index
    monkeypatch.setattr(D, "build_index", lambda block, *more: sizes.append(len(block)) or build(block, *more))
    text = " ".join(f"w{i}" for i in range(90))
    docs = spark.createDataFrame([(1, text), (2, text[:200])], "doc_id long, text string")
    bench = spark.createDataFrame([(7, text)], "item_id long, text string")
    found = D.find_leaks(docs, bench, block_items=4, pass_items=6, passage_words=9).collect()
    assert sizes == [4, 2, 4] and [(r["doc_id"], r["item_id"]) for r in found] == [(1, 7)]


def test_latent_products_are_no_plain_ones_and_find_paraphrases(spark):
    """On the stored corpus: the space has fewer dimensions than passages; recall and precision by rate of replaced words."""
    random.seed(9)
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(3000)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    words = [w for r in docs.limit(300).collect() for w in D.words_of(r["text"])]
    block = [part for i, t in items for part in D.parts_of(i, D.words_of(t), 128)]
    df, total, sample = D.survey(docs, frozenset(w for p in block for w in p.words), 4096, 256)
    index = D.build_index(block, df, total, sample, sample.count(), 0.25, 0.75, 64)
    assert index.project.shape[1] < len(block) < len(index.vocabulary) / 10
    idf = np.sqrt(index.weights[:-2])
    plain = np.zeros((len(block), len(idf)))
    for row, part in zip(plain, block):
        for w in part.words:
            row[index.vocabulary[w]] += idf[index.vocabulary[w]]
    plain /= np.linalg.norm(plain, axis=1, keepdims=True)
    latent = plain @ (index.project[:-2] / np.maximum(idf, 1e-9)[:, None])
    assert np.abs(latent @ latent.T - plain @ plain.T).max() > 0.05
    for rate, least in ((0.0, 0.99), (0.2, 0.95), (0.4, 0.3)):
        made = []
        for i, text in items:
            own = [random.choice(words) if random.random() < rate else w for w in D.words_of(text)]
            made.append((i, " ".join([*random.choices(words, k=90), *own, *random.choices(words, k=90)])))
        made += [(10_000 + i, " ".join(random.choices(words, k=240))) for i in range(200)]
        got = {(n, i) for n, i, *_ in index.find([t for _, t in made], 0.2, 0.35, 0.6, 0.5)}
        right = {(n, i) for n, (i, _) in enumerate(made) if i < 10_000}
        print(f"replaced {rate}: recall {len(got & right) / len(right):.3f}, precision {len(got & right) / max(1, len(got)):.3f}")
        assert len(got & right) >= least * len(right) and len(got - right) <= 2


def test_every_passage_counts_in_the_fit(spark, tmp_path):
    """The sums are those of all passages, whatever the number of rows and tasks, and come out the same when dealt anew."""
    random.seed(4)
    words = [f"w{i}" for i in range(40)]
    texts = [(i, " ".join(random.choices(words, k=random.choice([5, 64, 150])))) for i in range(700)] + [(None, "w1 w2"), (9000, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    passages = [set(D.words_of(t)[at : at + D.FIT_WORDS]) for _, t in texts for at in range(0, len(D.words_of(t)), D.FIT_WORDS)]

    def energy(dealt, rows, cells):
        df, total, sketch = D.survey(dealt, frozenset(words), rows, cells)
        assert total == len(texts) and df["w1"] == sum("w1" in D.words_of(t) for _, t in texts)
        return sorted((tuple(r["words"]), tuple(r["sums"])) for r in sketch.collect())

    one = energy(docs.coalesce(1), 100_003, 1)
    assert one == energy(docs.repartition(5), 100_003, 256)
    # with far more rows than passages nearly each has a row of its own
    assert sum(n * n for _, sums in one for n in sums) == pytest.approx(sum(map(len, passages)), rel=0.05)
    few = energy(docs, 64, 256)
    assert len(few) == 64
