import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from hammerline.llm import packing as P


def check(rows, limit=1024):
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= limit
    return len(sequences), sum(r["length"] for r in rows)


def test_ids_and_packing(spark, docs, odd_docs):
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    both = docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text").filter("doc_id < 7").selectExpr("doc_id + 100000 AS doc_id", "text"))
    texts = {r["doc_id"]: r["text"] or "" for r in both.collect()}
    rows = P.pack_documents(both).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = np.array(hf.encode(texts[doc_id], add_special_tokens=False).ids + [2], dtype="<u4")
        pieces.sort(key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert all(p["length"] == 1024 for p in pieces[1:])
        at = 0
        for p in pieces:
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    used, total = check(rows)
    assert used <= -(-total // 1024) + 3


def test_tokenizers_agree_on_odd_strings():
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    bpe = P.encoder(P.default_vocabulary())
    for text in ["", " ", "\n\n  x", "<|endoftext|>", "don't 'll", "a" * 3000, " " * 3000, "é\u0301\u200b٣४", "日本語\u3000テキスト", "\x00\x1f", "𝒳 🙂👍🏽"]:
        assert bpe.encode(text, allowed_special="all") == hf.encode(text, add_special_tokens=False).ids


def test_rows_without_an_own_id_are_packed_in_many_tasks(spark):
    none = spark.range(4000).selectExpr("CAST(NULL AS long) AS doc_id", "'a few words' AS text", "1 AS _row", "2 AS sequence_id")
    rows = P.pack_documents(none).collect()
    check(rows)
    assert len(rows) == len({(r["sequence_id"], r["offset"]) for r in rows}) == 4000


def test_plan_uses_up_the_histogram():
    rng = np.random.default_rng(1)
    counts = np.zeros(1025, dtype=np.int64)
    np.add.at(counts, rng.integers(1, 1025, 20_000), 1)
    chosen = P.plan(counts, 1024)
    used = np.zeros_like(counts)
    for lengths, repeats in chosen:
        assert sum(lengths) <= 1024 and repeats > 0
        np.add.at(used, lengths, repeats)
    assert (used == counts).all()
    least = max(-(-int((counts * np.arange(1025)).sum()) // 1024), int(counts[513:].sum()))
    assert sum(r for _, r in chosen) <= least * 1.005
    assert P.plan(np.zeros(1025, dtype=np.int64), 1024) == []


def test_hot_length_and_empty(spark, no_docs, odd_docs):
    same = spark.range(5000).selectExpr("id AS doc_id", "'a few words' AS text")
    used, total = check(P.pack_documents(same).collect())
    assert used == -(-5000 // (1024 // (total // 5000)))
    assert P.pack_documents(no_docs).count() == 0
    assert check(P.pack_documents(odd_docs).collect())[0] > 0
    assert P.tokenize(odd_docs, keep_ids=True).selectExpr("size(ids) = length AS ok").filter("ok").count() > 0


def test_added_tokens_are_one_id(spark):
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y", "a  <|endoftext|>  b", "<|<|endoftext|>|>", "<|endoftext|"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in P.tokenize(docs, keep_ids=True).collect():
        assert r["ids"] == [*hf.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 2]


def test_long_runs_of_blanks(spark):
    """Beyond what the pattern of the faster form can match."""
    form = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" " * 2_000_000 + "x", "a" + "\t" * 2_000_000, "\n" * 1_200_000 + "<|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found: dict[int, list[int]] = {}
    for row in P.tokenize(docs, keep_ids=True).orderBy("doc_id", "piece").collect():
        found.setdefault(row["doc_id"], []).extend(row["ids"])
    for number, text in enumerate(texts):
        assert found[number] == form.encode(text, add_special_tokens=False).ids + [P.END_ID]
