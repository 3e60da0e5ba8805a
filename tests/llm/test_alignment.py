"""Token alignment against both tokenizers run on whole texts, with every link enumerated."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hammerline.llm import registry, token_alignment
from hammerline.llm.token_alignment import align_documents, op11_token_alignment, safe_breaks, segment_pattern

NAMES = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def ends(tokens):
    out, at = [], 0
    for t in tokens:
        at += len(t)
        out.append(at)
    return out


def brute(rows):
    a_form = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_form.encode_special_tokens = True
    b_form = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    chars = token_alignment.byte_of_char()
    linked = []
    for _, text in rows:
        links, groups = [], []
        a = a_form.encode(" " + (text or ""), add_special_tokens=False)
        b = b_form.encode(text or "")
        raw_a = [bytes(chars[c] for c in t) for t in a.tokens]
        raw_b = [bytes([int(p[3:5], 16)]) if b_form.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, map(b_form.id_to_piece, b))]
        if text and b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            cuts = sorted(set(ends(raw_a)) & set(ends(raw_b)))
            by_cut = [([], []) for _ in cuts]
            for side, ids, raw in ((0, a.ids, raw_a), (1, b, raw_b)):
                at = 0
                for i, end in zip(ids, ends(raw)):
                    while cuts[at] < end:
                        at += 1
                    by_cut[at][side].append(i)
            groups = by_cut
            links = [(x, y) for g, h in groups for x in g for y in h]
        linked.append((groups, links))
    count = Counter(p for _, links in linked for p in set(links))
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for (doc_id, _), (groups, links) in zip(rows, linked):
        spelled = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        n_a, n_b = sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups)
        best = sum(count[p] == top[p[0]] for p in links)
        sha = hashlib.sha256(spelled.encode()).hexdigest() if groups else ""
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(count[p] for p in links), sha))
    return out


def check(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = align_documents(docs, **how).scored.collect()
    assert sorted((tuple(r[n] for n in NAMES) for r in found), key=repr) == sorted(brute(rows), key=repr)


def odd_texts():
    some = random.Random(3)
    parts = ["word", "Über", "naïve", "中文", "日本", "😀", "x1", "99", "'s", "don't", ";", "{", "»", " ", "　", " ", "\x85", "\x1c", "\x00", "é", "é"]
    blanks = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\r", " \r", "\r ", "\x0b", "\x0c", "  ", "  ", "   ", "\n ", ""]
    made = ["".join(some.choice(parts) + some.choice(blanks) for _ in range(some.randint(1, 12))) for _ in range(250)]
    return made + [some.choice(blanks) + t for t in made[:60]] + blanks


def test_odd_texts_and_small_blocks(spark):
    texts = [None, "", "a▁b", "▁", "<|endoftext|> in text", "<s> </s>", "<0x0A>", "x" * 3000, " " * 3000, "a b " * 2000, *odd_texts()]
    rows = list(enumerate(texts)) + [(3, "twice"), (3, "twice"), (None, "no id"), (None, None)]
    check(spark, rows)
    check(spark, rows, block_chars=200)


def test_synthetic_documents(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").limit(80).collect()]
    check(spark, rows, block_chars=30_000)


def test_long_text(spark):
    many = " ".join(f"word{i % 9973}\n{i}" for i in range(60_000))
    blank = " " * 400_000 + "x"
    check(spark, [(1, many), (2, many[:500]), (3, blank), (4, "y" * 20_000)])


def test_empty_and_extra_columns(spark):
    assert op11_token_alignment(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, "a c")], "doc_id long, text string")
    more = docs.withColumns({c: F.lit("own") for c in ("block", "n", "codes", "segment", "groups", "pairs", "idx", "best")})
    assert sorted(op11_token_alignment(more).collect()) == sorted(op11_token_alignment(docs).collect())


def test_groups_and_pairs(spark):
    made = align_documents(spark.createDataFrame([(1, "hello  world"), (2, "hello")], "doc_id long, text string"), keep_groups=True)
    own = {r["doc_id"]: r for r in made.documents.collect()}
    assert own[1]["groups"].startswith(own[2]["groups"] + ";") and own[1]["groups_sha256"] == hashlib.sha256(own[1]["groups"].encode()).hexdigest()
    pairs = {(r["a"], r["b"]): (r["n"], r["best"]) for r in made.pairs.collect()}
    first = own[2]["groups"].split(";")[0].split("|")
    assert pairs[int(first[0].split(",")[0]), int(first[1].split(",")[0])] == (2, True)


def test_safe_breaks():
    """The carriage return is not safe, as pieces such as `;\\r` exist; what is not split stays whole."""
    safe = safe_breaks(*token_alignment.default_vocabularies())
    assert " " in safe and "\n" in safe and "\r" not in safe
    find = segment_pattern(safe).findall
    for text in odd_texts():
        parts = find(" " + text)
        assert "".join(parts) == " " + text
        assert all(p[0] in safe for p in parts)
    assert find(" a b\rc \r") == [" a", " b\rc", " \r"] and find(" a\r") == [" a\r"]


@pytest.mark.parametrize("n", [0, 1, 5, 70_000])
def test_numbers_round_trip(n):
    numbers = np.arange(n, dtype=np.int64) * 3_000_001
    assert (token_alignment.unpack_numbers(token_alignment.pack_numbers(numbers, 8), n, 8) == numbers).all()
    assert (token_alignment.unpack_numbers(token_alignment.pack_numbers(numbers % 2**32), n) == numbers % 2**32).all()
    assert "op11_token_alignment" in registry.queries()


def test_links_of_large_groups():
    """Listed one by one or by distinct ids: the same links."""
    table = token_alignment.token_table(["1,2,1|3,3;4|5", "7|8,9", "1,1,1|3,6"])
    assert table[3].tolist() == [0, 0, 1, 2]
    found = []
    for most in (0, 100):
        of, a, b, times = token_alignment.linked_ids(*table[:3], most=most)
        total = Counter()
        for key, n in zip(zip(of.tolist(), a.tolist(), b.tolist()), times.tolist()):
            total[key] += n
        found.append(total)
    assert found[0] == found[1] and found[0][0, 1, 3] == 4 and found[0][3, 1, 6] == 3
