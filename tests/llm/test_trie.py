"""The conversation trie against a trie of Python dictionaries and SQL, on odd tables and many partitions."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from hammerline.llm import conversation_trie

TURN = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Every node from every conversation's prefixes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        made[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    nodes = {}
    for c, path in made.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    children, leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    for path, members in nodes.items():
        own_saving = (len(members) - 1) * (len(path[-1][1]) if path else 0)
        for d in range(len(path) + 1):
            saved[path[:d]] += own_saving
            leaves[path[:d]] += not children[path]
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if made[c] == path)
        above = min(nodes[path[:-1]]) if path else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(path), above, len(members), children[path], leaves[path], saved[path], sha))
    return out


def check(spark, rows):
    found = conversation_trie.op13_conversation_trie(spark.createDataFrame(rows, TURN)).collect()
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert sorted((tuple(r[n] for n in names) for r in found), key=repr) == sorted(brute(rows), key=repr)


@pytest.fixture
def many_parts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_random_conversations(spark, many_parts):
    """Few different turns: long shared prefixes, ends inside others, copies, parts that begin inside subtrees."""
    some = random.Random(5)
    for most, words in ((3, "a bb"), (9, "a bb ccc"), (4, "x")):
        rows = []
        for c in some.sample(range(-150, 800), 160):
            rows += [(c, t, some.choice("ua"), some.choice(words.split())) for t in range(some.randint(1, most))]
        check(spark, rows)


def test_copies_of_one_conversation(spark, many_parts):
    """Groups of ends over several parts and chunks."""
    rows = [(c * 100, t, "u", "one two"[: t + 3]) for c in range(300) for t in range(2)]
    rows += [(100 * c + 100_000, 0, "u", "one"[: 1 + c % 3]) for c in range(40)]
    before, conversation_trie.CHUNK = conversation_trie.CHUNK, 7
    try:
        check(spark, rows)
    finally:
        conversation_trie.CHUNK = before


def test_odd_tables(spark):
    long_text = "very long " * 120_000
    check(spark, [
        (None, 0, "u", "nobody's"), (1, None, None, None), (1, None, None, None), (1, 0, "", ""), (1, 0, "u", "tie"), (1, 0, "a", "tie"),
        (2, 0, "u", "é中"), (2, None, "u", "first"), (2, 1, "u", long_text), (205, 0, "u", "no base"), (300, 0, "u", "é中"), (301, 0, "ué", "中"),
    ])
    assert conversation_trie.op13_conversation_trie(spark.createDataFrame([], TURN)).count() == 0
    deep = [(c * 100, t, "u", str(t % 7)) for c in range(3) for t in range(700 + c)]
    check(spark, deep)


def test_extra_columns(spark):
    rows = [(1, 0, "u", "a"), (101, 0, "u", "a"), (400, 3, "u", "b")]
    plain = spark.createDataFrame(rows, TURN)
    more = plain.withColumns({c: F.lit("own") for c in ("size", "hash", "path", "part", "row", "id", "base", "turns", "depth")})
    assert sorted(conversation_trie.op13_conversation_trie(more).collect()) == sorted(conversation_trie.op13_conversation_trie(plain).collect())
