import random
import re

import numpy as np
import pytest
import xxhash

from hammerline.llm import simhash as S


def slow_fingerprint(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] if len(words) >= width else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(prints, budget):
    """Smallest index reachable, by breadth-first search."""
    label = [-1] * len(prints)
    for i in range(len(prints)):
        if label[i] < 0:
            label[i], todo = i, [i]
            while todo:
                a = todo.pop()
                for b in range(len(prints)):
                    if label[b] < 0 and (prints[a] ^ prints[b]).bit_count() <= budget:
                        label[b] = i
                        todo.append(b)
    return label


@pytest.mark.parametrize("near", [0, 3, 30])
def test_trie_join_finds_all_links(near):
    random.seed(near)
    prints = [random.getrandbits(64) for _ in range(150)]
    for _ in range(near):
        base = random.choice(prints)
        prints += [base ^ sum(1 << random.randrange(64) for _ in range(random.randrange(7))) for _ in range(5)]
    x = np.unique(np.array(prints, dtype=np.uint64))
    assert S.trie_join(x, 0, 0, 4).tolist() == slow_classes(x.tolist(), 4)


def test_classes_over_all_groups(spark, docs, odd_docs):
    both = docs.select("doc_id", "text").unionByName(odd_docs.selectExpr("doc_id + 100000 AS doc_id", "text"))
    rows = sorted(((r["doc_id"], r["text"]) for r in both.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    prints = [slow_fingerprint(t) for _, t in rows]
    label = slow_classes(prints, 4)
    expected = sorted((i or 0, f"{p:016x}", rows[c][0] or 0) for (i, _), p, c in zip(rows, prints, label))
    got = [(r["doc_id"] or 0, r["fingerprint"], r["component_id"] or 0) for r in S.op5_simhash(both).collect()]
    assert sorted(got) == expected


def test_chain_of_many_groups_is_one_class(spark):
    """Each step flips four further bits, so the ends share no bit and no group."""
    value, chain = 0, []
    for step in range(16):
        chain.append(value - (1 << 64) if value >> 63 else value)
        value |= 0xF << (60 - 4 * step)
    nodes = spark.createDataFrame([(v,) for v in chain], "fp long")
    edges = S.link_forest(nodes, 4)
    closed = S.close_classes(edges).collect()
    assert len(closed) == 15 and len({r["root"] for r in closed}) == 1


def test_large_group_of_near_copies_stays_linear(spark):
    random.seed(5)
    base = random.getrandbits(64)
    prints = {base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)} | {base}
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    edges = S.link_forest(nodes, 4)
    assert edges.count() < 40 * len(prints)  # not the 2 million pairs
    assert S.close_classes(edges).count() == len(prints) - 1


def test_empty(no_docs):
    assert S.op5_simhash(no_docs).count() == 0


def test_heavy_nodes_are_opened_where_they_are(spark):
    """Most fingerprints under one long prefix: nodes stay small, and no link is lost between nodes of other depths."""
    random.seed(8)
    prefix = random.getrandbits(20) << 44
    prints = {prefix | random.getrandbits(44) for _ in range(500)} | {random.getrandbits(64) for _ in range(60)}
    for p in random.sample(sorted(prints), 60):
        prints.add(p ^ sum(1 << random.randrange(64) for _ in range(3)))
    x = sorted(prints)
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in x], "fp long")
    starts, depths = S.trie_nodes(nodes, 40)
    ends = [*starts.tolist()[1:], 1 << 64]
    assert max(sum(a <= p < b for p in x) for a, b in zip(starts.tolist(), ends)) <= 40 and depths.max() > 20
    label = slow_classes(x, 4)
    closed = {r["x"] % (1 << 64): r["root"] % (1 << 64) for r in S.close_classes(S.link_forest(nodes, 4, node_rows=40)).collect()}
    found, true = {}, {}
    for i, p in enumerate(x):
        found.setdefault(closed.get(p, p), set()).add(p)
        true.setdefault(label[i], set()).add(p)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, true.values()))
