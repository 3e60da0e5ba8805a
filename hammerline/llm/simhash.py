"""SimHash near-duplicates: a self-join of the binary trie of fingerprints.

Fingerprints are the paths of a binary trie.  A pair of nodes of equal depth is visited
together with the number of bits in which their paths differ; children inherit it, and
a pair over the error budget is left with everything below it.  Spark deals the trie out
by its top levels: counts of nodes open the heavy ones, level by level, until each holds a
bounded number of fingerprints; nodes are paired when their paths are within the budget as
far as both go, each pair is one group, and a group's traversal runs on index ranges of
its sorted fingerprints, a bounded number of node pairs at a time.  Fingerprints are
copied only when the pairs are known, once for each partner of their node; with nodes of
250,000 that is 16 copies at 2 million fingerprints and 386 at 250 million.

Copies never meet as pairs: the join runs on distinct fingerprints, and a group returns a
spanning forest of the links it found, at most one edge a fingerprint, so that no class
is expanded yet no link between different texts is lost.  Node pairs whose fingerprints
are all known to be connected are skipped, which keeps large groups of near copies cheap.
Classes are then closed over all groups by alternating large-star and small-star rounds,
each written to the shared folder.

Defined cases: null and empty texts have no words and the fingerprint zero, linked like
any other; fewer words than a shingle form one; repeated shingles count each time; rows
that repeat a doc_id keep their own row; a null doc_id never is a class id unless the
whole class has none; of equal fingerprints one takes part and all get its class; very long texts are
hashed shingle by shingle; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage

_LANES = np.array([sum(((v >> j) & 1) << (8 * j) for j in range(8)) for v in range(256)], dtype=np.uint64)
CHUNK = 400_000


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of ``width`` lower-cased words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxh64_intdigest(joined, 42)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    return np.array(
        [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist())], dtype=np.uint64
    )


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    if not len(hashes):
        return 0
    lanes = _LANES[hashes.astype("<u8").view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)  # lanes of 8 bits hold 255
    counts = sums.astype("<u8").view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    bits = 2 * counts > len(hashes)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 4, with_key: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text as a signed 64-bit number;
    ``with_key`` passes the string column text_key on."""
    key = ["text_key"] * with_key

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([majority(shingle_hashes(t, width)) for t in batch["text"]], dtype=np.uint64)
            frame = {"doc_id": batch["doc_id"].astype("Int64"), "fp": found.view(np.int64)}
            yield pd.DataFrame(frame | {c: batch[c] for c in key})

    return docs.select("doc_id", "text", *key).mapInPandas(rows, "doc_id long, fp long" + ", text_key string" * with_key)


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union of the classes of i and j; every label stays the smallest index of its class."""
    while len(i):
        a, b = label[i], label[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low != high
        if not open_.any():
            return
        i, j = i[open_], j[open_]
        np.minimum.at(label, high[open_], low[open_])
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def trie_join(x: np.ndarray, split: int, depth: int, budget: int) -> np.ndarray:
    """Class labels of the sorted distinct fingerprints ``x`` (uint64).  With ``split`` only
    pairs between x[:split] and x[split:] are traversed, from ``depth`` on; with 0, all pairs."""
    n = len(x)
    label = np.arange(n)
    for turn in range(0, 64, 4):  # neighbours under rotations: most of a large group at once
        turned = x if not turn else (x << np.uint64(turn)) | (x >> np.uint64(64 - turn))
        order = np.argsort(turned)
        near = np.bitwise_count(x[order[1:]] ^ x[order[:-1]]) <= budget
        merge(label, order[1:][near], order[:-1][near])
    change = np.flatnonzero(np.diff(label)) + 1
    run_end = np.repeat(np.append(change, n), np.diff(np.concatenate(([0], change, [n]))))
    zeros: dict[int, np.ndarray] = {}

    def cut(lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
        if bit not in zeros:
            clear = (x >> np.uint64(bit)) & np.uint64(1) == 0
            zeros[bit] = np.concatenate(([0], np.cumsum(clear))).astype(np.int32)
        return lo + zeros[bit][hi] - zeros[bit][lo]

    if split:
        errors = int(np.bitwise_count((x[0] ^ x[split]) >> np.uint64(64 - depth))) if depth else 0
        first = ([0], [split], [split], [n], [errors])
    else:
        first = ([0], [n], [0], [n], [0])
    stack = [(depth, *(np.array(v, dtype=np.int64) for v in first))]
    while stack:
        depth, i0, i1, j0, j1, errors = stack.pop()
        if len(i0) > CHUNK:
            for at in range(0, len(i0), CHUNK):
                stack.append((depth, *(v[at : at + CHUNK] for v in (i0, i1, j0, j1, errors))))
            continue
        joined = (run_end[i0] >= i1) & (run_end[j0] >= j1) & (label[i0] == label[j0])
        useful = ~joined & (i1 > i0) & (j1 > j0) & (errors <= budget)
        i0, i1, j0, j1, errors = (v[useful] for v in (i0, i1, j0, j1, errors))
        small = (i1 - i0) * (j1 - j0) <= 16
        if depth >= 64:
            small[:] = True
        if small.any():
            a, la, b, lb = i0[small], i1[small] - i0[small], j0[small], j1[small] - j0[small]
            count = la * lb
            which = np.repeat(np.arange(len(a)), count)
            inner = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            i, j = a[which] + inner // lb[which], b[which] + inner % lb[which]
            near = (i < j) & (np.bitwise_count(x[i] ^ x[j]) <= budget)
            merge(label, i[near], j[near])
        i0, i1, j0, j1, errors = (v[~small] for v in (i0, i1, j0, j1, errors))
        if not len(i0):
            continue
        bit = 63 - depth
        im, jm = cut(i0, i1, bit), cut(j0, j1, bit)
        own = i0 == j0
        cross = ~own
        parts = (
            (i0, im, j0, jm, errors),
            (im, i1, jm, j1, errors),
            (i0, im, jm, j1, errors + 1),
            tuple(v[cross] for v in (im, i1, j0, jm, errors + 1)),
        )
        children = [np.concatenate(column) for column in zip(*parts)]
        alive = (children[1] > children[0]) & (children[3] > children[2]) & (children[4] <= budget)
        stack.append((depth + 1, *(v[alive] for v in children)))
    return label


def halves(start: int, depth: int, counts: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """(first fingerprint, depth, count) of the nodes below one whose descendants at the last depth have
    ``counts``: a node of up to ``most`` fingerprints stays whole, and so does one at the last depth."""
    total = int(counts.sum())
    if total <= most or len(counts) == 1:
        return [(start, depth, total)] if total else []
    middle = len(counts) // 2
    upper = start + (1 << (63 - depth))
    return halves(start, depth + 1, counts[:middle], most) + halves(upper, depth + 1, counts[middle:], most)


def trie_nodes(distinct: DataFrame, node_rows: int, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """First fingerprints (sorted) and depths of trie nodes that hold all fingerprints, at most ``node_rows`` each.

    Only heavy nodes are opened, ``step`` levels a round; a round brings 2**step counts of a heavy node to the driver."""
    whole, depth = halves(0, 0, np.array([distinct.count()]), node_rows), 0
    nodes: list[tuple[int, int, int]] = []
    while whole:
        heavy = [start for start, own, n in whole if n > node_rows and own < 64]
        nodes += [x for x in whole if x[2] <= node_rows or x[1] == 64]
        if not heavy:
            break
        last = min(64, depth + step)
        above = F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")
        inside = distinct.select(above.alias("above"), F.shiftrightunsigned("fp", 64 - last).alias("node"))
        if depth:
            opened = distinct.sparkSession.createDataFrame([(h >> (64 - depth),) for h in heavy], "above long")
            inside = inside.join(F.broadcast(opened), "above")  # n / node_rows rows
        counts = {h: np.zeros(1 << (last - depth), dtype=np.int64) for h in heavy}
        for row in inside.groupBy("above", "node").count().collect():  # heavy nodes are few: n / node_rows
            own = counts[(row["above"] << (64 - depth)) & (2**64 - 1)]
            own[row["node"] & (len(own) - 1)] = row["count"]
        whole = [x for h in heavy for x in halves(h, depth, counts[h], node_rows)]
        depth = last
    nodes.sort()
    return np.array([x[0] for x in nodes], dtype=np.uint64), np.array([x[1] for x in nodes], dtype=np.int64)


def partners(which: int, starts: np.ndarray, depths: np.ndarray, budget: int) -> np.ndarray:
    """Numbers of the nodes whose paths differ from one's in at most ``budget`` bits, as far as both go."""
    common = np.minimum(depths, depths[which])
    apart = (starts ^ starts[which]) >> np.minimum(64 - common, 63).astype(np.uint64)
    return np.flatnonzero((common == 0) | (np.bitwise_count(apart) <= budget))


def link_forest(distinct: DataFrame, budget: int = 4, node_rows: int = 250_000, least_nodes: int = 8) -> DataFrame:
    """(u, v): a spanning forest of each node pair's links between distinct fingerprints (fp).

    Nodes hold up to ``node_rows`` fingerprints, down to a fiftieth of it where that makes ``least_nodes`` nodes."""
    number = distinct.count()
    starts, depths = trie_nodes(distinct, min(node_rows, max(node_rows // 50, -(-number // least_nodes))))
    known = distinct.sparkSession.sparkContext.broadcast((starts, depths))  # two numbers a node

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts, depths = known.value
        near: dict[int, np.ndarray] = {}
        for batch in batches:
            x = batch["fp"].to_numpy().view(np.uint64)
            node = np.searchsorted(starts, x, side="right") - 1
            for own in np.unique(node):
                if own not in near:
                    near[own] = partners(own, starts, depths, budget)
                fp = batch["fp"].to_numpy()[node == own]
                other = np.tile(near[own], len(fp))
                yield pd.DataFrame({"fp": np.repeat(fp, len(near[own])), "a": np.minimum(own, other), "b": np.maximum(own, other)})

    def group(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        a, b = key
        starts, depths = known.value
        x = np.unique(frame["fp"].to_numpy().view(np.uint64))
        split = int(np.searchsorted(x, starts[b])) if a != b else 0
        if len(x) < 2 or (a != b and split in (0, len(x))):
            return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        label = trie_join(x, split, int(min(depths[a], depths[b])), budget)
        moved = np.flatnonzero(label != np.arange(len(x)))
        signed = x.view(np.int64)
        return pd.DataFrame({"u": signed[moved], "v": signed[label[moved]]})

    some = range(0, len(starts), max(1, len(starts) // 256))
    pairs = int(np.mean([len(partners(i, starts, depths, budget)) for i in some]) * len(starts) / 2) if len(starts) else 1
    # small in bytes and long in work, so the groups are dealt out before they could be coalesced
    dealt = distinct.mapInPandas(deal, "fp long, a int, b int").repartition(max(1, min(4096, pairs // 2)), "a", "b")
    return dealt.groupBy("a", "b").applyInPandas(group, "u long, v long")


def close_classes(edges: DataFrame) -> DataFrame:
    """(x, root) for every node x with an edge that isn't its class's root."""
    pairs = stage(
        edges.select(F.greatest("u", "v").alias("x"), F.least("u", "v").alias("y")).filter("x <> y").distinct(), "edges"
    )
    seen = None
    while True:
        state = pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")), F.sum(F.col("y").cast("decimal(38,0)"))
        ).first()
        if tuple(state) == seen:
            return pairs.withColumnRenamed("y", "root")
        seen = tuple(state)
        both = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.filter("y > x").join(low, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x").filter("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        pairs = stage(small.unionByName(least.select("x", F.col("m").alias("y"))).distinct(), "edges")


def near_duplicates(
    docs: DataFrame, width: int = 4, budget: int = 4, node_rows: int = 250_000, with_key: bool = False
) -> DataFrame:
    """doc_id, fp (signed), component_id: the smallest doc_id of the class.  ``with_key`` adds
    the column text_key of ``docs`` and root, a fingerprint that names the class."""
    prints = stage(fingerprints(docs, width, with_key), "prints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("lowest")), "nodes")
    roots = close_classes(link_forest(nodes.select("fp"), budget, node_rows))
    member = roots.unionByName(roots.select(F.col("root").alias("x"), "root").distinct())
    named = (
        member.join(nodes, member["x"] == nodes["fp"])
        .groupBy("root")
        .agg(F.min("lowest").alias("smallest"))
        .join(member, "root")
        .select(F.col("x").alias("fp"), "smallest", "root")
    )
    classes = nodes.join(named, "fp", "left").select(
        "fp", F.coalesce("smallest", "lowest").alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    classes = stage(classes, "classes")  # so that the join has plain exchanges, which Spark splits where they are skewed
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id", *["text_key", "root"] * with_key)


def op5_simhash(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
