"""A prefix trie of conversations, built as a Patricia tree over sorted turn sequences.

A conversation becomes one row with the 128-bit hashes of its turns, joined to a binary value, and
their lengths.  These rows are sorted across the cluster and staged, so a subtree is a run of
rows.  One pass over each sorted part opens and closes points with a stack: only branch points, ends of
conversations and leaves become points; the unary nodes between them stay lengths on a compressed
edge.  Everything a point counts is a sum or minimum over its rows, and a row tells which nodes it
introduces from what it shares with the row before, so parts meet in one aggregation.  Where a part begins
or ends inside a subtree, every node on its first and last row's path is made a point, so all parts
that share a subtree have its points in common.  Only then are edges expanded into nodes, by suffix sums
of their lengths.

No subtree is collected: a part holds one path of open points.  A digest of ends is sequential by
its definition; its numbers come sorted, in chunks that parts have joined, and stream through one hash.  What reaches the
driver are two numbers for each sorted part.

Defined cases: turns are ordered by turn, nulls first, ties by the hash of role and text (so repeated
rows are turns each); null roles and texts are empty; rows without a conv_id belong to no conversation and are left out; a conversation
may be left without turns and ends at the root; an empty table gives no rows; a long conversation holds 20 bytes
a turn in one row, whatever its texts; extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage

WIDTH = 16
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
SUMS = ("n", "least", "total", "fresh", "leaves", "children", "above", "end_first")
POINT = "id binary, parent binary, depth int, edge array<long>, " + ", ".join(f"{n} long" for n in SUMS) + ", ends string"
POINT_ARROW = pa.schema(
    [("id", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("edge", pa.list_(pa.int64()))]
    + [(n, pa.int64()) for n in SUMS]
    + [("ends", pa.string())]
)
#: Conversation ids that a chunk of ends joins.
CHUNK = 4096


def turn_hash() -> Column:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the ordered hashes and code points of each conversation's turns."""
    size = F.char_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("size")
    rows = turns.filter("conv_id IS NOT NULL").select("conv_id", F.struct("turn", turn_hash().alias("hash"), size).alias("turn"))
    ordered = F.sort_array(F.collect_list("turn"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["hash"].alias("hash"), t["size"].alias("size"))).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % 100 before its own after the
    h-th, h = crc32(c) % 6.  A base serves the hundred ids above it, so the join has no hot key."""
    own = stage(conversations(turns), "conversations")
    most = 5
    base = own.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    named = own.withColumn("base", F.expr("conv_id - conv_id % 100")).join(base, "base", "left")
    none = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("head", none), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.greatest(F.lit(0), F.size("turns") - h))
    return named.select("conv_id", F.concat(head, rest).alias("turns"))


def sorted_parts(sequences: DataFrame) -> DataFrame:
    """(part, row, conv_id, path, sizes), staged: sorted by path and id within and across parts."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["hash"]), ""))
    flat = sequences.select(F.col("conv_id").cast("long"), path.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    flat = stage(flat, "paths")  # the sort reads it twice
    parts = int(flat.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = flat.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    return stage(ranged.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"), "*"), "sorted")


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths share from their start."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    if a[: high * WIDTH] == b[: high * WIDTH]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[: middle * WIDTH] == b[: middle * WIDTH]:
            low = middle
        else:
            high = middle
    return low


def borders(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """For each part: the turns its first row shares with the row before and its last one with the row
    after (-1: there is none).  Two numbers a part come to the driver; paths are compared in tasks."""
    ends = rows.groupBy("part").agg(F.min_by("path", "row").alias("first"), F.max_by("path", "row").alias("last"))
    ends = stage(ends, "borders")
    order = sorted(r["part"] for r in ends.select("part").collect())
    if not order:
        return {}
    following = F.create_map(*[F.lit(x) for pair in zip(order, [*order[1:], -1]) for x in pair])
    after = ends.select(F.col("part").alias("next"), F.col("first").alias("other"))
    pairs = ends.withColumn("next", F.element_at(following, F.col("part"))).join(after, "next")
    share = F.pandas_udf(lambda a, b: a.combine(b, shared_turns), "int")
    found = {r["part"]: r["n"] for r in pairs.select("part", share("last", "other").alias("n")).collect()}
    before = dict(zip(order[1:], order))
    return {p: (found.get(before.get(p, -1), -1), found.get(p, -1)) for p in order}


@dataclass
class Point:
    """An open point: its depth, the lengths above it, what the row that opened it shares with the row
    before, and sums over its rows."""

    depth: int
    above: int
    shared: int
    children: int
    twice: int
    n: int = 0
    least: int | None = None
    total: int = 0
    fresh: int = 0
    leaves: int = 0
    ends: list[int] = field(default_factory=list)

    def take(self, n: int, least: int, total: int, fresh: int, leaves: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)
        self.total += total
        self.fresh += fresh
        self.leaves += leaves


class Part:
    """The pass over one sorted part.

    A row introduces the nodes below what it shares with the row before.  ``fresh`` sums the lengths of all that the
    rows of a point introduce; the row that opens the point also introduces ``twice`` above it, which is
    taken off when the point is written."""

    def __init__(self, before: int):
        self.before = before
        self.stack: list[Point] = []
        self.path = b""
        self.sums, self.chain = [0], [hashlib.md5(b"").digest()]

    def point(self, depth: int, shared: int, goes_on: bool) -> Point:
        above = self.sums[depth - 1] if depth else 0
        twice = above - self.sums[max(shared, 0)] if depth > max(shared, 0) else 0
        return Point(depth, above, shared, int(goes_on and shared <= depth), twice)

    def add(self, conv_id: int, path: bytes, sizes: list[int], last_of_leaf: bool) -> Iterator[tuple]:
        """The next row; yields the points that it closes."""
        length, first = len(sizes), not self.stack
        local = 0 if first else shared_turns(self.path, path)
        if not first:
            yield from self.close_to(local)
        del self.sums[local + 1 :], self.chain[local + 1 :]
        for i in range(local, length):
            self.sums.append(self.sums[-1] + sizes[i])
            self.chain.append(hashlib.md5(self.chain[-1] + path[i * WIDTH : (i + 1) * WIDTH]).digest())
        self.path = path
        shared = self.before if first else local
        if first:
            self.stack = [self.point(depth, shared, depth < length) for depth in range(length + 1)]
        elif length > local:
            self.stack[-1].children += 1
            self.stack.append(self.point(length, shared, False))
        top = self.stack[-1]
        total = self.sums[-1]
        top.take(1, conv_id, total, total - self.sums[max(shared, 0)], int(last_of_leaf))
        top.ends.append(conv_id)
        if len(top.ends) >= CHUNK:
            yield self.ends(top)

    def close_to(self, depth: int) -> Iterator[tuple]:
        """Closes the points deeper than ``depth``, which becomes a point if it is none: its rows so far
        are those of the point that is closed last."""
        while self.stack[-1].depth > depth:
            point = self.stack.pop()
            if self.stack[-1].depth < depth:
                self.stack.append(self.point(depth, point.shared, True))
            self.stack[-1].take(point.n, point.least, point.total, point.fresh, point.leaves)
            yield self.closed(point, self.stack[-1].depth)

    def finish(self) -> Iterator[tuple]:
        """Closes all; each node of the last row's path becomes a point."""
        if self.stack:
            for depth in range(self.stack[-1].depth - 1, -1, -1):
                yield from self.close_to(depth)
            yield self.closed(self.stack.pop(), -1)

    def closed(self, point: Point, above: int) -> tuple:
        """With its edge: for each node from below the point above, the lengths from it to before the point."""
        whole = self.sums[point.depth - 1] if point.depth else 0
        edge = [whole - (self.sums[d - 1] if d else 0) for d in range(above + 1, point.depth + 1)]
        parent = self.chain[above] if above >= 0 else None
        end_first, ends = self.joined(point)
        sums = (point.n, point.least, point.total, point.fresh - point.twice, point.leaves, point.children, point.above)
        return (self.chain[point.depth], parent, point.depth, edge, *sums, end_first, ends)

    def joined(self, point: Point) -> tuple[int | None, str | None]:
        ends, point.ends = point.ends, []
        return (ends[0], ",".join(map(str, ends))) if ends else (None, None)

    def ends(self, point: Point) -> tuple:
        """A chunk of ends ahead of the point."""
        return (self.chain[point.depth], None, None, None, 0, None, 0, 0, 0, 0, None, *self.joined(point))


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def local_points(rows: DataFrame) -> DataFrame:
    """Each part's points with their sums; a point that several parts share has a row from each."""
    found = borders(rows)
    parts = max(found, default=0) + 1

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, held = None, [], None
        for batch in batches:
            for number, conv_id, path, sizes in zip(*[batch[c].to_pylist() for c in ("part", "conv_id", "path", "sizes")]):
                if part is None:
                    part = Part(found[number][0])
                if held is not None:
                    out += part.add(*held, shared_turns(held[1], path) < len(held[2]))
                held = (conv_id, path, sizes)
                if len(out) >= 4000:
                    yield record_batch(out, POINT_ARROW)
                    out = []
                after = found[number][1]
        if held is not None:
            out += part.add(*held, after < len(held[2]))
            for row in part.finish():
                out.append(row)
                if len(out) >= 4000:
                    yield record_batch(out, POINT_ARROW)
                    out = []
        if out:
            yield record_batch(out, POINT_ARROW)

    ordered = rows.repartitionById(parts, F.col("part")).sortWithinPartitions("row")
    return ordered.select("part", "conv_id", "path", "sizes").mapInArrow(passed, POINT)


def end_digests(points: DataFrame) -> DataFrame:
    """(id, sha): the digest of each point's ends, whose chunks stream by in order."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.binary()), ("sha", pa.string())])
        last, state, out = None, None, []
        for batch in batches:
            for key, ends in zip(batch["id"].to_pylist(), batch["ends"].to_pylist()):
                if key == last:
                    state.update(b"," + ends.encode())
                    continue
                if last is not None:
                    out.append((last, state.hexdigest()))
                last, state = key, hashlib.sha256(ends.encode())
            if out:
                yield record_batch(out, schema)
                out = []
        if last is not None:
            yield record_batch([(last, state.hexdigest())], schema)

    chunks = points.filter("ends IS NOT NULL").select("id", "end_first", "ends")
    ordered = chunks.repartition("id").sortWithinPartitions("id", "end_first")
    return ordered.select("id", "ends").mapInArrow(hashed, "id binary, sha string")


def with_parents(points: DataFrame) -> DataFrame:
    """Adds parent_least, the parent's smallest member.  Points with many children, at most 10,000, are broadcast,
    so no other key of the join has more rows than the larger of 1,000 and a ten-thousandth."""
    bound = max(1000, points.count() // 10_000)
    above = points.select(F.col("id").alias("parent"), F.col("least").alias("parent_least"), "children")
    heavy = F.broadcast(above.filter(F.col("children") >= bound).select("parent", F.col("parent_least").alias("heavy_least")))
    marked = points.join(heavy, "parent", "left")
    done = marked.filter("heavy_least IS NOT NULL OR parent IS NULL").withColumn("parent_least", F.col("heavy_least"))
    light = above.filter(F.col("children") < bound).select("parent", "parent_least")
    rest = marked.filter("heavy_least IS NULL AND parent IS NOT NULL").join(light, "parent")
    return done.unionByName(rest).drop("heavy_least")


def build_trie(sequences: DataFrame) -> DataFrame:
    """The compressed tree of (conv_id, turns: array of hash and size): a row a point, with its ``edge``
    (an entry for each of its nodes from the top, the lengths from there to before the point), depth,
    parent, least, parent_least, n, leaves, children, saved and the digest of its ends."""
    local = stage(local_points(sorted_parts(sequences)), "points")
    sums = [F.sum(c).alias(c) for c in ("n", "total", "fresh", "leaves", "children")]
    firsts = [F.first(c, ignorenulls=True).alias(c) for c in ("parent", "depth", "edge", "above")]
    points = local.groupBy("id").agg(*firsts, F.min("least").alias("least"), *sums)
    saved = F.col("total") - F.col("n") * F.col("above") - F.col("fresh")
    points = points.join(end_digests(local), "id", "left").withColumn("saved", saved)
    return with_parents(stage(points, "tree"))


def expand_nodes(tree: DataFrame) -> DataFrame:
    """A row for each node: unary nodes have their point's members, and their own lengths besides its saving."""
    nodes = tree.select("*", F.posexplode("edge").alias("place", "ahead"))
    last = F.col("place") == F.size("edge") - 1
    parent = F.when(F.col("place") == 0, F.col("parent_least")).otherwise(F.col("least"))
    return nodes.select(
        F.col("least").alias("conv_id"),
        (F.col("depth") - F.size("edge") + 1 + F.col("place")).cast("long").alias("depth"),
        parent.alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + (F.col("n") - 1) * F.col("ahead")).alias("saved_tokens"),
        F.when(last, F.coalesce("sha", F.lit(EMPTY_SHA))).otherwise(EMPTY_SHA).alias("ends_sha256"),
    )


def op13_conversation_trie(turns: DataFrame) -> DataFrame:
    return expand_nodes(build_trie(rebuilt(turns)))


OP13_SQL = """
WITH turned AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS size,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS h
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h, size) AS pos FROM turned
), digits AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s FROM (SELECT DISTINCT conv_id FROM turned)
), bits AS (
  SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT CAST(range AS BIGINT) AS n FROM range(256))
), crc AS (
  SELECT list(v ORDER BY n) AS t FROM bits
), heads AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(s, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) % 6 AS h
  FROM digits, crc
), rebuilt AS (
  SELECT k.conv_id, o.pos, o.h AS hash, o.size, 0 AS part FROM heads k JOIN own o ON o.conv_id = k.conv_id - k.conv_id % 100 AND o.pos <= k.h
  UNION ALL
  SELECT k.conv_id, o.pos, o.h, o.size, 1 FROM heads k JOIN own o ON o.conv_id = k.conv_id AND o.pos > k.h
), paths AS (
  SELECT conv_id, list(hash ORDER BY part, pos) AS path, list(size ORDER BY part, pos) AS sizes FROM rebuilt GROUP BY conv_id
), members AS (
  SELECT k.conv_id, coalesce(path, []) AS path, coalesce(sizes, []) AS sizes FROM heads k LEFT JOIN paths p USING (conv_id)
), prefixes AS (
  SELECT conv_id, d, len(path) AS n, array_to_string(path[1:d], '') AS node, array_to_string(path[1:d - 1], '') AS above,
    CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size
  FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM members)
), nodes AS (
  SELECT node, any_value(CASE WHEN d > 0 THEN above END) AS above, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    any_value(size) AS size, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends
  FROM prefixes GROUP BY node
), children AS (
  SELECT above AS node, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above
), pairs AS (
  SELECT DISTINCT p.node AS top, q.node AS node FROM prefixes p JOIN prefixes q ON p.conv_id = q.conv_id AND q.d >= p.d
), subtrees AS (
  SELECT top, sum((n_convs - 1) * size) AS saved_tokens, count(*) FILTER (WHERE c.node IS NULL) AS n_leaves
  FROM pairs JOIN nodes n ON n.node = pairs.node LEFT JOIN children c ON c.node = pairs.node GROUP BY top
)
SELECT n.conv_id, n.depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN subtrees s ON s.top = n.node LEFT JOIN children c ON c.node = n.node LEFT JOIN nodes a ON a.node = n.above
"""
