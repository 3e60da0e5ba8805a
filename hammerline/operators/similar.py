"""The most similar lots of every lot at once, by the score of ``listings.similar_lots``.

A lot's similar ones share its artist (3), category (2) or price band (1), and go by score, then price.  Whatever
shares artist and category scores more than all else, so a lot whose artist and category have more than ``limit`` lots
is done with these.  Such groups are small as a rule: groups of up to ``LOCAL`` lots are ranked as they stream by.

Other lots are answered by lists, each in the order of price: the lots of the same artist and category,
of the same artist and of the same category, each inside the band and, where that has not enough, outside it; and where these
may not have enough, all lots inside the band.  What stands before a lot in its list scores at least as much, so the best k of
each list hold the best k of all.

A band of a list is a run of places in the group's order of price.  Groups that are asked for, with what asks at the upper
edge of its band between the prices, are sorted across the cluster into parts and stored.  A part is read in its order:
what asks finds its run in the rows behind it, and what lies above its band in the first rows of its group.  Where a
run or a group crosses parts, some rows of the next parts or of those before are handed on; these come to the driver, twice
``limit`` a part.  So a lot moves once for its group and once for each list that is asked for, and answers don't move at all,
but for lots with several lists.  No band is joined by comparison, and the sort splits a group or a price that a third of all
lots share."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.market import Market
from ..sources.versions import new_folder

ALL, ARTIST, CATEGORY, BOTH = range(4)
#: Lots of an artist and category up to which each is compared with each.
LOCAL = 128
#: Rows of a sorted part, about.  Each is a file of one row group, so that one task reads it in its order.
PART = 1_000_000
#: Rows that are answered at a time.
CHUNK = 20_000
#: What a row of a part is: an entry of its list, what asks it (alone, or with other lists), or the end of the part.
MERGED, ALONE, ENTRY, END = range(4)
FOUND = "lot_id string, place int, id string, similarity_score int"
#: Twice the cents that a decimal(12,2) can hold, and a bound of all places in a group's order.
TOP, SPAN = 2 * 10**12, 2**42


def _of(lots: DataFrame, kind: int) -> DataFrame:
    """The lots that belong to a group of the kind.  An unknown artist or category belongs to none."""
    keys = _keys(kind)
    return (lots.dropna(subset=keys) if keys else lots).withColumn("kind", F.lit(kind))


def _keys(kind: int) -> list[str]:
    return {ALL: [], ARTIST: ["a"], CATEGORY: ["c"], BOTH: ["a", "c"]}[kind]


def _group() -> list[Column]:
    kind = F.col("kind")
    return [kind, F.when(kind.isin(ARTIST, BOTH), F.col("a")).alias("ga"), F.when(kind.isin(CATEGORY, BOTH), F.col("c")).alias("gc")]


def _staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    path = new_folder(df.sparkSession, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers with 0 where there are none, and where there are some."""
    return pc.fill_null(column, 0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)


def _heights(twice: np.ndarray, known: np.ndarray | bool = True) -> np.ndarray:
    """Doubled cents as numbers from 0 to SPAN - 1, with unknown ones lowest."""
    return np.where(known, np.clip(twice + TOP + 1, 1, SPAN - 1), 0)


def _runs(start: np.ndarray, end: np.ndarray, first: np.ndarray, last: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first k places of each list, whether they are some and whether they lie in the band.  The list of a group from
    ``first`` to ``last`` is the band from ``start`` to ``end``, then what stands before it and what stands behind it."""
    j = np.arange(k)
    start, end, first, last = (x[:, None] for x in (start, np.maximum(start, end), first, last))
    near = j < end - start
    place = np.where(near, start + j, np.where(j < end - first, first + j - (end - start), first + j))
    return place, j < last - first, near


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where rows in the order of their keys begin a group."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def _batch(found: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(found, names=["lot_id", "place", "id", "similarity_score"])


def _ranking(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def ranked(rows: pa.Table) -> pa.RecordBatch:
        (a, _), (c, _), (f, known), (p, other) = (_numbers(rows[k].combine_chunks()) for k in "acfp")
        ids = rows["id"].combine_chunks()
        bounds = np.append(_starts(a, c), len(a))
        group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        price, base = np.where(other, p, f), (group + 1) * SPAN
        order = base - _heights(2 * f, known)
        start, end = np.searchsorted(order, base - _heights(3 * price)), np.searchsorted(order, base - _heights(price), "right")
        place, some, near = _runs(start, end, bounds[group], bounds[group + 1], limit + 1)
        some &= place != np.arange(len(a))[:, None]
        rank = np.cumsum(some, axis=1)
        row, j = np.nonzero(some & (rank <= limit))
        return _batch([ids.take(pa.array(row)), pa.array(rank[row, j], pa.int32()), ids.take(pa.array(place[row, j])), pa.array(np.where(near[row, j], 6, 5), pa.int32())])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            kept = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            cut = int(_starts(*(kept[k].to_numpy() for k in "ac"))[-1]) if len(kept) else 0
            if cut:
                yield ranked(kept[:cut])
                kept = kept[cut:]
        if kept is not None and len(kept):
            yield ranked(kept)

    return passed


def _parts(spark: SparkSession, n: int) -> int:
    """Parts of n rows: so many that one is sorted in memory whatever the session's number, but no more than the rows need."""
    return max(-(-n // PART), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * 20 // PART)), 1)


def _compared(lots: DataFrame, parts: int, limit: int) -> DataFrame:
    """Answers of lots whose groups of artist and category are small, but have ``limit`` others."""
    ordered = lots.select("a", "c", "f", "p", "id").repartition(parts, "a", "c").sortWithinPartitions("a", "c", F.col("f").desc_nulls_last(), "id")
    return ordered.mapInArrow(_ranking(limit), FOUND)


class _Rows:
    """Rows of a part: groups, doubled cents of entries or threefold ones of what asks, what a row is."""

    def __init__(self, rows: pa.Table):
        self.rows = rows
        self.kind, self.is_a = _numbers(rows["kind"].combine_chunks())[0], _numbers(rows["is"].combine_chunks())[0]
        (self.a, self.has_a), (self.c, self.has_c), (self.v, self.known) = (_numbers(rows[k].combine_chunks()) for k in "acv")
        by_a, by_c = np.isin(self.kind, (ARTIST, BOTH)), np.isin(self.kind, (CATEGORY, BOTH))
        self.starts = _starts(self.kind, np.where(by_a, self.a, 0), np.where(by_c, self.c, 0))

    def group(self, n: int) -> list[int | None]:
        kind = int(self.kind[n])
        return [kind, int(self.a[n]) if kind in (ARTIST, BOTH) else None, int(self.c[n]) if kind in (CATEGORY, BOTH) else None]

    def entries(self, start: int, end: int) -> np.ndarray:
        return start + np.flatnonzero(self.is_a[start:end] == ENTRY)


ROWS = ["kind", "is", "a", "c", "v", "id"]
TYPES = pa.schema([("kind", pa.int32()), ("is", pa.int32()), ("a", pa.int64()), ("c", pa.int64()), ("v", pa.int64()), ("id", pa.string())])
PLACED = pa.schema([*TYPES, ("part", pa.int32()), ("edge", pa.string())])


def _ending(take: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Passes a part on; a last row says how many there are, the part's first and last group, and the first entries of each."""

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        first = last = None
        heads, lasts = [], []
        for batch in batches:
            if not len(batch):
                continue
            rows = _Rows(pa.Table.from_batches([batch]))
            bounds = [*rows.starts, len(batch)]
            some = lambda at, most: rows.rows.take(rows.entries(bounds[at], bounds[at + 1])[:most]).to_pylist()  # noqa: B023, E731
            if first is None:
                first = last = rows.group(0)
            if rows.group(0) == first:
                heads += some(0, take - len(heads))
            for at in sorted({0, len(bounds) - 2}):
                if rows.group(bounds[at]) != last:
                    last, lasts = rows.group(bounds[at]), []
                lasts += some(at, take - len(lasts))
            n += len(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(batch), part), pa.int32()), pa.nulls(len(batch), pa.string())], schema=PLACED)
        if n:
            edge = json.dumps({"first": first, "last": last, "heads": heads, "lasts": lasts})
            end = {"kind": ALL, "is": END, "a": None, "c": None, "v": n, "id": ""}
            yield pa.RecordBatch.from_arrays([*[pa.array([end[k]], TYPES.field(k).type) for k in ROWS], pa.array([part], pa.int32()), pa.array([edge])], schema=PLACED)

    return passed


def _handed(edges: dict[int, dict], take: int) -> dict[int, tuple[list[dict], list[dict]]]:
    """By part: the first entries of its first group in the parts before, and of its last group in the parts behind."""
    heads, tails, parts = {}, {}, sorted(edges)
    before = None, []
    for part in parts:
        edge = edges[part]
        heads[part] = before[1] if before[0] == edge["first"] else []
        whole = edge["first"] == edge["last"]
        before = edge["last"], ((heads[part] if whole else []) + edge["lasts"])[:take]
    behind = None, []
    for part in reversed(parts):
        edge = edges[part]
        tails[part] = behind[1] if behind[0] == edge["last"] else []
        whole = edge["first"] == edge["last"]
        behind = edge["first"], (edge["heads"] + (tails[part] if whole else []))[:take]
    return {part: (heads[part], tails[part]) for part in parts}


def _answering(limit: int, take: int, handed: dict[int, tuple[list[dict], list[dict]]], which: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Answers what asks in parts read in their order: ranked if it asks one list, otherwise all entries with their cents as place."""

    chunk = CHUNK

    def answered(rows: _Rows, head: int, until: int) -> Iterator[pa.RecordBatch]:
        """Answers the rows up to one, some at a time.  Rows start with so many entries that were handed on."""
        entry = rows.is_a == ENTRY
        number = np.cumsum(entry) - entry
        own = np.flatnonzero(entry)
        group = np.repeat(np.arange(len(rows.starts)), np.diff([*rows.starts, len(entry)]))
        bounds = np.append(number, len(own))[np.append(rows.starts, len(entry))]
        order = (group[own] + 1) * SPAN - _heights(rows.v[own], rows.known[own])
        ids = rows.rows["id"].combine_chunks()
        again = np.zeros(len(own), bool)  # an id that stands for several lots of one price counts once in a list
        if take > limit + 1 and len(own) > 1:
            same_id = pc.equal(ids.take(pa.array(own[1:])), ids.take(pa.array(own[:-1]))).to_numpy(zero_copy_only=False)
            again[1:] = same_id & (order[1:] == order[:-1])
        all_asks = head + np.flatnonzero(rows.is_a[head:until] == which)
        for at in range(0, len(all_asks), chunk):
            asks = all_asks[at : at + chunk]
            of, price = group[asks], rows.v[asks] // 3
            end = np.searchsorted(order, (of + 1) * SPAN - _heights(price), "right")
            place, some, near = _runs(number[asks], end, bounds[of], bounds[of + 1], take)
            some &= near | (rows.kind[asks] != ALL)[:, None]
            row, j = np.nonzero(some)
            some[row, j] = pc.not_equal(ids.take(pa.array(own[place[row, j]])), ids.take(pa.array(asks[row]))).to_numpy(zero_copy_only=False)
            if which == ALONE:
                some[row, j] &= ~again[place[row, j]]
                rank = np.cumsum(some, axis=1)
                some &= rank <= limit
            row, j = np.nonzero(some)
            x, y = asks[row], own[place[row, j]]
            same = lambda k, has: (k[x] == k[y]) & has[x] & has[y]  # noqa: B023, E731
            score = 3 * same(rows.a, rows.has_a) + 2 * same(rows.c, rows.has_c) + near[row, j]
            third = pa.array(rank[row, j], pa.int32()) if which == ALONE else pa.array(rows.v[y] // 2, pa.int64(), mask=~rows.known[y])
            yield _batch([ids.take(pa.array(x)), third, ids.take(pa.array(y)), pa.array(score, pa.int32())])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, part, n, head, wanted = None, None, 0, 0, chunk
        for batch in batches:
            ends = np.flatnonzero(batch.column("is").to_numpy() == END)
            start = 0
            for stop in [*ends, len(batch)]:
                piece = pa.Table.from_batches([batch.slice(start, stop - start).select(ROWS)]).cast(TYPES)
                if len(piece):
                    if part is None:
                        part = batch.column("part")[start].as_py()
                        kept = pa.Table.from_pylist(handed[part][0], TYPES)
                        n, head, wanted = 0, len(kept), chunk
                    n, kept = n + len(piece), pa.concat_tables([kept, piece])
                start = stop + 1
                if stop < len(batch):
                    if part != batch.column("part")[int(stop)].as_py() or n != batch.column("v")[int(stop)].as_py():
                        raise RuntimeError(f"part {part} was not read whole and in its order")
                    until = len(kept)
                    yield from answered(_Rows(pa.concat_tables([kept, pa.Table.from_pylist(handed[part][1], TYPES)])), head, until)
                    part = None
                elif part is not None and len(kept) >= wanted:
                    rows = _Rows(kept)
                    begin = int(rows.starts[-1])
                    own = rows.entries(begin, len(kept))
                    until = max(head, int(own[-take])) if len(own) >= take else max(head, begin)
                    if until > head:
                        yield from answered(rows, head, until)
                    firsts = own[own < until][:take]
                    kept, head = pa.concat_tables([kept.take(firsts), kept[until:]]), len(firsts)
                    wanted = max(chunk, 2 * len(kept))
        if part is not None:
            raise RuntimeError(f"part {part} was not read to its end")

    return passed


def _listed(lots: DataFrame, asks: DataFrame, sizes: DataFrame, limit: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Answers of what asks one list, and (lot_id, place, id, similarity_score) with cents as place from the lists of all others.
    No id stands more than ``most`` times in lots."""
    spark, take = lots.sparkSession, (limit + 1) * most  # one may be the lot itself
    asked = asks.select(*_group()).distinct()
    groups = None
    for kind in range(4):
        keys = _keys(kind)
        size = _of(sizes, kind).groupBy("kind", *keys).agg(F.sum("n").alias("n"), F.sum("priced").alias("priced"))
        own = asked.filter(F.col("kind") == kind).select("kind", F.col("ga").alias("a"), F.col("gc").alias("c"))
        own = own.select("kind", *keys).join(size, ["kind", *keys])
        groups = own if groups is None else groups.unionByName(own, allowMissingColumns=True)
    # lots without a price stand last, and outside all bands: they count where there are few others
    groups = _staged(groups.select("kind", F.col("a").cast("long"), F.col("c").cast("long"), "n", ((F.col("priced") < take) & (F.col("kind") != ALL)).alias("thin")), "groups")
    rows = asks.select("kind", F.when(F.col("alone"), ALONE).otherwise(MERGED).alias("is"), "a", "c", (F.coalesce("p", "f") * 3).alias("v"), "id")
    found = {r["kind"]: r["n"] for r in groups.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    kinds, own = [], lots
    for kind in sorted(found):
        if kind != ALL:
            own = own.join(groups.filter(F.col("kind") == kind).select(*_keys(kind), F.col("thin").alias(f"thin_{kind}")), _keys(kind), "left")
        thin = F.col(f"thin_{kind}") if kind != ALL else F.lit(False)
        kinds.append(F.when(thin | (thin.isNotNull() & F.col("f").isNotNull()), kind))
    if kinds:
        own = own.select(F.explode(F.array_compact(F.array(*kinds))).alias("kind"), F.lit(ENTRY).alias("is"), "a", "c", (F.col("f") * 2).alias("v"), "id")
        rows = rows.unionByName(own)

    # the upper edge of a band before equal prices
    order = [*_group(), F.col("v").desc_nulls_last(), F.col("is"), F.col("id")]
    ordered = rows.select(*ROWS).repartitionByRange(_parts(spark, sum(found.values())), *order).sortWithinPartitions(*order)
    shape = ", ".join(f"`{k}` {t}" for k, t in zip(ROWS, ("int", "int", "long", "long", "long", "string"), strict=True)) + ", part int, edge string"
    placed = _staged(ordered.mapInArrow(_ending(take), shape), "sorted", **{"parquet.block.size": str(2**30)})
    handed = _handed({r["part"]: json.loads(r["edge"]) for r in placed.filter("edge IS NOT NULL").select("part", "edge").collect()}, take)
    placed = placed.select(*ROWS, "part")
    return placed.mapInArrow(_answering(limit, take, handed, ALONE), FOUND), placed.mapInArrow(_answering(limit, take, handed, MERGED), FOUND.replace("place int", "place long"))


def similar_lots_all(m: Market, limit: int = 10) -> DataFrame:
    """(lot_id, place, id, similarity_score) for every lot, by score, price and id; lots without any are left out."""
    cents = {c: (F.col(c) * 100).cast("long") for c in ("final_price", "estimated_price_max", "estimated_price_min")}
    price = F.coalesce(*[F.nullif(c, F.lit(0)) for c in cents.values()], F.lit(100_000)).cast("long")
    keys = [F.col("artist_id").cast("long").alias("a"), F.col("category_id").cast("long").alias("c")]
    # f is the final price, p the reference price where it is another
    lots = _staged(m.lots.select("id", *keys, cents["final_price"].alias("f"), F.nullif(price, cents["final_price"]).alias("p")), "lots")
    sizes = _staged(lots.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), F.count("f").alias("priced")), "sizes")

    # groups of artist and category that aren't compared lot by lot: few lots, many, or ids that stand for several
    named = lots.dropna(subset=["a", "c"])
    many = max(LOCAL, limit)
    odd = sizes.dropna(subset=["a", "c"]).filter((F.col("n") <= limit) | (F.col("n") > many)).select("a", "c", (F.col("n") > many).alias("enough"))
    parts = _parts(lots.sparkSession, sizes.agg(F.sum("n")).first()[0] or 0)
    repeated = _staged(lots.select(F.xxhash64("id").alias("h")).repartition(parts, "h").groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated")
    most = repeated.agg(F.max("n")).first()[0] or 1
    if most > 1:
        again = named.withColumn("h", F.xxhash64("id")).join(repeated, "h", "left_semi").select("a", "c", F.lit(False).alias("enough"))
        odd = odd.unionByName(again).groupBy("a", "c").agg(F.bool_and("enough").alias("enough"))
    odd = _staged(odd, "odd")
    compared = _compared(named.join(odd, ["a", "c"], "left_anti"), parts, limit)

    # lots that may find fewer than limit by artist or category: both have few, or none is known
    few = lots.filter("a IS NULL OR c IS NULL").unionByName(named.join(odd.filter("NOT enough"), ["a", "c"], "left_semi").select(lots.columns))
    for key in "ac":
        small = sizes.dropna(subset=[key]).groupBy(key).agg(F.sum("n").alias("n")).filter(F.col("n") < (limit + 1) * most)
        small = _staged(small.select(key, F.lit(True).alias(f"small_{key}")), "small")
        few = few.join(small, key, "left").withColumn(f"small_{key}", F.col(key).isNull() | F.col(f"small_{key}").isNotNull())
    enough = named.join(odd.filter("enough"), ["a", "c"], "left_semi").withColumn("alone", F.lit(True))
    a, c = F.col("a").isNotNull(), F.col("c").isNotNull()
    kinds = F.array(*[F.when(which, kind) for kind, which in ((BOTH, a & c), (ARTIST, a), (CATEGORY, c), (ALL, F.col("small_a") & F.col("small_c")))])
    few = few.withColumn("kinds", F.array_compact(kinds)).withColumn("alone", F.size("kinds") == 1)
    if most > 1:  # lots that share an id share an answer
        few = few.withColumn("h", F.xxhash64("id")).join(repeated.select("h", F.lit(True).alias("shared")), "h", "left").withColumn("alone", F.col("alone") & F.col("shared").isNull())
    few = _staged(few.select(*lots.columns, "kinds", "alone"), "few")
    asks = _of(enough, BOTH).unionByName(few.withColumn("kind", F.explode("kinds")).drop("kinds"))
    alone, each = _listed(lots, asks, sizes, limit, most)
    each = each.groupBy("lot_id").agg(F.collect_set(F.struct((-F.col("similarity_score")).alias("score"), F.col("place").isNull().alias("none"), (-F.col("place")).alias("price"), "id")).alias("best"))
    each = each.select("lot_id", F.posexplode(F.slice(F.array_sort("best"), 1, limit)).alias("at", "r"))
    merged = each.select("lot_id", (F.col("at") + 1).alias("place"), F.col("r.id").alias("id"), (-F.col("r.score")).alias("similarity_score"))
    return compared.unionByName(alone).unionByName(merged)
