"""Exact top-k by inner product: a Voronoi join of queries and data.

A bounded sample of vectors serves as pivots, more of them the more rows there are; every
vector joins the cell of its nearest pivot, and a summary of each cell (rows, radius,
longest vector) goes to the driver, one row a pivot.  A query is first solved in its own
cell, which gives a score it can already reach k times.  For another cell the smaller of
q.p + |q| * radius and |q| * longest bounds every score in it; the query is replicated only
to cells whose bound reaches that score (ties included), and solved there.  Which cells a query asks is kept as
pairs of numbers; its vector is joined where it is solved.  Cells are split
into blocks of bounded rows, so that a vector that a third of all rows share spreads over
many tasks; a cell is replicated as often as the queries that ask for it fill parts of
``query_rows``, and not at all where none asks.

Defined cases: vectors that are null or hold null or non-finite components take no part;
rows without an id neither; only vectors of the same dimension are compared; every row is
a query or candidate of its own, also where ids repeat, and a query skips only its own row;
equal scores go to the smaller vec_id; with fewer than k candidates all are given; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage

EXACT = 2**53


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.int64).reshape(len(column), -1)


def _scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact integer products: in floating point as long as no sum can pass 2**53."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * max(1, queries.shape[1])
    if most < EXACT:
        return np.rint(queries.astype(float) @ data.astype(float).T).astype(np.int64)
    return queries @ data.T


CELL = "rid long, vec_id long, dim int, v array<long>, cell int, radius double, norm double"
ASKED = "query long, query_id long, dim int, cell int"
FOUND = "query long, query_id long, vec_id long, score long"


def _cells(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds the cell of the nearest pivot, the distance to it and the length."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell, radius, norm = np.zeros(len(batch), np.int32), np.zeros(len(batch)), np.zeros(len(batch))
            for dim, rows in batch.groupby("dim").indices.items():
                own = shared.value[dim].astype(float)
                x = _matrix(batch["v"].iloc[rows]).astype(float)
                far = (own * own).sum(1)[None, :] - 2 * x @ own.T
                cell[rows] = far.argmin(1)
                radius[rows] = np.sqrt(((x - own[cell[rows]]) ** 2).sum(1))
                norm[rows] = np.sqrt((x * x).sum(1))
            yield batch.assign(cell=cell, radius=radius, norm=norm)

    return vectors.mapInPandas(assign, CELL)


def solve(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of ``right`` for each row of ``left`` but itself."""
    found = []
    if len(left) and len(right):
        right = right.sort_values("vec_id", kind="stable")
        ids, rows, x = right["vec_id"].to_numpy(), right["rid"].to_numpy(), _matrix(right["v"])
        for at in range(0, len(left), 256):
            some = left.iloc[at : at + 256]
            scores = _scores(_matrix(some["v"]), x)
            for query, query_id, row in zip(some["query"], some["query_id"], scores):
                others = np.flatnonzero(rows != query)
                values = row[others]
                if len(values) > k:
                    least = np.partition(values, len(values) - k)[len(values) - k]
                    others = others[values >= least]
                    values = row[others]
                best = others[np.argsort(-values, kind="stable")[:k]]  # by id among equals, as they are sorted
                found += [(query, query_id, i, s) for i, s in zip(ids[best], row[best])]
    return pd.DataFrame(found, columns=["query", "query_id", "vec_id", "score"]).astype("int64")


def shares(asked: DataFrame, query_rows: int) -> DataFrame:
    """(dim, cell, parts): into how many parts the queries of a cell are cut; at most one row a cell."""
    return asked.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("parts"))


def spread_data(placed: DataFrame, parts: DataFrame, blocks: DataFrame) -> DataFrame:
    """The rows of the cells asked for, in their block, once for each part of their queries."""
    known = parts.join(blocks, ["dim", "cell"])  # at most one row a pivot
    block = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int").alias("block")
    return placed.join(F.broadcast(known), ["dim", "cell"]).select(
        "dim", "cell", block, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "rid", "vec_id", "v"
    )


def spread_queries(asked: DataFrame, parts: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each query once for each block of the cells it asks for."""
    known = parts.join(blocks, ["dim", "cell"])
    part = F.pmod(F.xxhash64("query"), F.col("parts")).cast("int").alias("part")
    return asked.join(F.broadcast(known), ["dim", "cell"]).select(
        "dim", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), part, "query", "query_id"
    )


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    n_pivots: int | None = None,
    block_rows: int = 20_000,
    query_rows: int = 8_192,
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows where ``is_query`` holds, from ``vectors``
    (vec_id, embedding).  By default there are as many pivots as a quarter of the root of the
    rows, 48 to 4096."""
    from pyspark.sql import Window

    spark = vectors.sparkSession
    whole = stage(
        vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
            F.monotonically_increasing_id().alias("rid"), "vec_id", F.size("embedding").alias("dim"), quantised(F.col("embedding"), scale).alias("v")
        ),
        "vectors",
    )
    sizes = {r["dim"]: r["count"] for r in whole.groupBy("dim").count().collect()}
    chosen: dict[int, np.ndarray] = {}
    for dim, n in sizes.items():
        wanted = n_pivots or min(4096, max(48, math.isqrt(n) // 4))
        sample = whole.filter(F.col("dim") == dim).select("v", F.xxhash64("rid").alias("h"))
        rows = sample.orderBy("h").limit(4 * wanted).collect()  # bounded
        chosen[dim] = np.unique(np.array([r["v"] for r in rows], dtype=np.int64).reshape(len(rows), dim), axis=0)
        chosen[dim] = chosen[dim][np.random.default_rng(0).permutation(len(chosen[dim]))[:wanted]]
    placed = stage(_cells(whole, chosen), "cells")
    summary = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("radius").alias("radius"), F.max("norm").alias("norm")).collect()
    cells = {dim: sorted((r["cell"], r["radius"], r["norm"]) for r in summary if r["dim"] == dim) for dim in chosen}
    blocks = spark.createDataFrame(
        [(r["dim"], r["cell"], -(-r["n"] // block_rows)) for r in summary], "dim int, cell int, blocks int"
    )  # one row a pivot
    known = spark.sparkContext.broadcast((chosen, cells))
    queries = placed.filter(is_query).select(F.col("rid").alias("query"), F.col("vec_id").alias("query_id"), "dim", "cell", "v")

    def solved(asked: DataFrame) -> DataFrame:
        parts = stage(shares(asked, query_rows), "shares")
        keys = ["dim", "cell", "block", "part"]
        spread = spread_queries(asked, parts, blocks).toDF(*keys, "query", "query_id")  # columns of its own
        own = queries.select(F.col("query").alias("_query"), F.col("v").alias("_v"))
        left = spread.join(own, F.col("query") == F.col("_query")).select(*keys, "query", "query_id", F.col("_v").alias("v")).groupBy(*keys)
        return left.cogroup(spread_data(placed, parts, blocks).groupBy(*keys)).applyInPandas(lambda x, y: solve(x, y, k), FOUND)

    def elsewhere(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots, summaries = known.value
        tables = {dim: [np.array(x) for x in zip(*own)] for dim, own in summaries.items() if own}
        names = [c.split()[0] for c in ASKED.split(", ")]
        for batch in batches:
            made = []
            for query, query_id, dim, home, v, least in batch[[*names, "v", "least"]].itertuples(index=False):
                numbers, radii, norms = tables[dim]
                q = np.array(v, dtype=float)
                length = np.sqrt(q @ q)
                bound = np.minimum(pivots[dim][numbers].astype(float) @ q + length * radii, length * norms)
                fits = bound + 1e-12 * np.abs(bound) + 1 >= (least if least == least else -np.inf)
                made += [(query, query_id, dim, c) for c in numbers[fits].tolist() if c != home]
            yield pd.DataFrame(made, columns=names).astype({"query": "int64", "query_id": "int64", "dim": "int32", "cell": "int32"})

    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    rank = F.row_number().over(ranked)
    home = stage(solved(queries.drop("v")), "home")
    reached = home.withColumn("rank", rank).filter(F.col("rank") == k).select("query", F.col("score").cast("double").alias("least"))
    asked = stage(queries.join(reached, "query", "left").mapInPandas(elsewhere, ASKED), "asked")
    every = home.unionByName(solved(asked))
    return every.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_exact_topk(vectors: DataFrame) -> DataFrame:
    return top_k(vectors.select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


OP9_SQL = r"""
WITH q AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.rid, a.vec_id AS query_id, b.vec_id,
    list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.rid <> b.rid AND len(a.v) = len(b.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
