import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hammerline.llm.topk import shares, spread_data, top_k


def brute(rows, mod, k=10):
    data = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(1024 * x) for x in v]
            data.append((i, q))
    out = []
    for own, (i, q) in enumerate(data):
        if i % mod == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for n, (j, v) in enumerate(data) if n != own and len(v) == len(q))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [20_000, 17])
def test_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=6))]) for i in range(300)]
    rows += [(i, [0.5] * 6) for i in range(300, 420)]  # one very common vector
    rows += [(500, None), (600, [1.0, None] + [0.0] * 4), (700, [float("nan")] * 6), (800, [float("inf")] * 6), (900, [1.0, 2.0]), (901, [3.0, 4.0]), (None, [1.0] * 6)]
    rows += [(50, [9.0] * 6), (100, [0.25] * 6), (100, [0.25] * 6), (120, [0.5] * 6)]  # ids that repeat
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("an own column"))
    got = top_k(df, F.col("vec_id") % 50 == 0, n_pivots=8, block_rows=block_rows, query_rows=5 if block_rows == 17 else 8192)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute(rows, 50)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(df, F.col("vec_id") % 100 == 0).count() == 0


def test_cells_are_copied_only_where_asked(spark):
    placed = spark.createDataFrame([(i, i, 2, [1, i], i % 4) for i in range(40)], "rid long, vec_id long, dim int, v array<long>, cell int")
    blocks = spark.createDataFrame([(2, c, 2) for c in range(4)], "dim int, cell int, blocks int")
    asked = spark.createDataFrame([(q, 2, 1) for q in range(25)] + [(1, 2, 3)], "query long, dim int, cell int")
    parts = shares(asked, 10)
    assert {(r["cell"], r["parts"]) for r in parts.collect()} == {(1, 3), (3, 1)}
    rows = spread_data(placed, parts, blocks).collect()
    print("rows into the cogroup:", len(rows), "of", 4 * 4 * 10, "if every cell went to every part")
    assert sorted((r["cell"], r["rid"], r["part"]) for r in rows) == sorted(
        [(1, i, p) for i in range(1, 40, 4) for p in range(3)] + [(3, i, 0) for i in range(3, 40, 4)]
    )
