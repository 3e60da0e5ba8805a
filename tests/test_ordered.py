"""Deep pages and dealt ids."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from hammerline.operators.ordered import IdCounter, OrderedPages, with_block_ids


def test_pages_equal_the_plain_ones_and_read_few_parts(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 17).alias("v"))
    order = [F.col("v").desc_nulls_last(), F.col("id")]
    pages = OrderedPages(df, order, 16)
    for offset in (0, 7, 1234, 3333, 4990, 5000, 9000):
        assert pages.page(25, offset).collect() == df.orderBy(*order).offset(offset).limit(25).collect()
    assert len(pages.parts_of(25, 3333)) <= 2 and len(pages.before) > 8
    plan = pages.page(25, 3333)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan or "PartitionFilters: [_part" in plan
    assert OrderedPages(df.limit(0), order).page(10).count() == 0


def test_ids_are_consecutive_over_concurrent_batches(spark, tmp_path):
    counter = IdCounter(spark, f"file://{tmp_path}/ids", 100)
    batches = [spark.range(n).repartition(5).select(F.col("id").alias("v")) for n in (300, 1, 0, 450)]
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda b: with_block_ids(b, counter), batches))
    ids = sorted(r["id"] for df in made for r in df.collect())
    assert ids == list(range(100, 851))
    assert sorted(r["v"] for r in made[0].collect()) == list(range(300))
    assert "SinglePartition" not in made[0]._jdf.queryExecution().executedPlan().toString()
