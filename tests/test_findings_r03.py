"""Findings of round 3: what a task holds and shuffles does not grow with the input."""

from pyspark.sql import functions as F

from portolan.operators.uniqueness import key_bitmaps
from portolan.session import sized_shuffles


def test_a_bitmap_is_built_in_one_task(spark):
    """No part of a bitmap is shuffled: above the shuffle to the buckets there is no other."""
    df = spark.range(0, 400_000, 97).select(F.col("id").alias("k"), (F.col("id") % 5).cast("int").alias("month"))
    maps = key_bitmaps(df, "k", ["month"])
    plan = maps._jdf.queryExecution().executedPlan().toString().split("Exchange")[0]
    assert "bitmap_construct_agg" in plan and "partial_bitmap_construct_agg" in plan
    assert maps.agg(F.sum(F.bitmap_count("seen"))).first()[0] == df.count()


def test_sized_shuffles_follow_the_input(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100_000).repartition(3).write.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "rows").iterdir() if f.suffix == ".parquet")
    number = "spark.sql.shuffle.partitions"
    before = spark.conf.get(number)
    with sized_shuffles(spark, [path], per_partition=10_000):
        assert int(spark.conf.get(number)) >= size // 10_000 > int(before)
    with sized_shuffles(spark, [path]):
        assert spark.conf.get(number) == before
    assert spark.conf.get(number) == before
