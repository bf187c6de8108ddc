"""Exact uniqueness of numeric keys from stored bitmaps, a partition (month) at a time.

The keys of a partition are kept as bitmaps, one of 32,768 bits for every bucket of consecutive keys that occurs, with
Spark's own bitmap functions. A new partition is held against the bitmaps of the others: no key of the history is
read or shuffled again, only buckets. Keys should be dense, as running numbers are: a key far from all others costs a bitmap of 4 KB.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def key_bitmaps(df: DataFrame, key: str, partition_by: Sequence[str]) -> DataFrame:
    """``(*partition_by, bucket, seen, n_rows, repeated_keys, repeated_rows)``: per partition and bucket the keys as a bitmap, their rows, and
    the keys (and their rows) that occur more than once in the partition. Null keys are left out. The partitions' own
    keys are shuffled, to be counted and then to their bucket, so that a bitmap is built once, in one task: built in part by every
    task that met some of a bucket's keys, a sparse bucket's bitmap would be shuffled nearly once a key."""
    number = F.col(f"`{key}`").cast("long")
    per_key = df.select(*partition_by, number.alias("_k")).where(F.col("_k").isNotNull()).groupBy(*partition_by, "_k").agg(F.count(F.lit(1)).alias("_n"))
    many = F.when(F.col("_n") > 1, F.col("_n"))
    dealt = per_key.withColumn("bucket", F.bitmap_bucket_number("_k")).repartition(*partition_by, "bucket")
    return dealt.groupBy(*partition_by, "bucket").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_k")).alias("seen"), F.sum("_n").alias("n_rows"),
        F.count(many).alias("repeated_keys"), F.coalesce(F.sum(many), F.lit(0)).alias("repeated_rows"))


def incremental_key_report(new: DataFrame, history: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """``(*partition_by, n_rows, n_keys, repeated_keys, repeated_rows, seen_elsewhere, passed)`` for every partition in ``new`` (:func:`key_bitmaps`):
    rows with a key, distinct keys, keys that repeat inside it, and keys that also occur in an earlier partition of
    ``new`` or anywhere in ``history`` (the bitmaps of all other partitions; leave out those that ``new`` replaces).

    Of ``history`` only the buckets in ``new`` are looked at. A bucket's bitmaps are united in order of partition, history first, and
    ``|A and B| = |A| + |B| - |A or B|``.
    """
    touched = new.select(F.col("bucket").alias("_b")).distinct()
    before = (history.join(touched, F.col("bucket") == F.col("_b"), "left_semi").groupBy("bucket")
              .agg(F.bitmap_or_agg("seen").alias("seen")).withColumn("_new", F.lit(False)))
    rows = new.withColumn("_new", F.lit(True)).unionByName(before, allowMissingColumns=True)
    # A bucket's rows: one for the history and one for every new partition.
    order = Window.partitionBy("bucket").orderBy("_new", *partition_by)
    earlier = F.bitmap_count(F.bitmap_or_agg("seen").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    united = F.bitmap_count(F.bitmap_or_agg("seen").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    own = F.bitmap_count("seen")
    met = rows.select("*", own.alias("_own"), (own + earlier - united).alias("_shared")).where("_new")
    report = met.groupBy(*partition_by).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("_own").alias("n_keys"), F.sum("repeated_keys").alias("repeated_keys"),
        F.sum("repeated_rows").alias("repeated_rows"), F.sum("_shared").alias("seen_elsewhere"))
    return report.withColumn("passed", (F.col("repeated_keys") == 0) & (F.col("seen_elsewhere") == 0))
