"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.session import checkpoint_root, scratch_path

#: White space and words of every operator here: the six ASCII white-space bytes.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through files in the shared checkpoint folder.

    The files go when the last frame that reads them is collected
    (``spark.cleaner.referenceTracking.cleanCheckpoints``). Only narrow rows (ids,
    hashes, counts) are checkpointed by the operators, never texts.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint()


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are done with. It does so when the driver's garbage collectors
    meet them, which on an idle heap may be half an hour away (``spark.cleaner.periodicGC.interval``). Call this
    where large shuffles have just been written off by :func:`staged`; a checkpoint holds on to them until it is read."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def staged(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` written to the shared scratch folder and read back, and what deletes the files. Call it when
    all that reads them has itself been written or checkpointed."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)

    def delete() -> None:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)

    return spark.read.schema(df.schema).parquet(path), delete


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's text, modulo ``divisor`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def utf8(text: Column) -> Column:
    """The text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def byte_rows(batches: Iterator[pa.RecordBatch], column: str = "text",
              limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each slice holds about ``limit`` bytes of ``column``."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            size = size or 0  # null
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)
