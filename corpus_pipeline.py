"""The corpus pipeline: from raw documents to a training mix.

Five stages, each ``(spark, docs, sf_dir) -> DataFrame``. A stage's rows are written as Parquet and
reread as the next one's ``docs``, so a lost executor never costs more than the stage at
hand, and each stage works on all that its predecessor kept:

1. ``quality``: fit the pairwise quality ranking on the labelled documents (operator 2) and
   drop the documents below its threshold.
2. ``line_dedup``: remove passages that stand earlier in the corpus (operator 4). A document
   whose lines all go is a copy and goes with them.
3. ``near_dedup``: keep one document of each component of near-duplicates (operator 5 by its contract: three-word
   shingles, at most 3 differing bits).
4. ``decontaminate``: drop documents that hold a benchmark item (operator 9).
5. ``mix``: sources to target weights along the curriculum (operator 1): a row per copy
   taken, in training order, with ``epoch`` and ``position``.

All but the last return the columns of ``documents``. SQL can't express the classifier, so there is
no ORACLE_SQL; tests hold every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.llm import decontamination, line_dedup, mixing, quality, simhash
from portolan.llm.common import checkpoint, staged, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = quality.training_labels(table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, quality.fit(docs, labels))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, drop_emptied=True)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sized = mixing.sized(docs.drop("size"))
    sources = checkpoint(mixing.source_totals(sized.select("source", "size")))
    return mixing.mix_documents(sized, mixing.cyclic_schedule(sources, mixing.WEIGHTS, mixing.SHAPES))


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_dedup", near_stage),
          ("decontaminate", benchmark_stage), ("mix", mix_stage)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. A stage's rows are deleted when its successor's are written."""
    docs, delete = table(spark, sf_dir, "documents"), None
    for name, function in STAGES:
        docs, later = staged(function(spark, docs, sf_dir), f"pipeline-{name}")
        if delete:
            delete()
        delete = later
    return docs
