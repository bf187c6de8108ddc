"""Findings of round 3: the whole corpus is learned from, however large it is."""

import math
import zlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from portolan.llm import quality
from portolan.llm.queries import QUERIES
from tests.llm.helpers import docs_frame


def test_op2_learns_from_every_labelled_document(spark):
    """21,000 labelled documents, those of the largest hash with long texts: all of them make the means."""
    ids = spark.range(21_000).withColumn("rank", F.row_number().over(Window.orderBy(F.xxhash64("id"))))
    text = F.when(F.col("rank") > 20_000, F.repeat(F.lit("many words "), 200)).otherwise(F.concat(F.lit("word! "), F.repeat(F.lit("a"), (F.col("id") % 9).cast("int"))))
    docs = ids.select(F.col("id").alias("doc_id"), text.alias("text"))
    labels = ids.select(F.col("id").alias("doc_id"), (F.col("id") % 3 != 0).cast("int").alias("label"))
    model = quality.fit(docs, labels, steps=2)
    short = sum(math.log1p(1 + (i % 9 > 0)) for i in [r.id for r in ids.where("rank <= 20000").collect()])
    assert math.isclose(model.means[0], (short + 1_000 * math.log1p(400)) / 21_000, rel_tol=1e-9)


def test_numbered_gives_the_place_in_the_order(spark):
    rows = spark.range(1000).select(F.xxhash64("id").alias("h"), (F.col("id") % 7).alias("c"))
    found = quality.numbered(rows.repartition(5), [F.col("c"), F.col("h")])
    want = {(r.c, r.h): i for i, r in enumerate(sorted(rows.collect(), key=lambda r: (r.c, r.h)))}
    assert {(r.c, r.h): r["__i"] for r in found.collect()} == want
    assert quality.numbered(rows.limit(0), [F.col("h")]).count() == 0


def test_op3_keeps_strings_that_occur_twice_in_a_large_corpus(spark, tmp_path):
    """4.5 million tokens: a pair of words that occurs twice is still learned."""
    learned = [i for i in range(2_000) if zlib.crc32(str(i).encode()) % 7 != 2]
    common = " ".join(f"w{k * 7919 % 13}" for k in range(9_000))
    rows = [(i, common) for i in learned[:500]] + [(i, "alpha beta") for i in learned[500:502]]
    docs_frame(spark, rows).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    scored = {r.doc_id: r for r in QUERIES["op3_suffix_tree"](spark, str(tmp_path)).collect()}
    probe = scored[learned[500]]
    assert probe.train_tokens > 4_000_000 and probe.score - probe.base_score > 4
