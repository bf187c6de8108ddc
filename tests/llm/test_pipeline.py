"""The pipeline's stages, each held against its own input."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from portolan.session import stage
from tests.conftest import SF_SMALL
from tests.llm.helpers import components, simhash


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs, out = P.table(spark, SF_SMALL, "documents"), {}
    for name, function in P.STAGES:
        made = stage(function(spark, docs, SF_SMALL), name)
        out[name] = (docs, made)
        docs = made
    return out


def test_stages_are_the_five_in_order_and_keep_the_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_dedup", "decontaminate", "mix"]
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == stages[name][0].columns
        assert stages[name][1].dtypes == stages[name][0].dtypes


def test_quality_drops_the_bad_and_keeps_the_good(spark, stages):
    docs, kept = stages["quality"]
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    keep = {r.doc_id for r in kept.select("doc_id").collect()}
    marked = [(r.doc_id in keep, r.quality) for r in labels.join(docs, "doc_id").collect()]
    assert sum(k == bool(q) for k, q in marked) >= 0.97 * len(marked)


def test_line_dedup_leaves_no_repeated_window(stages):
    from portolan.llm.line_dedup import KEYS, _windows
    docs, out = stages["line_dedup"]
    repeats = lambda d: _windows(d).groupBy(*KEYS).count().where("count > 1").count()
    assert repeats(docs) > 0 and repeats(out) == 0
    assert out.where(F.length("text") != F.col("n_chars")).count() == 0


def test_near_dedup_keeps_one_of_each_component(stages):
    """Against brute force: fingerprints of three-word shingles, linked at three or fewer differing bits."""
    docs, out = stages["near_dedup"]
    before = docs.orderBy("doc_id").collect()
    prints = [simhash(r.text) for r in before]
    low = components(len(before), [(i, j) for i in range(len(before)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    assert {r.doc_id for r in out.collect()} == {before[i].doc_id for i in low}
    texts = [r.text for r in out.collect()]
    assert len(texts) == len(set(texts))


def test_decontamination_drops_exactly_the_documents_with_items(spark, stages):
    docs, out = stages["decontaminate"]
    norm = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [norm(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaky = {r.doc_id for r in docs.collect() if any(x in norm(r.text) for x in items)}
    kept = {r.doc_id for r in out.collect()}
    assert not leaky & kept and {r.doc_id for r in docs.collect()} - kept == leaky


def test_mix_order_and_run(spark, stages):
    docs, out = stages["mix"]
    rows = out.collect()
    assert {r.epoch for r in rows} <= {0, 1} and {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
    total = sum(r.size for r in docs.withColumn("size", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).collect())
    assert abs(sum(r["size"] for r in rows) - 1.5 * total) < 0.2 * total
    again = P.run(spark, SF_SMALL)
    assert sorted((r.doc_id, r.epoch, r.position) for r in again.collect()) == sorted((r.doc_id, r.epoch, r.position) for r in rows)


def test_stages_take_hard_rows(spark):
    """Nulls, empties and repeated rows go through every stage."""
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", "s", 0), (2, "plain words stand here, and more of them. Yes.", "en", "s", 46),
            (2, "plain words stand here, and more of them. Yes.", "en", "s", 46), (None, "plain words stand there, and other ones. No.", None, None, 44)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, function in P.STAGES:
        for frame in (docs, docs.limit(0)):
            out = function(spark, frame, SF_SMALL).collect()
            assert len(out) <= 2 * len(rows) and (frame is docs or not out)
