"""Operator 1: mixing sources to target weights along a curriculum.

Every source has a weight schedule: a piecewise-linear weight over the training clock
``t`` in [0, 1]. The schedule's integral is the source's share of the mix, so targets come
from the integrals (water-filled under a cap of ``max_epochs`` passes over a source), and
the cumulative demand of a source at clock ``t`` is ``target * W(t) / W(1)``. A document
that stands at token ``x`` of its source's (pseudo-random, repeatable) order is needed when
the cumulative demand reaches ``x``; inverting the demand gives its training position, and
the mix is the range sort of all copies by that position.

Built-in functions only. The order inside a source needs a running sum; one source may
hold most rows, so it is taken in two steps: sums of small hash buckets, a running sum over
the buckets, and a running sum inside each bucket.

Defined results: a null text has size 0; null is a source of its own, after all others; rows
of equal id and size are interchangeable copies and each is mixed; an empty table gives an
empty mix; a source without words has target 0. Extra columns ride along; columns named
like a result (``source_size``, ``target``, ``copies``, ``taken``, ``position``) are
replaced, and ``size`` is the caller's own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm.common import checkpoint, word_count
from portolan.session import stage

RESULTS = ("source_size", "target", "copies", "taken", "position")


def source_totals(docs: DataFrame, size: str = "size") -> DataFrame:
    """One row per source: ``source``, ``n_docs``, ``source_size``, ``rank`` by code point, null last.

    The rank is a window over the sources alone (one row each), never over documents.
    """
    totals = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"),
                                        F.sum(size).cast("long").alias("source_size"))
    return totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)


def cyclic_schedule(totals: DataFrame, weights: Sequence[float], shapes: Sequence[tuple[float, float]]) -> DataFrame:
    """Schedule knots ``(source, t, weight)``: the source of rank ``r`` runs linearly from
    ``weights[r % k] * shape[0]`` to ``weights[r % k] * shape[1]``."""
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]),
                                       (F.col("rank") % len(values) + 1).cast("int"))
    base = pick(weights)
    knots = F.array(F.struct(F.lit(0.0).alias("t"), (base * pick([s[0] for s in shapes])).alias("weight")),
                    F.struct(F.lit(1.0).alias("t"), (base * pick([s[1] for s in shapes])).alias("weight")))
    return totals.select("source", F.inline(knots))


def integrate(schedule: DataFrame) -> DataFrame:
    """Per source: ``weight`` (the schedule's integral) and ``segments``, each with its start
    ``t0``, length ``dt``, end weights ``w0``, ``w1`` and the integral ``c0`` before it."""
    by_time = Window.partitionBy("source").orderBy("t")
    steps = (schedule.withColumn("dt", F.lead("t").over(by_time) - F.col("t"))
             .withColumn("w1", F.lead("weight").over(by_time))
             .where("dt > 0")
             .withColumn("area", (F.col("weight") + F.col("w1")) / 2 * F.col("dt")))
    before = Window.partitionBy("source").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("c0", F.coalesce(F.sum("area").over(before), F.lit(0.0)))
    segment = F.struct(F.col("c0"), F.col("t").alias("t0"), "dt", F.col("weight").alias("w0"), "w1", "area")
    return steps.groupBy("source").agg(F.sum("area").alias("weight"),
                                       F.sort_array(F.collect_list(segment)).alias("segments"))


def targets(totals: DataFrame, share: float, max_epochs: int) -> DataFrame:
    """Add ``target``: ``share`` of all words split by ``weight``, at most ``max_epochs`` times a
    source's words, the excess going to the others by weight until none is above.

    With the sources in the order of cap / weight, a source is capped while the level that
    the later ones would share is above its own ratio; the first one that is not fixes the
    level for all others.
    """
    order = [F.col("ratio"), F.col("rank")]
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = (F.col("source_size") * max_epochs).cast("double")
    levels = (totals.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
              .withColumn("demand", F.sum("source_size").over(everything) * F.lit(share))
              .withColumn("level", (F.col("demand") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
                          / F.sum("weight").over(onward))
              .withColumn("level", F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")),
                                            F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank"))).over(everything)))
    return (levels.withColumn("target", F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")))
            .drop("cap", "ratio", "level"))


def clock(done: Column, segments: Column) -> Column:
    """Invert the integral: the clock at which a schedule has done the fraction ``done`` of its weight."""
    whole = F.get(segments, F.size(segments) - 1)
    x = done * (whole["c0"] + whole["area"])
    last = F.filter(segments, lambda s: s["c0"] <= x)
    s = F.get(last, F.size(last) - 1)
    rest = x - s["c0"]
    slope = (s["w1"] - s["w0"]) / s["dt"]
    below = s["w0"] + F.sqrt(F.greatest(s["w0"] * s["w0"] + slope * rest * 2, F.lit(0.0)))
    return F.when(rest > 0, s["t0"] + F.least(rest * 2 / below, s["dt"])).otherwise(s["t0"])


def plan_mix(docs: DataFrame, schedule: DataFrame, share: float = 1.5, max_epochs: int = 2,
             size: str = "size", bucket_rows: int = 1000) -> DataFrame:
    """One row per document: its columns, ``source_size``, ``target``, ``copies``, ``taken``
    (words taken, repeats counted), ``source_clock`` pieces and ``position`` (training
    position of the first copy in tokens, null if the mix takes none).

    ``docs`` needs ``doc_id``, ``source`` and the ``size`` column. A target of e passes and a
    rest takes every document e times and, once more, the documents whose middle lies inside
    the rest, so a source's words differ from its target by half a document at most.
    """
    row, n = F.struct(*[c for c in docs.columns if c not in RESULTS]), F.col("__size")
    keyed = docs.select(row.alias("__row"), F.col("source").alias("__source"),
                        F.col(size).cast("long").alias("__size"),
                        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("__key"))
    totals = source_totals(docs, size)
    planned = stage(targets(totals.join(integrate(schedule).withColumnRenamed("source", "__s"),
                                        F.col("source").eqNullSafe(F.col("__s"))).drop("__s"),
                            share, max_epochs), "mix-sources")
    # One row per source, read from a table of known size: the planner broadcasts it or, with
    # very many sources, joins by shuffle and splits the hot ones.
    placed = (keyed.join(planned.withColumnRenamed("source", "__s"), F.col("__source").eqNullSafe(F.col("__s")))
              .withColumn("__buckets", F.greatest(F.ceil(F.col("n_docs") / bucket_rows), F.lit(1)))
              .withColumn("__bucket", F.floor(F.conv(F.substring("__key", 1, 8), 16, 10).cast("double")
                                              * F.col("__buckets") / 4294967296.0).cast("long")))
    key = [F.col("rank"), F.col("__bucket")]
    sums = checkpoint(placed.groupBy("rank", "__bucket").agg(F.sum("__size").alias("__sum")))
    before = Window.partitionBy("rank").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("rank").alias("__r"), F.col("__bucket").alias("__b"),
                          F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    inside = (Window.partitionBy(*key).orderBy("__key", "__size")
              .rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("__offset") + F.coalesce(F.sum("__size").over(inside), F.lit(0))
    total, target = F.col("source_size"), F.col("target")
    passes = F.when(total > 0, F.floor(target / total)).otherwise(0).cast("long")
    rest = target - F.col("__passes") * total
    middle = F.col("__start") + n / 2.0
    return (placed.join(offsets, (F.col("rank") == F.col("__r")) & (F.col("__bucket") == F.col("__b")))
            .withColumn("__start", start).withColumn("__passes", passes)
            .withColumn("copies", (F.col("__passes") + F.when((n > 0) & (middle < rest), 1).otherwise(0)).cast("int"))
            .withColumn("copies", F.when(n > 0, F.col("copies")).otherwise(0))
            .withColumn("taken", (n * F.col("copies")).cast("long"))
            .withColumn("__done", F.when(F.col("copies") > 0, F.least(F.col("__start") / target, F.lit(1.0))))
            .withColumn("position", clock(F.col("__done"), F.col("segments")) * F.col("demand"))
            .select("__row.*", "source_size", "target", "copies", "taken", "position",
                    F.col("segments").alias("__segments"), F.col("demand").alias("__demand"),
                    F.col("__start")))


def mix_documents(docs: DataFrame, schedule: DataFrame, share: float = 1.5, max_epochs: int = 2,
                  size: str = "size") -> DataFrame:
    """The mix itself: one row per copy that is taken, with ``epoch`` and ``position``, range-sorted
    by position."""
    plan = plan_mix(docs, schedule, share, max_epochs, size).where(F.col("copies") > 0)
    copies = plan.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    done = F.least((F.col("__start") + F.col("epoch") * F.col("source_size")) / F.col("target"), F.lit(1.0))
    return (copies.withColumn("position", clock(done, F.col("__segments")) * F.col("__demand"))
            .drop("__segments", "__demand", "__start", "copies", "taken", "source_size", "target")
            .orderBy("position", "doc_id", "epoch"))


#: Weights by rank of the source, repeating, and the course of each: early, level, late.
WEIGHTS = (5.0, 2.0, 1.0)
SHAPES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", word_count(F.col("text")))


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Contract query of operator 1."""
    from portolan.llm.common import table

    docs = checkpoint(sized(table(spark, sf_dir, "documents")).select("doc_id", "source", "size"))
    plan = plan_mix(docs, cyclic_schedule(source_totals(docs), WEIGHTS, SHAPES))
    return (plan.select("doc_id", "size", "source_size", "target", "taken", "copies", "position")
            .orderBy("position", "doc_id"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s0),
s2 AS (SELECT *, CAST([5, 2, 1][rank % 3 + 1] AS DOUBLE) AS weight,
              CAST([1.5, 1.0, 0.5][rank % 3 + 1] AS DOUBLE) AS a, CAST([0.5, 1.0, 1.5][rank % 3 + 1] AS DOUBLE) AS b,
              CAST(source_size * 2 AS DOUBLE) AS cap FROM s1),
s3 AS (SELECT *, cap / weight AS ratio, CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) AS demand FROM s2),
s4 AS (SELECT *, (demand - coalesce(sum(cap) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY ratio, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s3),
s5 AS (SELECT (SELECT level FROM s4 WHERE level <= ratio ORDER BY ratio, rank LIMIT 1) AS level),
s AS (SELECT s4.source, rank, source_size, weight * a AS w0, weight * b AS w1, weight AS area, demand,
             coalesce(least(cap, s5.level * weight), cap) AS target FROM s4, s5),
r AS (SELECT d.*, s.* EXCLUDE (source),
             coalesce(sum(size) OVER (PARTITION BY rank ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
c AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM r),
e AS (SELECT *, CAST(CASE WHEN size = 0 THEN 0 ELSE passes + CASE WHEN CAST(start AS DOUBLE) + size / 2.0::DOUBLE
             < target - passes * source_size THEN 1 ELSE 0 END END AS INTEGER) AS copies FROM c),
f AS (SELECT *, CASE WHEN copies > 0 THEN least(CAST(start AS DOUBLE) / target, 1.0::DOUBLE) END * area AS rest FROM e)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, copies,
       CASE WHEN rest > 0 THEN least(rest * 2 / (w0 + sqrt(greatest(w0 * w0 + (w1 - w0) * rest * 2, 0.0::DOUBLE))), 1.0::DOUBLE)
            WHEN rest IS NOT NULL THEN 0.0::DOUBLE END * demand AS position
FROM f"""
