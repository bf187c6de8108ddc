"""Operator 2: quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a linear function of its text's features, and the probability that
document i is preferred to j is ``sigmoid(strength_i - strength_j)``. The weights minimise
the logistic loss on feature differences of preference pairs (a good document against a bad
one), by Newton steps whose gradient and Hessian are one aggregation each. The threshold is
the quantile of the labelled strengths that splits them as the labels do, and a document's
score is its probability of being preferred to a document at the threshold.

The model is fitted on all labelled documents. Their features are narrow rows, joined with the labels after the texts are
counted, so no text is shuffled; ranks and the threshold come from range-partitioned sorts (:func:`numbered`). Features and scores
cover every document and its whole text. Features come from the text alone.

Defined results: null and empty texts have the features of no characters and the score that follows from them;
labels other than 0 and 1 are ignored, the larger label wins where an id is labelled twice; a repeated
row is scored each time; without labels of both kinds every score is 0.5. An empty table gives
an empty result. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import SPACE, checkpoint, remainder, staged, table
from portolan.session import stage

FEATURES = ("log_words", "word_length", "letters", "capitals", "digits", "marks", "symbols", "exclaim",
            "distinct", "stop_share", "line_words", "symbol_words")


def counted(docs: DataFrame) -> DataFrame:
    """Add what is counted in the text, a column per count, so that each count is taken once.

    Characters of a class are counted by the length that goes when their runs are taken out.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    length, parts = F.length(t), F.split(t, f"{SPACE}+")
    runs = lambda pattern: (length - F.length(F.regexp_replace(t, f"{pattern}+", ""))).cast("double")
    one = lambda char: (length - F.length(F.replace(t, F.lit(char), F.lit("")))).cast("double")
    matches = lambda pattern: F.regexp_count(t, F.lit(pattern)).cast("double")
    return docs.withColumns({
        "__q_length": length.cast("double"),
        "__q_words": (F.size(parts) - (F.get(parts, F.lit(0)) == "").cast("int")
                      - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")).cast("double"),
        "__q_distinct": F.size(F.array_distinct(parts)).cast("double"),
        "__q_blanks": runs(SPACE), "__q_letters": runs(r"\p{L}"), "__q_capitals": runs(r"\p{Lu}"), "__q_digits": runs(r"\p{Nd}"),
        "__q_marks": runs(r"[.,;:'\"-]"), "__q_exclaim": one("!"), "__q_stops": matches(f"[.!?](?={SPACE}|$)"), "__q_feeds": one("\n"),
        "__q_symbols": matches(rf"[#*$%&|=<>{{}}~^_+\\]+(?={SPACE}|$)")})


def features() -> list[Column]:
    """The features, in the order of ``FEATURES``, from the counts of ``counted``."""
    length, words, distinct, blanks, letters, capitals, digits, marks, exclaim, stops, feeds, symbols = (
        F.col(f"__q_{c}") for c in ("length", "words", "distinct", "blanks", "letters", "capitals", "digits", "marks",
                                    "exclaim", "stops", "feeds", "symbols"))
    n, w = F.greatest(length, F.lit(1.0)), F.greatest(words, F.lit(1.0))
    return [F.log1p(words), (length - blanks) / w, letters / n, capitals / F.greatest(letters, F.lit(1.0)), digits / n, marks / n,
            (length - blanks - letters - digits - marks) / n, exclaim / n, F.log(distinct + 1) / F.log(words + 2), stops / w,
            F.log1p(words / (feeds + 1)), symbols / w]


@dataclass(frozen=True)
class BradleyTerry:
    """Weights over standardised features, and the strength at the threshold."""

    weights: tuple[float, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    threshold: float

    def strength(self, x: list[Column]) -> Column:
        total = F.lit(0.0)
        for f, w, m, s in zip(x, self.weights, self.means, self.scales, strict=True):
            total = total + (f - F.lit(m)) * F.lit(w / s)
        return total

    def score(self, x: list[Column]) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(self.threshold) - self.strength(x)))


def known_features() -> list[Column]:
    """The columns ``x0``.. of :func:`text_features`."""
    return [F.col(f"x{k}") for k in range(len(FEATURES))]


def text_features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the features ``x0``.. of every document."""
    return counted(docs.select("doc_id", "text")).select("doc_id", *[x.alias(f"x{k}") for k, x in enumerate(features())])


def labelled_features(featured: DataFrame, labels: DataFrame, max_train: int | None = None) -> DataFrame:
    """``doc_id``, ``label`` and features of the labelled documents among ``featured`` (:func:`text_features`); with ``max_train``
    at most so many ids, those of the smallest hash."""
    chosen = (labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").alias("__id")).agg(F.max("label").cast("int").alias("label")))
    if max_train is not None:
        chosen = chosen.orderBy(F.xxhash64("__id"), "__id").limit(max_train)
    return featured.join(chosen, F.col("doc_id") == F.col("__id")).select("doc_id", "label", *known_features())


def labelled_sample(docs: DataFrame, labels: DataFrame, max_train: int | None = None) -> DataFrame:
    """:func:`labelled_features` of documents as they are."""
    return labelled_features(text_features(docs), labels, max_train)


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``__i``, a row's place (from 0) in the ``order``. The rows are sorted in ranges, one a task; a count per range passes the driver."""
    number = F.monotonically_increasing_id()  # the task's number and, in the last 33 bits, the row's place in it
    placed = checkpoint(rows.repartitionByRange(*order).sortWithinPartitions(*order)).select(
        "*", F.shiftright(number, 33).cast("int").alias("__range"), number.bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"))
    before, starts = 0, {}
    for r in placed.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).orderBy("__range").collect():
        starts[r["__range"]] = before
        before += r["n"]
    start = F.get(F.array(*[F.lit(starts.get(k, 0)).cast("long") for k in range(max(starts, default=0) + 1)]), F.col("__range"))
    return placed.withColumn("__i", F.col("__at") + start).drop("__range", "__at")


def preference_pairs(sample: DataFrame, scaled: list[Column], partners: int) -> DataFrame:
    """Differences ``d0``.. of the ``scaled`` features of a good and a bad document: every row of the larger class
    meets ``partners`` rows of the other, dealt round-robin in order of the ids' hash."""
    z = [f"z{k}" for k in range(len(scaled))]
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    placed = numbered(sample.select("doc_id", "label", *[x.alias(c) for c, x in zip(z, scaled, strict=True)]),
                      [F.col("label"), F.xxhash64("doc_id"), F.col("doc_id"), *map(F.col, z)])
    ranked = placed.select("label", (F.col("__i") - F.when(F.col("label") == 1, F.lit(sizes[0])).otherwise(F.lit(0))).alias("i"), *z)
    many = 1 if sizes[1] >= sizes[0] else 0
    few, sign = sizes[1 - many], 1.0 if many == 1 else -1.0
    left = ranked.where(F.col("label") == many).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(partners - 1))))
    left = left.withColumn("j", (F.col("i") * partners + F.col("k") * (1 + few // partners)) % few).alias("a")
    right = ranked.where(F.col("label") == 1 - many).withColumnRenamed("i", "j").alias("b")
    return left.join(right, "j").select(*[((F.col(f"a.{c}") - F.col(f"b.{c}")) * sign).alias(f"d{k}") for k, c in enumerate(z)])


def fit(docs: DataFrame, labels: DataFrame, max_train: int | None = None, partners: int = 4, ridge: float = 1e-3,
        steps: int = 20) -> BradleyTerry:
    """Learn from ``labels`` (``doc_id``, ``label``) which texts are preferred: from all of them, unless ``max_train`` says how many."""
    return fit_features(text_features(docs), labels, max_train, partners, ridge, steps)


def fit_features(featured: DataFrame, labels: DataFrame, max_train: int | None = None, partners: int = 4, ridge: float = 1e-3,
                 steps: int = 20) -> BradleyTerry:
    """:func:`fit` on the features of the documents."""
    sample, delete = staged(labelled_features(featured, labels, max_train), "labelled")
    try:
        return _fitted(sample, partners, ridge, steps)
    finally:
        delete()


def _fitted(sample: DataFrame, partners: int, ridge: float, steps: int) -> BradleyTerry:
    size, known = len(FEATURES), known_features()
    stats = sample.agg(F.count(F.lit(1)).alias("n"), F.sum(F.lit(1) - F.col("label")).alias("bad"),
                       *[F.avg(x).alias(f"m{k}") for k, x in enumerate(known)],
                       *[F.stddev_pop(x).alias(f"s{k}") for k, x in enumerate(known)]).first()
    if not stats["n"] or not 0 < stats["bad"] < stats["n"]:
        return BradleyTerry((0.0,) * size, (0.0,) * size, (1.0,) * size, 0.0)
    means = [stats[f"m{k}"] for k in range(size)]
    scales = [stats[f"s{k}"] or 1.0 for k in range(size)]
    scaled = [(x - F.lit(m)) / F.lit(v) for x, m, v in zip(known, means, scales, strict=True)]
    pairs = checkpoint(preference_pairs(sample, scaled, partners))
    d, weights = [F.col(f"d{k}") for k in range(size)], np.zeros(size)
    upper = [(i, j) for i in range(size) for j in range(i, size)]
    for _ in range(steps):
        margin = sum((x * F.lit(float(w)) for x, w in zip(d, weights, strict=True)), F.lit(0.0))
        lost = F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("m")))  # probability of the other order
        curve = F.col("p") * (1 - F.col("p"))
        row = (pairs.withColumn("m", margin).withColumn("p", lost).withColumn("c", curve)
               .agg(F.count(F.lit(1)), *[F.sum(F.col("p") * x) for x in d], *[F.sum(F.col("c") * d[i] * d[j]) for i, j in upper])
               .first())
        n, gradient = row[0], np.array(row[1:1 + size]) / row[0] - ridge * weights
        hessian = np.zeros((size, size))
        for (i, j), v in zip(upper, row[1 + size:], strict=True):
            hessian[i, j] = hessian[j, i] = v / n
        step = np.linalg.solve(hessian + ridge * np.eye(size), gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    model = BradleyTerry(tuple(map(float, weights)), tuple(means), tuple(scales), 0.0)
    # The quantile that leaves as many labelled documents below as are labelled bad: half-way
    # between the two strengths on either side of that rank.
    bad = int(stats["bad"])
    strengths = numbered(sample.select(model.strength(known).alias("s")), [F.col("s")])
    threshold = strengths.where(F.col("__i").between(bad - 1, bad)).agg(F.avg("s")).first()[0]
    return BradleyTerry(model.weights, model.means, model.scales, float(threshold))


def quality_scores(docs: DataFrame, model: BradleyTerry) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every document."""
    return score_features(text_features(docs), model)


def score_features(featured: DataFrame, model: BradleyTerry) -> DataFrame:
    """:func:`quality_scores` from the features of the documents."""
    return (featured.select("doc_id", model.score(known_features()).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def keep_good(docs: DataFrame, model: BradleyTerry) -> DataFrame:
    """The documents at or above the threshold, all columns.

    The row and its score go through one generated row, so the filter stays above the counts and they
    are taken once per text.
    """
    scored = F.struct(F.struct(*docs.columns).alias("row"), model.score(features()).alias("score"))
    return counted(docs).select(F.inline(F.array(scored))).where("score >= 0.5").select("row.*")


def training_labels(labels: DataFrame) -> DataFrame:
    """The quality labels one may learn from: crc32 of the id modulo 3 is not 1."""
    return labels.where(remainder(F.col("doc_id"), 3) != 1).select("doc_id", F.col("quality").alias("label"))


def op2_quality_scores(spark, sf_dir: str) -> DataFrame:
    """Contract query of operator 2."""
    featured = stage(text_features(table(spark, sf_dir, "documents")), "features")  # narrow rows; each text is counted once
    model = fit_features(featured, training_labels(table(spark, sf_dir, "labels")))
    return score_features(featured, model).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")
