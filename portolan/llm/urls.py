"""Operator 6: URL filter: host and path rules first, then logistic regression on hashed
character n-grams of host and path.

Rules name a host and a path prefix; a rule fits its host and all subdomains. The list of
rules is a small fixed parameter and becomes one CASE expression, longest rule first. URLs
without a rule are judged by a logistic regression that is trained from a small labelled URL
table by full-batch gradient descent: each step is a Spark job over that table, the driver
holds the weight vector only, whose length is the parameter ``dims``. In scoring, the
weights are one array literal and every URL is scored in place: no shuffle, no join.

Built-in functions only. Defined results: a null URL, or one without ``://``, has empty host and
path, fits no rule and is judged by the model on no n-grams (its bias); repeated rows are judged each; an
empty table gives an empty result; other columns are not read. With an empty labelled table
the model knows nothing and allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.llm.common import lower_ascii, table

Rule = tuple[str, str, str]  # verdict, host, path prefix

#: The contract's rules.
RULES: tuple[Rule, ...] = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
                           ("allow", "com", "/fr/"), ("block", "com", "/de/"))

# A small labelled URL table, written by hand: what a crawl's owner marks as spam, advertising or adult, and
# ordinary sites; none of the names stands in the test tables. Schemes, prefixes and page paths are combined with every
# name so that neither label owns them.
BLOCKED = ("casino-royal", "casino-bonus", "online-casino", "lucky-casino", "sports-bets", "live-bets", "best-bets", "bet-now",
           "ads-click", "web-ads", "ad-track", "user-track", "click-track", "spam-link", "seo-spam", "spam-mail", "link-farm",
           "click-farm", "cheap-meds", "buy-pills", "pills-shop", "diet-pills", "cheap-loans", "adult-cams", "adult-zone",
           "xxx-adult", "adult-films", "adult-chat", "free-porn", "free-spins", "win-cash", "big-win", "poker-win")
ALLOWED = ("wikipedia", "library", "university", "museum", "weather", "journal", "gardening", "recipes", "history",
           "science", "newspaper", "football", "travel", "parliament", "hospital", "theatre", "railway", "software",
           "mathematics", "cathedral", "botanic-garden", "open-source", "local-news", "city-council",
           "brother", "author", "nation", "fiction", "running", "northern", "theory", "leather")
PAGES = ("/en/17.html", "/de/240/", "/fr/8?page=2", "/es/913", "/en/402#top")
PREFIXES = ("", "www.", "m.", "blog.")
ENDS = ("example.com", "example.net", "example.org")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``(url, label)``: label 1 is to be blocked. Bounded: names x prefixes, one path and end each, in turn."""
    rows = [(f"http://{prefix}{name}.{ENDS[(i + j) % len(ENDS)]}{PAGES[(i + j) % len(PAGES)]}", label)
            for label, names in ((1, BLOCKED), (0, ALLOWED)) for i, name in enumerate(names) for j, prefix in enumerate(PREFIXES)]
    values = F.array(*[F.struct(F.lit(url).alias("url"), F.lit(label).alias("label")) for url, label in rows])
    return spark.range(1).select(F.inline(values))


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits; null without one."""
    found = None
    for rule in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        found = F.when(fits, F.lit(value(rule))) if found is None else found.when(fits, F.lit(value(rule)))
    return found if found is not None else F.lit(None).cast("string")


def grams(host: Column, path: Column, dims: int, lengths: Sequence[int] = (3, 4, 5)) -> Column:
    """The buckets of the distinct n-grams of ``^host`` and ``path``. The host's are marked, so host
    and path never share a bucket by content."""
    def of(text: Column, mark: str) -> Column:
        return F.array_distinct(F.flatten(F.array(*[
            F.transform(F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>")),
                        lambda i, n=n: F.concat(F.lit(mark), F.substring(text, i, n))) for n in lengths])))

    words = F.concat(of(F.concat(F.lit("^"), host, F.lit("$")), "h:"), of(path, "p:"))
    return F.when(host == "", F.array().cast("array<int>")).otherwise(
        F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(dims)).cast("int")))


def margin(buckets: Column, weights: Sequence[float], bias: float) -> Column:
    """Bias plus the weights of the buckets met in training, over the root of their number, so that
    neither long URLs nor n-grams the model has never seen weigh."""
    # One string literal, which the optimizer folds into one array; not one expression per weight.
    vector = F.split(F.lit(",".join(f"{w:.8g}" for w in weights)), ",").cast("array<double>")
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("n"))
    met = F.transform(buckets, lambda b: F.get(vector, b))
    total = F.aggregate(met, start, lambda s, w: F.struct((s["sum"] + w).alias("sum"), (s["n"] + F.when(w != 0, 1.0).otherwise(0.0)).alias("n")),
                        lambda s: s["sum"] / F.sqrt(F.greatest(s["n"], F.lit(1.0))))
    return F.lit(float(bias)) + total


def train(labelled: DataFrame, dims: int = 16384, steps: int = 30, rate: float = 40.0, ridge: float = 3e-4,
          prior: float = 0.42) -> tuple[list[float], float]:
    """Weights and bias by full-batch gradient descent with momentum. The URLs to block weigh ``prior`` of the
    whole, so a URL of which the model knows nothing is allowed."""
    rows = labelled.select(grams(host_of(F.col("url")), path_of(F.col("url")), dims).alias("b"),
                           F.col("label").cast("double").alias("y")).where("y is not null").cache()
    n = rows.count()
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    weights, bias, speed, lean = [0.0] * dims, 0.0, [0.0] * dims, 0.0
    if len(sizes) < 2:
        return weights, -1.0 if n == 0 or 1.0 not in sizes else 1.0
    share = F.when(F.col("y") == 1.0, F.lit(prior / sizes[1.0])).otherwise(F.lit((1 - prior) / sizes[0.0]))
    for _ in range(steps):
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(F.col("b"), weights, bias)))
        residual = rows.select("b", (share * (p - F.col("y"))).alias("g"),
                               F.sqrt(F.greatest(F.size("b"), F.lit(1)).cast("double")).alias("n"))
        step = (residual.select(F.explode(F.concat(F.array(F.lit(-1)), "b")).alias("k"), "g", "n")
                .groupBy("k").agg(F.sum(F.when(F.col("k") < 0, F.col("g")).otherwise(F.col("g") / F.col("n"))).alias("g")).collect())
        gradient = {r["k"]: r["g"] for r in step}
        lean = 0.8 * lean - rate * gradient.pop(-1, 0.0) * 0.1
        bias += lean
        for k in range(dims):
            speed[k] = 0.8 * speed[k] - rate * (gradient.get(k, 0.0) + ridge * weights[k])
            weights[k] += speed[k]
    rows.unpersist()
    return weights, bias


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[Rule] = RULES, dims: int = 16384) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score`` (the model's
    probability of a block)."""
    weights, bias = train(labelled, dims)
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(grams(host, path, dims), weights, bias)))
    return parts.select("page_id", "host", "path", matching_rule(host, path, rules, lambda r: r[1] + r[2]).alias("rule"),
                        matching_rule(host, path, rules, lambda r: r[0]).alias("__ruled"), score.alias("score")).select(
        "page_id", "host", "path", "rule",
        F.coalesce("__ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    """Contract query of operator 6."""
    return filter_urls(table(spark, sf_dir, "pages"), labelled_urls(spark))
