"""Monthly partial states of the fact, from which answers over the whole history are finished.

A state holds sums and counts of one month that add up over months: a delivered month replaces its own rows (``sources.versions``), and
no other month's fact rows are read again. The states are as small as their keys: days, codes, pairs of codes; and a
bitmap of the keys seen, 4 KB for every 32,768 consecutive keys.

``days``          the distinct arrival and departure days: the date dimension
``counts``        rows and rows without a key: the warehouse checks
``visits``        per destination: visitors, known stays and their days, known ages and their sum
``genders``       per destination and gender: visitors
``pairs``         per destination and source: visitors
``nationalities`` per country of birth: visitors
``airlines``      per airline: visitors
``keys``          per bucket of keys: the keys seen as a bitmap, rows, and keys that repeat inside the month
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from portolan import schemas
from portolan.operators.uniqueness import key_bitmaps
from portolan.plans import analytics, immigration
from portolan.session import sized_shuffles
from portolan.sources import versions

MONTH = list(schemas.IMMIGRATION_PARTITION_COLUMNS)
State = Callable[[DataFrame], DataFrame]


def _counted(*columns: str) -> State:
    return lambda facts: facts.groupBy(*MONTH, *columns).agg(F.count(F.lit(1)).alias("n"))


def days(facts: DataFrame) -> DataFrame:
    dates = F.array(*[F.col(c) for c in schemas.IMMIGRATION_DATE_COLUMNS])
    return facts.select(*MONTH, F.explode(dates).alias("date")).where(F.col("date").isNotNull()).distinct()


def counts(facts: DataFrame) -> DataFrame:
    return facts.groupBy(*MONTH).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("cicid").isNull()).alias("null_keys"))


def visits(facts: DataFrame) -> DataFrame:
    return facts.groupBy(*MONTH, "i94addr").agg(
        F.count(F.lit(1)).alias("n"), F.sum("stay").alias("stay_days"), F.count("stay").alias("stays"),
        F.sum("i94bir").alias("age_years"), F.count("i94bir").alias("ages"))


def keys(facts: DataFrame) -> DataFrame:
    return key_bitmaps(facts, "cicid", MONTH)


STATES: dict[str, State] = {
    "days": days, "counts": counts, "visits": visits, "genders": _counted("i94addr", "gender"), "pairs": _counted("i94addr", "i94res"),
    "nationalities": _counted("i94cit"), "airlines": _counted("airline"), "keys": keys,
}


def state_schema(spark: SparkSession, state: State) -> StructType:
    return state(spark.createDataFrame([], schemas.IMMIGRATION_TABLE)).schema


def write_states(facts: DataFrame, months: Iterable[str], root: str, version: str, states: Mapping[str, State] = STATES) -> dict[str, str]:
    """The states of the ``months`` (as ``versions.partition_key`` names them) that ``facts`` holds, as ``version`` below ``root``: one folder
    a state and load, however many months. Returns which folder counts for each month, as ``versions.publish`` takes it. Each
    state reads its own columns of ``facts``: pass a written table."""
    months = list(months)

    def write(name: str) -> dict[str, str]:
        written = versions.write_version(states[name](facts), f"{root}/{name}", [], version)
        return {f"{name}/{month}": f"{name}/{v}" for v in written.values() for month in months}

    # The states don't depend on each other: concurrent jobs.
    with sized_shuffles(facts.sparkSession, facts.inputFiles()), ThreadPoolExecutor(max_workers=4) as pool:
        return {k: v for part in pool.map(write, states) for k, v in part.items()}


def read_state(spark: SparkSession, root: str, name: str, partitions: Mapping[str, str], states: Mapping[str, State] = STATES) -> DataFrame:
    """The rows of a state: of each load's folder the months for which it counts by ``partitions`` (``<name>/<month>`` -> folder)."""
    schema = state_schema(spark, states[name])
    own = {k.removeprefix(f"{name}/"): v for k, v in partitions.items() if k.startswith(f"{name}/")}
    if not own:
        return spark.createDataFrame([], schema)
    full = StructType([*schema.fields, StructField(versions.VERSION, StringType())])
    rows = spark.read.schema(full).option("basePath", f"{root}/{name}").parquet(*sorted({f"{root}/{v}" for v in own.values()}))
    counting = []
    for month, folder in own.items():
        values = [part.split("=", 1)[1] for part in month.split("/")]
        counting.append((folder.split(f"{versions.VERSION}=")[1], *[None if v == versions.NULL_PARTITION else int(v) for v in values]))
    # A row per month; without a month column in common the join would have no key, so it is by all of them.
    which = spark.createDataFrame(counting, StructType([StructField("_v", StringType()), *[StructField(f"_{c}", IntegerType()) for c in MONTH]]))
    same = F.col(versions.VERSION) == F.col("_v")
    for c in MONTH:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(which, same, "left_semi").drop(versions.VERSION)


def update_states(facts: DataFrame, root: str, states: Mapping[str, State] = STATES) -> versions.Publication:
    """Replace the states of the months in ``facts`` at a place of their own (``warehouse_load`` keeps them with its tables)."""
    spark = facts.sparkSession
    basis = versions.current(spark, root)
    months = [versions.partition_key(r, MONTH) for r in facts.select(*MONTH).distinct().collect()]  # a row per month
    return versions.publish(spark, root, basis, write_states(facts, months, root, versions.new_version(), states))


class Answers:
    """The questions of ``plans.analytics``, finished from states: no fact rows are read."""

    def __init__(self, spark: SparkSession, root: str, publication: versions.Publication | None = None, prefix: str = ""):
        self.spark, self.root = spark, f"{root}/{prefix}".rstrip("/")
        published = versions.current(spark, root) if publication is None else publication
        self.partitions = {k.removeprefix(prefix): v.removeprefix(prefix) for k, v in published.partitions.items() if k.startswith(prefix)}

    def state(self, name: str) -> DataFrame:
        return read_state(self.spark, self.root, name, self.partitions)

    def _sum(self, name: str, by: Sequence[str], as_name: str) -> DataFrame:
        return self.state(name).groupBy(*by).agg(F.sum("n").alias(as_name))

    def date_dimension(self) -> DataFrame:
        return immigration.calendar(self.state("days").select("date").distinct())

    def average_stay(self) -> DataFrame:
        sums = self.state("visits").groupBy("i94addr").agg(F.sum("stay_days").alias("_d"), F.sum("stays").alias("n_stays"))
        return sums.select("i94addr", (F.col("_d") / F.nullif("n_stays", F.lit(0))).alias("avg_stay"), "n_stays")

    def visitors_by_nationality(self, country: DataFrame) -> DataFrame:
        return analytics.named_by_country(self._sum("nationalities", ["i94cit"], "_n"), country, "i94cit")

    def visitors_by_origin(self, country: DataFrame) -> DataFrame:
        return analytics.named_by_country(self._sum("pairs", ["i94res"], "_n"), country, "i94res")

    def visitors_by_airline(self) -> DataFrame:
        return self._sum("airlines", ["airline"], "visitors")

    def destination_source_lift(self) -> DataFrame:
        pairs = self._sum("pairs", ["i94addr", "i94res"], "visitors").where(F.col("i94addr").isNotNull())
        return analytics.lift_of_pairs(pairs, "i94addr", "i94res")

    def visitor_demographics(self, states: DataFrame, genders: Sequence[str] = ("F", "M")) -> DataFrame:
        ages = self.state("visits").groupBy("i94addr").agg(
            F.sum("n").alias("visitors"), (F.sum("age_years") / F.nullif(F.sum("ages"), F.lit(0))).alias("avg_age"))
        known = F.nullif(F.sum(F.when(F.col("gender").isNotNull(), F.col("n"))), F.lit(0))
        of = lambda g: F.coalesce(F.sum(F.when(F.col("gender") == g, F.col("n"))), F.lit(0))
        shares = self.state("genders").groupBy(F.col("i94addr").alias("_to")).agg(*[(of(g) / known).alias(f"share_{g}") for g in genders])
        joined = ages.join(shares, F.col("i94addr").eqNullSafe(F.col("_to"))).drop("_to")
        return analytics.demographics_of(joined, states, genders, "i94addr")

    def demographics_correlation(self, states: DataFrame, columns: Sequence[str]) -> DataFrame:
        per_state = self._sum("visits", ["i94addr"], "_n").where(F.col("i94addr").isNotNull())
        return analytics.state_correlation(per_state, states, columns, "i94addr")

    def temperature_correlation(self, country: DataFrame) -> DataFrame:
        return analytics.climate_correlation(self._sum("pairs", ["i94res"], "_n"), country, "i94res")

    def destination_source_climate(self, country: DataFrame) -> DataFrame:
        return analytics.climate_of_pairs(self._sum("pairs", ["i94addr", "i94res"], "_n"), country, "i94addr", "i94res")
