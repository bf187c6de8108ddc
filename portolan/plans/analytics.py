"""Questions over the star schema.

Two plan shapes, both without shuffling the fact:

* per-row enrichment (star join, code decoding, state normalisation): the fact is
  streamed through broadcast hash joins. Pass dimensions as tables (the warehouse, or
  ``portolan.session.stage``): their file size is known, so the planner broadcasts them
  under ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a sort-merge join
  above it; a lazily computed dimension is left to AQE's runtime statistics;
* counts by a dimension attribute: the fact is first aggregated by the foreign key
  (partial aggregation, at most one row per code per task), and only that small
  result is joined to the dimension and re-aggregated by the attribute.

The date dimension plays two roles in the star join, arrival and departure; one row per
day, it is broadcast like the other dimensions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portolan import schemas
from portolan.operators.joins import decode


def star_join(fact: DataFrame, country: DataFrame, states: DataFrame, date: DataFrame) -> DataFrame:
    """Fact rows with country of birth and residence, state name and calendar parts of the
    arrival and departure days.

    Pass the dimensions as tables (the warehouse, or ``portolan.session.stage``): the
    planner reads their size and broadcasts them, or joins by sort-merge beyond
    ``spark.sql.autoBroadcastJoinThreshold``. Country and date serve two roles each.
    """
    places = country.select("Code", "Country", "Temperature")
    names = states.select("Code", "State")
    days = date.select("date", "year", "month", "dayofweek")
    joined = (fact.alias("f")
              .join(places.alias("born"), F.col("f.i94cit") == F.col("born.Code"), "left")
              .join(places.alias("home"), F.col("f.i94res") == F.col("home.Code"), "left")
              .join(names.alias("st"), F.col("f.i94addr") == F.col("st.Code"), "left")
              .join(days.alias("arr"), F.col("f.arrdate") == F.col("arr.date"), "left")
              .join(days.alias("dep"), F.col("f.depdate") == F.col("dep.date"), "left")
              .select("f.*", F.col("born.Country").alias("born_country"),
                      F.col("home.Country").alias("residence_country"),
                      F.col("home.Temperature").alias("residence_temperature"), F.col("st.State").alias("state"),
                      F.col("arr.year").alias("arrival_year"), F.col("arr.month").alias("arrival_month"),
                      F.col("arr.dayofweek").alias("arrival_dayofweek"),
                      F.col("dep.year").alias("departure_year"), F.col("dep.month").alias("departure_month")))
    return joined.select(
        "cicid", "i94cit", "born_country", "i94res", "residence_country", "residence_temperature",
        "i94addr", "state", "arrdate", "arrival_year", "arrival_month", "arrival_dayofweek",
        "depdate", "departure_year", "departure_month", "stay")


def decode_codes(fact: DataFrame, lookups: Sequence[tuple[str, DataFrame, str, str, str]],
                 keep: Sequence[str] = ("cicid",)) -> DataFrame:
    """Add the label of each coded column: ``[(code column, lookup, lookup key, label, output)]``."""
    out = fact.select(*keep, *[code for code, *_ in lookups])
    for code, lookup, key, label, output in lookups:
        out = decode(out, code, lookup, key, label, output)
    return out


def normalize_state_codes(fact: DataFrame, states: DataFrame, column: str = "i94addr",
                          other: str = schemas.OTHER_STATE_CODE) -> DataFrame:
    """Codes outside the state list (and missing codes) become the catch-all code."""
    codes = states.select(F.col("Code").alias("_valid")).distinct()
    joined = fact.join(codes, fact[column] == codes["_valid"], "left")
    return joined.withColumn(column, F.coalesce(F.col("_valid"), F.lit(other))).drop("_valid")


def visitors_by(fact: DataFrame, column: str, name: str = "visitors") -> DataFrame:
    """Count of fact rows per value of ``column``."""
    return fact.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def visitors_by_country(fact: DataFrame, country: DataFrame, code: str = "i94cit") -> DataFrame:
    """(Country, visitors) by the country that ``code`` points to (i94cit: nationality,
    i94res: residence). Codes without a country count under a null Country."""
    return named_by_country(visitors_by(fact, code, "_n"), country, code)


def named_by_country(per_code: DataFrame, country: DataFrame, code: str) -> DataFrame:
    """``visitors_by_country`` from the counts ``_n`` per code."""
    names = country.select(F.col("Code").alias("_code"), "Country")
    named = per_code.join(names, per_code[code] == names["_code"], "left")
    return named.groupBy("Country").agg(F.sum("_n").alias("visitors"))


def average_stay(fact: DataFrame, by: str = "i94addr") -> DataFrame:
    """(by, avg_stay, n_stays): mean stay in days where it is known."""
    return fact.groupBy(by).agg(F.avg("stay").alias("avg_stay"), F.count("stay").alias("n_stays"))


def visitor_demographics(fact: DataFrame, states: DataFrame, genders: Sequence[str] = ("F", "M"),
                         dest: str = "i94addr", age: str = "i94bir") -> DataFrame:
    """Per destination state: its name and population, visitors, their mean age, the share of each
    of ``genders`` among those whose gender is known, and visitors per 1,000 inhabitants.
    Visitors without a listed state count under a null name."""
    share = [(F.count_if(F.col("gender") == g) / F.nullif(F.count("gender"), F.lit(0))).alias(f"share_{g}") for g in genders]
    per_state = fact.groupBy(dest).agg(F.count(F.lit(1)).alias("visitors"), F.avg(age).alias("avg_age"), *share)
    return demographics_of(per_state, states, genders, dest)


def demographics_of(per_state: DataFrame, states: DataFrame, genders: Sequence[str], dest: str) -> DataFrame:
    """``visitor_demographics`` from ``visitors``, ``avg_age`` and ``share_*`` per destination."""
    names = states.select(F.col("Code").alias("_code"), "State", "TotalPopulation")
    joined = per_state.join(names, per_state[dest] == names["_code"], "left")
    return joined.select(dest, F.col("State").alias("state"), F.col("TotalPopulation").alias("population"), "visitors", "avg_age",
                         *[f"share_{g}" for g in genders],
                         (F.col("visitors") * 1000.0 / F.nullif("TotalPopulation", F.lit(0))).alias("visitors_per_1000"))


def destination_source_lift(fact: DataFrame, dest: str = "i94addr", src: str = "i94res") -> DataFrame:
    """(dest, src, visitors, lift) with lift = n * N / (n_dest * n_src): how much more often a
    destination is chosen by a source than if the two were independent (1 = independent)."""
    pairs = fact.where(F.col(dest).isNotNull()).groupBy(dest, src).agg(F.count(F.lit(1)).alias("visitors"))
    return lift_of_pairs(pairs, dest, src)


def lift_of_pairs(pairs: DataFrame, dest: str, src: str) -> DataFrame:
    """``destination_source_lift`` from ``visitors`` per pair."""
    total = pairs.agg(F.sum("visitors")).scalar()
    n_dest = F.sum("visitors").over(Window.partitionBy(dest))
    n_src = F.sum("visitors").over(Window.partitionBy(src))
    lift = F.col("visitors").cast("double") * total / (n_dest.cast("double") * n_src)
    return pairs.select(dest, src, "visitors", lift.alias("lift"))


def correlation(a: Column, b: Column) -> Column:
    """``corr``, but null where one side doesn't vary (``corr`` divides by zero there, an error in ANSI mode)."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y)))


def demographics_correlation(fact: DataFrame, states: DataFrame, columns: Sequence[str],
                             dest: str = "i94addr") -> DataFrame:
    """One row: states matched, and corr(visitors per state, column) for each state column."""
    per_state = fact.where(F.col(dest).isNotNull()).groupBy(dest).agg(F.count(F.lit(1)).alias("_n"))
    return state_correlation(per_state, states, columns, dest)


def state_correlation(per_state: DataFrame, states: DataFrame, columns: Sequence[str], dest: str) -> DataFrame:
    """``demographics_correlation`` from the counts ``_n`` per destination."""
    joined = per_state.join(states, per_state[dest] == states["Code"], "inner")
    return joined.agg(F.count(F.lit(1)).alias("states_matched"),
                      *[correlation(F.col("_n").cast("double"), F.col(f"`{c}`").cast("double")).alias(f"corr_{c}")
                        for c in columns])


def temperature_correlation(fact: DataFrame, country: DataFrame, src: str = "i94res") -> DataFrame:
    """One row: countries matched, corr(visitors per source country, its temperature)."""
    return climate_correlation(visitors_by(fact, src, "_n"), country, src)


def climate_correlation(per_src: DataFrame, country: DataFrame, src: str) -> DataFrame:
    """``temperature_correlation`` from the counts ``_n`` per source."""
    joined = per_src.join(country.select("Code", "Temperature"), per_src[src] == F.col("Code"), "inner")
    return joined.agg(F.count(F.lit(1)).alias("countries_matched"),
                      correlation(F.col("_n").cast("double"), F.col("Temperature")).alias("corr_temperature"))


def destination_source_climate(fact: DataFrame, country: DataFrame, dest: str = "i94addr",
                               src: str = "i94res") -> DataFrame:
    """(dest, avg_source_temperature, n_with_temperature): mean temperature of the visitors'
    countries of residence per destination, over visitors whose country has one."""
    return climate_of_pairs(fact.groupBy(dest, src).agg(F.count(F.lit(1)).alias("_n")), country, dest, src)


def climate_of_pairs(pairs: DataFrame, country: DataFrame, dest: str, src: str) -> DataFrame:
    """``destination_source_climate`` from the counts ``_n`` per pair."""
    temps = country.select(F.col("Code").alias("_code"), F.col("Temperature").alias("_t"))
    joined = pairs.join(temps, pairs[src] == temps["_code"], "left")
    weight = F.when(F.col("_t").isNotNull(), F.col("_n"))
    return joined.groupBy(dest).agg(
        (F.sum(F.col("_t") * F.col("_n")) / F.sum(weight)).alias("avg_source_temperature"),
        F.coalesce(F.sum(weight), F.lit(0)).cast("bigint").alias("n_with_temperature"))
