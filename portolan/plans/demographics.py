"""City demographics, the state roll-up and the states dimension.

City demographics is ONE aggregation per city: the attributes repeated on every race
row (first row by a stable order) and one conditional sum per race, where a separate
aggregate + pivot + join would shuffle three times. The state roll-up is a second,
tiny aggregation. Both aggregate partially before shuffling, so a city or state
holding most rows costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan import schemas
from portolan.functions.columns import convert_types, fill_zero
from portolan.functions.text import title_case
from portolan.operators.aggregate import first_value_columns, pivot_loss_report, pivot_sum_columns
from portolan.operators.quality import raise_on_failure
from portolan.sources.io import load_data, save_data


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def read_demographics(spark: SparkSession, path: str, sep: str = ";", **options: object) -> DataFrame:
    """The city demographics CSV (header, ``;``-separated) with numeric columns typed."""
    df = load_data(spark, path, "csv", schema=schemas.DEMOGRAPHICS_SOURCE, header=True, sep=sep, **options)
    df = convert_types(df, {c: "int" for c in schemas.DEMOGRAPHICS_INTEGER_COLUMNS})
    return convert_types(df, {c: "double" for c in schemas.DEMOGRAPHICS_DOUBLE_COLUMNS})


def city_demographics(df: DataFrame, keys: Sequence[str] = tuple(schemas.DEMOGRAPHICS_KEYS),
                      attributes: Mapping[str, str] = schemas.DEMOGRAPHICS_CITY_ATTRIBUTES,
                      race: str = "Race", count: str = "Count",
                      races: Mapping[object, str] = schemas.RACES,
                      order_by: Column | None = None, fill: object = 0) -> DataFrame:
    """One row per city: keys, the first row's attributes (renamed), one count column per
    race; missing numbers become ``fill``. Rows with a null key are left out."""
    keyed = df.where(reduce(lambda a, b: a & b, [_c(k).isNotNull() for k in keys])) if keys else df
    firsts, unpack = first_value_columns(attributes, order_by)
    pivots = pivot_sum_columns(race, races, count)
    out = (keyed.groupBy(*[_c(k) for k in keys]).agg(*firsts, *pivots)
           .select(*[_c(k) for k in keys], *unpack, *[_c(n) for n in races.values()]))
    if fill is None:
        return out
    return fill_zero(out, [*attributes.values(), *races.values()], fill)


def state_rollup(cities: DataFrame, keys: Sequence[str] = ("State Code", "State"),
                 columns: Sequence[str] = tuple(schemas.STATE_SUM_COLUMNS)) -> DataFrame:
    """Sum of each numeric city column per state code, with the state's name.

    Grouped by the code alone (the name is the smallest one seen for the code), so the
    states dimension has exactly one row per lookup code even if a code were spelt
    with two names.
    """
    code, *names = keys
    return (cities.groupBy(_c(code))
            .agg(*[F.min(_c(n)).alias(n) for n in names], *[F.sum(_c(c)).alias(c) for c in columns]))


def states_dimension(lookup: DataFrame, rollup: DataFrame, code: str = "Code", label: str = "State",
                     rollup_code: str = "State Code", rollup_name: str = "State",
                     columns: Sequence[str] | None = None) -> DataFrame:
    """Every lookup code with its state's sums (null where no city is known) and a name:
    the demographics name, else the title-cased lookup label. One row per lookup row
    (the roll-up has one row per code)."""
    columns = list(columns) if columns is not None else [
        c for c in rollup.columns if c not in (rollup_code, rollup_name)]
    left = lookup.select(_c(code).alias("Code"), _c(label).alias("_label"))
    right = rollup.select(_c(rollup_code).alias("_code"), _c(rollup_name).alias("_name"),
                          *[_c(c) for c in columns])
    joined = left.join(right, left["Code"] == right["_code"], "left")
    return joined.select("Code", F.coalesce("_name", title_case(F.col("_label"))).alias("State"),
                         *[_c(c) for c in columns])


def process_demographics(spark: SparkSession, input_path: str, output_path: str | None = None,
                         partition_by: Sequence[str] | None = None, sep: str = ";") -> DataFrame:
    """Read, check that the pivot leaves no count out, build city demographics, optionally save."""
    raw = read_demographics(spark, input_path, sep=sep)
    raise_on_failure(pivot_loss_report(raw, "Race", schemas.RACES, "Count"), "Race pivot")
    cities = city_demographics(raw)
    if output_path is not None:
        save_data(cities, output_path, partition_by=list(partition_by or []))
    return cities


def process_states(lookup: DataFrame, cities: DataFrame, output_path: str | None = None) -> DataFrame:
    """States dimension from the state lookup and city demographics, optionally saved."""
    states = states_dimension(lookup, state_rollup(cities))
    if output_path is not None:
        save_data(states, output_path)
    return states
