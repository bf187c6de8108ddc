"""Country climate aggregates and the country dimension.

Names are repaired BEFORE grouping, and grouping uses the same lower-cased name the
join uses, so the climate side holds one row per join key and a lookup code can
never fan out into two rows. The climate aggregation reads billions of temperature
rows but shuffles one partial row per country per task; the join then touches only
the lookup and one row per country.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan import schemas
from portolan.functions.columns import refactor_values
from portolan.functions.text import label_fallback
from portolan.operators.aggregate import mean_and_first, two_level_mean
from portolan.sources.io import load_data, save_data


def read_temperature(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """The city temperature CSV (header), all columns as text."""
    return load_data(spark, path, "csv", schema=schemas.TEMPERATURE_SOURCE, header=True, **options)


def country_climate(temps: DataFrame, order_by: Column | None = None, ignore_nulls: bool = False,
                    country: str = "Country", value: str = "AverageTemperature",
                    firsts: Sequence[str] = ("Latitude", "Longitude")) -> DataFrame:
    """(Country, Temperature, Latitude, Longitude): mean temperature and the first row's
    coordinates per country; ``ignore_nulls`` takes each first non-null coordinate."""
    return mean_and_first(temps, country, value, firsts, order_by, ignore_nulls, mean_name="Temperature")


def country_climate_two_level(temps: DataFrame, country: str = "Country", city: str = "City",
                              value: str = "AverageTemperature") -> DataFrame:
    """(Country, Temperature, n_cities): mean over cities of each city's mean temperature."""
    return two_level_mean(temps, country, city, value, mean_name="Temperature", count_name="n_cities")


def country_dimension(temps: DataFrame, lookup: DataFrame,
                      temperature_renames: Sequence[tuple[str, object, object]] = tuple(schemas.TEMPERATURE_COUNTRY_RENAMES),
                      lookup_renames: Sequence[tuple[str, object, object]] = tuple(schemas.LOOKUP_COUNTRY_RENAMES),
                      order_by: Column | None = None) -> DataFrame:
    """(Code, Country, Temperature, Latitude, Longitude) for every lookup code.

    Country is the temperature source's name where the lower-cased names match, else
    the title-cased lookup label; climate columns are null without a match. One row
    per lookup row: the climate side has one row per (lower-cased) name.
    """
    named = refactor_values(temps, temperature_renames).withColumn("_key", F.lower("Country"))
    climate = mean_and_first(named, "_key", "AverageTemperature", ["Country", "Latitude", "Longitude"],
                             order_by, mean_name="Temperature")
    codes = refactor_values(lookup, lookup_renames).select(
        "Code", "I94CTRY", F.lower("I94CTRY").alias("_key"))
    joined = codes.join(climate, "_key", "left")
    return joined.select("Code", label_fallback(F.col("Country"), F.col("I94CTRY")).alias("Country"),
                         "Temperature", "Latitude", "Longitude")


def process_countries(temps: DataFrame, lookup: DataFrame, output_path: str | None = None) -> DataFrame:
    """Country dimension, optionally saved."""
    countries = country_dimension(temps, lookup)
    if output_path is not None:
        save_data(countries, output_path)
    return countries
