"""The whole monthly build: raw sources in, a loaded and checked warehouse out.

Order: fact (partitioned by arrival year/month) and the delivery's date dimension read
back from it; landing copies of temperature and airports; city demographics, states and
countries; then the warehouse load with its checks. Monthly runs accumulate: the
warehouse fact keeps earlier months and its date dimension covers all of them. Every
step reads what the step before wrote, so a failed run restarts from files, not from
lineage.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from portolan.functions.columns import rejected_values
from portolan.plans import countries, demographics, immigration, landing, warehouse
from portolan.sources.lookups import country_lookup, state_lookup


#: Column of the staged fact with the values that conversion lost; ``rejected_arrivals`` lists them.
REJECTS = "_rejects"


@dataclass(frozen=True)
class Sources:
    """Where the raw inputs are. ``immigration_format`` is any installed Spark source and
    ``immigration_options`` are its options (CSV has a header unless they say otherwise)."""

    immigration: str
    temperature: str
    demographics: str
    state_lookup: str
    country_lookup: str
    airport: str | None = None
    immigration_format: str = "parquet"
    immigration_options: Mapping[str, object] = field(default_factory=dict)


def build_warehouse(spark: SparkSession, sources: Sources, output_root: str, database: str,
                    debug_size: int | None = None, whole_months: bool = True) -> DataFrame:
    """Run every job and load the warehouse; returns the per-table check report. ``whole_months=False``: the arrivals are a piece
    of their months and are merged into them by key; by default a delivered month replaces the month that is there."""
    out = output_root.rstrip("/")
    raw = immigration.read_immigration(spark, sources.immigration, sources.immigration_format,
                                       debug_size=debug_size, **sources.immigration_options)
    # A key that is there must not become null on its way into the fact. What other columns lose is kept next to it.
    immigration.process_immigration(raw, output_path=f"{out}/immigration.parquet", date_output_path=f"{out}/date.parquet",
                                    rejects=REJECTS, must_keep=["cicid", "i94yr", "i94mon"])
    temps = landing.process_temperature(spark, sources.temperature, f"{out}/temperature.parquet")
    if sources.airport:
        landing.process_airport(spark, sources.airport, f"{out}/airport.parquet")
    demographics.process_demographics(spark, sources.demographics, f"{out}/demographics.parquet")
    cities = spark.read.parquet(f"{out}/demographics.parquet")
    demographics.process_states(state_lookup(spark, sources.state_lookup), cities, f"{out}/states.parquet")
    countries.process_countries(temps, country_lookup(spark, sources.country_lookup), f"{out}/country.parquet")
    tables = {name: spark.read.parquet(f"{out}/{name}.parquet") for name in ("immigration", "country", "states")}
    # The fact keeps every delivered month, so the date dimension covers all of them: it is united from the days of
    # each month, of which only the delivered ones are read from the fact.
    tables["date"] = lambda load: load.answers().date_dimension()
    # The staged fact is already clustered by its partitions: no second shuffle of it.
    return warehouse.warehouse_load(spark, database, f"{out}/warehouse", tables, rebalance=not whole_months, whole_months=whole_months)


def rejected_arrivals(spark: SparkSession, output_root: str) -> DataFrame:
    """``(cicid, column, value, reason)`` of the last delivery built below ``output_root``."""
    return rejected_values(spark.read.parquet(f"{output_root.rstrip('/')}/immigration.parquet"), "cicid", REJECTS)
