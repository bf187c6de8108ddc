"""Every query of the operator inventory as ``(spark, sf_dir) -> DataFrame``.

Each one runs the library on the role views of ``portolan.fixtures`` over the whole
test tables. Computed doubles are rounded to 4 places only here, for comparison with
the SQL oracle (``portolan.oracles``); the library itself never rounds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from portolan import fixtures as fx
from portolan import schemas
from portolan.checks import SQL_CHECKS
from portolan.functions.columns import convert_types, drop_columns, refactor_values, rejected_values, rename_columns
from portolan.functions.dates import convert_day_numbers, day_difference
from portolan.functions.text import title_case
from portolan.operators.aggregate import first_values, pivot_sum
from portolan.operators.colocated import join_colocated, save_colocated
from portolan.operators.quality import (cast_loss_report, duplicate_key_report, null_key_report, orphan_report,
                                        row_count_report, sql_check_report)
from portolan.operators.uniqueness import incremental_key_report, key_bitmaps
from portolan.plans import analytics, countries, demographics, immigration, landing, rollups, warehouse
from portolan.session import app_id, scratch_path, stage
from portolan.sources.io import load_data, overwrite_partitions, read_partitioned, save_data
from portolan.sources.labels import extract_pairs, label_entries, number_lines
from portolan.sources.lookups import mode_lookup, visa_lookup
from portolan.streaming.monthly import ingest_deliveries

Query = Callable[[SparkSession, str], DataFrame]

CITY_KEYS = ["City", "State", "State_Code"]
CITY_ATTRIBUTES = {"Total_Population": "TotalPopulation", "Median_Age": "MedianAge"}
RACE_COLUMNS = {race: race for race in fx.RACE_VALUES}
STATE_COLUMNS = ["TotalPopulation", *fx.RACE_VALUES]
LOOKUP_RENAMES = [*schemas.LOOKUP_COUNTRY_RENAMES, *fx.INVALID_RENAMES]
# The states table of the fixture: its population columns are the fixture's races.
STATES_FIXTURE_TABLE = StructType([StructField("Code", StringType()), StructField("State", StringType()),
                                   *[StructField(c, LongType()) for c in STATE_COLUMNS]])


def _r4(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 4) for c in columns})


# --- shared building blocks over the role views ------------------------------------

def facts(spark: SparkSession, d: str) -> DataFrame:
    return immigration.immigration_facts(fx.visits_raw(spark, d))


def dates(spark: SparkSession, d: str) -> DataFrame:
    return immigration.date_dimension_of_days(fx.visits_raw(spark, d))


def cities(spark: SparkSession, d: str) -> DataFrame:
    return demographics.city_demographics(fx.demographics_raw(spark, d), CITY_KEYS, CITY_ATTRIBUTES,
                                          race="Race", count="Count_", races=RACE_COLUMNS,
                                          order_by=F.col("seq"))


def rollup(spark: SparkSession, d: str) -> DataFrame:
    return demographics.state_rollup(cities(spark, d), ["State_Code", "State"], STATE_COLUMNS)


def states(spark: SparkSession, d: str) -> DataFrame:
    return demographics.states_dimension(fx.lookup_state(spark, d), rollup(spark, d),
                                         rollup_code="State_Code", rollup_name="State")


def country(spark: SparkSession, d: str) -> DataFrame:
    return countries.country_dimension(fx.temperature_raw(spark, d), fx.lookup_country(spark, d),
                                       lookup_renames=LOOKUP_RENAMES, order_by=F.col("seq"))


# --- sources and sinks ---------------------------------------------------------------

def load_project_limit(spark, d):
    return load_data(spark, f"{d}/part.parquet", "parquet",
                     columns=["p_partkey", "p_name", "p_brand", "p_retailprice"],
                     debug_size=1000, order_by="p_partkey")


def csv_roundtrip(spark, d):
    raw = fx.demographics_raw(spark, d)
    path = scratch_path(spark, "csv")
    save_data(raw, path, format="csv", header=True, sep=";")
    return load_data(spark, path, "csv", schema=raw.schema, header=True, sep=";")


def parquet_roundtrip(spark, d):
    path = scratch_path(spark, "parquet")
    save_data(fx.temperature_raw(spark, d), path, columns=["seq", "City", "Country", "AverageTemperature"])
    return load_data(spark, path)


def partitioned_fact_write(spark, d):
    path = scratch_path(spark, "immigration")
    immigration.process_immigration(fx.visits_raw(spark, d), output_path=path)
    return read_partitioned(spark, path, schemas.IMMIGRATION_TABLE)


def land_temperature(spark, d):
    temps = fx.temperature_raw(spark, d)
    path = scratch_path(spark, "temperature")
    landing.land(temps, path, ["Country"])
    fields = [f for f in temps.schema.fields if f.name != "Country"]
    return read_partitioned(spark, path, StructType([*fields, StructField("Country", StringType())]))


def land_temperature_by_city(spark, d):
    """The temperatures landed by country and, inside, in order of city; read back for the cities whose name ends in 7."""
    temps = fx.temperature_raw(spark, d)
    path = scratch_path(spark, "temperature-city")
    landing.land(temps, path, ["Country"], cluster_by=["City", "seq"])
    fields = [f for f in temps.schema.fields if f.name != "Country"]
    landed = read_partitioned(spark, path, StructType([*fields, StructField("Country", StringType())]))
    return landed.where(F.col("City").endswith("7"))


def land_airport(spark, d):
    airports = fx.table(spark, d, "supplier")
    path = scratch_path(spark, "airport")
    landing.land(airports, path, ["s_nationkey"])
    fields = [f for f in airports.schema.fields if f.name != "s_nationkey"]
    return read_partitioned(spark, path, StructType([*fields, airports.schema["s_nationkey"]]))


def stage_table_load(spark, d):
    database = f"portolan_{uuid.uuid4().hex[:10]}"
    location = scratch_path(spark, "warehouse")
    warehouse.create_tables(spark, database, location)
    staged = scratch_path(spark, "date-staging")
    save_data(dates(spark, d), staged)                                # the staging area
    for _ in range(2):                                                # a rerun replaces, never doubles
        warehouse.copy_into(spark, staged, f"`{database}`.`date`")
    return spark.table(f"`{database}`.`date`")


def monthly_refresh(spark, d):
    fact = facts(spark, d)
    path = scratch_path(spark, "refresh")
    parts = schemas.IMMIGRATION_PARTITION_COLUMNS
    overwrite_partitions(fact.where(F.col("i94mon") <= 6), path, parts)   # first deliveries
    overwrite_partitions(fact.where(F.col("i94mon") > 6), path, parts)    # later ones: kept apart
    overwrite_partitions(fact.where(F.col("i94mon") == 1), path, parts)   # January again: replaced
    return read_partitioned(spark, path, schemas.IMMIGRATION_TABLE)


def monthly_stream_ingest(spark, d):
    """Deliveries land as files and a file stream merges them into the fact: every month arrives in two pieces over two
    runs; January is delivered again, whole and marked as complete, and replaces itself; a last run finds nothing new."""
    raw = fx.visits_raw(spark, d)
    landing, fact_path = scratch_path(spark, "landing"), scratch_path(spark, "stream-fact")
    for name, part in (("odd", F.col("cicid") % 2 == 1), ("even", F.col("cicid") % 2 == 0), ("january-complete", F.col("i94mon") == 1), ("", None)):
        if part is not None:
            raw.where(part).write.parquet(f"{landing}/{name}")
        ingest_deliveries(spark, landing, fact_path, raw.schema)
    return read_partitioned(spark, fact_path, schemas.IMMIGRATION_TABLE)


def label_text_lookups(spark, d):
    """Label-format text written from part (a ``value`` header, then a ``'code' = 'label'``
    entry, per part), read back as text and parsed into (section, code, label)."""
    p = fx.table(spark, d, "part")
    header = F.concat(F.lit("  value brand_"), F.regexp_replace("p_brand", "#", "_"))
    entry = F.concat(F.lit("   '"), F.col("p_partkey").cast("string"), F.lit("' = '"),
                     F.regexp_replace("p_name", "'", "''"), F.lit("'"))
    path = scratch_path(spark, "label-text")
    p.select(F.explode(F.array(header, entry)).alias("value")).write.text(path)
    return label_entries(number_lines(spark.read.text(path)))


def label_text_sections(spark, d):
    """The same format as it is published: one header per section and all of its entries below it,
    so most lines carry a header from far above."""
    p = fx.table(spark, d, "part").select(
        F.concat(F.lit("brand_"), F.regexp_replace("p_brand", "#", "_")).alias("section"), "p_partkey",
        F.concat(F.lit("   '"), F.col("p_partkey").cast("string"), F.lit(" ' = '"),
                 F.regexp_replace("p_name", "'", "''"), F.lit("  '")).alias("line"))
    headers = p.groupBy("section").agg(F.lit(-1).cast("bigint").alias("p_partkey"),
                                       F.concat(F.lit("  value "), F.first("section")).alias("line"))
    path = scratch_path(spark, "label-sections")
    # A range of sections per file: a section never spans two files.
    (p.unionByName(headers).repartitionByRange("section").sortWithinPartitions("section", "p_partkey")
     .select(F.col("line").alias("value")).write.text(path))
    entries = label_entries(number_lines(spark.read.text(path)), chunk_lines=64)
    return entries.select("section", "code", F.rtrim("label").alias("label"))


def extract_key_values(spark, d):
    return extract_pairs(fx.table(spark, d, "pages"), "html", keep=["page_id"])


# --- projections and scalar functions ---------------------------------------------------

def convert_types_q(spark, d):
    return convert_types(fx.visits_raw(spark, d), immigration.IMMIGRATION_TYPES)


def drop_columns_q(spark, d):
    return drop_columns(fx.visits_raw(spark, d), schemas.IMMIGRATION_HIGH_NULL_COLUMNS,
                        schemas.IMMIGRATION_UNUSED_COLUMNS, schemas.IMMIGRATION_PARTITION_COLUMNS)


def rename_columns_q(spark, d):
    return rename_columns(fx.demographics_raw(spark, d),
                          {"State_Code": "StateCode", "Count_": "Count", "Total_Population": "TotalPopulation",
                           "Median_Age": "MedianAge", "Not_There": "Ignored"})


# Sequential value repairs over the whole arrivals source: AUTOMOBILE -> AUTO -> CAR
# shows that a later rule sees the result of an earlier one.
VALUE_RULES = [("visatype", "AUTOMOBILE", "AUTO"), ("visatype", "AUTO", "CAR"),
               ("visatype", "HOUSEHOLD", "HOME"), ("airline", "PROMO", "PROMOTION"),
               ("gender", "N", "X"), ("not_a_column", "a", "b")]


def value_refactoring(spark, d):
    raw = fx.visits_raw(spark, d).select("cicid", "visatype", "airline", "gender")
    return refactor_values(raw, VALUE_RULES)


def title_case_q(spark, d):
    st = fx.lookup_state(spark, d).select(F.lit("state").alias("source"), "Code", F.col("State").alias("label"))
    co = fx.lookup_country(spark, d).select(F.lit("country").alias("source"), F.col("Code").cast("string"),
                                            F.col("I94CTRY").alias("label"))
    city = fx.demographics_raw(spark, d).select(F.lit("city").alias("source"), F.col("seq").cast("string"),
                                                 F.upper("City").alias("label"))
    labels = st.unionByName(co).unionByName(city.withColumnRenamed("seq", "Code"))
    return labels.withColumn("title", title_case(F.col("label")))


def sas_dates(spark, d):
    raw = fx.visits_raw(spark, d).select("cicid", "arrdate", "depdate")
    return convert_day_numbers(raw, ["arrdate", "depdate", "not_there"])


def stay_length(spark, d):
    raw = convert_types(fx.visits_raw(spark, d).select("cicid", "arrdate", "depdate"), immigration.IMMIGRATION_TYPES)
    return convert_day_numbers(raw.withColumn("stay", day_difference(F.col("arrdate"), F.col("depdate"))), ["arrdate", "depdate"])


# --- jobs ------------------------------------------------------------------------------

def immigration_fact(spark, d):
    return facts(spark, d)


def date_dimension(spark, d):
    return dates(spark, d)


def city_first_values(spark, d):
    return first_values(fx.demographics_raw(spark, d), CITY_KEYS, CITY_ATTRIBUTES, order_by=F.col("seq"))


def first_values_default(spark, d):
    """First values without an order column, over attributes with nulls: the smallest row, null first."""
    p = fx.table(spark, d, "part")
    rows = p.select("p_brand", F.when(F.col("p_partkey") % 3 != 0, F.col("p_size")).alias("size"),
                    F.when(F.col("p_partkey") % 2 != 0, F.col("p_type")).alias("type"), F.col("p_retailprice").alias("price"))
    return first_values(rows, ["p_brand"], {"type": "first_type", "size": "first_size", "price": "first_price"})


def race_pivot(spark, d):
    return pivot_sum(fx.demographics_raw(spark, d), CITY_KEYS, "Race", RACE_COLUMNS, "Count_")


def city_demographics(spark, d):
    return cities(spark, d)


def state_rollup(spark, d):
    return rollup(spark, d)


def states_dimension(spark, d):
    return states(spark, d)


def country_climate(spark, d):
    return _r4(countries.country_climate(fx.temperature_raw(spark, d), order_by=F.col("seq")), "Temperature")


def country_climate_nonnull(spark, d):
    return _r4(countries.country_climate(fx.temperature_raw(spark, d), order_by=F.col("seq"),
                                         ignore_nulls=True), "Temperature")


def country_climate_two_level(spark, d):
    return _r4(countries.country_climate_two_level(fx.temperature_raw(spark, d)), "Temperature")


def country_dimension(spark, d):
    return _r4(country(spark, d), "Temperature")


# --- warehouse and quality ---------------------------------------------------------------

def _warehouse_frames(spark, d):
    """The four tables. The date dimension reads only the two date columns of the source."""
    return {"immigration": (facts(spark, d), "cicid"), "country": (country(spark, d), "Code"),
            "states": (states(spark, d), "Code"), "date": (dates(spark, d), "date")}


def dq_null_keys(spark, d):
    return null_key_report(_warehouse_frames(spark, d))


def dq_row_counts(spark, d):
    return row_count_report({name: df for name, (df, _) in _warehouse_frames(spark, d).items()})


def dq_duplicate_keys(spark, d):
    return duplicate_key_report(_warehouse_frames(spark, d))


def dq_orphans(spark, d):
    # Staged dimensions have a size the planner can read.
    country_dim, states_dim, day_dim = _dimensions(spark, d)
    return orphan_report(facts(spark, d), [
        ("born_country", "i94cit", country_dim, "Code"),
        ("residence_country", "i94res", country_dim, "Code"),
        ("state", "i94addr", states_dim, "Code"),
        ("arrival_date", "arrdate", day_dim, "date"),
        ("departure_date", "depdate", day_dim, "date"),
    ])


def dq_incremental_keys(spark, d):
    """Two new months, one after the other, held against the stored bitmaps of all months before them: for the key of the
    fact, which is unique, and for flight numbers, which repeat."""
    fact, reports = facts(spark, d), []
    months = sorted(tuple(r) for r in fact.select(*rollups.MONTH).distinct().collect())  # a row per month
    of = lambda m: (F.col("i94yr") == m[0]) & (F.col("i94mon") == m[1])
    before = fact
    for month in months[-2:]:
        before = before.where(~of(month))
    for key in ("cicid", "fltno"):
        root = scratch_path(spark, f"keys-{key}")
        states = {"keys": lambda f, key=key: key_bitmaps(f, key, rollups.MONTH)}
        published = rollups.update_states(before, root, states)
        for month in months[-2:]:
            new = stage(states["keys"](fact.where(of(month))), "new-keys")
            history = rollups.read_state(spark, root, "keys", published.partitions, states)
            reports.append(incremental_key_report(new, history, rollups.MONTH).select(F.lit(key).alias("key"), "*"))
            published = rollups.update_states(fact.where(of(month)), root, states)
    return reduce(DataFrame.unionByName, reports)


def dq_sql_checks(spark, d):
    """SQL checks with integer, fractional, text, null and missing results."""
    fx.table(spark, d, "part").createOrReplaceTempView("portolan_part")
    report = sql_check_report(spark, [{"check_sql": sql.replace("FROM part", "FROM portolan_part"), "expected_result": expected}
                                      for sql, expected in SQL_CHECKS])
    spark.catalog.dropTempView("portolan_part")  # the statements are resolved by now
    return report.withColumn("check_sql", F.regexp_replace("check_sql", "portolan_part", "part"))


def dq_cast_loss(spark, d):
    """Values that a cast to the table's types would lose: none by the types in use, those beyond 2^31 and
    the texts by narrower ones."""
    raw = fx.visits_raw(spark, d).withColumn("big", F.col("cicid") * 100000)
    return cast_loss_report(raw, {**{c: t for c, t in immigration.IMMIGRATION_TYPES.items()}, "big": "int", "fltno": "int",
                                  "visatype": "int"})


def dq_rejects(spark, d):
    """The values that a conversion of the arrivals loses, written next to the converted rows and listed from there."""
    raw = fx.visits_raw(spark, d).withColumn("big", F.col("cicid").cast("bigint") * 100000)
    path = scratch_path(spark, "converted")
    save_data(convert_types(raw, {**immigration.IMMIGRATION_TYPES, "big": "int", "fltno": "int", "visatype": "int"}, rejects="_rejects"), path)
    return rejected_values(load_data(spark, path), "cicid", "_rejects")


def _dimensions(spark, d):
    """Country, states and date, each written once."""
    return (stage(country(spark, d), "country"), stage(states(spark, d), "states"), stage(dates(spark, d), "date"))


def warehouse_load(spark, d):
    database = f"portolan_{uuid.uuid4().hex[:10]}"
    tables = {"immigration": facts(spark, d), "country": country(spark, d), "states": states(spark, d),
              # The date dimension is united from the days of the loaded months.
              "date": lambda load: load.answers().date_dimension()}
    table_schemas = dict(schemas.WAREHOUSE_SCHEMAS)
    table_schemas["states"] = STATES_FIXTURE_TABLE
    return warehouse.warehouse_load(spark, database, scratch_path(spark, "warehouse"), tables,
                                    table_schemas=table_schemas)


# --- analytics -------------------------------------------------------------------------------

def star_join(spark, d):
    out = analytics.star_join(facts(spark, d), *_dimensions(spark, d))
    return _r4(out, "residence_temperature")


def decode_codes(spark, d):
    return analytics.decode_codes(facts(spark, d), [
        ("i94mode", mode_lookup(spark), "ID", "Mode", "mode"),
        ("i94visa", visa_lookup(spark), "ID", "Type", "visa_type"),
        # derived by a distinct over orders, so its plan size is that of orders: write it, then its size is known
        ("i94port", stage(fx.lookup_port(spark, d), "ports"), "ID", "Port", "port"),
    ])


def _colocated(spark, d):
    """Arrivals and parts stored by part number: some arrivals have none, some one that no part has, and one part's share is hot."""
    number = F.col("fltno").cast("bigint")
    key = (F.when(number % 17 == 0, F.lit(None)).when(number % 19 == 0, number + 1_000_000_000).when(number % 3 == 1, F.lit(1)).otherwise(number))
    database, location = f"portolan_{uuid.uuid4().hex[:10]}", scratch_path(spark, "colocated")
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{location}'")
    save_colocated(facts(spark, d).select("cicid", key.alias("part"), "stay"), f"{database}.arrivals", "part", 8, location)
    save_colocated(fx.table(spark, d, "part").select("p_partkey", "p_brand", "p_type"), f"{database}.parts", "p_partkey", 8, location, dimension=True)
    return f"{database}.arrivals", f"{database}.parts"


def colocated_join(spark, d):
    return join_colocated(spark, *_colocated(spark, d), "part", "p_partkey", ["p_brand", "p_type"])


def colocated_orphans(spark, d):
    return join_colocated(spark, *_colocated(spark, d), "part", "p_partkey", [], "left_anti")


def normalize_state_codes(spark, d):
    normalized = analytics.normalize_state_codes(facts(spark, d), stage(states(spark, d), "states"))
    return analytics.visitors_by(normalized, "i94addr")


def average_stay(spark, d):
    return _r4(analytics.average_stay(facts(spark, d)), "avg_stay")


def visitors_by_nationality(spark, d):
    return analytics.visitors_by_country(facts(spark, d), country(spark, d), "i94cit")


def visitor_demographics(spark, d):
    out = analytics.visitor_demographics(facts(spark, d), states(spark, d), genders=("A", "N", "R"))
    return _r4(out, "avg_age", "share_A", "share_N", "share_R", "visitors_per_1000")


def visitors_by_airline(spark, d):
    return analytics.visitors_by(facts(spark, d), "airline")


def visitors_by_origin(spark, d):
    return analytics.visitors_by_country(facts(spark, d), country(spark, d), "i94res")


def destination_source_lift(spark, d):
    return _r4(analytics.destination_source_lift(facts(spark, d)), "lift")


def demographics_correlation(spark, d):
    out = analytics.demographics_correlation(facts(spark, d), states(spark, d), STATE_COLUMNS)
    return _r4(out, *[f"corr_{c}" for c in STATE_COLUMNS])


def temperature_correlation(spark, d):
    return _r4(analytics.temperature_correlation(facts(spark, d), country(spark, d)), "corr_temperature")


def destination_source_climate(spark, d):
    return _r4(analytics.destination_source_climate(facts(spark, d), country(spark, d)),
               "avg_source_temperature")


# --- answers from monthly states ---------------------------------------------------------------

# The states of the arrivals per (application, test folder), built by three deliveries; the second one delivers
# 1994 again.
_ANSWERS: dict[tuple[str, str], str] = {}


def answers(spark: SparkSession, d: str) -> rollups.Answers:
    key = (app_id(spark), d.rstrip("/"))
    if key not in _ANSWERS:
        root, fact = scratch_path(spark, "states"), facts(spark, d)
        for part in (F.col("i94yr") <= 1994, F.col("i94yr").between(1994, 1996), F.col("i94yr") > 1996):
            rollups.update_states(fact.where(part), root)
        _ANSWERS[key] = root
    return rollups.Answers(spark, _ANSWERS[key])


def rolled_date_dimension(spark, d):
    return answers(spark, d).date_dimension()


def rolled_average_stay(spark, d):
    return _r4(answers(spark, d).average_stay(), "avg_stay")


def rolled_visitors_by_nationality(spark, d):
    return answers(spark, d).visitors_by_nationality(country(spark, d))


def rolled_visitors_by_airline(spark, d):
    return answers(spark, d).visitors_by_airline()


def rolled_visitors_by_origin(spark, d):
    return answers(spark, d).visitors_by_origin(country(spark, d))


def rolled_destination_source_lift(spark, d):
    return _r4(answers(spark, d).destination_source_lift(), "lift")


def rolled_visitor_demographics(spark, d):
    out = answers(spark, d).visitor_demographics(states(spark, d), genders=("A", "N", "R"))
    return _r4(out, "avg_age", "share_A", "share_N", "share_R", "visitors_per_1000")


def rolled_demographics_correlation(spark, d):
    out = answers(spark, d).demographics_correlation(states(spark, d), STATE_COLUMNS)
    return _r4(out, *[f"corr_{c}" for c in STATE_COLUMNS])


def rolled_temperature_correlation(spark, d):
    return _r4(answers(spark, d).temperature_correlation(country(spark, d)), "corr_temperature")


def rolled_destination_source_climate(spark, d):
    return _r4(answers(spark, d).destination_source_climate(country(spark, d)), "avg_source_temperature")


#: Queries that give the rows of another one by another way.
ROLLED = {f"rolled_{name}": name for name in (
    "date_dimension", "average_stay", "visitors_by_nationality", "visitors_by_airline", "visitors_by_origin", "destination_source_lift",
    "visitor_demographics", "demographics_correlation", "temperature_correlation", "destination_source_climate")}

QUERIES: dict[str, Query] = {
    "load_project_limit": load_project_limit,
    "csv_roundtrip": csv_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "partitioned_fact_write": partitioned_fact_write,
    "land_temperature": land_temperature,
    "land_temperature_by_city": land_temperature_by_city,
    "land_airport": land_airport,
    "stage_table_load": stage_table_load,
    "monthly_refresh": monthly_refresh,
    "monthly_stream_ingest": monthly_stream_ingest,
    "extract_key_values": extract_key_values,
    "label_text_lookups": label_text_lookups,
    "label_text_sections": label_text_sections,
    "convert_types": convert_types_q,
    "drop_columns": drop_columns_q,
    "rename_columns": rename_columns_q,
    "value_refactoring": value_refactoring,
    "title_case": title_case_q,
    "sas_dates": sas_dates,
    "stay_length": stay_length,
    "immigration_fact": immigration_fact,
    "date_dimension": date_dimension,
    "city_first_values": city_first_values,
    "first_values_default": first_values_default,
    "race_pivot": race_pivot,
    "city_demographics": city_demographics,
    "state_rollup": state_rollup,
    "states_dimension": states_dimension,
    "country_climate": country_climate,
    "country_climate_nonnull": country_climate_nonnull,
    "country_climate_two_level": country_climate_two_level,
    "country_dimension": country_dimension,
    "dq_null_keys": dq_null_keys,
    "dq_row_counts": dq_row_counts,
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_orphans": dq_orphans,
    "dq_sql_checks": dq_sql_checks,
    "dq_cast_loss": dq_cast_loss,
    "warehouse_load": warehouse_load,
    "star_join": star_join,
    "decode_codes": decode_codes,
    "normalize_state_codes": normalize_state_codes,
    "average_stay": average_stay,
    "visitors_by_nationality": visitors_by_nationality,
    "visitor_demographics": visitor_demographics,
    "visitors_by_airline": visitors_by_airline,
    "visitors_by_origin": visitors_by_origin,
    "destination_source_lift": destination_source_lift,
    "demographics_correlation": demographics_correlation,
    "temperature_correlation": temperature_correlation,
    "destination_source_climate": destination_source_climate,
    "colocated_join": colocated_join,
    "colocated_orphans": colocated_orphans,
    "dq_incremental_keys": dq_incremental_keys,
    "dq_rejects": dq_rejects,
    **{name: globals()[name] for name in ROLLED},
}
