"""Schemas of sources and warehouse tables, and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, I, L, D = StringType(), IntegerType(), LongType(), DoubleType()

# ---------------------------------------------------------------------------
# Fixed values of the data model: keep them exactly as written, results depend on them.
# ---------------------------------------------------------------------------

# Day numbers in the arrivals source count days since this date.
SAS_EPOCH = "1960-01-01"
ISO_DATE = "yyyy-MM-dd"

# Columns of the arrivals source that the fact job reads.
IMMIGRATION_READ_COLUMNS = [
    "i94addr", "i94mon", "cicid", "i94visa", "i94res", "arrdate", "i94yr", "depdate",
    "airline", "fltno", "i94mode", "i94port", "visatype", "gender", "i94cit", "i94bir",
]
# Columns cast to integer (absent ones are ignored).
IMMIGRATION_INTEGER_COLUMNS = [
    "cicid", "i94yr", "i94mon", "i94cit", "i94res", "arrdate", "i94mode", "i94bir",
    "i94visa", "count", "biryear", "dtadfile", "depdate",
]
# Keys that grow with the data are cast to bigint: yearly volumes at scale pass 2^31.
IMMIGRATION_LONG_COLUMNS = ["cicid"]
# Day-number columns turned into ISO date strings.
IMMIGRATION_DATE_COLUMNS = ["arrdate", "depdate"]
# Columns dropped: mostly empty, and not useful.
IMMIGRATION_HIGH_NULL_COLUMNS = ["visapost", "occup", "entdepu", "insnum"]
IMMIGRATION_UNUSED_COLUMNS = ["count", "entdepa", "entdepd", "matflag", "dtaddto", "biryear", "admnum"]
# The fact is partitioned by arrival year and month.
IMMIGRATION_PARTITION_COLUMNS = ["i94yr", "i94mon"]

# City demographics: keys, numeric types, the attributes repeated on every race row
# (source name -> warehouse name) and the race values (value -> column name).
DEMOGRAPHICS_KEYS = ["City", "State", "State Code"]
DEMOGRAPHICS_INTEGER_COLUMNS = ["Count", "Male Population", "Female Population", "Total Population",
                                "Number of Veterans", "Foreign-born"]
DEMOGRAPHICS_DOUBLE_COLUMNS = ["Median Age", "Average Household Size"]
DEMOGRAPHICS_CITY_ATTRIBUTES = {
    "Median Age": "MedianAge",
    "Male Population": "MalePopulation",
    "Female Population": "FemalePopulation",
    "Total Population": "TotalPopulation",
    "Number of Veterans": "NumberVeterans",
    "Foreign-born": "ForeignBorn",
    "Average Household Size": "AverageHouseholdSize",
}
RACES = {
    "American Indian and Alaska Native": "AmericanIndianAndAlaskaNative",
    "Asian": "Asian",
    "Black or African-American": "BlackOrAfricanAmerican",
    "Hispanic or Latino": "HispanicOrLatino",
    "White": "White",
}
# Columns summed per state.
STATE_SUM_COLUMNS = ["TotalPopulation", "FemalePopulation", "MalePopulation", "NumberVeterans", "ForeignBorn",
                     "AmericanIndianAndAlaskaNative", "Asian", "BlackOrAfricanAmerican", "HispanicOrLatino", "White"]

# Country names of the temperature source renamed to match the country lookup.
TEMPERATURE_COUNTRY_RENAMES = [
    ("Country", "Congo (Democratic Republic Of The)", "Congo"),
    ("Country", "Côte D'Ivoire", "Ivory Coast"),
]
# Country lookup labels renamed to match the temperature source.
LOOKUP_COUNTRY_RENAMES = [
    ("I94CTRY", "BOSNIA-HERZEGOVINA", "BOSNIA AND HERZEGOVINA"),
    ("I94CTRY", "INVALID: CANADA", "CANADA"),
    ("I94CTRY", "CHINA, PRC", "CHINA"),
    ("I94CTRY", "GUINEA-BISSAU", "GUINEA BISSAU"),
    ("I94CTRY", "INVALID: PUERTO RICO", "PUERTO RICO"),
    ("I94CTRY", "INVALID: UNITED STATES", "UNITED STATES"),
]

# Code labels of travel mode and visa category.
MODE_LABELS = [(1, "Air"), (2, "Sea"), (3, "Land"), (9, "Not reported")]
VISA_LABELS = [(1, "Business"), (2, "Pleasure"), (3, "Student")]
# Catch-all state code for codes outside the valid list.
OTHER_STATE_CODE = "99"

# Warehouse quality checks: first column of the first row must equal the expected value.
NULL_KEY_CHECKS = [
    {"check_sql": "SELECT COUNT(*) FROM immigration WHERE cicid is null", "expected_result": 0},
    {"check_sql": "SELECT COUNT(*) FROM country WHERE Code is null", "expected_result": 0},
    {"check_sql": "SELECT COUNT(*) FROM states WHERE Code is null", "expected_result": 0},
    {"check_sql": "SELECT COUNT(*) FROM date WHERE date is null", "expected_result": 0},
]
WAREHOUSE_TABLES = ["immigration", "country", "states", "date"]
WAREHOUSE_KEYS = {"immigration": "cicid", "country": "Code", "states": "Code", "date": "date"}

# ---------------------------------------------------------------------------
# Sources (as delivered) and warehouse tables (column order is the load order).
# ---------------------------------------------------------------------------

TEMPERATURE_SOURCE = _schema(("dt", S), ("AverageTemperature", S), ("City", S), ("Country", S),
                             ("Latitude", S), ("Longitude", S))
DEMOGRAPHICS_SOURCE = _schema(("City", S), ("State", S), ("Median Age", S), ("Male Population", S),
                              ("Female Population", S), ("Total Population", S), ("Number of Veterans", S),
                              ("Foreign-born", S), ("Average Household Size", S), ("State Code", S),
                              ("Race", S), ("Count", S))
AIRPORT_SOURCE = _schema(("ident", S), ("type", S), ("name", S), ("elevation_ft", S), ("continent", S),
                         ("iso_country", S), ("iso_region", S), ("municipality", S), ("gps_code", S),
                         ("iata_code", S), ("local_code", S), ("coordinates", S))

LOOKUP_STATE = _schema(("Code", S), ("State", S))
LOOKUP_COUNTRY = _schema(("Code", I), ("I94CTRY", S))
LOOKUP_PORT = _schema(("ID", S), ("Port", S))
LOOKUP_MODE = _schema(("ID", I), ("Mode", S))
LOOKUP_VISA = _schema(("ID", I), ("Type", S))

IMMIGRATION_TABLE = _schema(
    ("i94addr", S), ("cicid", L), ("i94visa", I), ("i94res", I), ("arrdate", S), ("depdate", S),
    ("airline", S), ("fltno", S), ("i94mode", I), ("i94port", S), ("visatype", S), ("gender", S),
    ("i94cit", I), ("i94bir", I), ("stay", I), ("i94yr", I), ("i94mon", I))
COUNTRY_TABLE = _schema(("Code", I), ("Country", S), ("Temperature", D), ("Latitude", S), ("Longitude", S))
STATES_TABLE = _schema(
    ("Code", S), ("State", S), ("BlackOrAfricanAmerican", L), ("TotalPopulation", L), ("White", L),
    ("ForeignBorn", L), ("AmericanIndianAndAlaskaNative", L), ("HispanicOrLatino", L), ("NumberVeterans", L),
    ("Asian", L), ("FemalePopulation", L), ("MalePopulation", L))
DATE_TABLE = _schema(("date", S), ("year", I), ("month", I), ("day", I), ("weekofyear", I), ("dayofweek", I))

WAREHOUSE_SCHEMAS = {"immigration": IMMIGRATION_TABLE, "country": COUNTRY_TABLE,
                     "states": STATES_TABLE, "date": DATE_TABLE}
WAREHOUSE_PARTITIONS = {"immigration": IMMIGRATION_PARTITION_COLUMNS}
