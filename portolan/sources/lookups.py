"""Code lookup tables (code -> label) read as typed CSV with cleaned labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portolan import schemas
from portolan.functions.text import clean_label
from portolan.sources.io import load_data


def read_lookup(spark: SparkSession, path: str, schema: StructType, label: str) -> DataFrame:
    """Read a lookup CSV with a header; no-break spaces in the label become spaces."""
    df = load_data(spark, path, "csv", schema=schema, header=True)
    return df.withColumn(label, clean_label(F.col(label)))


def state_lookup(spark: SparkSession, path: str) -> DataFrame:
    """(Code string, State): codes stay text, the catch-all '99' included."""
    return read_lookup(spark, path, schemas.LOOKUP_STATE, "State")


def country_lookup(spark: SparkSession, path: str) -> DataFrame:
    """(Code int, I94CTRY): country codes of citizenship and residence."""
    return read_lookup(spark, path, schemas.LOOKUP_COUNTRY, "I94CTRY")


def port_lookup(spark: SparkSession, path: str) -> DataFrame:
    """(ID string, Port): port keys are text and may carry trailing blanks; never join on labels."""
    return read_lookup(spark, path, schemas.LOOKUP_PORT, "Port")


def _values(spark: SparkSession, rows, schema: StructType) -> DataFrame:
    """A small constant table as an inline ``VALUES`` relation: Catalyst knows its exact
    size, so joins against it are broadcast (a frame built from a Python list is an RDD
    of unknown size, which would make the planner shuffle the other side)."""
    def lit(value: object) -> str:
        return "'" + str(value).replace("'", "''") + "'" if isinstance(value, str) else str(value)
    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    names = ", ".join(f.name for f in schema.fields)
    df = spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def mode_lookup(spark: SparkSession) -> DataFrame:
    """(ID, Mode): the four travel-mode codes."""
    return _values(spark, schemas.MODE_LABELS, schemas.LOOKUP_MODE)


def visa_lookup(spark: SparkSession) -> DataFrame:
    """(ID, Type): the three visa categories."""
    return _values(spark, schemas.VISA_LABELS, schemas.LOOKUP_VISA)
