"""Day-number dates, ISO date strings and calendar parts, as native expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.schemas import ISO_DATE, SAS_EPOCH


def day_number_to_date(days: Column) -> Column:
    """Days since 1960-01-01 (number, possibly fractional text) -> DATE; null stays null."""
    return F.date_add(F.lit(SAS_EPOCH).cast("date"), days.try_cast("double").try_cast("int"))


def day_number_to_iso(days: Column) -> Column:
    """Days since 1960-01-01 -> ``YYYY-MM-DD`` string (20545 -> '2016-04-01')."""
    return day_number_to_date(days).cast("string")


def date_to_day_number(date: Column) -> Column:
    """DATE (or timestamp) -> days since 1960-01-01."""
    return F.datediff(date.cast("date"), F.lit(SAS_EPOCH).cast("date"))


def convert_day_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn the named day-number columns into ISO strings; absent names are ignored."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: day_number_to_iso(F.col(c)) for c in present}) if present else df


def iso_date(text: Column) -> Column:
    """``YYYY-MM-DD`` text -> DATE, null when the text is not a date."""
    return F.try_to_date(text, ISO_DATE)


def date_difference(first: Column, second: Column) -> Column:
    """Signed days from ``first`` to ``second`` (ISO strings or dates); null if either is null."""
    return F.datediff(iso_date(second.cast("string")), iso_date(first.cast("string")))


def day_difference(first: Column, second: Column) -> Column:
    """Signed days from ``first`` to ``second`` (day numbers); null if either is null."""
    return (second - first).cast("int")


def date_parts(date: Column) -> dict[str, Column]:
    """Calendar attributes of a DATE: ISO week of year, day of week with Sunday = 1."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "weekofyear": F.weekofyear(date),
        "dayofweek": F.dayofweek(date),
    }
