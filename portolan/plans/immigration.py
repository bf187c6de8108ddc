"""The arrivals fact and the date dimension.

Fact: project the read columns, cast them leniently to integers, compute the stay in
days from the day numbers, turn the day numbers into ISO dates, drop unused columns.
Only projections: no shuffle, one pass, whole-stage code generation end to end.

Date dimension: every distinct arrival or departure day, one scan (``explode(array(arr,
dep))`` + ``distinct`` before any parsing); partial aggregation keeps the shuffle at
one row per day per task however hot a day is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from portolan import schemas
from portolan.functions.columns import convert_types, drop_columns, rejected_values  # noqa: F401 (re-exported)
from portolan.functions.dates import convert_day_numbers, date_parts, day_difference, day_number_to_date, iso_date
from portolan.operators.quality import DataQualityError
from portolan.sources.io import load_data, save_data


# The integer types of the fact: bigint for keys that grow with the data, int for codes and days.
IMMIGRATION_TYPES = {c: "bigint" if c in schemas.IMMIGRATION_LONG_COLUMNS else "int"
                     for c in schemas.IMMIGRATION_INTEGER_COLUMNS}


def read_immigration(spark: SparkSession, path: str, format: str = "parquet",
                     columns: Sequence[str] = tuple(schemas.IMMIGRATION_READ_COLUMNS),
                     debug_size: int | None = None, order_by: str | None = None, **options: object) -> DataFrame:
    """The arrivals source in any installed format, projected to the columns the fact
    reads (``debug_size`` keeps only the first rows by ``order_by``, by default the key). CSV
    has a header unless ``header`` says otherwise."""
    if format == "csv":
        options.setdefault("header", True)
    if debug_size is not None and order_by is None:
        order_by = "cicid"
    return load_data(spark, path, format, list(columns), debug_size, order_by=order_by, **options)


def immigration_facts(raw: DataFrame, columns: Sequence[str] = schemas.IMMIGRATION_READ_COLUMNS, rejects: str | None = None) -> DataFrame:
    """Raw arrival records -> fact rows (lazy). ``rejects`` adds a column of the values that no type took (``convert_types``)."""
    present = [c for c in columns if c in raw.columns]
    df = raw.select(*present)
    df = convert_types(df, IMMIGRATION_TYPES, rejects)
    if "arrdate" in df.columns and "depdate" in df.columns:
        # Signed days from arrival to departure; null when either day is unknown.
        df = df.withColumn("stay", day_difference(F.col("arrdate"), F.col("depdate")))
    df = convert_day_numbers(df, schemas.IMMIGRATION_DATE_COLUMNS)
    return drop_columns(df, schemas.IMMIGRATION_HIGH_NULL_COLUMNS, schemas.IMMIGRATION_UNUSED_COLUMNS)


def date_dimension(facts: DataFrame, columns: Sequence[str] = tuple(schemas.IMMIGRATION_DATE_COLUMNS)) -> DataFrame:
    """(date, year, month, day, weekofyear, dayofweek) for every distinct non-null day of
    the ISO-date ``columns`` of ``facts``; ``date`` is unique.

    Texts are made distinct first, in the scan's tasks, and only the few distinct ones
    are parsed. For raw records use :func:`date_dimension_of_days`, which works on numbers.
    """
    texts = facts.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("text_")).distinct()
    return calendar(texts.withColumnRenamed("text_", "date"))


def date_dimension_of_days(raw: DataFrame, columns: Sequence[str] = tuple(schemas.IMMIGRATION_DATE_COLUMNS)) -> DataFrame:
    """The same from raw records' day numbers: distinct integers, then dates."""
    days = convert_types(raw.select(*columns), {c: "int" for c in columns})
    numbers = days.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("number_")).distinct()
    return _calendar(numbers.select(day_number_to_date(F.col("number_")).alias("day_")))


def calendar(dates: DataFrame) -> DataFrame:
    """The date dimension of the ISO dates in the column ``date``."""
    return _calendar(dates.select(iso_date(F.col("date")).alias("day_")))


def _calendar(days: DataFrame) -> DataFrame:
    days = days.where(F.col("day_").isNotNull()).distinct()
    parts = date_parts(F.col("day_"))
    return days.select(F.col("day_").cast("string").alias("date"), *[v.alias(k) for k, v in parts.items()])


def process_immigration(raw: DataFrame, output_path: str | None = None, date_output_path: str | None = None,
                        partition_by: Sequence[str] | None = tuple(schemas.IMMIGRATION_PARTITION_COLUMNS),
                        saved_columns: str | Sequence[str] = "*",
                        max_records_per_file: int | None = None, rebalance: bool = True,
                        rejects: str | None = None, must_keep: Sequence[str] = ()) -> DataFrame:
    """Build the fact, write it partitioned by arrival year/month, and write the date
    dimension. When the fact is written first, the date dimension reads just its two
    date columns back instead of recomputing the fact.

    ``rebalance`` shuffles rows on the partition columns before the write (few, evenly
    sized files per month, hot months split by AQE). Input delivered one file per month
    is already clustered: pass ``rebalance=False`` to write it without a shuffle.

    ``rejects`` names a column of the written fact that holds the values lost in conversion (:func:`rejected_values` reads them
    from there). A lost value of the columns ``must_keep`` raises :class:`DataQualityError` when the fact has been
    written: they are counted while it is written, so the source is read once.
    """
    facts = immigration_facts(raw, rejects=rejects)
    if output_path is not None and must_keep:
        if rejects is None:
            raise ValueError("must_keep needs a rejects column")
        lost = Observation("lost")
        of = lambda c: F.coalesce(F.exists(F.col(rejects), lambda r: r["column"] == c), F.lit(False))
        save_data(facts.observe(lost, *[F.count_if(of(c)).alias(c) for c in must_keep]), output_path, columns=saved_columns,
                  partition_by=list(partition_by or []), max_records_per_file=max_records_per_file, rebalance=rebalance)
        failed = {c: n for c, n in lost.get.items() if n}
        if failed:
            raise DataQualityError(f"Key conversion validation FAILED: values lost {failed}")
    elif output_path is not None:
        save_data(facts, output_path, columns=saved_columns, partition_by=list(partition_by or []),
                  max_records_per_file=max_records_per_file, rebalance=rebalance)
    if date_output_path is not None:
        if output_path is not None and saved_columns == "*":
            dates = date_dimension(facts.sparkSession.read.parquet(output_path))
        else:
            dates = date_dimension_of_days(raw)
        save_data(dates, date_output_path)
    return facts
