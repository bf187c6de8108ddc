"""Data-quality checks as DataFrames: one lazy report, then (optionally) one raise.

Each table is scanned once for all of its counts (``count``, ``count_if``), every
count is a global aggregate with partial aggregation per task, and the report is a
union of one-row frames. Only the report (one row per check) ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.functions.columns import lenient_cast


class DataQualityError(ValueError):
    """Raised with every failed check listed, not just the first one."""


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _equals(result: Column, kind: T.DataType, expected: object) -> Column:
    """The result compared with the expected value as given: numbers as numbers (0.5 is not 0, 2.0
    is 2), text as text, null only with None; values of different kinds differ."""
    if expected is None:
        return result.isNull()
    if isinstance(expected, bool) or isinstance(kind, T.BooleanType):
        same = isinstance(expected, bool) and isinstance(kind, T.BooleanType)
    elif isinstance(expected, (int, float, Decimal)):
        same = isinstance(kind, T.NumericType)
    else:
        same = isinstance(kind, T.StringType) == isinstance(expected, str)
    return F.coalesce(result == F.lit(expected), F.lit(False)) if same else F.lit(False)


def sql_check_report(spark: SparkSession, checks: Sequence[Mapping[str, object]]) -> DataFrame:
    """``[{check_sql, expected_result}]`` -> (check_sql, result, expected, passed), values as text.

    The result of a check is the first column of its first row, as in a scalar query. A
    check without a row fails (its result is null and so is any other missing value).
    """
    rows = []
    for check in checks:
        sql, expected = str(check["check_sql"]), check["expected_result"]
        result = spark.sql(sql)
        kind = result.schema.fields[0].dataType
        named = result.toDF(*[f"c{i}" for i in range(len(result.columns))]).select("c0").limit(1)
        # A global aggregate always has its one row, also over no rows.
        rows.append(named.agg(F.count(F.lit(1)).alias("n"), F.first("c0").alias("value"))
                    .select(F.lit(sql).alias("check_sql"), F.col("value").cast("string").alias("result"),
                            F.lit(None if expected is None else str(expected)).cast("string").alias("expected"),
                            ((F.col("n") > 0) & _equals(F.col("value"), kind, expected)).alias("passed")))
    return _union(rows)


def cast_loss_report(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """(column, lost, passed): values that are there but become null when the named columns
    are cast, e.g. a key beyond an integer's range. One scan for all columns."""
    current = {f.name: f.dataType for f in df.schema.fields}
    used = [c for c in types if c in current]
    lost = df.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & lenient_cast(F.col(f"`{c}`"), current[c], types[c]).isNull())
                    .alias(c) for c in used])
    return lost.unpivot([], used, "column", "lost").withColumn("passed", F.col("lost") == 0)


def table_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table (one scan each): rows and rows whose key is null."""
    frames = [df.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count_if(F.col(f"`{key}`").isNull()).alias("null_keys"))
              .select(F.lit(name).alias("table"), F.lit(key).alias("key"), "n_rows", "null_keys")
              for name, (df, key) in tables.items()]
    return _union(frames)


def null_key_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table, key, null_keys, expected, passed): no key may be null."""
    counts = table_counts(tables)
    return counts.select("table", "key", "null_keys", F.lit(0).cast("bigint").alias("expected"),
                         (F.col("null_keys") == 0).alias("passed"))


def row_count_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, n_rows, passed): every table must hold at least one row."""
    frames = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
              for name, df in tables.items()]
    return _union(frames).withColumn("passed", F.col("n_rows") >= 1)


def duplicate_key_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table, duplicate_keys, duplicate_rows): keys held by more than one row, and the
    rows holding them. A primary key has 0 of both. Null keys are checked separately."""
    frames = []
    for name, (df, key) in tables.items():
        per_key = (df.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`"))
                   .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        frames.append(per_key.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                                  F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("duplicate_rows"))
                      .select(F.lit(name).alias("table"), "duplicate_keys", "duplicate_rows"))
    return _union(frames)


def orphan_report(fact: DataFrame, relations: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """(relationship, orphans): non-null foreign keys of ``fact`` without a dimension row.

    ``relations`` = [(name, fact column, dimension, dimension key)]. The fact is read
    once: every dimension's key set is left-joined and one aggregation counts the misses
    of all relationships, instead of one anti-join scan per relationship. Pass dimensions
    as tables (the warehouse, or ``portolan.session.stage``): the planner then knows
    their size, broadcasts small key sets and joins large ones by sort-merge.
    """
    used = sorted({col for _, col, _, _ in relations})
    joined = fact.select(*[F.col(f"`{c}`") for c in used])
    misses = []
    for i, (name, col, dim, key) in enumerate(relations):
        keys = dim.select(F.col(f"`{key}`").alias(f"_k{i}")).distinct()
        joined = joined.join(keys, joined[col] == keys[f"_k{i}"], "left")
        misses.append(F.count_if(F.col(f"`{col}`").isNotNull() & F.col(f"_k{i}").isNull()).alias(name))
    wide = joined.agg(*misses)
    return wide.unpivot([], [name for name, _, _, _ in relations], "relationship", "orphans")


def raise_on_failure(report: DataFrame, what: str = "Data quality") -> DataFrame:
    """Collect the (small) report and raise listing every failed row; return it otherwise."""
    failed = [row.asDict() for row in report.where(~F.col("passed")).collect()]
    if failed:
        raise DataQualityError(f"{what} validation FAILED: {failed}")
    return report
