"""Aggregations: deterministic first values, one-pass pivots, roll-ups, two-level means.

All of them are plain ``groupBy().agg()`` with built-in aggregate functions, so Spark
runs a partial aggregation before the shuffle: a hot key costs one row per map task,
not one task holding a third of the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def first_value_columns(attributes: Mapping[str, str], order_by: Column | None = None,
                        ignore_nulls: bool = False) -> tuple[list[Column], list[Column]]:
    """Aggregate expressions for "the first row's values" and the projection that unpacks them.

    ``order_by`` fixes which row is first (smallest value first). Without it the rows are
    ordered by the attributes themselves, one after the other, null before any value: a
    total order, so rows that tie hold the same values and the result never follows the
    input order.
    Every attribute is a ``min_by`` on the same ordering, so all values come from one
    row; with a numeric order, numeric attributes keep fixed-width buffers and the aggregation stays
    hash-based. With ``ignore_nulls`` each attribute takes its first non-null value.
    """
    names = list(attributes)
    order = order_by if order_by is not None else F.struct(*[_c(n) for n in names])
    if ignore_nulls:
        aggs = [F.min_by(_c(n), F.when(_c(n).isNotNull(), order)).alias(attributes[n]) for n in names]
    else:
        aggs = [F.min_by(_c(n), order).alias(attributes[n]) for n in names]
    return aggs, [_c(attributes[n]) for n in names]


def first_values(df: DataFrame, keys: Sequence[str], attributes: Mapping[str, str],
                 order_by: Column | None = None, ignore_nulls: bool = False) -> DataFrame:
    """One row per key with the first row's ``attributes`` (``{source: output name}``)."""
    aggs, unpack = first_value_columns(attributes, order_by, ignore_nulls)
    return df.groupBy(*[_c(k) for k in keys]).agg(*aggs).select(*[_c(k) for k in keys], *unpack)


def pivot_sum_columns(pivot: str, values: Mapping[object, str], measure: str,
                      fill: object | None = None) -> list[Column]:
    """``sum(measure)`` per pivot value as one conditional sum each (fixed output schema,
    no job to discover the values, a single aggregation)."""
    out = []
    for value, name in values.items():
        total = F.sum(F.when(_c(pivot) == F.lit(value), _c(measure)))
        out.append((F.coalesce(total, F.lit(fill)) if fill is not None else total).alias(name))
    return out


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot: str, values: Mapping[object, str],
              measure: str, fill: object | None = None) -> DataFrame:
    """``groupBy(keys).pivot(pivot, values).sum(measure)`` with explicit values."""
    return df.groupBy(*[_c(k) for k in keys]).agg(*pivot_sum_columns(pivot, values, measure, fill))


def pivot_loss_report(df: DataFrame, pivot: str, values: Mapping[object, str], measure: str) -> DataFrame:
    """One row (measure_total, pivot_total, lost_values, passed): what a pivot on a fixed list of
    ``values`` leaves out. It passes when the measure's total over all rows is that over the
    listed values; ``lost_values`` names up to ten of the others."""
    listed = F.coalesce(_c(pivot).isin(list(values)), F.lit(False))
    per_value = df.groupBy(_c(pivot).cast("string").alias("value"), listed.alias("listed")).agg(F.sum(_c(measure)).alias("total"))
    other = F.when(~F.col("listed") & F.col("total").isNotNull(), F.coalesce("value", F.lit("null")))
    return per_value.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("measure_total"),
        F.coalesce(F.sum(F.when(F.col("listed"), F.col("total"))), F.lit(0)).alias("pivot_total"),
        F.array_join(F.slice(F.sort_array(F.collect_set(other)), 1, 10), ", ").alias("lost_values"),
    ).withColumn("passed", F.col("lost_values") == "")


def sum_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``sum`` of each column per key, named like the column (no ``sum(...)`` names)."""
    return df.groupBy(*[_c(k) for k in keys]).agg(*[F.sum(_c(c)).alias(c) for c in columns])


def mean_and_first(df: DataFrame, key: str, value: str, firsts: Sequence[str],
                   order_by: Column | None = None, ignore_nulls: bool = False,
                   mean_name: str = "mean") -> DataFrame:
    """Per key: mean of ``value`` (text is read as a number, non-numbers skipped) and the
    first row's ``firsts``.

    In two steps: rows are first united by key and attributes with sums, counts and the smallest ``order_by``, all of fixed
    width, so that the many rows of a source meet a hash aggregation; only the distinct attributes of a key (as many as
    it has coordinates, say) meet the aggregation that carries text. Rows that tie in ``order_by`` are ordered by their attributes.
    """
    number = _c(value).try_cast("double")
    order = [] if order_by is None else [F.min(order_by).alias("_low")]
    united = df.groupBy(_c(key), *[_c(c) for c in firsts]).agg(F.sum(number).alias("_sum"), F.count(number).alias("_n"), *order)
    place = F.struct(*[_c(c) for c in firsts]) if order_by is None else \
        F.when(F.col("_low").isNotNull(), F.struct(F.col("_low"), *[_c(c) for c in firsts]))
    aggs, unpack = first_value_columns({c: c for c in firsts}, place, ignore_nulls)
    mean = (F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0))).alias(mean_name)
    return united.groupBy(_c(key)).agg(mean, *aggs).select(_c(key), _c(mean_name), *unpack)


def two_level_mean(df: DataFrame, outer: str, inner: str, value: str,
                   mean_name: str = "mean", count_name: str = "n_inner") -> DataFrame:
    """Mean of per-``inner`` means per ``outer`` (e.g. cities, then countries)."""
    inner_means = (df.groupBy(_c(outer), _c(inner))
                   .agg(F.avg(_c(value).try_cast("double")).alias("_inner_mean")))
    return inner_means.groupBy(_c(outer)).agg(F.avg("_inner_mean").alias(mean_name),
                                              F.count(F.lit(1)).alias(count_name))
