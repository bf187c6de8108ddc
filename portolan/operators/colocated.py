"""Joins of a fact to a dimension too large to broadcast, without shuffling the fact at query time.

``save_colocated`` stores a table once by the hash of a key: bucketed and sorted, so two tables with the same number of buckets join bucket by
bucket with no exchange and no sort. What would make a bucket hot is stored apart: rows without a key, which match nothing, and the
rows of the few keys that hold more than ``hot_share`` of all rows (at most ``1 / hot_share`` keys, so as many rows of a dimension, which
are broadcast). ``join_colocated`` unites the three parts.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROPERTY = "portolan.hot"


def _parts(table: str) -> dict[str, str]:
    """The tables of a stored frame; ``table`` may name its database."""
    return {part: table if part == "cold" else f"{table}__{part}" for part in ("cold", "hot", "nulls")}


def _quoted(table: str) -> str:
    return ".".join(f"`{name}`" for name in table.split("."))


def save_colocated(df: DataFrame, table: str, key: str, buckets: int, location: str, hot_share: float = 0.01, dimension: bool = False) -> None:
    """Store ``df`` as ``table`` (below ``location``) by ``key``; an existing one is replaced. A ``dimension`` has one row a key,
    which is checked, and no hot keys. The rows are shuffled here, once, whatever is joined to them later."""
    spark, column = df.sparkSession, F.col(f"`{key}`")
    parts, hot = _parts(table), []
    per_key = df.where(column.isNotNull()).groupBy(column.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    if dimension:
        twice = per_key.where("n > 1").limit(1).collect()
        if twice:
            raise ValueError(f"{table}: the key {twice[0]['k']!r} occurs {twice[0]['n']} times")
    else:
        total = per_key.agg(F.sum("n")).first()[0] or 0
        hot = [r["k"] for r in per_key.where(F.col("n") > max(1.0, hot_share * total)).collect()]  # fewer than 1 / hot_share
    is_hot = column.isin(hot) if hot else F.lit(False)
    place = lambda part: f"{location}/{parts[part].rsplit('.', 1)[-1]}"
    cold = df.where(column.isNotNull() & ~is_hot).repartition(buckets, column)
    (cold.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option("path", place("cold")).saveAsTable(_quoted(parts["cold"])))
    for part, rows in (("hot", df.where(column.isNotNull() & is_hot)), ("nulls", df.where(column.isNull()))):
        rows.write.mode("overwrite").option("path", place(part)).saveAsTable(_quoted(parts[part]))
    spark.sql(f"ALTER TABLE {_quoted(parts['cold'])} SET TBLPROPERTIES ('{PROPERTY}'='{json.dumps(hot, default=str)}')")


def hot_keys(spark: SparkSession, table: str) -> list:
    """The keys whose rows a stored table keeps apart."""
    shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(table)}").collect()}
    return json.loads(shown.get(PROPERTY, "[]"))


def read_colocated(spark: SparkSession, table: str) -> DataFrame:
    """All rows of a stored table."""
    cold, hot, nulls = (spark.table(_quoted(name)) for name in _parts(table).values())
    return cold.unionByName(hot).unionByName(nulls)


def join_colocated(spark: SparkSession, fact: str, dimension: str, fact_key: str, dimension_key: str,
                   columns: Sequence[str], how: str = "left") -> DataFrame:
    """The rows of the stored ``fact`` with ``columns`` of the stored ``dimension``: ``left`` keeps all, ``inner`` those that match,
    ``left_anti`` those that don't but have a key (orphans; without ``columns``)."""
    if how not in ("left", "inner", "left_anti"):
        raise ValueError(f"how must be left, inner or left_anti: {how}")
    parts = {part: spark.table(_quoted(name)) for part, name in _parts(fact).items()}
    side = spark.table(_quoted(dimension)).select(F.col(f"`{dimension_key}`").alias("_key"), *[F.col(f"`{c}`") for c in columns])
    on = F.col(f"`{fact_key}`") == F.col("_key")
    out = parts["cold"].join(side, on, how)
    hot = hot_keys(spark, fact)
    if hot:
        few = side.where(F.col("_key").isin(hot))  # a row a key
        out = out.unionByName(parts["hot"].join(F.broadcast(few), on, how))
    out = out.drop("_key")
    if how == "left":
        missing = {c: F.lit(None).cast(side.schema[c].dataType) for c in columns}
        out = out.unionByName(parts["nulls"].withColumns(missing) if missing else parts["nulls"])
    return out
