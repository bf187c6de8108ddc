"""Joins of a large fact to small dimensions and code lookups.

Left joins keep every fact row; the lookup side is projected to its key and labels
first. Which side is broadcast is the planner's decision, from measured sizes
(``spark.sql.autoBroadcastJoinThreshold``, AQE at runtime). A side whose plan statistics
are unreliable (a lazily aggregated frame) is staged first (``portolan.session.stage``),
which gives it a size in bytes; beyond the threshold the join is a sort-merge join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def unique_on(df: DataFrame, key: str) -> DataFrame:
    """One row per key (the smallest row), so a left join cannot fan out."""
    others = [c for c in df.columns if c != key]
    if not others:
        return df.select(F.col(f"`{key}`")).distinct()
    row = F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("_row")
    return df.groupBy(F.col(f"`{key}`")).agg(row).select(F.col(f"`{key}`"), "_row.*")


def lookup_join(df: DataFrame, lookup: DataFrame, left_key: str | Column, right_key: str,
                columns: Sequence[str] | None = None, prefix: str = "") -> DataFrame:
    """Left join ``df`` to a code table on ``left_key == right_key`` and add its ``columns``
    (all but the key by default), optionally prefixed. The lookup key is dropped."""
    columns = [c for c in (columns or lookup.columns) if c != right_key]
    side = lookup.select(F.col(f"`{right_key}`").alias("_lk"),
                         *[F.col(f"`{c}`").alias(prefix + c) for c in columns])
    left = F.col(f"`{left_key}`") if isinstance(left_key, str) else left_key
    return df.join(side, left == side["_lk"], "left").drop("_lk")


def decode(df: DataFrame, code: str, lookup: DataFrame, lookup_key: str, label: str,
           output: str | None = None) -> DataFrame:
    """Add the label of ``code`` from a lookup (``null`` for unknown codes)."""
    key = f"_{code}_key"
    side = lookup.select(F.col(f"`{lookup_key}`").alias(key), F.col(f"`{label}`").alias(output or label))
    return df.join(side, F.col(f"`{code}`") == side[key], "left").drop(key)
