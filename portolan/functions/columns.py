"""Column-level cleaning: lenient casts, drops, renames, value repair.

Every helper builds one projection of native expressions, so the whole chain stays
inside whole-stage code generation and Catalyst can prune and push through it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _as_type(dtype: T.DataType | str) -> T.DataType:
    if isinstance(dtype, T.DataType):
        return dtype
    return T._parse_datatype_string(dtype)


# Text that can be cast to a number: a decimal number with an exponent, or a hexadecimal one, between blanks and
# control characters. Other text is not cast at all, as a cast that fails costs an exception for every value.
NUMBER_TEXT = (r"^[\x00-\x20\x7F-\x9F]*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|0[xX][0-9a-fA-F.]+[pP][+-]?\d+)[dDfF]?"
               r"[\x00-\x20\x7F-\x9F]*$")
_BITS = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}


def _in_range(column: Column, source: T.DataType, target: T.DataType) -> Column | None:
    """Whether a number fits an integral type, after truncation; None if every one does."""
    bits = _BITS[type(target)]
    if isinstance(source, _INTEGRAL):
        return None if _BITS[type(source)] <= bits else column.between(-(1 << bits), (1 << bits) - 1)
    high = float(1 << bits)
    # Doubles next to the ends of bigint are whole; Spark takes 2^63 for its largest value. NaN is above all.
    return (column >= -high) & (column <= high) if bits == 63 else (column > -high - 1) & (column < high)


def lenient_cast(column: Column, source: T.DataType, target: T.DataType | str) -> Column:
    """Cast that yields null where the value does not fit, never an error.

    Text holding a decimal number (``'5.0'``) still reaches an integral type: the
    plain cast is tried first, then a cast through double (which truncates, like a
    cast of a double does). Values that can't be cast are told by their form or range, not by a cast that fails.
    """
    target = _as_type(target)
    if isinstance(target, _INTEGRAL):
        if isinstance(source, T.StringType):
            number = column.try_cast("double")
            return F.when(column.rlike(NUMBER_TEXT),
                          F.coalesce(column.try_cast(target), F.when(_in_range(number, T.DoubleType(), target), number.try_cast(target))))
        if isinstance(source, (*_INTEGRAL, T.DoubleType, T.FloatType)):
            fits = _in_range(column, source, target)
            return column.cast(target) if fits is None else F.when(fits, column.try_cast(target))
    return column.try_cast(target)


def convert_types(df: DataFrame, types: Mapping[str, T.DataType | str], rejects: str | None = None) -> DataFrame:
    """Cast the named columns that exist; names absent from ``df`` are ignored.

    ``rejects`` names a column to add: the values of the row that were there and are null after the cast, as an array of ``(column,
    value, reason)``, or null if all came through. It is computed in the same pass.
    """
    current = {field.name: field.dataType for field in df.schema.fields}
    present = {name: dtype for name, dtype in types.items() if name in current}
    cast = {name: lenient_cast(F.col(f"`{name}`"), current[name], dtype) for name, dtype in present.items()}
    if rejects is not None:
        lost = []
        for name, done in cast.items():
            column = F.col(f"`{name}`")
            reason = F.lit("out of range")
            if isinstance(current[name], T.StringType):
                reason = F.when(column.rlike(NUMBER_TEXT), reason).otherwise(F.lit("not a number"))
            entry = F.struct(F.lit(name).alias("column"), column.cast("string").alias("value"), reason.alias("reason"))
            lost.append(F.when(column.isNotNull() & done.isNull(), entry))
        empty = F.lit(None).cast("array<struct<column:string,value:string,reason:string>>")
        # Only rows that lose a value build the array.
        any_lost = reduce(lambda a, b: a | b, [entry.isNotNull() for entry in lost]) if lost else F.lit(False)
        cast[rejects] = F.when(any_lost, F.array_compact(F.array(*lost))) if lost else empty
    return df.withColumns(cast) if cast else df


def rejected_values(df: DataFrame, key: str, rejects: str) -> DataFrame:
    """``(key, column, value, reason)``: a row for every value that a conversion lost (see :func:`convert_types`)."""
    return (df.where(F.col(f"`{rejects}`").isNotNull()).select(F.col(f"`{key}`"), F.explode(F.col(f"`{rejects}`")).alias("_r"))
            .select(F.col(f"`{key}`"), "_r.column", "_r.value", "_r.reason"))


def drop_columns(df: DataFrame, *groups: Iterable[str]) -> DataFrame:
    """Drop every named column; names absent from ``df`` are ignored."""
    names = [name for group in groups for name in ([group] if isinstance(group, str) else group)]
    return df.drop(*names)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename ``{old: new}``; names absent from ``df`` are ignored, order is kept."""
    present = {old: new for old, new in mapping.items() if old in df.columns}
    return df.withColumnsRenamed(present) if present else df


def _sequential_mapping(pairs: Sequence[tuple[object, object]]) -> dict[object, object]:
    """Final value of every old value when the rules apply one after another."""
    mapping: dict[object, object] = {}
    for start, _ in pairs:
        if start in mapping:
            continue
        value = start
        for old, new in pairs:
            if value == old:
                value = new
        mapping[start] = value
    return mapping


def refactor_values(df: DataFrame, rules: Sequence[tuple[str, object, object]]) -> DataFrame:
    """Replace values rule by rule, in list order: ``(column, old, new)``.

    A later rule sees the result of the earlier ones, so ``a -> b`` then ``b -> c``
    turns ``a`` into ``c``. The rules of a column are composed up front into one
    ``CASE`` with one branch per distinct old value (linear in the rules, where nesting
    one ``when`` per rule would double the expression with every rule).
    """
    by_column: dict[str, list[tuple[object, object]]] = {}
    for name, old, new in rules:
        if name in df.columns:
            by_column.setdefault(name, []).append((old, new))
    exprs: dict[str, Column] = {}
    for name, pairs in by_column.items():
        column = F.col(f"`{name}`")
        changes = [(old, new) for old, new in _sequential_mapping(pairs).items() if old != new]
        if not changes:
            continue
        expr = None
        for old, new in changes:
            expr = (F.when if expr is None else expr.when)(column == F.lit(old), F.lit(new))
        exprs[name] = expr.otherwise(column)
    return df.withColumns(exprs) if exprs else df


def fill_zero(df: DataFrame, columns: Sequence[str], value: object = 0) -> DataFrame:
    """Replace nulls by ``value`` (0) in the named numeric columns (each must exist)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.fillna(value, subset=list(columns))
