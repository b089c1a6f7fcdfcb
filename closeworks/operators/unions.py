"""Unions of tables whose schemas drift from month to month."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from closeworks.operators.schema import (
    adjust_column_names,
    common_columns,
    conform,
    dedupe_columns_first,
    resolved,
    spellings,
    strip_accents_columns,
)

NUMERIC_WIDTH = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by name, whose letter case does not count; a column missing from a table is null there, and one of
    several types gets the widest."""
    schema = common_schema(dfs)
    return reduce(DataFrame.unionAll, [conform(df, schema) for df in dfs])


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union of two frames over their common columns, without repeated rows."""
    return union_all(common_columns(left, right)).distinct()


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Narrowest type that holds all values of both: integer, double, timestamp, else text."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if a in NUMERIC_WIDTH and b in NUMERIC_WIDTH:
        return max(a, b, key=NUMERIC_WIDTH.index)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        # A double holds every int, but not every bigint or decimal: as text both keep all their digits.
        exact = (*NUMERIC_WIDTH[:3], T.FloatType(), T.DoubleType())
        return T.DoubleType() if a in exact and b in exact else T.StringType()
    moments = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, moments) and isinstance(b, moments):
        zoned = isinstance(a, T.TimestampType) or isinstance(b, T.TimestampType)
        return T.TimestampType() if zoned else T.TimestampNTZType()
    return T.StringType()


def clean_snapshot(df: DataFrame) -> DataFrame:
    """Canonical names: plain letters, upper case, underscores, each name once."""
    return dedupe_columns_first(adjust_column_names(strip_accents_columns(df)))


def common_schema(dfs: Sequence[DataFrame]) -> T.StructType:
    """All columns in the order and spelling of first sight, each with the widest type it occurs in."""
    fields = [resolved(df) for df in dfs]
    wide = []
    for name in spellings(dfs):
        kinds = [columns[name.lower()].dataType for columns in fields if name.lower() in columns]
        wide.append(T.StructField(name, reduce(wider_type, kinds)))
    return T.StructType(wide)


def type_conflicts(dfs: Sequence[DataFrame]) -> dict[str, list[str]]:
    """Columns that occur with several types, with those types in order of first sight."""
    fields = [resolved(df) for df in dfs]
    seen = {
        name: list(dict.fromkeys(c[name.lower()].dataType.simpleString() for c in fields if name.lower() in c)) for name in spellings(dfs)
    }
    return {name: kinds for name, kinds in seen.items() if len(kinds) > 1}


def union_harmonized(dfs: Sequence[DataFrame], clean: bool = True) -> DataFrame:
    """One table from snapshots with different names, columns and types.

    Every snapshot is brought to the common schema first, so the union is a single flat
    node over scans that read only what they have.
    """
    cleaned = [clean_snapshot(df) for df in dfs] if clean else list(dfs)
    schema = common_schema(cleaned)
    return reduce(DataFrame.unionAll, [conform(df, schema) for df in cleaned])
