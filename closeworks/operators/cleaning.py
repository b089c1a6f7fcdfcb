"""Value cleaning on lists of columns; each call adds one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closeworks.functions import dates, text
from closeworks.operators.schema import quoted, with_columns_changed


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _is_date(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def parse_dates(df: DataFrame, columns: Sequence[str], pivot_year: int = 2049) -> DataFrame:
    """Mixed-layout text columns to dates; timestamps lose their time."""

    def change(column, kind):
        return column.cast("date") if _is_date(kind) else dates.parse_mixed_date(column, pivot_year)

    return df.withColumns({c: change(quoted(c), _type_of(df, c)) for c in columns})


def coerce_dates(df: DataFrame, columns: Sequence[str], dayfirst: bool = True) -> DataFrame:
    def change(column, kind):
        return column.cast("date") if _is_date(kind) else dates.coerce_date(column, dayfirst)

    return df.withColumns({c: change(quoted(c), _type_of(df, c)) for c in columns})


def replace_chars(df: DataFrame, columns: Sequence[str], pattern: str, replacement: str) -> DataFrame:
    return with_columns_changed(df, columns, lambda c: F.regexp_replace(c, pattern, replacement))


def to_number(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return with_columns_changed(df, columns, text.number)


def compress_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return with_columns_changed(df, columns, lambda c: text.squeeze(c.cast("string")))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to null in every floating-point column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return with_columns_changed(df, floats, lambda c: F.when(~F.isnan(c), c))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))


def blank_nulls(df: DataFrame) -> DataFrame:
    """Null to the empty string in every text column."""
    return df.fillna("")


def parse_money(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Brazilian currency text to double; numeric columns pass through, null as 0."""

    def change(column, kind):
        if isinstance(kind, T.NumericType):
            return F.coalesce(column.cast("double"), F.lit(0.0))
        return text.parse_brl(column)

    return df.withColumns({c: change(quoted(c), _type_of(df, c)) for c in columns})


def coerce_ids(df: DataFrame, columns: Sequence[str], fill_zero: bool = False) -> DataFrame:
    def change(column):
        number = text.coerce_id(column)
        return F.coalesce(number, F.lit(0)) if fill_zero else number

    return with_columns_changed(df, columns, change)


def null_text(df: DataFrame, tokens: Sequence[str] = text.TEXTUAL_NULLS) -> DataFrame:
    """Textual nulls of every text column to real nulls."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return with_columns_changed(df, texts, lambda c: text.null_tokens(c, tokens))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: quoted(name).try_cast(kind) for name, kind in types.items()})
