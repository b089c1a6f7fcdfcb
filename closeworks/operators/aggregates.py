"""Aggregations. All combine per task before the shuffle, so a hot key stays cheap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closeworks.functions import fixed_values as V
from closeworks.functions.rules import bin_label
from closeworks.operators.joins import lookup
from closeworks.operators.schema import quoted


def classify_amounts(
    df: DataFrame, classes: Mapping[str, Sequence[str]] = V.PAYMENT_CLASSES, value: str = "VALOR"
) -> DataFrame:
    """One column per class with the value where the subtype belongs to it, else null."""
    return df.withColumns(
        {name: F.when(F.col("SUB_TIPO").isin(*subtypes), F.col(value)) for name, subtypes in classes.items()}
    )


def positive_sums(df: DataFrame, keys: Sequence[str], amounts: Sequence[str]) -> DataFrame:
    """Sums per key with null as 0; only keys whose amounts add up to more than 0."""
    sums = df.groupBy(*keys).agg(*[F.coalesce(F.sum(a), F.lit(0.0)).alias(a) for a in amounts])
    return sums.filter(reduce(Column.__add__, [F.col(a) for a in amounts]) > 0)


def sums_by(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(old).alias(new) for old, new in sums.items()])


def case_totals(
    fact: DataFrame,
    amounts: Sequence[str],
    case: str = "PROCESSO_ID",
    paid_on: str = "DATA_EFETIVA_DO_PAGAMENTO",
) -> DataFrame:
    """One row per case: last payment date and summed amounts."""
    return fact.groupBy(case).agg(
        F.max(paid_on).alias("DT_ULT_PGTO"),
        *[F.sum(F.coalesce(F.col(a), F.lit(0.0))).alias(a) for a in amounts],
    )


def monthly_indicators(
    df: DataFrame, measures: Sequence[str] | Mapping[str, str], month: str = "MES_FECH"
) -> DataFrame:
    """Sums of flags and amounts per closing month."""
    names = dict(measures) if isinstance(measures, Mapping) else {m: m for m in measures}
    return df.groupBy(month).agg(*[F.sum(old).alias(new) for old, new in names.items()])


def counts(
    df: DataFrame, keys: Sequence[str], name: str = "QTD", counted: str | None = None, sums: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows per combination of attributes, or values of `counted` that are not null, and sums by their new names."""
    number = F.count(F.lit(1) if counted is None else quoted(counted)).alias(name)
    return df.groupBy(*keys).agg(number, *[F.sum(quoted(old)).alias(new) for new, old in (sums or {}).items()])


def history_totals(
    df: DataFrame, history: DataFrame, keys, value: str, count_name: str, sum_name: str, null_safe=True
) -> DataFrame:
    """How often and for how much each key occurs in the history, 0 where it does not."""
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    totals = history.groupBy(*[quoted(k) for k in pairs.values()]).agg(
        F.count(F.lit(1)).alias("__count"), F.sum(value).alias("__sum")
    )
    found = lookup(df, totals, pairs, {"__count": count_name, "__sum": sum_name}, null_safe, derived=True)
    return found.fillna(0, subset=[count_name, sum_name])


#: Pivot column of all values that are not listed.
OTHERS = "OUTROS"


def _listed(df: DataFrame, column: str, values: Sequence) -> tuple[DataFrame, list[str]]:
    """The pivot column as text, with one value for all that is not listed, null included."""
    known = F.when(F.col(column).isin(*values), F.col(column).cast("string")).otherwise(F.lit(OTHERS))
    return df.withColumn(column, known), [*map(str, values), OTHERS]


def pivot_first(df: DataFrame, keys: Sequence[str], column: str, values: Sequence, **cells: str) -> DataFrame:
    """One column per listed value and cell, and OUTROS for all other values, holding the cell's first value.

    The smallest value that is not null is taken where a cell has several, so that the result does not depend
    on the order of rows. The values are given, which saves a job to find them.
    """
    aggregates = [F.min(old).alias(new) for new, old in cells.items()]
    named, listed = _listed(df, column, values)
    return named.groupBy(*keys).pivot(column, listed).agg(*aggregates)


def pivot_sum(df: DataFrame, keys: Sequence[str], column: str, values: Sequence, value: str) -> DataFrame:
    """Sums per listed value, and OUTROS for all other values."""
    named, listed = _listed(df, column, values)
    return named.groupBy(*keys).pivot(column, listed).agg(F.sum(value))


def to_long(
    df: DataFrame, ids: Sequence[str], variable: str, value: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Matrix to long form without empty cells."""
    columns = [c for c in df.columns if c not in ids] if columns is None else columns
    long = df.unpivot([quoted(i) for i in ids], [quoted(c) for c in columns], variable, value)
    return long.filter(F.col(value).isNotNull())


def sum_where(df: DataFrame, keys: Sequence[str], condition: Column, value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(F.when(condition, F.col(value))).alias(name))


def _orderable(kind: T.DataType) -> bool:
    """Whether rows can be sorted by a column of this type."""
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of each key in the given order; of rows that are equal there the smallest in all columns.

    Spark limits each task to one row per key before the shuffle (WindowGroupLimit), so a
    key with very many rows does not end up in one task.
    """
    rest = F.struct(*[quoted(f.name) for f in df.schema.fields if _orderable(f.dataType)])
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, rest))
    return df.withColumn("__position", position).filter("__position = 1").drop("__position")


def keep_first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """First `n` rows of each key with their position as POSICAO."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("POSICAO", position).filter(F.col("POSICAO") <= n)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All copies of rows whose key occurs more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    marked = lookup(df, repeated, keys, {"__n": "__n"}, null_safe=True, how="inner")
    return marked.drop("__n")


def volume_price(
    tasks: DataFrame,
    prices: DataFrame,
    keys: Mapping[str, str],
    band_column: str,
    price: str,
    name: str,
    bands=V.VOLUME_BANDS,
    also: Mapping[str, str] | None = None,
) -> DataFrame:
    """Price of each task from the band its office and type reach by their number of tasks.

    `keys` maps the grouping columns of the tasks to those of the price list, which is in long
    form with one row per key and band. `also` maps further columns that the price depends on, but not the band.
    """
    volumes = tasks.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    volumes = volumes.withColumn("__band", bin_label(F.col("__n"), bands))
    if also:
        banded = lookup(tasks, volumes, list(keys), ["__band"], null_safe=True, derived=True)
        on = {**keys, **also, "__band": band_column}
        return lookup(banded, prices, on, {price: name}, null_safe=True).drop("__band")
    priced = lookup(volumes, prices, {**keys, "__band": band_column}, {price: "__price"}, null_safe=True)
    return lookup(tasks, priced, list(keys), {"__price": name}, null_safe=True)
