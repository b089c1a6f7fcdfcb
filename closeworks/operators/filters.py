"""Row filters. Conditions stay on plain columns so that they reach the scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.functions import fixed_values as V


def valid_payments(
    df: DataFrame,
    classes: dict[str, list[str]] = V.PAYMENT_CLASSES,
    void_statuses: Sequence[str] = V.VOID_PAYMENT_STATUSES,
    unlisted: Sequence[str] = V.UNLISTED_SUBTYPES,
) -> DataFrame:
    """Payments of a listed subtype whose status is known and not void or returned."""
    subtypes = [s for values in classes.values() for s in values if s not in unlisted]
    status = F.upper("STATUS_DO_PAGAMENTO")
    return df.filter(
        F.col("SUB_TIPO").isin(*subtypes)
        & ~status.isin(*void_statuses)
        & ~F.contains(status, F.lit(V.RETURNED_PAYMENT))
    )


def valid_guarantees(df: DataFrame, types: Sequence[str] = V.GUARANTEE_TYPES) -> DataFrame:
    """Guarantees of a listed type that were released and are not void, removed or returned."""
    status = F.col("STATUS_DA_GARANTIA")
    return df.filter(
        F.col("DATA_DE_LEVANTAMENTO_PARTE_CONTRARIA").isNotNull()
        & ~status.isin(*V.VOID_GUARANTEE_STATUSES)
        & ~F.contains(status, F.lit(V.RETURNED_PAYMENT))
        & (F.col("STATUS") != V.REMOVED_STATUS)
        & F.col("TIPO_GARANTIA").isin(*types)
    )


def has_key(df: DataFrame, *keys: str) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def in_period(
    df: DataFrame, column: str, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """Rows from `start` to the end of the day `end`; an open side is None."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(column) < F.date_add(F.lit(end).cast("date"), 1))
    return df


def last_months(df: DataFrame, column: str, base: date | str, months: int = 24) -> DataFrame:
    """Rows of the `months` months that end with the base month."""
    base_month = F.trunc(F.lit(base).cast("date"), "MM")
    return df.filter(
        (F.col(column) >= F.add_months(base_month, 1 - months))
        & (F.col(column) < F.add_months(base_month, 1))
    )


def flagged(df: DataFrame, flag: str, value: int = 1) -> DataFrame:
    return df.filter(F.col(flag) == value)


def not_flagged(df: DataFrame, flag: str, value: int = 1) -> DataFrame:
    """Rows where the flag is null or holds another value."""
    return df.filter(F.col(flag).isNull() | (F.col(flag) != value))


def contains(df: DataFrame, column: str, word: str) -> DataFrame:
    return df.filter(F.coalesce(F.contains(F.upper(column), F.lit(word.upper())), F.lit(False)))


def court_plan_parts(df: DataFrame) -> DataFrame:
    """Payments that belong to a court-ordered installment plan."""
    plan = F.col("PARCELAMENTO_CONDENACAO")
    return df.filter(plan.isNotNull() & ~plan.isin(*V.NO_COURT_PLAN))


def is_settlement_part(column: Column) -> Column:
    """Any part of a settlement, the last one included."""
    return (column == V.SETTLEMENT_PART) | F.startswith(column, F.lit(V.LAST_SETTLEMENT_PART))
