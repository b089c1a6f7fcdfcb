"""Accounting calendars and file validity windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closeworks.functions.dates import as_date
from closeworks.operators.joins import lookup


def check_calendar(calendar: DataFrame) -> DataFrame:
    """Faulty rows of a calendar with their PROBLEMA: INVERTIDO, SOBREPOSTO or LACUNA.

    `calendar` has MES_CONTABIL, DT_INICIO, DT_FIM; it is one small table, ordered as a whole.
    """
    earlier = (
        Window.partitionBy(F.lit(1))
        .orderBy("MES_CONTABIL", "DT_INICIO")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start, end = as_date(calendar, "DT_INICIO"), as_date(calendar, "DT_FIM")
    previous = F.max(end).over(earlier)
    problem = (
        F.when(start > end, "INVERTIDO")
        .when(start <= previous, "SOBREPOSTO")
        .when(F.date_diff(start, previous) > 1, "LACUNA")
    )
    return calendar.withColumn("PROBLEMA", problem).filter(F.col("PROBLEMA").isNotNull())


def calendar_days(calendar: DataFrame) -> DataFrame:
    """One row per day with its month, the earliest where intervals overlap.

    The size depends on the span of the calendar only, not on the data it is joined to.
    """
    start, end = as_date(calendar, "DT_INICIO"), as_date(calendar, "DT_FIM")
    days = calendar.filter(start <= end).select(
        F.col("MES_CONTABIL").alias("__month"), F.explode(F.sequence(start, end)).alias("__day")
    )
    return days.groupBy("__day").agg(F.min("__month").alias("__month"))


def assign_period(
    df: DataFrame, column: str, calendar: DataFrame, name: str = "MES_CONTABIL"
) -> DataFrame:
    """Add the accounting month whose closed interval holds the date; null outside of all.

    The interval test becomes a lookup by day, so each row costs one hash probe and never
    matches twice.
    """
    dated = df.withColumn("__date", as_date(df, column))
    found = lookup(dated, calendar_days(calendar), {"__date": "__day"}, {"__month": name})
    return found.drop("__date")


def file_month(
    df: DataFrame, column: str, months: DataFrame, name: str = "MES_FECH", unlisted_by_date: bool = True
) -> DataFrame:
    """Closing month of a file date `yyyyMMdd`, as listed in `months` (ARQUIVO, MES_FECH).

    A file that is not listed gets the calendar month of its date, or null if `unlisted_by_date` is off.
    """
    found = lookup(df, months, {column: "ARQUIVO"}, {"MES_FECH": "__listed"})
    month = F.trunc(F.try_to_date(F.col(column), "yyyyMMdd"), "MM") if unlisted_by_date else F.lit(None)
    return found.withColumn(name, F.coalesce("__listed", month)).drop("__listed")


def in_source_window(df: DataFrame, source: str, event: str, windows: DataFrame) -> DataFrame:
    """Distinct rows whose event date lies in the window of the file they came from.

    `windows` has ARQUIVO, DT_INICIO, DT_FIM with one row per file.
    """
    found = lookup(
        df, windows, {source: "ARQUIVO"}, {"DT_INICIO": "__from", "DT_FIM": "__to"}, how="inner"
    )
    valid = F.col(event).between(F.col("__from"), F.col("__to"))
    return found.filter(valid).drop("__from", "__to").distinct()
