"""Date parsing and date arithmetic expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closeworks.functions.fixed_values import NO_INFO

CLAIM_DAYS = 1800
CLAIM_YEARS = 5


def _slash_date(text: Column, month_first: bool, pivot_year: int) -> Column:
    """Slash date with one- or two-digit day and month and a two- or four-digit year.

    Two-digit years above `pivot_year` belong to the 1900s.
    """
    day_month = "M/d/" if month_first else "d/M/"
    short = F.try_to_date(text, day_month + "yy")
    short = F.when(F.year(short) > pivot_year, F.add_months(short, -1200)).otherwise(short)
    return F.coalesce(short, F.try_to_date(text, day_month + "yyyy"))


def parse_mixed_date(text: Column, pivot_year: int = 2049) -> Column:
    """Date from text whose layout is guessed from its length.

    Ten characters are day first with a four-digit year, six to eight are month first,
    and every other length is day first.
    """
    size = F.length(text)
    return (
        F.when(size == 10, F.try_to_date(text, "dd/MM/yyyy"))
        .when(size.between(6, 8), _slash_date(text, True, pivot_year))
        .when(
            text.like("%/%/%/%"),
            _slash_date(F.regexp_extract(text, r"^(\d+/\d+/\d+)/", 1), True, pivot_year),
        )
        .otherwise(_slash_date(text, False, pivot_year))
    )


def parse_short_date(text: Column, order: str = "mdy", pivot_year: int = 2049) -> Column:
    """Ten characters are `dd/MM/yyyy`, all others a slash date in the given order."""
    return F.when(F.length(text) == 10, F.try_to_date(text, "dd/MM/yyyy")).otherwise(
        _slash_date(text, order == "mdy", pivot_year)
    )


def coerce_date(text: Column, dayfirst: bool = True) -> Column:
    """Date from the usual written forms, null where none fits. ISO dates may carry a time."""
    slash = ("d/M/yyyy", "M/d/yyyy") if dayfirst else ("M/d/yyyy", "d/M/yyyy")
    day = F.substring_index(F.trim(text), " ", 1)
    iso = F.regexp_extract(day, r"^(\d{4}-\d{2}-\d{2})", 1)
    return F.coalesce(
        F.try_to_date(iso, "yyyy-MM-dd"),
        *[F.try_to_date(day, layout) for layout in slash],
        F.try_to_date(F.translate(day, ".-", "//"), slash[0]),
    )


def as_date(df: DataFrame, column: str) -> Column:
    """A column as date: text in any written form, null where unreadable; dates and timestamps as they are."""
    value = F.col("`" + column.replace("`", "``") + "`")
    return coerce_date(value) if isinstance(df.schema[column].dataType, T.StringType) else F.to_date(value)


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM")


def whole_months(start: Column, end: Column) -> Column:
    """Completed months between two dates; a month not yet complete does not count."""
    return F.timestamp_diff("MONTH", start, end)


def days_between(start: Column, end: Column) -> Column:
    return F.date_diff(end, start)


def month_year(col: Column) -> Column:
    return F.concat_ws("-", F.lpad(F.month(col).cast("string"), 2, "0"), F.year(col).cast("string"))


def claim_start(filing: Column, hire: Column) -> Column:
    """Later of hire and filing minus 1800 days; the hire date where filing is missing."""
    limit = F.date_sub(filing, CLAIM_DAYS)
    return F.when(limit >= hire, limit).otherwise(hire)


def claim_end(filing: Column, dismissal: Column) -> Column:
    return F.coalesce(dismissal, filing)


def claim_label(start: Column, end: Column) -> Column:
    return F.when(
        start.isNotNull() & end.isNotNull(),
        F.concat_ws(" a ", month_year(start), month_year(end)),
    )


def claim_vintage(dismissal: Column, tenure_months: Column) -> Column:
    """Year of dismissal, five years earlier after more than 60 months of tenure."""
    year = F.year(dismissal)
    return F.when(
        dismissal.isNotNull(),
        F.when(tenure_months <= 60, year).when(tenure_months > 60, year - CLAIM_YEARS).cast("string"),
    ).otherwise(F.lit(NO_INFO))


def name_date(name: Column, pattern: str, layout: str) -> Column:
    """Date written in a file name; `pattern` has one group."""
    return F.try_to_date(F.regexp_extract(name, pattern, 1), layout)
