"""Small literal tables used by the queries."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from closeworks.sources.dims import accounting_calendar


def calendar_rows() -> list[tuple[date, date, date]]:
    """Months from the 20th to the 19th for the years of the given tables.

    2000 has no closing and February 1998 ends late, so that it overlaps with March.
    """
    rows = []
    for i in range(12 * 7 + 1):
        month = date(1995 + i // 12, i % 12 + 1, 1)
        if month.year == 2000:
            continue
        start = (month - timedelta(days=1)).replace(day=1) + timedelta(days=19)
        end = date(1998, 3, 5) if month == date(1998, 2, 1) else month + timedelta(days=18)
        rows.append((month, start, end))
    return rows


def calendar(spark: SparkSession) -> DataFrame:
    return accounting_calendar(spark, calendar_rows())
