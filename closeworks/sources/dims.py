"""Literal dimension tables and calendars."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from closeworks.functions import fixed_values as V

MAX_BROADCAST_ROWS = 100_000


def dim_from_rows(spark: SparkSession, rows: Sequence[tuple], ddl: str, size: int | None = None) -> DataFrame:
    """Typed table from rows in code; broadcast in joins if it has few rows.

    `size` is the number of rows it is expanded to where it is joined. ISO text is accepted for dates.
    """
    schema = T.StructType.fromDDL(ddl)

    def typed(value, kind):
        if isinstance(kind, T.DateType) and isinstance(value, str):
            return date.fromisoformat(value)
        if isinstance(kind, T.TimestampType) and isinstance(value, str):
            return datetime.fromisoformat(value)
        return value

    columns = [
        [typed(row[i], field.dataType) for row in rows] for i, field in enumerate(schema.fields)
    ]
    arrow = to_arrow_schema(schema)
    table = pa.table([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)
    df = spark.createDataFrame(table)
    return F.broadcast(df) if (len(rows) if size is None else size) <= MAX_BROADCAST_ROWS else df


def _day(value: str | date) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def accounting_calendar(spark: SparkSession, rows: Sequence[tuple] | None = None) -> DataFrame:
    """MES_CONTABIL, DT_INICIO, DT_FIM."""
    rows = V.ACCOUNTING_MONTHS if rows is None else rows
    days = sum((_day(end) - _day(start)).days + 1 for _, start, end in rows)  # it is joined day by day
    return dim_from_rows(spark, rows, "MES_CONTABIL date, DT_INICIO date, DT_FIM date", days)


def file_months(spark: SparkSession) -> DataFrame:
    return dim_from_rows(spark, V.FILE_MONTHS, "ARQUIVO string, MES_FECH date")


def hr_file_windows(spark: SparkSession) -> DataFrame:
    return dim_from_rows(spark, V.HR_FILE_WINDOWS, "ARQUIVO string, DT_INICIO date, DT_FIM date")


def cut_calendar(spark: SparkSession) -> DataFrame:
    """Closing month and the day the case system was cut for it."""
    return dim_from_rows(spark, V.CUT_DAYS, "MES_FECH date, DIA_CORTE date")
