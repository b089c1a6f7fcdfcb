"""Books of consumer-agency and real-estate cases, read from closing workbooks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.functions import fixed_values as V
from closeworks.functions import rules
from closeworks.functions.dates import coerce_date, month_start, name_date
from closeworks.operators import aggregates, filters, periods
from closeworks.operators.joins import lookup
from closeworks.sources.sheets import promote_header

FILE_DATE = r"(\d{2}\.\d{2}\.\d{4})"
HEADER_MARKER = "LINHA"
MEASURES = {
    "NOVOS": "NOVOS",
    "ENCERRADOS": "ENCERRADOS",
    "ESTOQUE": "ESTOQUE",
    "PROVISAO_TOTAL_PASSIVO_M": "PROVISAO_TOTAL_PASSIVO_M",
}


def _file_month(corrections: dict[str, str] | None) -> Column:
    """Month of the date in the file name, null without a readable date."""
    written = F.regexp_extract("SOURCE_FILE", FILE_DATE, 1)
    for wrong, right in (corrections or {}).items():
        written = F.when(written == wrong, right).otherwise(written)
    return month_start(name_date(written, r"(.*)", "dd.MM.yyyy"))


def undated_workbooks(grid: DataFrame, corrections: dict[str, str] | None = None) -> DataFrame:
    """Workbooks that `closing_workbooks` leaves out as their name has no readable date, with their number of rows."""
    return grid.filter(_file_month(corrections).isNull()).groupBy("SOURCE_FILE").agg(F.count(F.lit(1)).alias("LINHAS"))


def closing_workbooks(grid: DataFrame, columns: dict[str, str], corrections: dict[str, str] | None = None) -> DataFrame:
    """Rows of all closing tabs, stamped with the month of the date in the file name.

    `columns` maps sheet headers to our names; `corrections` maps a misdated file name (its
    date part) to the right date part.
    """
    named = promote_header(grid, list(columns), HEADER_MARKER)
    month = _file_month(corrections)
    return named.filter(month.isNotNull()).select(
        month.alias("MES_FECH"), *[F.col(f"`{old}`").alias(new) for old, new in columns.items()]
    )


def typed_closing(rows: DataFrame, dates: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    changes = {d: coerce_date(F.col(d)) for d in dates}
    changes |= {n: F.col(n).try_cast("double") for n in numbers}
    return rows.withColumns(changes)


def monthly_totals(rows: DataFrame) -> DataFrame:
    return aggregates.monthly_indicators(rows, MEASURES)


def agency_payments(payments: DataFrame, calendar: DataFrame) -> DataFrame:
    """Classified payments per case with the accounting month of the last one."""
    valid = payments.filter(
        ~F.col("STATUS_DO_PAGAMENTO").isin(*V.AGENCY_VOID_STATUSES)
        & ~F.contains(F.col("STATUS_DO_PAGAMENTO"), F.lit(V.RETURNED_PAYMENT))
    )
    classified = aggregates.classify_amounts(valid, V.AGENCY_PAYMENT_CLASSES)
    dated = periods.assign_period(classified, "DATA_EFETIVA_DO_PAGAMENTO", calendar)
    return dated.groupBy("PROCESSO_ID").agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in V.AGENCY_PAYMENT_CLASSES],
        F.max("MES_CONTABIL").alias("MES_PAGAMENTO"),
    )


def agency_guarantees(guarantees: DataFrame, calendar: DataFrame) -> DataFrame:
    """Released guarantees per case with the accounting month of the last release."""
    valid = filters.valid_guarantees(guarantees, V.AGENCY_GUARANTEE_TYPES)
    dated = periods.assign_period(valid, "DATA_DE_LEVANTAMENTO_PARTE_CONTRARIA", calendar)
    return dated.groupBy("PROCESSO_ID").agg(
        F.sum("VALOR_LEVANTADO_PARTE_CONTRARIA").alias("GARANTIA"), F.max("MES_CONTABIL").alias("MES_GARANTIA")
    )


def agency_book(
    closings: DataFrame, payments: DataFrame, guarantees: DataFrame, managerial: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Closings with payments, guarantees, the closing reason and managerial data."""
    case = {"ID_PROCESSO": "PROCESSO_ID"}
    paid = lookup(closings, agency_payments(payments, calendar), case, [*V.AGENCY_PAYMENT_CLASSES, "MES_PAGAMENTO"], derived=True)
    paid = lookup(paid, agency_guarantees(guarantees, calendar), case, ["GARANTIA", "MES_GARANTIA"], derived=True)
    settlement, conviction, seizure, guarantee = (
        F.coalesce(F.col(c), F.lit(0.0)) for c in ("ACORDO", "CONDENACAO", "PENHORA", "GARANTIA")
    )
    book = paid.withColumns(
        {
            "TOTAL_PAGAMENTOS": settlement + conviction + seizure + guarantee,
            "MOTIVO_ENC_AGRP": rules.closing_reason(
                F.col("ENCERRADOS"), settlement, [conviction, seizure, guarantee]
            ),
        }
    )
    extra = [c for c in managerial.columns if c != "PROCESSO_ID" and c not in book.columns]
    return lookup(book, managerial, case, extra)
