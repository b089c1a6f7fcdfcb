"""The financial closing of one month and the history of all closings."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.functions import fixed_values as V
from closeworks.functions import rules
from closeworks.operators import aggregates, filters, periods
from closeworks.operators.cleaning import compress_values, parse_dates, to_number
from closeworks.operators.joins import lookup
from closeworks.operators.schema import existing
from closeworks.operators.unions import union_harmonized
from closeworks.plans.payments import AMOUNT_COLS

BOOK_MEASURES = {
    "NOVOS": "NOVOS",
    "REATIVADOS": "REATIVADOS",
    "ENCERRADOS": "ENCERRADOS",
    "ESTOQUE": "ESTOQUE",
    "ACORDO": "ACORDO",
    "CONDENACAO": "CONDENACAO",
    "TOTAL_PAGAMENTOS": "TOTAL_PAGAMENTOS",
    "PROVISAO_TOTAL_PASSIVO_M": "PROVISAO_TOTAL_PASSIVO_M",
    "PROVISAO_MOV_M": "PROVISAO_MOV_M",
}


def clean_closing_sheet(sheet: DataFrame, dates: Sequence[str] = ("DATACADASTRO", "REABERTURA", "DISTRIBUICAO"),
                        numbers: Sequence[str] = ("CENTRO_DE_CUSTO_M_1", "CENTRO_DE_CUSTO_M")) -> DataFrame:
    """Typed closing sheet without rows that have no case."""
    dates, numbers = existing(sheet, dates), existing(sheet, numbers)
    texts = [n for n in [*dates, *numbers] if dict(sheet.dtypes)[n] == "string"]
    cleaned = compress_values(filters.has_key(sheet, "ID_PROCESSO"), texts)
    return to_number(parse_dates(cleaned, dates), numbers)


def recognised_payments(
    fact: DataFrame, calendar: DataFrame, closing_month: date | str, amounts: Sequence[str] = AMOUNT_COLS
) -> DataFrame:
    """What was paid per case in accounting months up to the closing month; `unassigned_payments` are in none."""
    dated = periods.assign_period(fact, "DATA_EFETIVA_DO_PAGAMENTO", calendar)
    counted = filters.in_period(dated, "MES_CONTABIL", end=closing_month)
    return counted.groupBy("PROCESSO_ID").agg(
        F.max("MES_CONTABIL").alias("DT_ULT_PGTO"),
        *[F.sum(a).alias(a) for a in amounts],
        F.sum("TOTAL_PAGAMENTOS").alias("TOTAL_PAGAMENTOS"),
    )


def unassigned_payments(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Payments that no closing recognises, as their date is missing or in no accounting month."""
    dated = periods.assign_period(fact, "DATA_EFETIVA_DO_PAGAMENTO", calendar)
    return dated.filter(F.col("MES_CONTABIL").isNull()).drop("MES_CONTABIL")


def monthly_closing(
    sheet: DataFrame,
    managerial: DataFrame,
    fact: DataFrame,
    calendar: DataFrame,
    closing_month: date | str,
) -> DataFrame:
    """The closing sheet with status, phase, strategy and payments of closed cases.

    `managerial` holds each case once. Payments are recognised by the month of each payment,
    so a late payment does not hide earlier ones.
    """
    extra = {
        "DATA_REGISTRADO": "__registered",
        "STATUS": "__status",
        "FASE": "__phase",
        "CARTEIRA": "CARTEIRA",
        "ULTIMA_POSICAO_ESTRATEGIA_JUSTIFICATIVA_ACORDO_DEFESA": "__strategy",
    }
    found = lookup(sheet, managerial, {"ID_PROCESSO": "PROCESSO_ID"}, extra)
    newest_phase = F.coalesce("__phase", "FASE_M")
    enriched = found.select(
        *[F.col(c) for c in found.columns if not c.startswith("__") and c not in ("DATACADASTRO", "STATUS_M", "FASE_M")],
        F.coalesce("DATACADASTRO", "__registered").alias("DATACADASTRO"),
        F.coalesce("STATUS_M", "__status").alias("STATUS_M"),
        F.when(F.col("FASE_M") == "", newest_phase).otherwise(F.col("FASE_M")).alias("FASE_M"),
        rules.group_phase(newest_phase, V.CLOSING_PHASES).alias("DP_FASE"),
        rules.document_flag(F.col("DOC")).alias("PROCESSO_COM_DOCUMENTO"),
        F.coalesce("INDICACAO_PROCESSO_ESTRATEGICO", "__strategy").alias("ESTRATEGIA"),
        F.lit(closing_month).cast("date").alias("MES_FECH"),
    )
    paid = recognised_payments(fact, calendar, closing_month)
    paid = paid.withColumn("__closed", F.lit(1))
    amounts = ["DT_ULT_PGTO", *AMOUNT_COLS, "TOTAL_PAGAMENTOS"]
    return lookup(enriched, paid, {"ID_PROCESSO": "PROCESSO_ID", "ENCERRADOS": "__closed"}, amounts, derived=True)


def closing_history(closings: Sequence[DataFrame]) -> DataFrame:
    """All monthly closings as one table, whatever their columns and types."""
    return union_harmonized(closings)


def indicators(book: DataFrame) -> DataFrame:
    """Monthly totals of the book."""
    present = {old: new for old, new in BOOK_MEASURES.items() if old in book.columns}
    return aggregates.monthly_indicators(book, present)
