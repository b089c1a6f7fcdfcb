"""Weekly base of labour settlements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.functions import dates, rules, text
from closeworks.operators import cleaning
from closeworks.operators.schema import dedupe_columns_suffix, insert_after, snake_columns


def weekly_settlements(sheet: DataFrame) -> DataFrame:
    """Settlements with value, bracket, month and a 0/1 count."""
    named = dedupe_columns_suffix(snake_columns(sheet, upper=True))
    typed = cleaning.coerce_dates(cleaning.parse_money(named, ["VALOR_DO_ACORDO_FECHADO"]), ["DATA_ACORDO"])
    typed = cleaning.cast_columns(typed, {"QUANTIDADE_DE_PARCELAS": "int"})
    # A heading that starts with "ID" and punctuation is the case.
    typed = typed.withColumnsRenamed({"ID": "ID_PROCESSO"})
    rows = typed.withColumns(
        {
            "MES_DATA_ACORDO": dates.month_start(F.col("DATA_ACORDO")),
            "QTD_ACORDO": text.text_flag(F.col("A_VISTA_PARCELADO")),
            "FAIXA": rules.settlement_bracket(F.col("VALOR_DO_ACORDO_FECHADO")),
        }
    )
    rows = insert_after(rows, "DATA_ACORDO", "SEMANA_NUMERO", F.lit(""))
    return insert_after(rows, "SEMANA_BOLETIM", "TOTAL_APTO_MES", F.lit("")) if "SEMANA_BOLETIM" in rows.columns else rows
