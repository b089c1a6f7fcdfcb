"""Table of closed cases that feeds a provision model elsewhere."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.functions import dates, rules, text
from closeworks.functions import fixed_values as V
from closeworks.operators import filters
from closeworks.operators.aggregates import counts, keep_one
from closeworks.operators.joins import lookup
from closeworks.operators.schema import existing

# Columns of the modelling table, in their order.
FEATURES = [
    "ID_PROCESSO", "CADASTRO", "MES_CADASTRO", "AREA_DO_DIREITO", "SUB_AREA_DO_DIREITO", "VALOR_DA_CAUSA",
    "ESCRITORIO_RESPONSAVEL", "PARTE_CONTRARIA_CPF", "PARTE_CONTRARIA_NOME", "MATRICULA", "CARTEIRA", "ESTADO",
    "COMARCA", "CLASSIFICACAO", "NATUREZA_OPERACIONAL", "DATA_ADMISSAO", "MES_DATA_ADMISSAO", "DATA_DISPENSA",
    "MES_DATA_DISPENSA", "DISTRIBUICAO", "DISTRIBUICAO_AJUSTADA", "PARTE_CONTRARIA_CARGO_GRUPO", "FASE", "FILIAL",
    "BAND", "NOME_DA_LOJA", "TIPO_BAND", "ENCERRADOS", "MOTIVO_ENCERRAMENTO", "ACORDO", "CONDENACAO", "PENHORA",
    "OUTROS_PAGAMENTOS", "IMPOSTO", "GARANTIA", "TOTAL_PAGAMENTOS", "MES_FECH", "DIA_CORTE", "MOTIVO_ENC_AGRP",
    "CARGO_AJUSTADO", "TEMPO_EMPRESA_MESES", "CLUSTER_AGING_TEMPO_DE_EMPRESA", "MESES_AGING_ENCERR",
    "CLUSTER_AGING", "SAFRA_DE_RECLAMACAO", "TERCEIRO_AJUSTADO", "ET", "DT_ULT_PGTO",
]


def closed_in_window(book: DataFrame, base: date | str, months: int = 24) -> DataFrame:
    return filters.last_months(filters.flagged(book, "ENCERRADOS"), "MES_FECH", base, months)


def closed_per_month(book: DataFrame, base: date | str, months: int = 24) -> DataFrame:
    return counts(closed_in_window(book, base, months), ["MES_FECH"], "QTD_MES")


def modelling_base(
    book: DataFrame, managerial: DataFrame, cuts: DataFrame, base: date | str, months: int = 24
) -> DataFrame:
    """Closed cases of the last months with adjusted titles, phases and dates.

    Where the managerial base has a case several times, the earliest filing date is taken.
    """
    closed = closed_in_window(book, base, months).drop("DISTRIBUICAO")
    closed = lookup(closed, cuts, "MES_FECH", ["DIA_CORTE"])
    filed = keep_one(managerial.select("PROCESSO_ID", "DISTRIBUICAO"), ["PROCESSO_ID"], [F.asc_nulls_last("DISTRIBUICAO")])
    found = lookup(closed, filed, {"ID_PROCESSO": "PROCESSO_ID"}, ["DISTRIBUICAO"], derived=True)
    title, nature = F.col("PARTE_CONTRARIA_CARGO_GRUPO"), F.col("NATUREZA_OPERACIONAL")
    last_payment = F.when(F.col("DT_ULT_PGTO") != F.lit("1900-01-01").cast("date"), F.col("DT_ULT_PGTO"))
    filing = F.coalesce("DISTRIBUICAO", "DATACADASTRO")
    result = found.withColumns(
        {
            "CADASTRO": F.col("DATACADASTRO"),
            "CARTEIRA": F.col("PROCESSO_ESTEIRA"),
            "BAND": F.col("BANDEIRA"),
            "TIPO_BAND": F.lit("N/A"),
            "DISTRIBUICAO": filing,
            "DISTRIBUICAO_AJUSTADA": dates.month_start(filing),
            "PARTE_CONTRARIA_CARGO_GRUPO": rules.title_synonym(title),
            "CARGO_AJUSTADO": rules.model_title(title, nature),
            "FASE": rules.ministry_phase(F.col("PARTE_CONTRARIA_NOME"), F.col("FASE"), names=None),
            "CLUSTER_AGING_TEMPO_DE_EMPRESA": text.label_or(F.col("FX_TEMPO_EMPRESA"), V.NO_INFO),
            "CLUSTER_AGING": text.label_or(F.col("CLUSTER_AGING"), V.NO_INFO),
            "SAFRA_DE_RECLAMACAO": text.label_or(F.col("SAFRA_RECLAMACAO"), V.NO_INFO),
            "DT_ULT_PGTO": dates.month_start(F.coalesce(last_payment, "MES_FECH")),
        }
    )
    return result.select(*existing(result, FEATURES))
