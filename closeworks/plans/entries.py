"""New cases from books and managerial bases of several eras."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.functions import dates, rules, text
from closeworks.operators import aggregates, filters, periods
from closeworks.operators.unions import union_all


def book_entries(book: DataFrame, source: str, until: str | None = None, cut: str = "2020-01-01") -> DataFrame:
    """New cases of a book, up to a month if one is given."""
    new = filters.in_period(filters.flagged(book, "NOVOS"), "MES_FECH", end=until)
    if "NOVO_X_LEGADO" not in new.columns:
        new = new.withColumn("NOVO_X_LEGADO", rules.new_or_legacy(F.col("DATACADASTRO"), cut))
    return new.withColumn("SOURCE", F.lit(source))


def managerial_entries(
    base: DataFrame, calendar: DataFrame, source: str, since: str | None = "2019-12-01", cut: str = "2020-01-01"
) -> DataFrame:
    """Cases of a managerial base as entries of the accounting month they were registered in."""
    named = base.withColumnsRenamed(
        {
            "PROCESSO_ID": "ID_PROCESSO",
            "PARTE_CONTRARIA_CARGO_CARGO_GRUPO": "PARTE_CONTRARIA_CARGO_GRUPO",
            "PARTE_CONTRARIA_DATA_ADMISSAO": "DATA_ADMISSAO",
            "PARTE_CONTRARIA_DATA_DISPENSA": "DATA_DISPENSA",
            "PROCESSO_ESTADO": "ESTADO",
            "PROCESSO_COMARCA": "COMARCA",
        }
    )
    added = {
        "MES_CADASTRO": dates.month_start(F.col("DATA_REGISTRADO")),
        "NOVOS": F.lit(1),
        "NOVO_X_LEGADO": rules.new_or_legacy(F.col("DATA_REGISTRADO"), cut),
        "SOURCE": F.lit(source),
    }
    for date_name in ("DATA_ADMISSAO", "DATA_DISPENSA"):
        if date_name in named.columns:
            added[f"MES_{date_name}"] = dates.month_start(F.col(date_name))
    if {"FILIAL", "CENTRO_DE_CUSTO_AREA_DEMANDANTE_NOME"} <= set(named.columns):
        added["FILIAL"] = text.branch_code(F.col("FILIAL"), F.col("CENTRO_DE_CUSTO_AREA_DEMANDANTE_NOME"))
    dated = periods.assign_period(named.withColumns(added), "DATA_REGISTRADO", calendar, "MES_FECH")
    return filters.in_period(dated, "MES_FECH", start=since)


def entries_base(*eras: DataFrame) -> DataFrame:
    """All eras in one table; columns an era does not have are null."""
    return union_all(eras)


def entries_per_month(entries: DataFrame, since: str) -> DataFrame:
    recent = filters.in_period(entries, "MES_FECH", start=since)
    return aggregates.counts(recent, ["MES_FECH"], "QTD", "ID_PROCESSO")
