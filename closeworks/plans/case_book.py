"""The consolidated case book and the tax extract of closed cases."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.functions import dates, rules, text
from closeworks.functions import fixed_values as V
from closeworks.operators import filters
from closeworks.operators.aggregates import keep_one
from closeworks.operators.cleaning import nan_to_null
from closeworks.operators.joins import lookup, org_lookup, refresh_closed
from closeworks.operators.schema import existing, with_missing
from closeworks.plans.payments import AMOUNT_COLS

CONVICTION_COLS = [a for a in AMOUNT_COLS if a not in ("ACORDO", "PENSAO")]

# Columns of the managerial base and their names in the book.
MANAGERIAL_COLUMNS = {
    "ADVOGADO_RESPONSAVEL": "ADVOGADO_RESPONSAVEL",
    "ESCRITORIO": "ESCRITORIO_RESPONSAVEL",
    "NUMERO_DO_PROCESSO": "NUMERO_DO_PROCESSO",
    "PARTE_CONTRARIA_CPF": "PARTE_CONTRARIA_CPF",
    "PARTE_CONTRARIA_NOME": "PARTE_CONTRARIA_NOME",
    "ADVOGADO_DA_PARTE_CONTRARIA": "ADVOGADO_PARTE_CONTRARIA",
    "MATRICULA": "MATRICULA",
    "PROCESSO_ESTADO": "ESTADO",
    "PROCESSO_COMARCA": "COMARCA",
    "CLASSIFICACAO": "CLASSIFICACAO",
    "NATUREZA_OPERACIONAL": "NATUREZA_OPERACIONAL",
    "TERCEIRO_PRINCIPAL": "TERCEIRO_PRINCIPAL",
    "NOVO_TERCEIRO": "NOVO_TERCEIRO",
    "PARTE_CONTRARIA_DATA_ADMISSAO": "DATA_ADMISSAO",
    "PARTE_CONTRARIA_DATA_DISPENSA": "DATA_DISPENSA",
    "PARTE_CONTRARIA_CARGO_CARGO_GRUPO": "PARTE_CONTRARIA_CARGO_GRUPO",
    "PARTE_CONTRARIA_CARGO": "CARGO",
    "PARTE_CONTRARIA_MOTIVO_DO_DESLIGAMENTO": "MOTIVO_DESLIGAMENTO",
    "FASE": "FASE_ATUAL",
    "MOTIVO_DE_ENCERRAMENTO": "MOTIVO_ENCERRAMENTO",
    "FILIAL": "FILIAL",
    "BANDEIRA": "BANDEIRA",
    "CENTRO_DE_CUSTO_AREA_DEMANDANTE_NOME": "NOME_DA_LOJA",
    "DATA_REGISTRADO": "DATA_REGISTRADO",
    "DIRETORIA": "DIRETORIA_DP_LOJA",
}
#: Columns that `case_book` adds to the managerial data.
DIMENSION_COLUMNS = ("CLUSTER_VALOR", "ET")
# Names of the book's measures, and of the columns of closing sheets.
MEASURES = [
    "PERC_SOCIO_M",
    "PERC_EMPRESA_M",
    "PROVISAO_MOV_M",
    "PROVISAO_TOTAL_M_1",
    "PROVISAO_TOTAL_M",
    "CORRECAO_M_1",
    "CORRECAO_M",
    "CORRECAO_MOV_M",
    "PROVISAO_TOTAL_PASSIVO_M",
    "SOCIO_PROVISAO_TOTAL_M",
    "EMPRESA_PROV_TOTAL_PASSIVO_M",
    "EMPRESA_PROVISAO_MOV_M",
    *AMOUNT_COLS,
    "TOTAL_PAGAMENTOS",
]
CLOSING_RENAMES = {
    "EMPRESA_M": "EMPRESA",
    "STATUS_M": "STATUS",
    "CENTRO_DE_CUSTO_M": "CENTRO_CUSTO_M",
    "FASE_M": "FASE",
    "VLR_CAUSA": "VALOR_DA_CAUSA",
    "CARTEIRA": "PROCESSO_ESTEIRA",
    "ACORDOS": "ACORDO",
    "MEDIA_DE_PAGAMENTO": "MEDIA_PAGAMENTO",
    "%_SOCIO_M": "PERC_SOCIO_M",
    "%_EMPRESA_M": "PERC_EMPRESA_M",
    "SOCIO:_PROVISAO_TOTAL_M": "SOCIO_PROVISAO_TOTAL_M",
    "EMPRESA:_PROV_TOTAL_PASSIVO_M": "EMPRESA_PROV_TOTAL_PASSIVO_M",
    "EMPRESA:_PROVISAO_MOV_M": "EMPRESA_PROVISAO_MOV_M",
}


def tidy_closings(closings: DataFrame) -> DataFrame:
    """Closings with canonical names and real nulls, one row per case, month and flags.

    Columns that the managerial base has too are dropped; its values count.
    """
    taken = [c for c in MANAGERIAL_COLUMNS.values() if c in closings.columns and c != "DATA_REGISTRADO"]
    named = nan_to_null(closings.withColumnsRenamed(CLOSING_RENAMES)).drop(*taken)
    named = with_missing(filters.has_key(named, "ID_PROCESSO"), {a: "double" for a in AMOUNT_COLS})
    named = named.withColumn("NOVOS", F.coalesce("NOVOS", "REATIVADOS"))
    key = ["MES_FECH", "ID_PROCESSO", "NOVOS", "ENCERRADOS", "ESTOQUE"]
    tie_breakers = existing(named, ["DATACADASTRO", "TOTAL_PAGAMENTOS", "PROVISAO_TOTAL_M", "STATUS", "FASE"])
    return keep_one(named, key, tie_breakers)


def enriched_cases(
    book: DataFrame,
    managerial: DataFrame,
    units: DataFrame,
    areas: DataFrame,
    override: tuple[str, str, str] | None = None,
    cut: str = "2020-01-01",
    strategy_default: str | None = None,
) -> DataFrame:
    """Closings with organisation, managerial data, party rules and the claim period."""
    # The functional area of the closing itself, if it has one, is not replaced.
    area_name = "AREA_FUNCIONAL_CENTRO" if "AREA_FUNCIONAL" in book.columns else "AREA_FUNCIONAL"
    cases = org_lookup(book, units, areas, "CENTRO_CUSTO_M", "EMPRESA", override, area_name)
    types = {c: "date" if "DATA_" in c else "string" for c in MANAGERIAL_COLUMNS}
    wanted = MANAGERIAL_COLUMNS | {c: c for c in DIMENSION_COLUMNS if c in managerial.columns}
    cases = lookup(cases, with_missing(managerial, types), {"ID_PROCESSO": "PROCESSO_ID"}, wanted)
    cases = cases.withColumns(
        {
            "NOVO_X_LEGADO": rules.new_or_legacy(F.col("DATACADASTRO"), cut),
            "MES_CADASTRO": dates.month_start(F.col("DATACADASTRO")),
            "ESTRATEGIA": rules.strategy(F.col("ESTRATEGIA")),
            "INDICACAO_PROCESSO_ESTRATEGICO": rules.strategy_label(
                F.col("INDICACAO_PROCESSO_ESTRATEGICO"), strategy_default
            ),
            "TERCEIRO_AJUSTADO": F.coalesce("TERCEIRO_PRINCIPAL", "NOVO_TERCEIRO"),
            "PARTE_CONTRARIA_CARGO_GRUPO": text.strip_suffix(F.col("PARTE_CONTRARIA_CARGO_GRUPO"), " PARA"),
            "FASE": rules.ministry_phase(F.col("PARTE_CONTRARIA_NOME"), F.col("FASE")),
            "PERIODO1": dates.claim_start(F.col("DISTRIBUICAO"), F.col("DATA_ADMISSAO")),
            "PERIODO2": dates.claim_end(F.col("DISTRIBUICAO"), F.col("DATA_DISPENSA")),
            "PERIODO_RECLAMADO": F.date_sub("DISTRIBUICAO", dates.CLAIM_DAYS),
        }
    )
    return cases.withColumn(
        "PERIODO_RECL_GRUPO", dates.claim_label(F.col("PERIODO1"), F.col("PERIODO2"))
    )


def with_measures(cases: DataFrame) -> DataFrame:
    """Measures without nulls, month columns, tenure and aging."""
    month = F.col("MES_FECH")
    closed, stock = F.col("ENCERRADOS") == 1, F.col("ESTOQUE") == 1
    registered, registered_month = F.col("DATACADASTRO"), F.col("MES_CADASTRO")
    hired, left = F.col("DATA_ADMISSAO"), F.col("DATA_DISPENSA")
    measures = {m: F.coalesce(F.col(m), F.lit(0.0)) if m in cases.columns else F.lit(0.0) for m in MEASURES}
    return cases.withColumns(
        {
            **measures,
            "MES_DATA_ADMISSAO": dates.month_start(hired),
            "MES_DATA_DISPENSA": dates.month_start(left),
            "TEMPO_EMPRESA_MESES": dates.whole_months(hired, left),
            "TEMPO_EMPRESA_DIAS": dates.days_between(hired, left),
            "TEMPO_AJUIZAR_ACAO": dates.whole_months(left, F.col("DISTRIBUICAO")),
            "MESES_AGING_ENCERR": F.when(closed, dates.whole_months(registered_month, month)),
            "ANO_AGING_ENCERR": F.when(closed, dates.days_between(registered_month, month)),
            "MESES_AGING_ESTOQ": F.when(stock, dates.whole_months(registered_month, month)),
            "ANO_AGING_ESTOQ": F.when(stock, dates.days_between(registered_month, month)),
            "AGING_ESTOQ_MESES": F.when(stock, dates.whole_months(registered, month)),
            "BASE_ANO_AGING_ESTOQ": F.when(stock, dates.days_between(registered, month)),
            "MOTIVO_ENCERRAMENTO": rules.blank_reason(
                F.col("ESTOQUE"), F.col("NOVOS"), F.col("MOTIVO_ENCERRAMENTO")
            ),
        }
    )


def with_labels(
    cases: DataFrame, splits: Sequence[tuple[str, Sequence[str], str, str]] = (), defence_first: bool = False
) -> DataFrame:
    """Bands, groups and reasons, all as expressions of the row itself."""
    c = F.col
    labelled = cases.withColumns(
        {
            "FX_ANO_AGING_ENCERR": rules.bin_label(c("ANO_AGING_ENCERR"), V.CASE_DAY_BINS),
            "FX_MES_AGING_ESTOQ": rules.bin_label(c("AGING_ESTOQ_MESES"), V.STOCK_MONTH_BINS),
            "FX_ANO_AGING_ESTOQ": rules.bin_label(c("BASE_ANO_AGING_ESTOQ"), V.MODEL_DAY_BINS),
            "FX_ANO_AGING_ESTOQ_2": rules.bin_label(c("BASE_ANO_AGING_ESTOQ"), V.CASE_DAY_BINS),
            "FX_TEMPO_EMPRESA": rules.bin_label(c("TEMPO_EMPRESA_DIAS"), V.TENURE_DAY_BINS),
            "DP_FASE": rules.group_phase(c("FASE")),
            "DP_VP_DIRETORIA": rules.reporting_group(c("VP"), c("DIRETORIA"), splits),
            "DP_NATUREZA": rules.case_nature(
                c("PROVISAO_TOTAL_PASSIVO_M"),
                c("NATUREZA_OPERACIONAL"),
                c("SUB_AREA_DO_DIREITO"),
                c("AREA_DO_DIREITO"),
                c("INDICACAO_PROCESSO_ESTRATEGICO"),
                defence_first,
            ),
            "TRIM_ESTOQ": rules.quarter_stock(c("ESTOQUE"), c("MES_FECH")),
            "MOTIVO_ENC_AGRP": rules.closing_reason(
                c("ENCERRADOS"), c("ACORDO"), [c(a) for a in CONVICTION_COLS]
            ),
            "CARGO_TRATADO": rules.listed_title(c("PARTE_CONTRARIA_CARGO_GRUPO")),
            "CLUSTER_AGING": rules.aging_cluster(c("AGING_ESTOQ_MESES"), c("MESES_AGING_ENCERR")),
            "SAFRA_RECLAMACAO": dates.claim_vintage(c("DATA_DISPENSA"), c("TEMPO_EMPRESA_MESES")),
        }
    )
    return labelled.drop("TEMPO_EMPRESA_DIAS", "BASE_ANO_AGING_ESTOQ")


def case_book(
    closings: DataFrame,
    managerial: DataFrame,
    totals: DataFrame,
    units: DataFrame,
    areas: DataFrame,
    state_clusters: DataFrame,
    third_parties: DataFrame,
    override: tuple[str, str, str] | None = None,
    splits: Sequence[tuple[str, Sequence[str], str, str]] = (),
    strategy_default: str | None = None,
    defence_first: bool = False,
) -> DataFrame:
    """The main book: one row per case, month and combination of flags.

    `managerial`, `totals` and the four dimensions hold each key once.
    """
    # De-duplicate and refresh first, while the rows are still narrow.
    current = totals.withColumnsRenamed({"PROCESSO_ID": "ID_PROCESSO"})
    refreshed = refresh_closed(tidy_closings(closings), current, AMOUNT_COLS)
    people = _with_dimensions(managerial, state_clusters, third_parties)
    cases = enriched_cases(refreshed, people, units, areas, override, strategy_default=strategy_default)
    book = with_labels(with_measures(cases), splits, defence_first)
    return book.withColumn("ET", text.label_or(F.col("ET"), V.NO_INFO))


def _with_dimensions(managerial: DataFrame, state_clusters: DataFrame, third_parties: DataFrame) -> DataFrame:
    """Managerial data, one row per case, with what hangs on its state and its third party.

    Both have few values. Looked up here the wide rows of the book are not shuffled for them.
    """
    known = with_missing(managerial, {"PROCESSO_ESTADO": "string", "TERCEIRO_PRINCIPAL": "string", "NOVO_TERCEIRO": "string"})
    known = lookup(known, state_clusters, {"PROCESSO_ESTADO": "DE"}, {"PARA": "CLUSTER_VALOR"})
    known = known.withColumn("__third", F.coalesce("TERCEIRO_PRINCIPAL", "NOVO_TERCEIRO"))
    return lookup(known, third_parties, {"__third": "EMPRESA_TERCEIRIZADA"}, {"TERCEIRO_AJUSTADO": "ET"}).drop("__third")


def tax_extract(book: DataFrame, totals: DataFrame, month: date | str) -> DataFrame:
    """Cases closed from the given month on, with what has been paid on them by now."""
    closed = filters.in_period(filters.flagged(book, "ENCERRADOS"), "MES_FECH", start=month)
    closed = closed.drop(*AMOUNT_COLS, "TOTAL_PAGAMENTOS", "DT_ULT_PGTO", "MOTIVO_ENC_AGRP")
    amounts = [*AMOUNT_COLS, "TOTAL_PAGAMENTOS", "DT_ULT_PGTO"]
    found = lookup(closed, totals, {"ID_PROCESSO": "PROCESSO_ID"}, amounts, derived=True)
    reason = rules.closing_reason(F.col("ENCERRADOS"), F.col("ACORDO"), [F.col(a) for a in CONVICTION_COLS])
    return found.withColumn("MOTIVO_ENC_AGRP", reason)
