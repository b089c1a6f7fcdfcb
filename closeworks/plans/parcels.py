"""Installment control: paid parts of settlements and convictions with due dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.functions import dates
from closeworks.functions import fixed_values as V
from closeworks.operators import aggregates, filters, installments, ordered
from closeworks.operators.joins import inner_lookup, lookup
from closeworks.operators.unions import union_all

PAID_ON = "DATA_EFETIVA_DO_PAGAMENTO"


def cases_with_plan(closings: DataFrame) -> DataFrame:
    """First closing of each case that pays in parts."""
    plan = F.col("PARCELAMENTO_CONDENACAO")
    parts = closings.filter((F.col("PARCELAMENTO_ACORDO") == V.SETTLEMENT_PART) | ~plan.isin(*V.NO_PLAN))
    order = ["MES_FECH", "FASE_M", "PROVISAO_M_1", "PROVISAO_TOTAL_M_1"]
    return aggregates.keep_one(parts, ["ID_PROCESSO"], order)


def settlement_parts(payments: DataFrame, cases: DataFrame, settlements: DataFrame) -> DataFrame:
    """Paid parts of settlements, numbered by date and value."""
    rows = payments.select("PROCESSO_ID", "SUB_TIPO", PAID_ON, "ACORDO", "PARCELAMENTO_ACORDO").distinct()
    rows = rows.filter(
        filters.is_settlement_part(F.col("PARCELAMENTO_ACORDO")) & F.col("ACORDO").isNotNull()
    )
    rows = inner_lookup(rows, cases, {"PROCESSO_ID": "ID_PROCESSO"}, derived=True)
    numbered = ordered.ordered(
        rows,
        ["PROCESSO_ID"],
        [PAID_ON, "ACORDO", "SUB_TIPO", "PARCELAMENTO_ACORDO"],
        {"PARCELA": ordered.row_number(), "DATA_DO_ACORDO": ordered.first(PAID_ON)},
        counted=payments,
    )
    agreed = {
        "QUANTIDADE_DE_PARCELAS": "QTD_PARCELAS_ACORDO",
        "ALCADA_1": "ALCADA_1",
        "ALCADA_2": "ALCADA_2",
        "ALCADA_3": "ALCADA_3",
        "VALOR_DO_ACORDO_FECHADO": "VALOR_DO_ACORDO",
    }
    found = lookup(numbered, settlements, {"PROCESSO_ID": "ID"}, agreed)
    paid = F.col(PAID_ON).isNotNull()
    return found.select(
        "PROCESSO_ID",
        "SUB_TIPO",
        F.lit("ACORDO").alias("DP_SUB_TIPO"),
        "QTD_PARCELAS_ACORDO",
        "PARCELA",
        F.when(paid, F.col("PARCELA")).alias("PARCELA_PAGA"),
        dates.month_start(F.col(PAID_ON)).alias("MES_FECH"),
        F.col(PAID_ON).alias("DATA_PAGTO"),
        "DATA_DO_ACORDO",
        installments.due_date(F.col(PAID_ON), F.col("PARCELA")).alias("DT_VENCIMENTO_PARCELA"),
        "ALCADA_1",
        "ALCADA_2",
        "ALCADA_3",
        F.col("ACORDO").alias("VALOR_PARCELA"),
        F.when(paid, F.col("ACORDO")).alias("VALOR_PARCELA_PAGA"),
        "VALOR_DO_ACORDO",
    )


def conviction_parts(payments: DataFrame, since: str = "2022-01-01") -> DataFrame:
    """Paid parts of convictions; payments of one day share a number."""
    rows = payments.filter(
        ~F.col("PARCELAMENTO_CONDENACAO").isin(*V.NO_PLAN) & F.col("CONDENACAO").isNotNull()
    )
    rows = filters.in_period(rows, PAID_ON, start=since)
    valued = ordered.ordered(
        rows,
        ["PROCESSO_ID"],
        [PAID_ON, "CONDENACAO"],
        {
            "PARCELA": ordered.dense_rank(PAID_ON),
            "DATA_DO_ACORDO": ordered.first(PAID_ON),
            "__down_payment": ordered.first("CONDENACAO"),
            "__paid": ordered.total("CONDENACAO"),
        },
        counted=payments,
    )
    agreed = F.col("__down_payment") / V.COURT_PLAN_DOWN_PAYMENT
    return valued.select(
        "PROCESSO_ID",
        "SUB_TIPO",
        F.lit("CONDENAÇÃO").alias("DP_SUB_TIPO"),
        dates.month_start(F.col(PAID_ON)).alias("MES_FECH"),
        "PARCELA",
        F.col("PARCELA").alias("PARCELA_PAGA"),
        F.lit(1 + V.COURT_PLAN_LATER_PARTS).alias("QTD_PARCELAS_ACORDO"),
        F.when(F.col("__paid") >= agreed, "SIM").otherwise("NÃO").alias("QUITADO"),
        F.col(PAID_ON).alias("DATA_PAGTO"),
        "DATA_DO_ACORDO",
        installments.due_date(F.col(PAID_ON), F.col("PARCELA")).alias("DT_VENCIMENTO_PARCELA"),
        "PARCELAMENTO_CONDENACAO",
        F.col("CONDENACAO").alias("VALOR_PARCELA_PAGA"),
        agreed.alias("VALOR_DO_ACORDO"),
        installments.conviction_part_value(F.col("PARCELA"), F.col("CONDENACAO")).alias("VALOR_PARCELA"),
    )


def installment_control(
    payments: DataFrame, closings: DataFrame, settlements: DataFrame, since: str = "2022-01-01"
) -> DataFrame:
    """All paid parts with due dates and their share of the provision.

    `settlements` holds each case (ID) once.
    """
    cases = cases_with_plan(closings)
    parts = union_all([conviction_parts(payments, since), settlement_parts(payments, cases, settlements)])
    parts = parts.withColumns(
        {
            "MES_DO_PAGTO": dates.month_start(F.col("DATA_PAGTO")),
            "MES_DO_ACORDO": dates.month_start(F.col("DATA_DO_ACORDO")),
            "MES_VENCIMENTO_PARCELA": dates.month_start(F.col("DT_VENCIMENTO_PARCELA")),
        }
    )
    found = lookup(
        parts,
        cases,
        {"PROCESSO_ID": "ID_PROCESSO", "MES_DO_ACORDO": "MES_FECH"},
        {"FASE_M": "FASE", "PROVISAO_M_1": "PROVISAO_M_1", "PROVISAO_TOTAL_M_1": "PROVISAO_TOTAL_M_1"},
    )
    kind, part, number = F.col("DP_SUB_TIPO"), F.col("PARCELA"), F.col("QTD_PARCELAS_ACORDO")
    return found.withColumns(
        {
            f"{p}_PARCELA": installments.provision_part(kind, part, F.col(p), number)
            for p in ("PROVISAO_M_1", "PROVISAO_TOTAL_M_1")
        }
    )
