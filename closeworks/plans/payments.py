"""Payments and guarantees: the payment fact, case totals and the installment forecast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.operators import aggregates, filters, installments
from closeworks.operators.joins import full_outer_coalesce

CASE_DATE = ["PROCESSO_ID", "DATA_EFETIVA_DO_PAGAMENTO"]
PAID_COLS = ["ACORDO", "CONDENACAO", "PENHORA", "PENSAO", "OUTROS_PAGAMENTOS", "IMPOSTO"]
# One definition of "paid on a case" for all jobs; procedural costs are not part of it.
AMOUNT_COLS = [*PAID_COLS, "GARANTIA"]


def add_up(names: list[str]) -> Column:
    return reduce(Column.__add__, [F.col(n) for n in names])


def classified_payments(payments: DataFrame) -> DataFrame:
    """Valid payments with one amount column per class; a missing payment date is the date
    the payment was asked for."""
    valid = filters.valid_payments(payments)
    paid_on = F.coalesce("DATA_EFETIVA_DO_PAGAMENTO", "DATA_SOLICITACAO_ESCRITORIO")
    return aggregates.classify_amounts(valid).withColumn("DATA_EFETIVA_DO_PAGAMENTO", paid_on)


def guarantees_by_date(guarantees: DataFrame) -> DataFrame:
    """Released guarantees summed by case and release date."""
    valid = filters.valid_guarantees(guarantees)
    return valid.groupBy(
        "PROCESSO_ID",
        F.col("DATA_DE_LEVANTAMENTO_PARTE_CONTRARIA").alias("DATA_EFETIVA_DO_PAGAMENTO"),
    ).agg(F.sum("VALOR_LEVANTADO_PARTE_CONTRARIA").alias("GARANTIA"))


def payment_fact(payments: DataFrame, guarantees: DataFrame) -> DataFrame:
    """Amounts by case and payment date with their total."""
    paid = aggregates.positive_sums(classified_payments(payments), CASE_DATE, PAID_COLS)
    fact = full_outer_coalesce(paid, guarantees_by_date(guarantees), CASE_DATE)
    return fact.withColumn("TOTAL_PAGAMENTOS", add_up(AMOUNT_COLS))


def payment_totals(fact: DataFrame) -> DataFrame:
    """One row per case: last payment date, amounts and total."""
    return aggregates.case_totals(fact, [*AMOUNT_COLS, "TOTAL_PAGAMENTOS"])


def cost_totals(payments: DataFrame) -> DataFrame:
    """Procedural costs per case, which are classified but not part of what was paid on it."""
    costs = classified_payments(payments).filter(F.col("CUSTAS").isNotNull())
    return costs.groupBy("PROCESSO_ID").agg(F.sum("CUSTAS").alias("CUSTAS"))


def installment_forecast(payments: DataFrame) -> DataFrame:
    """One row per open part of a court-ordered plan (30 % down, six more parts)."""
    plans = installments.plan_amounts(filters.court_plan_parts(payments))
    counted = installments.remaining_parts(installments.highest_part(plans))
    return installments.expand_parts(counted)

