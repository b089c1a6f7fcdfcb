"""Supplier billing: court calculators and expert reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.functions import dates, rules, text
from closeworks.functions import fixed_values as V
from closeworks.operators import aggregates
from closeworks.operators.joins import discount_for, flag_exists, lookup
from closeworks.operators.unions import union_all


def calculator_billing(
    batches: Sequence[DataFrame], prices: DataFrame, penalties: DataFrame, history: DataFrame
) -> DataFrame:
    """Price of each calculation with late penalty; what was already paid costs nothing.

    `prices` and `penalties` are matrices with TIPO_DE_TAREFA and one column per office;
    `history` has PROCESSO_ID, NATUREZA_DO_SERVICO, DATA_DE_CONFIRMACAO.
    """
    tasks = union_all(batches)
    tasks = tasks.withColumns(
        {
            "NATUREZA_DO_SERVICO": text.strip_prefix(F.col("OBSERVACAO"), V.TASK_PREFIX),
            "FATURAR": rules.billable(F.col("ANALISE")),
            "DATA_DE_CONFIRMACAO": dates.coerce_date(F.col("DATA_DE_CONFIRMACAO").cast("string")),
        }
    ).drop("OBSERVACAO")
    on = {"ESCRITORIO": "ESCRITORIO", "NATUREZA_DO_SERVICO": "TIPO_DE_TAREFA"}
    long_prices = aggregates.to_long(prices, ["TIPO_DE_TAREFA"], "ESCRITORIO", "VALOR_TAREFA")
    long_penalties = aggregates.to_long(penalties, ["TIPO_DE_TAREFA"], "ESCRITORIO", "DESCONTO_SLA")
    priced = lookup(lookup(tasks, long_prices, on, ["VALOR_TAREFA"]), long_penalties, on, ["DESCONTO_SLA"])
    status = F.col("STATUS_DA_TAREFA")
    priced = priced.withColumn(
        "VALOR_TAREFA", F.when(F.col("FATURAR") == "NÃO FATURADO", 0.0).otherwise(F.col("VALOR_TAREFA"))
    )
    priced = priced.withColumns(
        {
            "VALOR_FINAL": rules.late_penalty(status, F.col("VALOR_TAREFA"), F.col("DESCONTO_SLA")),
            "DESCONTO_SLA": F.when(status == V.ON_TIME_STATUS, 0.0).otherwise(F.col("DESCONTO_SLA")),
        }
    )
    known = flag_exists(
        priced, history, ["PROCESSO_ID", "NATUREZA_DO_SERVICO", "DATA_DE_CONFIRMACAO"], "__paid", null_safe=True
    )
    paid = F.col("__paid")
    return known.withColumns(
        {
            "STATUS_PAGAMENTO": F.when(paid, "Pago no mês").otherwise("Não pago no mês"),
            "VALOR_FINAL": F.when(paid, 0.0).otherwise(F.col("VALOR_FINAL")),
            "DESCONTO_SLA": F.when(paid, 0.0).otherwise(F.col("DESCONTO_SLA")),
        }
    ).drop("__paid")


def _long_prices(band_prices: DataFrame) -> DataFrame:
    return aggregates.to_long(band_prices, ["ESCRITORIO", "TIPO_DE_PERICIA", "TIPO_ACAO"], "FAIXA", "VALOR")


def unambiguous_prices(band_prices: DataFrame, action: Sequence[str] = ()) -> DataFrame:
    """One price per office, report type and band, and per action type if listed; none where prices differ."""
    only = F.when(F.min("VALOR") == F.max("VALOR"), F.min("VALOR"))
    keys = ["ESCRITORIO", "TIPO_DE_PERICIA", *action, "FAIXA"]
    return _long_prices(band_prices).groupBy(*keys).agg(only.alias("VALOR"))


def ambiguous_prices(band_prices: DataFrame, action: Sequence[str] = ()) -> DataFrame:
    """Price rows that contradict each other, with the lowest and highest price: to be settled by the supplier."""
    keys = ["ESCRITORIO", "TIPO_DE_PERICIA", *action, "FAIXA"]
    found = _long_prices(band_prices).groupBy(*keys).agg(F.min("VALOR").alias("MENOR"), F.max("VALOR").alias("MAIOR"))
    return found.filter(F.col("MENOR") < F.col("MAIOR"))


def expert_billing(
    tasks: DataFrame,
    reference: DataFrame,
    band_prices: DataFrame,
    task_prices: DataFrame,
    report_prices: DataFrame,
    discounts: DataFrame,
    history: DataFrame,
    excluded_offices: Sequence[str],
    discounted_tasks: Sequence[str] = V.DISCOUNTED_TASKS,
) -> DataFrame:
    """Price of each expert report: by volume band, by task or by report type of the office.

    Tasks that have a TIPO_ACAO are priced by it. Where price rows contradict each other (`ambiguous_prices`)
    the band gives no price. `reference` maps DE to PARA report types; `band_prices` is a matrix with ESCRITORIO,
    TIPO_DE_PERICIA, TIPO_ACAO and one column per volume band; `task_prices` has ESCRITORIO,
    TIPO, VALOR and `report_prices` ESCRITORIO, TIPO_DE_PERICIA, VALOR.
    """
    candidates = tasks.filter(text.contains_word(F.col("ANALISE"), "FATURAR"))
    candidates = candidates.withColumn("FATURAR", rules.billable(F.col("ANALISE")))
    candidates = lookup(candidates, reference, {"TIPO_DE_PERICIA": "DE"}, {"PARA": "PERICIA_AJUSTADA"})
    by_report: Mapping[str, str] = {"ESCRITORIO": "ESCRITORIO", "PERICIA_AJUSTADA": "TIPO_DE_PERICIA"}
    action = [c for c in ("TIPO_ACAO",) if c in candidates.columns]
    prices = unambiguous_prices(band_prices, action)
    priced = aggregates.volume_price(
        candidates, prices, by_report, "FAIXA", "VALOR", "__by_volume", also={c: c for c in action}
    )
    priced = lookup(
        priced, task_prices, {"ESCRITORIO": "ESCRITORIO", "TIPO_DA_TAREFA": "TIPO"}, {"VALOR": "__by_task"},
        null_safe=True,
    )
    priced = lookup(priced, report_prices, by_report, {"VALOR": "__by_report"}, null_safe=True)
    value = F.coalesce("__by_volume", "__by_task", "__by_report")
    priced = priced.withColumn("VALOR", F.when(F.col("FATURAR") == "NÃO FATURADO", 0.0).otherwise(value))
    priced = priced.drop("__by_volume", "__by_task", "__by_report")
    reduced = discount_for(
        priced, discounts, "TIPO_DA_TAREFA", "ESCRITORIO", discounted_tasks, excluded_offices
    )
    reduced = reduced.withColumns(
        {
            "VALOR_FINAL": F.col("VALOR") * F.coalesce(F.col("DESCONTO"), F.lit(1.0)),
            "PROCESSO_ID": F.coalesce(text.coerce_id(F.col("PROCESSO_ID")), F.lit(0)),
            "TAREFA_ID": F.coalesce(text.coerce_id(F.col("TAREFA_ID")), F.lit(0)),
        }
    )
    known = history.withColumn("PROCESSO_ID", F.coalesce(text.coerce_id(F.col("PROCESSO_ID")), F.lit(0)))
    keys = {
        "PROCESSO_ID": "PROCESSO_ID",
        "PERICIA_AJUSTADA": "TIPO_DE_PERICIA",
        "FATURAR": "FATURAR",
        "ESCRITORIO": "FORNECEDOR",
        "TIPO_DA_TAREFA": "TIPO_DA_TAREFA",
    }
    counted = aggregates.history_totals(
        reduced, known, keys, "PRECO_FINAL", "QTD_OCORRENCIAS_NO_HISTORICO", "VALOR_PAGAMENTOS_ANTERIORES"
    )
    paid = F.col("QTD_OCORRENCIAS_NO_HISTORICO") >= 1
    return counted.withColumns(
        {
            "HOUVE_PAGAMENTO_EM_MES_ANTERIOR": paid,
            "FATURAR": F.when(paid, "NÃO FATURAR").otherwise(F.col("FATURAR")),
            "RESOLVIDO": F.lit("RESOLVIDO"),
            "ANALISE": F.when(paid, V.PAID_BEFORE).otherwise(F.col("ANALISE")),
            "VALOR_FINAL": F.when(paid, 0.0).otherwise(F.col("VALOR_FINAL")),
        }
    )
