"""Filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import shapes
from catalog.registry import query, table
from closeworks.operators import filters, schema
from closeworks.plans.payments import classified_payments

_AMOUNTS = ["ACORDO", "CONDENACAO", "CUSTAS", "IMPOSTO", "PENHORA", "PENSAO", "OUTROS_PAGAMENTOS"]


@query(f"""
WITH {shapes.CLASSIFIED}
SELECT PROCESSO_ID, LINHA, DIA, VALOR, SUB_TIPO, {", ".join(_AMOUNTS)} FROM classified""")
def payment_classes(spark, folder):
    paid = classified_payments(shapes.payments(spark, folder))
    return paid.select(
        "PROCESSO_ID", "LINHA", F.col("DATA_EFETIVA_DO_PAGAMENTO").alias("DIA"), "VALOR", "SUB_TIPO", *_AMOUNTS
    )


@query(f"""
WITH {shapes.GUARANTEES}
SELECT TIPO_GARANTIA, STATUS, STATUS_DA_GARANTIA, count(*) AS n FROM released GROUP BY ALL""")
def valid_guarantees(spark, folder):
    valid = filters.valid_guarantees(shapes.guarantees(spark, folder))
    return valid.groupBy("TIPO_GARANTIA", "STATUS", "STATUS_DA_GARANTIA").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linenumber <> 3""")
def non_null_keys(spark, folder):
    items = table(spark, folder, "lineitem")
    keyed = items.select(F.when(F.col("l_linenumber") != 3, F.col("l_orderkey")).alias("l_orderkey"), "l_partkey")
    return filters.has_key(keyed, "l_orderkey")


@query(f"""
WITH {shapes.CASES}
SELECT 'novos' AS part, count(*) AS n FROM cases WHERE NOVOS = 1
UNION ALL SELECT 'abertos', count(*) FROM cases WHERE ENCERRADOS <> 1 OR ENCERRADOS IS NULL""")
def flag_filter(spark, folder):
    cases = shapes.cases(spark, folder)
    new = filters.flagged(cases, "NOVOS").agg(F.lit("novos").alias("part"), F.count(F.lit(1)).alias("n"))
    is_open = filters.not_flagged(cases, "ENCERRADOS")
    return new.union(is_open.agg(F.lit("abertos"), F.count(F.lit(1))))


@query("""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate::DATE <= DATE '1999-06-30'""")
def period_filter(spark, folder):
    orders = table(spark, folder, "orders")
    return filters.in_period(orders, "o_orderdate", "1998-01-01", "1999-06-30").select("o_orderkey", "o_totalprice")


@query(f"""
WITH {shapes.CASES}
SELECT MES_FECH, count(*) AS n FROM cases
WHERE MES_FECH BETWEEN DATE '1998-07-01' AND DATE '2000-06-01' AND ENCERRADOS = 1 GROUP BY 1""")
def rolling_24_months(spark, folder):
    closed = filters.flagged(shapes.cases(spark, folder), "ENCERRADOS")
    recent = filters.last_months(closed, "MES_FECH", "2000-06-01", 24)
    return recent.groupBy("MES_FECH").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT o_orderkey AS ID_PROCESSO, o_custkey AS CLIENTE, o_orderdate::DATE AS DATACADASTRO, 'ATUAL' AS SOURCE,
       coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END, 0) AS PROVISAO, o_totalprice * 0.3 AS PARTE
FROM orders""")
def wide_projection(spark, folder):
    provision = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice"))
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ID_PROCESSO"),
        F.col("o_custkey").alias("CLIENTE"),
        F.to_date("o_orderdate").alias("DATACADASTRO"),
        F.lit("ATUAL").alias("SOURCE"),
        F.coalesce(provision, F.lit(0.0)).alias("PROVISAO"),
        (F.col("o_totalprice") * 0.3).alias("PARTE"),
    )


@query("""
SELECT o_orderkey, o_orderstatus, '' AS week, o_orderdate::DATE AS day FROM orders""")
def inserted_column(spark, folder):
    orders = table(spark, folder, "orders")
    kept = orders.select(*schema.existing(orders, ["o_orderkey", "missing", "o_orderstatus", "o_orderdate"]))
    named = schema.rename(kept, {"o_orderdate": "day"}).withColumn("day", F.to_date("day"))
    return schema.insert_after(named, "o_orderstatus", "week", F.lit(""))


@query(f"""
WITH {shapes.PAYMENTS}
SELECT PROCESSO_ID, LINHA, PLANO, VALOR FROM payments
WHERE PLANO IS NOT NULL AND PLANO NOT IN ('PAGAMENTO SEM PARCELAMENTO', 'SALDO - PARCELAMENTO INDEFERIDO')""")
def installment_rows(spark, folder):
    parts = filters.court_plan_parts(shapes.payments(spark, folder))
    return parts.select("PROCESSO_ID", "LINHA", F.col("PARCELAMENTO_CONDENACAO").alias("PLANO"), "VALOR")
