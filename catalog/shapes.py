"""The given tables in the shape of the business tables, in Spark and in SQL.

A case is an order, a payment or guarantee a line item, a person a customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import table

# ---- cases --------------------------------------------------------------------

CASES = """cases AS (
  SELECT o_orderkey AS ID_PROCESSO, o_custkey AS CUSTOMER, o_orderdate::DATE AS DATACADASTRO,
         o_orderstatus AS STATUS, o_totalprice AS VALOR, o_orderpriority AS PRIORIDADE,
         date_trunc('month', o_orderdate)::DATE AS MES_FECH,
         CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS NOVOS,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS ENCERRADOS,
         CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS ESTOQUE
  FROM orders)"""


def cases(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    day = F.to_date("o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias("ID_PROCESSO"),
        F.col("o_custkey").alias("CUSTOMER"),
        day.alias("DATACADASTRO"),
        status.alias("STATUS"),
        F.col("o_totalprice").alias("VALOR"),
        F.col("o_orderpriority").alias("PRIORIDADE"),
        F.trunc(day, "MM").alias("MES_FECH"),
        (status == "P").cast("int").alias("NOVOS"),
        (status == "F").cast("int").alias("ENCERRADOS"),
        (status == "O").cast("int").alias("ESTOQUE"),
    )


# ---- payments -----------------------------------------------------------------

PAYMENTS = """payments AS (
  SELECT l_orderkey AS PROCESSO_ID, l_linenumber AS LINHA,
         CASE WHEN l_linenumber <> 7 THEN l_shipdate::DATE END AS PAGO_EM,
         (l_shipdate::DATE - 10)::DATE AS PEDIDO_EM,
         CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'ACORDO - TRABALHISTA'
              WHEN l_returnflag = 'A' THEN 'CONDENAÇÃO - TRABALHISTA'
              WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'CUSTAS PROCESSUAIS - TRABALHISTA'
              WHEN l_returnflag = 'N' THEN 'INSS - TRABALHISTA'
              WHEN l_linestatus = 'O' THEN 'SUBTIPO DESCONHECIDO'
              WHEN l_linenumber <= 2 THEN 'LIBERAÇÃO DE PENHORA - MASSA'
              WHEN l_linenumber <= 4 THEN 'PENSÃO - CÍVEL'
              ELSE 'PAGAMENTO' END AS SUB_TIPO,
         CASE WHEN l_quantity > 48 THEN NULL WHEN l_quantity > 46 THEN 'Cancelado'
              WHEN l_quantity > 44 THEN 'PAGAMENTO DEVOLVIDO - BANCO' ELSE 'PAGO' END AS SITUACAO,
         l_extendedprice AS VALOR,
         CASE WHEN l_linenumber = 1 THEN 'PARCELAMENTO 916 - 30%'
              WHEN l_linenumber <= 5 THEN l_linenumber::VARCHAR || 'ª PARCELA'
              WHEN l_linenumber = 6 THEN 'PAGAMENTO SEM PARCELAMENTO' END AS PLANO
  FROM lineitem)"""


def payments(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem")
    flag, status, line = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    quantity, day = F.col("l_quantity"), F.to_date("l_shipdate")
    return items.select(
        F.col("l_orderkey").alias("PROCESSO_ID"),
        line.alias("LINHA"),
        F.when(line != 7, day).alias("DATA_EFETIVA_DO_PAGAMENTO"),
        F.date_sub(day, 10).alias("DATA_SOLICITACAO_ESCRITORIO"),
        F.when((flag == "A") & (status == "F"), "ACORDO - TRABALHISTA")
        .when(flag == "A", "CONDENAÇÃO - TRABALHISTA")
        .when((flag == "N") & (status == "F"), "CUSTAS PROCESSUAIS - TRABALHISTA")
        .when(flag == "N", "INSS - TRABALHISTA")
        .when(status == "O", "SUBTIPO DESCONHECIDO")
        .when(line <= 2, "LIBERAÇÃO DE PENHORA - MASSA")
        .when(line <= 4, "PENSÃO - CÍVEL")
        .otherwise("PAGAMENTO")
        .alias("SUB_TIPO"),
        F.when(quantity > 48, None)
        .when(quantity > 46, "Cancelado")
        .when(quantity > 44, "PAGAMENTO DEVOLVIDO - BANCO")
        .otherwise("PAGO")
        .alias("STATUS_DO_PAGAMENTO"),
        F.col("l_extendedprice").alias("VALOR"),
        F.when(line == 1, "PARCELAMENTO 916 - 30%")
        .when(line <= 5, F.concat(line.cast("string"), F.lit("ª PARCELA")))
        .when(line == 6, "PAGAMENTO SEM PARCELAMENTO")
        .alias("PARCELAMENTO_CONDENACAO"),
    )


# Valid payments with one column per class; the date falls back to the request.
CLASSIFIED = PAYMENTS + """, valid AS (
  SELECT *, coalesce(PAGO_EM, PEDIDO_EM) AS DIA FROM payments
  WHERE SUB_TIPO <> 'SUBTIPO DESCONHECIDO'
    AND upper(SITUACAO) NOT IN ('REMOVIDO', 'CANCELADO', 'REJEITADO', 'EM CORREÇÃO', 'PENDENTE')
    AND upper(SITUACAO) NOT LIKE '%PAGAMENTO DEVOLVIDO%'),
classified AS (
  SELECT *,
    CASE WHEN SUB_TIPO LIKE 'ACORDO%' THEN VALOR END AS ACORDO,
    CASE WHEN SUB_TIPO LIKE 'CONDENA%' THEN VALOR END AS CONDENACAO,
    CASE WHEN SUB_TIPO LIKE 'CUSTAS%' THEN VALOR END AS CUSTAS,
    CASE WHEN SUB_TIPO LIKE 'INSS%' THEN VALOR END AS IMPOSTO,
    CASE WHEN SUB_TIPO LIKE 'LIBERA%' THEN VALOR END AS PENHORA,
    CASE WHEN SUB_TIPO LIKE 'PENS%' THEN VALOR END AS PENSAO,
    CASE WHEN SUB_TIPO = 'PAGAMENTO' THEN VALOR END AS OUTROS_PAGAMENTOS
  FROM valid)"""

PAID_BY_DATE = CLASSIFIED + """, paid AS (
  SELECT PROCESSO_ID, DIA, coalesce(sum(ACORDO), 0) AS ACORDO, coalesce(sum(CONDENACAO), 0) AS CONDENACAO,
         coalesce(sum(PENHORA), 0) AS PENHORA, coalesce(sum(PENSAO), 0) AS PENSAO,
         coalesce(sum(OUTROS_PAGAMENTOS), 0) AS OUTROS_PAGAMENTOS, coalesce(sum(IMPOSTO), 0) AS IMPOSTO
  FROM classified GROUP BY 1, 2
  HAVING coalesce(sum(ACORDO), 0) + coalesce(sum(CONDENACAO), 0) + coalesce(sum(PENHORA), 0)
       + coalesce(sum(PENSAO), 0) + coalesce(sum(OUTROS_PAGAMENTOS), 0) + coalesce(sum(IMPOSTO), 0) > 0)"""

# ---- guarantees ---------------------------------------------------------------

GUARANTEES = """guarantees AS (
  SELECT l_orderkey AS PROCESSO_ID,
         CASE WHEN l_tax = 0.07 THEN 'REMOVIDO' WHEN l_tax < 0.08 THEN 'ATIVO' END AS STATUS,
         CASE WHEN l_discount = 0.1 THEN 'CANCELADO' WHEN l_discount = 0.09 THEN 'PAGAMENTO DEVOLVIDO'
              WHEN l_discount > 0 THEN 'LEVANTADA' END AS STATUS_DA_GARANTIA,
         CASE WHEN l_linenumber <= 4 THEN 'DEPÓSITO JUDICIAL' WHEN l_linenumber = 5 THEN 'CAUÇÃO'
              ELSE 'PENHORA - GARANTIA' END AS TIPO_GARANTIA,
         CASE WHEN l_linenumber <> 7 THEN l_shipdate::DATE END AS LIBERADA_EM,
         l_extendedprice AS VALOR
  FROM lineitem WHERE l_returnflag = 'R'),
released AS (
  SELECT * FROM guarantees
  WHERE LIBERADA_EM IS NOT NULL AND STATUS <> 'REMOVIDO' AND STATUS_DA_GARANTIA <> 'CANCELADO'
    AND STATUS_DA_GARANTIA NOT LIKE '%PAGAMENTO DEVOLVIDO%'
    AND TIPO_GARANTIA IN ('DEPÓSITO JUDICIAL', 'PENHORA - GARANTIA'))"""


def guarantees(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
    line, tax, discount = F.col("l_linenumber"), F.col("l_tax"), F.col("l_discount")
    return items.select(
        F.col("l_orderkey").alias("PROCESSO_ID"),
        F.when(tax == 0.07, "REMOVIDO").when(tax < 0.08, "ATIVO").alias("STATUS"),
        F.when(discount == 0.1, "CANCELADO")
        .when(discount == 0.09, "PAGAMENTO DEVOLVIDO")
        .when(discount > 0, "LEVANTADA")
        .alias("STATUS_DA_GARANTIA"),
        F.when(line <= 4, "DEPÓSITO JUDICIAL")
        .when(line == 5, "CAUÇÃO")
        .otherwise("PENHORA - GARANTIA")
        .alias("TIPO_GARANTIA"),
        F.when(line != 7, F.to_date("l_shipdate")).alias("DATA_DE_LEVANTAMENTO_PARTE_CONTRARIA"),
        F.col("l_extendedprice").alias("VALOR_LEVANTADO_PARTE_CONTRARIA"),
    )


FACT = PAID_BY_DATE + ", " + GUARANTEES + """, released_by_date AS (
  SELECT PROCESSO_ID, LIBERADA_EM AS DIA, sum(VALOR) AS GARANTIA FROM released GROUP BY 1, 2),
amounts AS (
  SELECT coalesce(a.PROCESSO_ID, b.PROCESSO_ID) AS PROCESSO_ID, coalesce(a.DIA, b.DIA) AS DIA,
         coalesce(ACORDO, 0) AS ACORDO, coalesce(CONDENACAO, 0) AS CONDENACAO, coalesce(PENHORA, 0) AS PENHORA,
         coalesce(PENSAO, 0) AS PENSAO, coalesce(OUTROS_PAGAMENTOS, 0) AS OUTROS_PAGAMENTOS,
         coalesce(IMPOSTO, 0) AS IMPOSTO, coalesce(GARANTIA, 0) AS GARANTIA
  FROM paid a FULL OUTER JOIN released_by_date b ON a.PROCESSO_ID = b.PROCESSO_ID AND a.DIA = b.DIA),
fact AS (
  SELECT *, ACORDO + CONDENACAO + PENHORA + PENSAO + OUTROS_PAGAMENTOS + IMPOSTO + GARANTIA AS TOTAL FROM amounts),
totals AS (
  SELECT PROCESSO_ID, max(DIA) AS DT_ULT_PGTO, sum(ACORDO) AS ACORDO, sum(CONDENACAO) AS CONDENACAO,
         sum(PENHORA) AS PENHORA, sum(PENSAO) AS PENSAO, sum(OUTROS_PAGAMENTOS) AS OUTROS_PAGAMENTOS,
         sum(IMPOSTO) AS IMPOSTO, sum(GARANTIA) AS GARANTIA, sum(TOTAL) AS TOTAL_PAGAMENTOS
  FROM fact GROUP BY 1)"""

# ---- accounting calendar for the years of the given tables -----------------------

# Months from the 20th to the 19th; 2000 has no closing and February 1998 ends late, so that
# it overlaps with March.
CALENDAR = """calendar AS (
  SELECT m::DATE AS MES_CONTABIL, (m - INTERVAL 1 MONTH + INTERVAL 19 DAY)::DATE AS DT_INICIO,
         CASE WHEN m = DATE '1998-02-01' THEN DATE '1998-03-05' ELSE (m + INTERVAL 18 DAY)::DATE END AS DT_FIM
  FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2002-01-01', INTERVAL 1 MONTH)) AS m)
  WHERE year(m) <> 2000)"""
DAY_MONTHS = CALENDAR + """, day_months AS (
  SELECT d::DATE AS D, min(MES_CONTABIL) AS MES_CONTABIL
  FROM (SELECT MES_CONTABIL, unnest(generate_series(DT_INICIO, DT_FIM, INTERVAL 1 DAY)) AS d FROM calendar)
  GROUP BY 1)"""
