"""Composite jobs on the given tables in the shape of the business tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import dims, shapes
from catalog.registry import query, rounded, table
from closeworks.functions import fixed_values as V
from closeworks.functions.text import format_brl
from closeworks.plans import (
    agency,
    billing,
    case_book as book_plan,
    closing,
    entries,
    modelling,
    normalise,
    parcels,
    phases,
    settlements,
    staff,
    tax_status,
)
from closeworks.plans.payments import AMOUNT_COLS, classified_payments, payment_fact, payment_totals
from closeworks.plans.payments import installment_forecast as forecast
from closeworks.sources.dims import dim_from_rows


def _round_sql(names) -> str:
    return ", ".join(f"round({n}, 2) AS {n}" for n in names)


# ---- installment forecast -----------------------------------------------------


@query(f"""
WITH {shapes.PAYMENTS}, parts AS (
  SELECT *, CASE WHEN LINHA = 1 THEN 0.5 ELSE LINHA END::DOUBLE AS NUMERO,
         CASE WHEN LINHA = 1 THEN VALOR / 0.3 - VALOR ELSE 0 END AS RESTO
  FROM payments WHERE LINHA <= 5),
counted AS (
  SELECT *, CASE WHEN NUMERO <> max(NUMERO) OVER (PARTITION BY PROCESSO_ID) THEN 0 WHEN NUMERO = 0.5 THEN 6 ELSE 6 - NUMERO END::INTEGER AS FALTAM
  FROM parts),
expanded AS (SELECT *, unnest(generate_series(1, FALTAM)) AS n FROM counted WHERE FALTAM >= 1)
SELECT PROCESSO_ID, LINHA, VALOR, FALTAM AS PARCELAS_FALTANTES, n::INTEGER AS NUMERO_PARCELA,
       CASE WHEN RESTO > 0 THEN RESTO / FALTAM ELSE VALOR END AS VALOR_POR_PARCELA
FROM expanded""")
def installment_forecast(spark, folder):
    open_parts = forecast(shapes.payments(spark, folder))
    return open_parts.select("PROCESSO_ID", "LINHA", "VALOR", "PARCELAS_FALTANTES", "NUMERO_PARCELA", "VALOR_POR_PARCELA")


# ---- monthly closing ----------------------------------------------------------

_CLOSING_PARTS = shapes.FACT + ", " + shapes.DAY_MONTHS + """, sheet AS (
  SELECT o_orderkey AS ID_PROCESSO, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate::DATE END AS DATACADASTRO,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS STATUS_M,
         CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'RECURSAL TRT' WHEN 2 THEN 'EXECUÇÃO - TRT' WHEN 3 THEN 'CONHECIMENTO' WHEN 4 THEN 'N/A' END AS FASE_M,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS ENCERRADOS, o_totalprice AS PROVISAO_MOV_M
  FROM orders),
ger AS (
  SELECT o_orderkey AS PROCESSO_ID, (o_orderdate::DATE - 1)::DATE AS DATA_REGISTRADO, lower(o_orderstatus) AS STATUS,
         CASE WHEN o_orderkey % 7 <> 0 THEN 'RECURSAL' END AS FASE, o_orderpriority AS CARTEIRA
  FROM orders WHERE o_orderpriority <> '3-MEDIUM'),
joined AS (
  SELECT s.*, g.*, coalesce(g.FASE, s.FASE_M) AS FASE_NOVO FROM sheet s LEFT JOIN ger g ON s.ID_PROCESSO = g.PROCESSO_ID),
dated AS (SELECT f.*, MES_CONTABIL FROM fact f LEFT JOIN day_months ON f.DIA = D)"""


def _closing_sql(month: str, name: str) -> str:
    return f"""recognised_{name} AS (
  SELECT PROCESSO_ID AS P, max(MES_CONTABIL) AS DT_ULT_PGTO, {", ".join(f"sum({a}) AS {a}" for a in AMOUNT_COLS)}, sum(TOTAL) AS TOTAL_PAGAMENTOS
  FROM dated WHERE MES_CONTABIL <= DATE '{month}' GROUP BY 1),
closing_{name} AS (
  SELECT ID_PROCESSO, ENCERRADOS, PROVISAO_MOV_M, CARTEIRA, coalesce(DATACADASTRO, DATA_REGISTRADO) AS DATACADASTRO,
         coalesce(STATUS_M, STATUS) AS STATUS_M, CASE WHEN FASE_M = '' THEN FASE_NOVO ELSE FASE_M END AS FASE_M,
         CASE WHEN FASE_NOVO IN ('', 'N/A') THEN 'DEMAIS' WHEN FASE_NOVO = 'EXECUÇÃO - TRT' THEN 'EXECUÇÃO'
              WHEN FASE_NOVO IN ('RECURSAL', 'RECURSAL TRT') THEN 'RECURSAL' ELSE FASE_NOVO END AS DP_FASE,
         CASE WHEN ID_PROCESSO % 9 < 7 THEN 'SIM' ELSE 'NÃO' END AS PROCESSO_COM_DOCUMENTO, CASE WHEN PROCESSO_ID IS NOT NULL THEN 'DEFESA' END AS ESTRATEGIA,
         DATE '{month}' AS MES_FECH, DT_ULT_PGTO, {_round_sql([*AMOUNT_COLS, "TOTAL_PAGAMENTOS"])}
  FROM joined LEFT JOIN recognised_{name} r ON ID_PROCESSO = r.P AND ENCERRADOS = 1)"""


def _closing_inputs(spark, folder):
    orders = table(spark, folder, "orders")
    key, day, status = F.col("o_orderkey"), F.to_date("o_orderdate"), F.col("o_orderstatus")
    phase = F.when(key % 6 == 0, "")
    for i, spelling in enumerate(["RECURSAL TRT", "EXECUÇÃO - TRT", "CONHECIMENTO", "N/A"], start=1):
        phase = phase.when(key % 6 == i, spelling)
    sheet = orders.select(
        key.alias("ID_PROCESSO"),
        F.when(key % 4 != 0, day).alias("DATACADASTRO"),
        F.when(key % 5 != 0, status).alias("STATUS_M"),
        phase.alias("FASE_M"),
        # Each listed analysis, one that is not listed, and none.
        F.get(F.array(*map(F.lit, [*V.DOCUMENT_ANALYSES, "ACORDO"])), (key % (len(V.DOCUMENT_ANALYSES) + 2)).cast("int")).alias("DOC"),
        F.lit(None).cast("string").alias("INDICACAO_PROCESSO_ESTRATEGICO"),
        (status == "F").cast("int").alias("ENCERRADOS"),
        F.col("o_totalprice").alias("PROVISAO_MOV_M"),
    )
    managerial = orders.filter("o_orderpriority <> '3-MEDIUM'").select(
        key.alias("PROCESSO_ID"),
        F.date_sub(day, 1).alias("DATA_REGISTRADO"),
        F.lower(status).alias("STATUS"),
        F.when(key % 7 != 0, "RECURSAL").alias("FASE"),
        F.col("o_orderpriority").alias("CARTEIRA"),
        F.lit("DEFESA").alias("ULTIMA_POSICAO_ESTRATEGIA_JUSTIFICATIVA_ACORDO_DEFESA"),
    )
    fact = payment_fact(shapes.payments(spark, folder), shapes.guarantees(spark, folder))
    return closing.clean_closing_sheet(sheet), managerial, fact, dims.calendar(spark)


@query(f"""
WITH {shapes.FACT}, {shapes.DAY_MONTHS}
SELECT PROCESSO_ID, max(MES_CONTABIL) AS DT_ULT_PGTO, {", ".join(f"round(sum({a}), 2) AS {a}" for a in AMOUNT_COLS)},
       round(sum(TOTAL), 2) AS TOTAL_PAGAMENTOS
FROM fact JOIN day_months ON DIA = D WHERE MES_CONTABIL <= DATE '1998-12-01' GROUP BY 1""")
def recognised_payments(spark, folder):
    fact = payment_fact(shapes.payments(spark, folder), shapes.guarantees(spark, folder))
    known = closing.recognised_payments(fact, dims.calendar(spark), "1998-12-01")
    return rounded(known, *AMOUNT_COLS, "TOTAL_PAGAMENTOS")


@query(f"WITH {_CLOSING_PARTS}, {_closing_sql('1999-06-01', 'a')} SELECT * FROM closing_a")
def monthly_closing(spark, folder):
    book = closing.monthly_closing(*_closing_inputs(spark, folder), "1999-06-01")
    return rounded(book.drop("DOC", "INDICACAO_PROCESSO_ESTRATEGICO"), *AMOUNT_COLS, "TOTAL_PAGAMENTOS")


@query(f"""
WITH {_CLOSING_PARTS}, {_closing_sql('1998-06-01', 'a')}, {_closing_sql('1999-06-01', 'b')},
both_months AS (SELECT * FROM closing_a UNION ALL SELECT * FROM closing_b)
SELECT MES_FECH, sum(ENCERRADOS)::BIGINT AS ENCERRADOS, round(sum(ACORDO), 2) AS ACORDO, round(sum(CONDENACAO), 2) AS CONDENACAO,
       round(sum(TOTAL_PAGAMENTOS), 2) AS TOTAL_PAGAMENTOS, round(sum(PROVISAO_MOV_M), 2) AS PROVISAO_MOV_M
FROM both_months GROUP BY 1""")
def closing_history(spark, folder):
    inputs = _closing_inputs(spark, folder)
    older = closing.monthly_closing(*inputs, "1998-06-01").withColumnRenamed("ACORDO", "Acordo")
    newer = closing.monthly_closing(*inputs, "1999-06-01").withColumn("ENCERRADOS", F.col("ENCERRADOS").cast("bigint"))
    totals = closing.indicators(closing.closing_history([older, newer]))
    return rounded(totals, "ACORDO", "CONDENACAO", "TOTAL_PAGAMENTOS", "PROVISAO_MOV_M")


# ---- case book ----------------------------------------------------------------

_BOOK_SQL = shapes.FACT + """, case_totals AS (
  SELECT o_custkey AS P, max(DT_ULT_PGTO) AS D, sum(ACORDO) AS a, sum(CONDENACAO) AS c, sum(PENHORA) AS ph, sum(PENSAO) AS ps,
         sum(OUTROS_PAGAMENTOS) AS o, sum(IMPOSTO) AS i, sum(GARANTIA) AS g
  FROM totals JOIN orders ON PROCESSO_ID = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1),
closings AS (
  SELECT o_custkey AS ID_PROCESSO, date_trunc('month', o_orderdate)::DATE AS MES_FECH,
         (o_orderdate::DATE - (o_orderkey % 3000)::INTEGER)::DATE AS DATACADASTRO, (o_orderdate::DATE - 30)::DATE AS DISTRIBUICAO,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'RECURSAL TST' WHEN '2-HIGH' THEN 'EXECUÇÃO DEFIN' WHEN '3-MEDIUM' THEN 'INATIVO' ELSE 'CONHECIMENTO' END AS FASE,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'CONTENCIOSO COLETIVO' END AS SUB_AREA, o_orderpriority = '5-LOW' AS IS_LOW,
         CASE WHEN o_orderstatus = 'P' THEN 1 WHEN o_orderstatus = 'F' THEN 0 END AS NOVOS_, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS REATIVADOS,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS ENCERRADOS, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS ESTOQUE,
         o_totalprice AS PROVISAO_TOTAL_M, o_totalprice - 400000 AS PROVISAO_TOTAL_PASSIVO_M, 0.0 AS ZERO
  FROM orders),
person AS (
  SELECT c_custkey, c_mktsegment, c_nationkey, n_name, r_name, (DATE '1988-01-15' + (c_custkey % 3000)::INTEGER)::DATE AS HIRED,
         CASE WHEN c_custkey % 9 <> 0 THEN (DATE '1988-01-15' + (c_custkey % 3000)::INTEGER + (c_custkey * 7 % 4000)::INTEGER)::DATE END AS LEFT_ON,
         CASE WHEN c_custkey % 40 = 0 THEN 'MINISTERIO PUBLICO DO TRABALHO' ELSE c_name END AS PARTE,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'VENDEDOR' WHEN 'FURNITURE' THEN 'CAIXA' ELSE 'PINTOR' END AS CARGO_GRUPO,
         CASE WHEN c_custkey % 6 = 0 THEN 'TERCEIRO SOLVENTE' END AS NATUREZA
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE c_mktsegment <> 'HOUSEHOLD'),
latest AS (SELECT ID_PROCESSO AS P, max(MES_FECH) AS m FROM closings WHERE ENCERRADOS = 1 GROUP BY 1),
fresh AS (
  SELECT c.*, coalesce(NOVOS_, REATIVADOS) AS NOVOS, (l.m IS NOT NULL AND ENCERRADOS = 1) AS renewed, t.*
  FROM closings c LEFT JOIN latest l ON c.ID_PROCESSO = l.P AND c.MES_FECH = l.m LEFT JOIN case_totals t ON c.ID_PROCESSO = t.P),
refreshed AS (
  SELECT *, CASE WHEN renewed THEN coalesce(a, 0) ELSE 0 END AS ACORDO, CASE WHEN renewed THEN coalesce(c, 0) ELSE 0 END AS CONDENACAO,
         CASE WHEN renewed THEN coalesce(ph, 0) ELSE 0 END AS PENHORA, CASE WHEN renewed THEN coalesce(ps, 0) ELSE 0 END AS PENSAO,
         CASE WHEN renewed THEN coalesce(o, 0) ELSE 0 END AS OUTROS, CASE WHEN renewed THEN coalesce(i, 0) ELSE 0 END AS IMPOSTO,
         CASE WHEN renewed THEN coalesce(g, 0) ELSE 0 END AS GARANTIA, CASE WHEN renewed THEN D END AS DT_ULT_PGTO
  FROM fresh),
one AS (
  SELECT *, row_number() OVER (PARTITION BY MES_FECH, ID_PROCESSO, NOVOS, ENCERRADOS, ESTOQUE
      ORDER BY DATACADASTRO, round(ACORDO + CONDENACAO + PENHORA + PENSAO + OUTROS + IMPOSTO + GARANTIA, 2), PROVISAO_TOTAL_M) AS rn
  FROM refreshed),
book AS (
  SELECT one.*, person.*, date_trunc('month', DATACADASTRO)::DATE AS MES_CADASTRO,
    CASE WHEN LEFT_ON >= HIRED THEN (year(LEFT_ON) * 12 + month(LEFT_ON)) - (year(HIRED) * 12 + month(HIRED))
      - CASE WHEN day(LEFT_ON) < day(HIRED) THEN 1 ELSE 0 END END AS TENURE,
    (MES_FECH - date_trunc('month', DATACADASTRO)::DATE)::INTEGER AS MES_DAYS, (MES_FECH - DATACADASTRO)::INTEGER AS DAYS,
    (year(MES_FECH) * 12 + month(MES_FECH)) - (year(DATACADASTRO) * 12 + month(DATACADASTRO)) AS BOUNDARIES
  FROM one LEFT JOIN person ON ID_PROCESSO = c_custkey WHERE rn = 1),
aged AS (
  SELECT *, CASE WHEN DATACADASTRO <= MES_FECH THEN BOUNDARIES - CASE WHEN 1 < day(DATACADASTRO) THEN 1 ELSE 0 END
                 ELSE -(-BOUNDARIES - CASE WHEN day(DATACADASTRO) < 1 THEN 1 ELSE 0 END) END AS MONTHS FROM book)"""


def _cluster(value: str) -> str:
    labels = ["ATÉ 1 ANO", "1 - 2 ANOS", "2 - 3 ANOS", "3 - 4 ANOS", "4 - 5 ANOS", "5 - 6 ANOS", "6 - 7 ANOS"]
    parts = " ".join(f"WHEN {value} <= {12 * (i + 1)} THEN '{label}'" for i, label in enumerate(labels))
    return f"CASE {parts} ELSE '+7 ANOS' END"


_REASON = """CASE WHEN ENCERRADOS = 1 THEN CASE WHEN ACORDO > 1 THEN 'ACORDO'
    WHEN CONDENACAO + PENHORA + OUTROS + IMPOSTO + GARANTIA > 1 THEN 'CONDENACAO'
    WHEN ACORDO + CONDENACAO + PENHORA + OUTROS + IMPOSTO + GARANTIA <= 1 THEN 'SEM ONUS' END END"""


def _customer_book(spark, folder, **options):
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    key, day, status = F.col("o_orderkey"), F.to_date("o_orderdate"), F.col("o_orderstatus")
    priority = F.col("o_orderpriority")
    closings = orders.select(
        F.col("o_custkey").alias("ID_PROCESSO"),
        F.trunc(day, "MM").alias("MES_FECH"),
        F.date_sub(day, (key % 3000).cast("int")).alias("DATACADASTRO"),
        F.date_sub(day, 30).alias("DISTRIBUICAO"),
        F.when(priority == "1-URGENT", "RECURSAL TST")
        .when(priority == "2-HIGH", "EXECUÇÃO DEFIN")
        .when(priority == "3-MEDIUM", "INATIVO")
        .otherwise("CONHECIMENTO")
        .alias("FASE_M"),
        F.lit("TRABALHISTA").alias("AREA_DO_DIREITO"),
        F.when(priority == "4-NOT SPECIFIED", "CONTENCIOSO COLETIVO").alias("SUB_AREA_DO_DIREITO"),
        F.when(status == "P", 1).when(status == "F", 0).alias("NOVOS"),
        (status == "O").cast("int").alias("REATIVADOS"),
        (status == "F").cast("int").alias("ENCERRADOS"),
        (status == "O").cast("int").alias("ESTOQUE"),
        F.col("o_totalprice").alias("PROVISAO_TOTAL_M"),
        (F.col("o_totalprice") - 400000).alias("PROVISAO_TOTAL_PASSIVO_M"),
        F.when(status == "P", "FILIAL SA").otherwise("EMPRESA").alias("EMPRESA_M"),
        # One cost centre per customer, so that the organisation follows the nation.
        (F.col("o_custkey") % 1_000_000_007).alias("CENTRO_DE_CUSTO_M"),
        status.alias("STATUS_M"),
        F.lit("DEF").alias("ESTRATEGIA"),
        F.when(priority == "5-LOW", "DEFESA").alias("INDICACAO_PROCESSO_ESTRATEGICO"),
        F.lit(None).cast("date").alias("DT_ULT_PGTO"),
        F.lit(0.0).alias("TOTAL_PAGAMENTOS"),
    )
    people = customer.filter("c_mktsegment <> 'HOUSEHOLD'")
    hired = F.date_add(F.lit("1988-01-15").cast("date"), (F.col("c_custkey") % 3000).cast("int"))
    segment = F.col("c_mktsegment")
    managerial = people.select(
        F.col("c_custkey").alias("PROCESSO_ID"),
        F.when(F.col("c_custkey") % 40 == 0, "MINISTERIO PUBLICO DO TRABALHO").otherwise(F.col("c_name")).alias("PARTE_CONTRARIA_NOME"),
        hired.alias("PARTE_CONTRARIA_DATA_ADMISSAO"),
        F.when(F.col("c_custkey") % 9 != 0, F.date_add(hired, (F.col("c_custkey") * 7 % 4000).cast("int"))).alias(
            "PARTE_CONTRARIA_DATA_DISPENSA"
        ),
        F.when(segment == "BUILDING", "VENDEDOR PARA").when(segment == "FURNITURE", "CAIXA").otherwise("PINTOR").alias(
            "PARTE_CONTRARIA_CARGO_CARGO_GRUPO"
        ),
        F.col("c_nationkey").cast("string").alias("PROCESSO_ESTADO"),
        F.when(F.col("c_custkey") % 6 == 0, "TERCEIRO SOLVENTE").alias("NATUREZA_OPERACIONAL"),
        F.lit(None).cast("string").alias("TERCEIRO_PRINCIPAL"),
        segment.alias("NOVO_TERCEIRO"),
        F.lit("ARQUIVADO").alias("MOTIVO_DE_ENCERRAMENTO"),
        F.col("c_custkey").cast("string").alias("MATRICULA"),
        F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("PARTE_CONTRARIA_CPF"),
    )
    fact = payment_fact(shapes.payments(spark, folder), shapes.guarantees(spark, folder))
    owners = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    totals = payment_totals(fact).join(owners, F.col("PROCESSO_ID") == F.col("o_orderkey"))
    totals = totals.groupBy(F.col("o_custkey").alias("PROCESSO_ID")).agg(
        F.max("DT_ULT_PGTO").alias("DT_ULT_PGTO"),
        *[F.round(F.sum(a), 2).alias(a) for a in [*AMOUNT_COLS, "TOTAL_PAGAMENTOS"]],
    )
    nation = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    people = people.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    units = people.select(F.col("c_custkey").alias("CENTRO_DE_CUSTO"), F.col("n_name").alias("BU"))
    areas = people.select(
        F.col("c_custkey").alias("CENTRO"), F.col("n_name").alias("DESCRICAO"), F.col("r_name").alias("NOME2"),
        F.col("n_name").alias("NOME3"), F.col("r_name").alias("NOME_RESPONSAVEL"), F.col("r_name").alias("AREA_FUNCIONAL"),
    )
    clusters = nation.select(F.col("n_nationkey").cast("string").alias("DE"), F.col("r_name").alias("PARA"))
    third = customer.select(F.col("c_mktsegment").alias("EMPRESA_TERCEIRIZADA")).distinct().filter(
        "EMPRESA_TERCEIRIZADA <> 'MACHINERY'"
    ).withColumn("TERCEIRO_AJUSTADO", F.lower("EMPRESA_TERCEIRIZADA"))
    splits = [("ASIA", ["NATION_2"], "LOGISTICA", "TECNOLOGIA")]
    book = book_plan.case_book(closings, managerial, totals, units, areas, clusters, third, splits=splits, **options)
    return book, managerial, totals


@query(f"""
WITH {_BOOK_SQL}
SELECT ID_PROCESSO, MES_FECH, NOVOS, ENCERRADOS, ESTOQUE, DATACADASTRO, MES_CADASTRO, PROVISAO_TOTAL_M,
  round(ACORDO, 2) AS ACORDO, round(PENSAO, 2) AS PENSAO, round(GARANTIA, 2) AS GARANTIA,
  round(ACORDO + CONDENACAO + PENHORA + PENSAO + OUTROS + IMPOSTO + GARANTIA, 2) AS TOTAL_PAGAMENTOS, DT_ULT_PGTO,
  n_name AS BU, CASE WHEN r_name = 'ASIA' THEN CASE WHEN n_name = 'NATION_2' THEN 'LOGISTICA' ELSE 'TECNOLOGIA' END ELSE r_name END AS DP_VP_DIRETORIA,
  CASE WHEN PARTE = 'MINISTERIO PUBLICO DO TRABALHO' THEN 'N/A' ELSE FASE END AS FASE,
  CASE WHEN PARTE = 'MINISTERIO PUBLICO DO TRABALHO' OR FASE = 'INATIVO' THEN 'DEMAIS' WHEN FASE = 'RECURSAL TST' THEN 'RECURSAL_TST'
       WHEN FASE = 'EXECUÇÃO DEFIN' THEN 'EXECUÇÃO' ELSE FASE END AS DP_FASE,
  CASE WHEN PROVISAO_TOTAL_PASSIVO_M > 0 THEN 'PASSÍVEL PROVISÃO' WHEN NATUREZA IS NOT NULL THEN NATUREZA
       WHEN SUB_AREA IS NOT NULL THEN 'ESTRATEGICO' WHEN IS_LOW THEN 'DEFESA' ELSE 'PASSÍVEL PROVISÃO' END AS DP_NATUREZA,
  CASE WHEN ESTOQUE = 1 AND month(MES_FECH) IN (3, 6, 9, 12) THEN 'SIM' END AS TRIM_ESTOQ, {_REASON} AS MOTIVO_ENC_AGRP,
  CASE WHEN ESTOQUE = 1 OR NOVOS = 1 THEN '' WHEN PARTE IS NOT NULL THEN 'ARQUIVADO' END AS MOTIVO_ENCERRAMENTO,
  CASE WHEN CARGO_GRUPO IN ('VENDEDOR', 'CAIXA') THEN CARGO_GRUPO ELSE 'OUTROS' END AS CARGO_TRATADO,
  CASE WHEN ESTOQUE = 1 THEN {_cluster('MONTHS')} WHEN ENCERRADOS = 1 THEN {_cluster('BOUNDARIES')} ELSE 'Sem info' END AS CLUSTER_AGING,
  CASE WHEN LEFT_ON IS NULL THEN 'Sem info' WHEN TENURE <= 60 THEN year(LEFT_ON)::VARCHAR ELSE (year(LEFT_ON) - 5)::VARCHAR END AS SAFRA_RECLAMACAO,
  r_name AS CLUSTER_VALOR, CASE WHEN c_mktsegment IS NULL OR c_mktsegment = 'MACHINERY' THEN 'Sem info' ELSE lower(c_mktsegment) END AS ET,
  CASE WHEN ENCERRADOS = 1 THEN CASE WHEN MES_DAYS <= 360 THEN 'até 1 ano' WHEN MES_DAYS <= 1080 THEN '1 - 3 anos' WHEN MES_DAYS <= 2160 THEN '3 - 6 anos'
       WHEN MES_DAYS <= 3240 THEN '6 - 9 anos' ELSE '+9 anos' END END AS FX_ANO_AGING_ENCERR
FROM aged""")
def case_book(spark, folder):
    book, _, _ = _customer_book(spark, folder)
    amounts = ["ACORDO", "PENSAO", "GARANTIA", "TOTAL_PAGAMENTOS"]
    return rounded(book, *amounts).select(
        "ID_PROCESSO", "MES_FECH", "NOVOS", "ENCERRADOS", "ESTOQUE", "DATACADASTRO", "MES_CADASTRO", "PROVISAO_TOTAL_M",
        *amounts, "DT_ULT_PGTO", "BU", "DP_VP_DIRETORIA", "FASE", "DP_FASE", "DP_NATUREZA", "TRIM_ESTOQ",
        "MOTIVO_ENC_AGRP", "MOTIVO_ENCERRAMENTO", "CARGO_TRATADO", "CLUSTER_AGING", "SAFRA_RECLAMACAO", "CLUSTER_VALOR",
        "ET", "FX_ANO_AGING_ENCERR",
    )


def _ages(value: str, *bands: tuple[int, str], last: str) -> str:
    parts = " ".join(f"WHEN {value} <= {most} THEN '{label}'" for most, label in bands)
    return f"CASE WHEN {value} IS NULL THEN NULL {parts} ELSE '{last}' END"


_BOOK_MORE = {
    "ID_PROCESSO": "ID_PROCESSO", "MES_FECH": "MES_FECH", "NOVOS": "NOVOS", "ENCERRADOS": "ENCERRADOS", "ESTOQUE": "ESTOQUE",
    "DATACADASTRO": "DATACADASTRO", "PROVISAO_TOTAL_M": "PROVISAO_TOTAL_M", "PROVISAO_TOTAL_PASSIVO_M": "PROVISAO_TOTAL_PASSIVO_M",
    "PROVISAO_MOV_M": "0::DOUBLE", "CORRECAO_M": "0::DOUBLE", "PERC_SOCIO_M": "0::DOUBLE",
    "CONDENACAO": "round(CONDENACAO, 2)", "PENHORA": "round(PENHORA, 2)", "OUTROS_PAGAMENTOS": "round(OUTROS, 2)", "IMPOSTO": "round(IMPOSTO, 2)",
    "STATUS": "CASE WHEN NOVOS_ = 1 THEN 'P' WHEN ENCERRADOS = 1 THEN 'F' ELSE 'O' END",
    "EMPRESA": "CASE WHEN NOVOS_ = 1 THEN 'FILIAL SA' ELSE 'EMPRESA' END",
    "BU": "CASE WHEN NOVOS_ = 1 THEN 'FILIAL' ELSE n_name END", "VP": "CASE WHEN NOVOS_ = 1 THEN 'FILIAL' ELSE r_name END",
    "DIRETORIA": "CASE WHEN NOVOS_ = 1 THEN 'FILIAL' ELSE n_name END", "RESPONSAVEL_AREA": "CASE WHEN NOVOS_ = 1 THEN 'FILIAL' ELSE upper(r_name) END",
    "AREA_FUNCIONAL": "CASE WHEN NOVOS_ = 1 THEN 'FIL' ELSE r_name END",
    "DP_VP_DIRETORIA": """CASE WHEN NOVOS_ = 1 THEN 'FILIAL' WHEN r_name = 'ASIA' THEN CASE WHEN n_name = 'NATION_2' THEN 'LOGISTICA' ELSE 'TECNOLOGIA' END
        ELSE r_name END""",
    "ESTRATEGIA": "'DEFESA'", "INDICACAO_PROCESSO_ESTRATEGICO": "CASE WHEN IS_LOW THEN 'DEFESA' ELSE 'ACORDO' END", "NOVO_X_LEGADO": "'LEGADO'",
    "DP_NATUREZA": """CASE WHEN PROVISAO_TOTAL_PASSIVO_M > 0 THEN 'PASSÍVEL PROVISÃO' WHEN IS_LOW THEN 'DEFESA' WHEN NATUREZA IS NOT NULL THEN NATUREZA
        WHEN SUB_AREA IS NOT NULL THEN 'ESTRATEGICO' ELSE 'PASSÍVEL PROVISÃO' END""",
    "ESTADO": "c_nationkey::VARCHAR", "PARTE_CONTRARIA_NOME": "PARTE", "PARTE_CONTRARIA_CARGO_GRUPO": "CARGO_GRUPO",
    "MATRICULA": "c_custkey::VARCHAR", "PARTE_CONTRARIA_CPF": "lpad(c_custkey::VARCHAR, 11, '0')", "NOVO_TERCEIRO": "c_mktsegment",
    "TERCEIRO_AJUSTADO": "c_mktsegment", "NATUREZA_OPERACIONAL": "NATUREZA", "AREA_DO_DIREITO": "'TRABALHISTA'", "SUB_AREA_DO_DIREITO": "SUB_AREA",
    "DISTRIBUICAO": "DISTRIBUICAO", "DATA_ADMISSAO": "HIRED", "DATA_DISPENSA": "LEFT_ON",
    "MES_DATA_ADMISSAO": "date_trunc('month', HIRED)::DATE", "MES_DATA_DISPENSA": "date_trunc('month', LEFT_ON)::DATE",
    "PERIODO1": "START_", "PERIODO2": "coalesce(LEFT_ON, DISTRIBUICAO)", "PERIODO_RECLAMADO": "(DISTRIBUICAO - 1800)::DATE",
    "PERIODO_RECL_GRUPO": "CASE WHEN START_ IS NOT NULL THEN strftime(START_, '%m-%Y') || ' a ' || strftime(coalesce(LEFT_ON, DISTRIBUICAO), '%m-%Y') END",
    "TEMPO_EMPRESA_MESES": "TENURE::BIGINT",
    "TEMPO_AJUIZAR_ACAO": """(CASE WHEN DISTRIBUICAO >= LEFT_ON THEN FILED - CASE WHEN day(DISTRIBUICAO) < day(LEFT_ON) THEN 1 ELSE 0 END
        ELSE FILED + CASE WHEN day(LEFT_ON) < day(DISTRIBUICAO) THEN 1 ELSE 0 END END)::BIGINT""",
    "MESES_AGING_ENCERR": "CASE WHEN ENCERRADOS = 1 THEN BOUNDARIES END::BIGINT", "ANO_AGING_ENCERR": "CASE WHEN ENCERRADOS = 1 THEN MES_DAYS END",
    "MESES_AGING_ESTOQ": "CASE WHEN ESTOQUE = 1 THEN BOUNDARIES END::BIGINT", "ANO_AGING_ESTOQ": "CASE WHEN ESTOQUE = 1 THEN MES_DAYS END",
    "AGING_ESTOQ_MESES": "CASE WHEN ESTOQUE = 1 THEN MONTHS END::BIGINT",
    "FX_MES_AGING_ESTOQ": _ages(
        "STOCK_MONTHS", (6, "até 6 meses"), (12, "7 - 12 meses"), (18, "13 - 18 meses"), (24, "19 - 24 meses"), last="+24 meses"
    ),
    "FX_ANO_AGING_ESTOQ": _ages(
        "STOCK_DAYS", (360, "até 1 ano"), (720, "1 - 2 anos"), (1080, "2 - 3 anos"), (1440, "3 - 4 anos"), (1800, "4 - 5 anos"),
        (2160, "5 - 6 anos"), (2520, "6 - 7 anos"), last="+7 anos",
    ),
    "FX_ANO_AGING_ESTOQ_2": _ages(
        "STOCK_DAYS", (360, "até 1 ano"), (1080, "1 - 3 anos"), (2160, "3 - 6 anos"), (3240, "6 - 9 anos"), last="+9 anos"
    ),
    "FX_TEMPO_EMPRESA": _ages(
        "(LEFT_ON - HIRED)", (360, "até 1 ano"), (720, "1 - 2 anos"), (1080, "2 - 3 anos"), (1440, "3 - 4 anos"), (1800, "4 - 5 anos"),
        (2160, "5 - 6 anos"), (3600, "6 - 10 anos"), last="Acima de 10 anos",
    ),
}


@query(f"""
WITH {_BOOK_SQL}, more AS (
  SELECT *, CASE WHEN DISTRIBUICAO - 1800 >= HIRED THEN (DISTRIBUICAO - 1800)::DATE ELSE HIRED END AS START_,
    (year(DISTRIBUICAO) * 12 + month(DISTRIBUICAO)) - (year(LEFT_ON) * 12 + month(LEFT_ON)) AS FILED,
    CASE WHEN ESTOQUE = 1 THEN MONTHS END AS STOCK_MONTHS, CASE WHEN ESTOQUE = 1 THEN DAYS END AS STOCK_DAYS FROM aged)
SELECT {", ".join(f'{sql} AS "{name}"' for name, sql in _BOOK_MORE.items())} FROM more""")
def case_book_more(spark, folder):
    """The other columns of the book, with a company of its own, a default strategy and the defence first."""
    override = ("FILIAL SA", "FILIAL", "FIL")
    book, _, _ = _customer_book(spark, folder, override=override, strategy_default="ACORDO", defence_first=True)
    return rounded(book, "CONDENACAO", "PENHORA", "OUTROS_PAGAMENTOS", "IMPOSTO").select(*_BOOK_MORE)


@query(f"""
WITH {_BOOK_SQL}
SELECT ID_PROCESSO, MES_FECH, DATACADASTRO, round(a, 2) AS ACORDO, round(g, 2) AS GARANTIA, D AS DT_ULT_PGTO,
  round(c, 2) AS CONDENACAO, round(ph, 2) AS PENHORA, round(ps, 2) AS PENSAO, round(o, 2) AS OUTROS_PAGAMENTOS, round(i, 2) AS IMPOSTO,
  round(a + c + ph + ps + o + i + g, 2) AS TOTAL_PAGAMENTOS,
  CASE WHEN a > 1 THEN 'ACORDO' WHEN c + ph + o + i + g > 1 THEN 'CONDENACAO' WHEN a + c + ph + o + i + g <= 1 THEN 'SEM ONUS' END AS MOTIVO_ENC_AGRP
FROM book WHERE ENCERRADOS = 1 AND MES_FECH >= DATE '2000-01-01'""")
def tax_extract(spark, folder):
    book, _, totals = _customer_book(spark, folder)
    amounts = [*AMOUNT_COLS, "TOTAL_PAGAMENTOS"]
    extract = rounded(book_plan.tax_extract(book, totals, "2000-01-01"), *amounts)
    return extract.select("ID_PROCESSO", "MES_FECH", "DATACADASTRO", *amounts, "DT_ULT_PGTO", "MOTIVO_ENC_AGRP")


@query("""
WITH c AS (
  SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS MES_FECH, o_orderdate::DATE AS CADASTRO, o_totalprice,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'COORD ADM LOJA' WHEN '2-HIGH' THEN 'VENDEDOR' ELSE 'CAIXA' END AS CARGO,
    CASE WHEN o_orderkey % 5 = 0 THEN 'TERCEIRO INSOLVENTE' WHEN o_orderkey % 5 = 1 THEN 'PRÓPRIO' END AS NATUREZA,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN (o_orderdate::DATE - 20)::DATE END AS FILED,
    CASE o_orderkey % 3 WHEN 0 THEN DATE '1900-01-01' WHEN 1 THEN (o_orderdate::DATE + 5)::DATE END AS PAGO
  FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '1998-07-01' AND o_orderdate < DATE '2000-07-01')
SELECT o_orderkey AS ID_PROCESSO, CADASTRO, o_totalprice AS TOTAL_PAGAMENTOS, MES_FECH, (MES_FECH + 19)::DATE AS DIA_CORTE,
  coalesce(FILED, CADASTRO) AS DISTRIBUICAO, date_trunc('month', coalesce(FILED, CADASTRO))::DATE AS DISTRIBUICAO_AJUSTADA,
  CASE CARGO WHEN 'COORD ADM LOJA' THEN 'CONS ADM LOJA' WHEN 'CAIXA' THEN 'ASSESSOR DE ATENDIMENTO' ELSE CARGO END AS PARTE_CONTRARIA_CARGO_GRUPO,
  CASE WHEN NATUREZA = 'TERCEIRO INSOLVENTE' THEN NATUREZA WHEN NATUREZA = 'PRÓPRIO' AND CARGO = 'VENDEDOR' THEN CARGO ELSE 'OUTROS' END AS CARGO_AJUSTADO,
  'Sem info' AS CLUSTER_AGING, date_trunc('month', CASE WHEN PAGO > DATE '1900-01-01' THEN PAGO ELSE MES_FECH END)::DATE AS DT_ULT_PGTO
FROM c""")
def modelling_base(spark, folder):
    orders = table(spark, folder, "orders")
    key, day, priority = F.col("o_orderkey"), F.to_date("o_orderdate"), F.col("o_orderpriority")
    missing = F.lit(None).cast("string")
    book = orders.select(
        key.alias("ID_PROCESSO"),
        day.alias("DATACADASTRO"),
        F.trunc(day, "MM").alias("MES_FECH"),
        (F.col("o_orderstatus") == "F").cast("int").alias("ENCERRADOS"),
        F.col("o_totalprice").alias("TOTAL_PAGAMENTOS"),
        F.when(priority == "1-URGENT", "COORD ADM LOJA").when(priority == "2-HIGH", "VENDEDOR").otherwise("CAIXA").alias(
            "PARTE_CONTRARIA_CARGO_GRUPO"
        ),
        F.when(key % 5 == 0, "TERCEIRO INSOLVENTE").when(key % 5 == 1, "PRÓPRIO").alias("NATUREZA_OPERACIONAL"),
        F.when(key % 3 == 0, F.lit("1900-01-01").cast("date")).when(key % 3 == 1, F.date_add(day, 5)).alias("DT_ULT_PGTO"),
        *[missing.alias(n) for n in ("PROCESSO_ESTEIRA", "BANDEIRA", "PARTE_CONTRARIA_NOME", "FASE", "FX_TEMPO_EMPRESA",
                                     "CLUSTER_AGING", "SAFRA_RECLAMACAO")],
        missing.cast("date").alias("DISTRIBUICAO"),
    )
    filed = orders.filter("o_orderpriority <> '4-NOT SPECIFIED'")
    managerial = filed.select(key.alias("PROCESSO_ID"), F.date_sub(day, 20).alias("DISTRIBUICAO"))
    cuts = book.select("MES_FECH").distinct().withColumn("DIA_CORTE", F.date_add("MES_FECH", 19))
    base = modelling.modelling_base(book, managerial, cuts, "2000-06-01")
    return base.select(
        "ID_PROCESSO", "CADASTRO", "TOTAL_PAGAMENTOS", "MES_FECH", "DIA_CORTE", "DISTRIBUICAO", "DISTRIBUICAO_AJUSTADA",
        "PARTE_CONTRARIA_CARGO_GRUPO", "CARGO_AJUSTADO", "CLUSTER_AGING", "DT_ULT_PGTO",
    )


# ---- entries ------------------------------------------------------------------


@query(f"""
WITH {shapes.DAY_MONTHS}, rows AS (
  SELECT o_orderkey AS ID_PROCESSO, date_trunc('month', o_orderdate)::DATE AS MES_FECH, 'ATUAL' AS SOURCE,
         CASE WHEN o_orderdate >= DATE '1998-01-01' THEN 'NOVO' ELSE 'LEGADO' END AS NOVO_X_LEGADO, NULL AS FILIAL
  FROM orders WHERE o_orderstatus = 'P' AND o_orderdate >= DATE '2000-01-01'
  UNION ALL
  SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE, '1999', CASE WHEN o_orderdate >= DATE '1998-01-01' THEN 'NOVO' ELSE 'LEGADO' END, NULL
  FROM orders WHERE o_orderstatus = 'P' AND o_orderdate < DATE '2000-01-01' AND date_trunc('month', o_orderdate) <= DATE '1999-07-01'
  UNION ALL
  SELECT o_orderkey, MES_CONTABIL, 'ATIVOS', CASE WHEN o_orderdate >= DATE '1998-01-01' THEN 'NOVO' ELSE 'LEGADO' END,
         CASE WHEN o_orderkey % 2 = 0 THEN substr(o_orderpriority, 3, 4) ELSE o_orderstatus END
  FROM orders JOIN day_months ON o_orderdate::DATE = D WHERE o_orderstatus = 'O' AND MES_CONTABIL >= DATE '1997-12-01')
SELECT * FROM rows""")
def entries_base(spark, folder):
    orders = table(spark, folder, "orders")
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    book = shapes.cases(spark, folder).select("ID_PROCESSO", "DATACADASTRO", "MES_FECH", "NOVOS")
    is_recent = F.col("DATACADASTRO") >= F.to_date(cut)
    active = orders.filter("o_orderstatus = 'O'").select(
        F.col("o_orderkey").alias("PROCESSO_ID"),
        F.to_date("o_orderdate").alias("DATA_REGISTRADO"),
        F.when(F.col("o_orderkey") % 2 != 0, F.col("o_orderstatus")).alias("FILIAL"),
        F.col("o_orderpriority").alias("CENTRO_DE_CUSTO_AREA_DEMANDANTE_NOME"),
    )
    all_eras = entries.entries_base(
        entries.managerial_entries(active, dims.calendar(spark), "ATIVOS", "1997-12-01", "1998-01-01"),
        entries.book_entries(book.filter(~is_recent), "1999", "1999-07-01", "1998-01-01"),
        entries.book_entries(book.filter(is_recent), "ATUAL", cut="1998-01-01"),
    )
    return all_eras.select("ID_PROCESSO", "MES_FECH", "SOURCE", "NOVO_X_LEGADO", "FILIAL")


# ---- staff --------------------------------------------------------------------

_FILES = [("19980105", "1995-01-01", "1997-12-31"), ("19990104", "1998-01-01", "1998-12-31"), ("20000103", "1999-01-01", "2001-12-31")]


def _organisation(spark, folder):
    nation = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    units = nation.select(F.col("n_nationkey").alias("CENTRO_DE_CUSTO"), F.col("n_name").alias("BU"))
    areas = nation.select(
        F.col("n_nationkey").alias("CENTRO"), F.col("n_name").alias("DESCRICAO"), F.col("r_name").alias("NOME2"),
        F.col("n_name").alias("NOME3"), F.col("r_name").alias("NOME_RESPONSAVEL"), F.col("r_name").alias("AREA_FUNCIONAL"),
    )
    return units, areas


@query("""
WITH f AS (
  SELECT o_orderkey, o_custkey, o_orderdate::DATE AS DESLIGAMENTO, (o_orderdate::DATE - (o_orderkey % 3000)::INTEGER)::DATE AS ADMISSAO,
         o_orderkey % 25 AS CENTRO, o_orderpriority AS FUNCAO, CASE o_orderstatus WHEN 'F' THEN '19980105' WHEN 'O' THEN '19990104' ELSE '20000103' END AS f
  FROM orders),
w(f, a, b) AS (VALUES ('19980105', DATE '1995-01-01', DATE '1997-12-31'), ('19990104', DATE '1998-01-01', DATE '1998-12-31'), ('20000103', DATE '1999-01-01', DATE '2001-12-31')),
v AS (SELECT f.* FROM f JOIN w ON f.f = w.f WHERE DESLIGAMENTO BETWEEN a AND b),
cs AS (SELECT * FROM (SELECT o_custkey AS CPF, o_orderkey AS ID_PROCESSO, o_orderdate::DATE AS DISP, date_trunc('month', o_orderdate)::DATE AS MES_FECH,
         row_number() OVER (PARTITION BY o_custkey ORDER BY date_trunc('month', o_orderdate) DESC, o_orderkey) AS rn
       FROM orders WHERE o_orderstatus = 'P') WHERE rn = 1)
SELECT v.o_orderkey AS MATRICULA, v.o_custkey AS CPF, DESLIGAMENTO, date_trunc('month', DESLIGAMENTO)::DATE AS MES_DESLIGAMENTO, n_name AS BU, r_name AS VP,
  CASE WHEN r_name = 'ASIA' THEN CASE WHEN n_name = 'NATION_2' THEN 'LOGISTICA' ELSE 'TECNOLOGIA' END ELSE r_name END AS DP_VP_DIRETORIA,
  (DESLIGAMENTO - ADMISSAO)::INTEGER AS TEMPO_EMPRESA,
  CASE WHEN DESLIGAMENTO - ADMISSAO <= 360 THEN 'até 1 ano' WHEN DESLIGAMENTO - ADMISSAO <= 1080 THEN '1 - 3 anos'
       WHEN DESLIGAMENTO - ADMISSAO <= 2160 THEN '3 - 5 anos' ELSE '+5 anos' END AS FX_TMP_EMPRESA,
  CASE WHEN DESLIGAMENTO - ADMISSAO <= 90 THEN 'Contrato Experiência' ELSE 'Contrato Normal' END AS TIPO_CONTRATO,
  cs.ID_PROCESSO, cs.MES_FECH, CASE WHEN cs.CPF IS NULL THEN 0 ELSE 1 END AS NOVOS,
  CASE WHEN cs.ID_PROCESSO IS NOT NULL THEN (cs.DISP = DESLIGAMENTO)::INTEGER END AS FLAG_DT_DISPENSA, 1 AS QTDE
FROM v LEFT JOIN cs ON v.o_custkey = cs.CPF JOIN nation ON CENTRO = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def terminations_monthly(spark, folder):
    orders = table(spark, folder, "orders")
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    files = []
    for i, (status, (name, _, _)) in enumerate(zip("FOP", _FILES)):
        columns = [
            key.alias("MATRICULA"),
            F.col("o_custkey").alias("CPF"),
            day.cast("string").alias("Desligamento") if i else day.alias("DESLIGAMENTO"),
            F.date_sub(day, (key % 3000).cast("int")).alias("ADMISSAO"),
            (key % 25).alias("CodCCustoContabil"),
            F.lit("EMPRESA").alias("DescricaoN1"),
            F.col("o_orderpriority").alias("FUNCAO"),
            F.lit(f"HC por Status {name}.xlsx").alias("SOURCE"),
        ]
        files.append(orders.filter(F.col("o_orderstatus") == status).select(*columns))
    windows = dim_from_rows(spark, _FILES, "ARQUIVO string, DT_INICIO date, DT_FIM date")
    reported = staff.reported_terminations(files, windows)
    book = shapes.cases(spark, folder).select(
        "ID_PROCESSO", "NOVOS", "MES_FECH", F.col("DATACADASTRO").alias("DATA_DISPENSA"), F.lit("RECURSAL").alias("FASE"),
        F.concat(F.lit("."), F.col("CUSTOMER").cast("string")).alias("PARTE_CONTRARIA_CPF"),
        F.lit(None).cast("string").alias("MATRICULA"), F.lit(None).cast("string").alias("DP_FASE"),
    )
    managerial = orders.select(key.alias("PROCESSO_ID"), key.cast("string").alias("MATRICULA"))
    cases = staff.new_cases_by_person(book, managerial)
    units, areas = _organisation(spark, folder)
    splits = [("ASIA", ["NATION_2"], "LOGISTICA", "TECNOLOGIA")]
    result = staff.terminations_monthly(reported, cases, units, areas, splits=splits)
    return result.select(
        "MATRICULA", "CPF", "DESLIGAMENTO", "MES_DESLIGAMENTO", "BU", "VP", "DP_VP_DIRETORIA", "TEMPO_EMPRESA",
        "FX_TMP_EMPRESA", "TIPO_CONTRATO", "ID_PROCESSO", "MES_FECH", "NOVOS", "FLAG_DT_DISPENSA", "QTDE",
    )


@query("""
WITH t AS (
  SELECT * FROM (SELECT c_custkey // 2 AS MATRICULA, c_custkey AS CPF, (DATE '1996-01-01' + (c_custkey % 2000)::INTEGER)::DATE AS DESL,
      row_number() OVER (PARTITION BY c_custkey // 2 ORDER BY c_custkey % 2000 DESC, c_custkey) AS rn
    FROM customer) WHERE rn = 1),
m AS (
  SELECT MATRICULA, CPF, DESL, o_orderkey, date_trunc('month', o_orderdate)::DATE AS MES_FECH FROM t
  LEFT JOIN orders ON o_custkey = CPF AND CPF % 10 <> 0)
SELECT lpad(MATRICULA::VARCHAR, 8, '0') AS MATRICULA, DESL AS DATA_DESLIGAMENTO, o_orderkey AS ID_PROCESSO, MES_FECH,
  CASE WHEN o_orderkey IS NULL THEN 0 ELSE 1 END AS NOVOS,
  (row_number() OVER (PARTITION BY MATRICULA ORDER BY MES_FECH NULLS FIRST, o_orderkey, DESL) = 1)::INTEGER AS QTDE
FROM m""")
def termination_study(spark, folder):
    """The last termination of each employee with the lawsuits of the person."""
    return _study(spark, folder, last_only=True)


@query("""
WITH t AS (
  SELECT c_custkey // 2 AS MATRICULA, c_custkey AS CPF, (DATE '1996-01-01' + (c_custkey % 2000)::INTEGER)::DATE AS DESL,
    (DATE '1996-01-01' - (c_custkey % 3000)::INTEGER)::DATE AS ADM FROM customer),
m AS (
  SELECT MATRICULA, CPF, DESL, ADM, o_orderkey, date_trunc('month', o_orderdate)::DATE AS MES_FECH FROM t
  LEFT JOIN orders ON o_custkey = CPF AND CPF % 10 <> 0)
SELECT lpad(MATRICULA::VARCHAR, 8, '0') AS MATRICULA, DESL AS DATA_DESLIGAMENTO, o_orderkey AS ID_PROCESSO, MES_FECH,
  CASE WHEN o_orderkey IS NULL THEN 0 ELSE 1 END AS NOVOS,
  (row_number() OVER (PARTITION BY MATRICULA ORDER BY MES_FECH NULLS FIRST, o_orderkey NULLS FIRST, DESL) = 1)::INTEGER AS QTDE
FROM m""")
def termination_study_all(spark, folder):
    """Every termination with every lawsuit of the person, as the study asks; an employee counts once."""
    return _study(spark, folder, last_only=False)


def _study_inputs(spark, folder, registration):
    # Two customers stand for two terminations of one employee.
    customer = table(spark, folder, "customer")
    left = F.date_add(F.lit("1996-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int"))
    rows = customer.select(
        F.floor(F.col("c_custkey") / 2).cast("string").alias("MATRICULA"), "c_mktsegment",
        # Every tenth person has no tax id but a placeholder, here and in the lawsuits.
        F.when(F.col("c_custkey") % 10 == 0, "000.000.000-00").otherwise(F.col("c_custkey").cast("string")).alias("CPF"),
        F.when(F.col("c_custkey") % 2 == 0, "Desligado-R").otherwise("DESLIGADO").alias("STATUS_COLABORADOR"),
        # The hiring date separates terminations of one day by the person.
        F.date_sub(F.lit("1996-01-01").cast("date"), (F.col("c_custkey") % 3000).cast("int")).alias("DATA_ADMISSAO"),
        left.alias("DATA_DESLIGAMENTO"),
    )
    history = rows.filter("c_mktsegment <> 'BUILDING'").drop("c_mktsegment")
    previews = rows.filter("c_mktsegment <> 'MACHINERY'").withColumnRenamed("c_mktsegment", "SETOR")
    everyone = staff.all_terminations(history, previews)
    book = shapes.cases(spark, folder).select(
        "ID_PROCESSO", "MES_FECH", F.lit(1).alias("NOVOS"), F.when(F.col("CUSTOMER") % 10 == 0, "00000000000").otherwise(F.lpad(F.col("CUSTOMER").cast("string"), 11, "0")).alias("cpf"),
    ).select("ID_PROCESSO", "MES_FECH", "NOVOS", F.when(F.col("ID_PROCESSO") % 2 == 0, F.col("cpf")).alias("PARTE_CONTRARIA_CPF"))
    managerial = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("PROCESSO_ID"),
        F.when(F.col("o_custkey") % 10 == 0, "0").otherwise(F.col("o_custkey").cast("string")).alias("PARTE_CONTRARIA_CPF"),
        registration.cast("string").alias("MATRICULA"),
    )
    return everyone, book, managerial


def _study(spark, folder, last_only):
    inputs = _study_inputs(spark, folder, F.lit(None))
    return staff.termination_study(*inputs, last_only=last_only).select(*_STUDY_COLUMNS)


@query("""
WITH t AS (
  SELECT c_custkey // 2 AS MATRICULA, (DATE '1996-01-01' + (c_custkey % 2000)::INTEGER)::DATE AS DESL FROM customer),
suits AS (
  SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS MES_FECH, o_custkey % 10 <> 0 AS named, o_custkey // 2 AS own,
    CASE WHEN o_orderkey % 97 = 0 THEN o_custkey // 2 + 1 END AS other FROM orders),
-- a lawsuit that has the tax id of one and the registration of the next makes them one person, so persons are runs of registrations
numbers AS (SELECT MATRICULA AS g FROM t UNION SELECT other FROM suits WHERE other IS NOT NULL),
tied AS (SELECT DISTINCT own AS g FROM suits WHERE named AND other IS NOT NULL),
persons AS (
  SELECT g, coalesce(sum(CASE WHEN g IN (FROM tied) THEN 0 ELSE 1 END) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS person FROM numbers),
cases AS (
  SELECT o_orderkey, MES_FECH, person FROM suits JOIN persons ON g = CASE WHEN named THEN own ELSE other END),
m AS (
  SELECT MATRICULA, DESL, p.person, o_orderkey, MES_FECH FROM t JOIN persons p ON g = MATRICULA LEFT JOIN cases c ON c.person = p.person)
SELECT lpad(MATRICULA::VARCHAR, 8, '0') AS MATRICULA, DESL AS DATA_DESLIGAMENTO, o_orderkey AS ID_PROCESSO, MES_FECH,
  CASE WHEN o_orderkey IS NULL THEN 0 ELSE 1 END AS NOVOS,
  (row_number() OVER (PARTITION BY person ORDER BY MES_FECH NULLS FIRST, o_orderkey NULLS FIRST, DESL) = 1)::INTEGER AS QTDE
FROM m""")
def termination_study_persons(spark, folder):
    """The study by person: lawsuits that name a tax id and another registration tie employees together."""
    registration = F.when(F.col("o_orderkey") % 97 == 0, F.floor(F.col("o_custkey") / 2) + 1)
    return staff.termination_study_by_person(*_study_inputs(spark, folder, registration)).select(*_STUDY_COLUMNS)


_STUDY_COLUMNS = ["MATRICULA", "DATA_DESLIGAMENTO", "ID_PROCESSO", "MES_FECH", "NOVOS", "QTDE"]


@query("""
SELECT c_nationkey AS CODCCUSTOCONTABIL, (DATE '2024-01-01' + to_months((c_custkey % 3)::INTEGER))::DATE AS MES_REF, n_name AS BU,
  r_name AS VP, upper(c_mktsegment) AS STATUS, count(c_custkey) AS QTD
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_mktsegment IN ('BUILDING', 'FURNITURE') GROUP BY ALL""")
def active_headcount(spark, folder):
    month = F.add_months(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 3).cast("int"))
    files = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("MATRICULA"), F.col("c_nationkey").alias("CODCCUSTOCONTABIL"), month.alias("MES_REF"),
        F.lit(1).alias("CODEMPRESA"), *[F.lit(f"N{i}").alias(f"DESCRICAON{i}") for i in range(1, 6)],
        F.lower("c_mktsegment").alias("STATUS"),
    )
    units, areas = _organisation(spark, folder)
    active = staff.active_headcount(files, units, areas, statuses=("BUILDING", "FURNITURE"))
    return active.select("CODCCUSTOCONTABIL", "MES_REF", "BU", "VP", "STATUS", "QTD")


# ---- phases -------------------------------------------------------------------

_ROLL_SQL = """s AS (
  SELECT o_custkey AS ID, date_trunc('month', o_orderdate)::DATE AS MES, o_orderstatus,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'RECURSAL_TST' WHEN '2-HIGH' THEN 'EXECUÇÃO' WHEN '3-MEDIUM' THEN 'DEMAIS' ELSE 'CONHECIMENTO' END AS FASE
  FROM orders),
closed AS (SELECT ID, min(MES) AS m FROM s WHERE o_orderstatus = 'F' AND MES >= DATE '1998-01-01' GROUP BY 1),
h AS (
  SELECT s.ID, s.MES, CASE WHEN s.MES = m THEN 'ENCERRADO' ELSE FASE END AS FASE FROM s LEFT JOIN closed ON s.ID = closed.ID
  WHERE s.ID IN (SELECT ID FROM s WHERE o_orderstatus <> 'F' AND MES >= DATE '1998-01-01')),
l AS (SELECT *, lag(FASE) OVER (PARTITION BY ID ORDER BY MES, FASE) AS ant FROM h),
r AS (
  SELECT *, CASE WHEN ant IS NULL THEN 0 WHEN ant = FASE THEN 1 WHEN FASE <> 'ENCERRADO' THEN 2 ELSE 3 END AS code,
         CASE WHEN ant <> FASE THEN ant || ' - ' || FASE END AS label FROM l)"""


def _rolled(spark, folder):
    orders = table(spark, folder, "orders")
    month, priority = F.trunc(F.to_date("o_orderdate"), "MM"), F.col("o_orderpriority")
    snapshots = orders.select(
        F.col("o_custkey").alias("ID_PROCESSO"), month.alias("MES_FECH"),
        F.when(priority == "1-URGENT", "RECURSAL TST").when(priority == "2-HIGH", " EXECUCAO ").when(
            priority == "3-MEDIUM", F.lit(None)).otherwise("CONHECIMENTO").alias("FASE"),
    )
    book = orders.select(
        F.col("o_custkey").alias("ID_PROCESSO"), month.alias("MES_FECH"),
        (F.col("o_orderstatus") == "F").cast("int").alias("ENCERRADOS"),
    )
    return phases.roll_forward(phases.phase_history(snapshots, book, "1998-01-01"))


@query(f"""
WITH {_ROLL_SQL}, p AS (SELECT o_custkey AS ID, date_trunc('month', o_orderdate)::DATE AS MES, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)
SELECT d.MES AS MES_FECH, code AS MUDOU_FASE, label AS DP_FASE_MES, round(sum(v), 2) AS PROVISAO_MOV_M, count(*) AS QTDE
FROM (SELECT DISTINCT ID, MES, code, label FROM r) d LEFT JOIN p ON d.ID = p.ID AND d.MES = p.MES GROUP BY ALL""")
def phase_roll(spark, folder):
    provisions = table(spark, folder, "orders").groupBy(
        F.col("o_custkey").alias("ID_PROCESSO"), F.trunc(F.to_date("o_orderdate"), "MM").alias("MES_FECH")
    ).agg(F.sum("o_totalprice").alias("PROVISAO_MOV_M"))
    return rounded(phases.transition_matrix(_rolled(spark, folder), provisions), "PROVISAO_MOV_M")


_MONTHS = [f"1998{m:02d}" for m in range(1, 13)]


@query(f"WITH {_ROLL_SQL} SELECT ID AS ID_PROCESSO, " + ", ".join(
    f"min(CASE WHEN strftime(MES, '%Y%m') = '{m}' THEN code END) AS MUDOU_FASE_{m},"
    f" min(CASE WHEN strftime(MES, '%Y%m') = '{m}' THEN label END) AS DP_FASE_{m}" for m in _MONTHS
) + """, min(CASE WHEN MES IS NULL OR year(MES) <> 1998 THEN code END) AS "MUDOU_FASE_OUTROS",
  min(CASE WHEN MES IS NULL OR year(MES) <> 1998 THEN label END) AS "DP_FASE_OUTROS" FROM r GROUP BY 1""")
def phase_roll_wide(spark, folder):
    return phases.transition_pivot(_rolled(spark, folder), _MONTHS)


# ---- installment control -------------------------------------------------------------

_CONTROL_SQL = shapes.CLASSIFIED + """, c AS (
  SELECT PROCESSO_ID, SUB_TIPO, LINHA, DIA, CONDENACAO FROM classified
  WHERE PLANO NOT IN ('PAGAMENTO SEM PARCELAMENTO', '') AND CONDENACAO IS NOT NULL AND DIA >= DATE '1997-01-01'),
cn AS (
  SELECT *, dense_rank() OVER (PARTITION BY PROCESSO_ID ORDER BY DIA) AS PARCELA, min(DIA) OVER (PARTITION BY PROCESSO_ID) AS PRIMEIRO,
    first_value(CONDENACAO) OVER (PARTITION BY PROCESSO_ID ORDER BY DIA, CONDENACAO) / 0.3 AS ACORDADO,
    sum(CONDENACAO) OVER (PARTITION BY PROCESSO_ID) AS PAGO FROM c),
a AS (
  SELECT DISTINCT PROCESSO_ID, SUB_TIPO, DIA, ACORDO, CASE WHEN LINHA % 3 = 0 THEN 'ÚLTIMA PARCELA DE ACORDO' ELSE 'PARCELA DE ACORDO' END AS P
  FROM classified WHERE ACORDO IS NOT NULL AND LINHA < 6),
plan AS (
  SELECT PROCESSO_ID, MES_FECH, FASE_M, PROVISAO FROM (
    SELECT o_orderkey AS PROCESSO_ID, DATE '1997-01-01' AS MES_FECH, 'INICIAL' AS FASE_M, o_totalprice AS PROVISAO FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE, 'FINAL', o_totalprice FROM orders WHERE o_orderstatus = 'O')),
an AS (
  SELECT a.*, row_number() OVER (PARTITION BY a.PROCESSO_ID ORDER BY DIA, ACORDO, SUB_TIPO, P) AS PARCELA, min(DIA) OVER (PARTITION BY a.PROCESSO_ID) AS PRIMEIRO
  FROM a JOIN plan ON a.PROCESSO_ID = plan.PROCESSO_ID),
rows AS (
  SELECT PROCESSO_ID, SUB_TIPO, 'CONDENAÇÃO' AS TIPO, PARCELA, 7 AS QTD, CASE WHEN PAGO >= ACORDADO THEN 'SIM' ELSE 'NÃO' END AS QUITADO, DIA, PRIMEIRO,
         CONDENACAO AS PAGA, ACORDADO, CASE WHEN PARCELA = 1 THEN CONDENACAO ELSE (CONDENACAO / 0.3 - CONDENACAO) / 6 END AS PARTE FROM cn
  UNION ALL
  SELECT an.PROCESSO_ID, SUB_TIPO, 'ACORDO', PARCELA, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 4 END, NULL, DIA, PRIMEIRO, ACORDO,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice END, ACORDO FROM an JOIN orders ON PROCESSO_ID = o_orderkey)"""


@query(f"""
WITH {_CONTROL_SQL}
SELECT r.PROCESSO_ID, SUB_TIPO, TIPO AS DP_SUB_TIPO, PARCELA::BIGINT AS PARCELA, QTD AS QTD_PARCELAS_ACORDO, QUITADO, DIA AS DATA_PAGTO,
  PRIMEIRO AS DATA_DO_ACORDO, (DIA + ((PARCELA - 1) * 30)::INTEGER)::DATE AS DT_VENCIMENTO_PARCELA, PAGA AS VALOR_PARCELA_PAGA, ACORDADO AS VALOR_DO_ACORDO,
  PARTE AS VALOR_PARCELA, FASE_M AS FASE,
  CASE WHEN TIPO = 'CONDENAÇÃO' AND PARCELA = 1 THEN PROVISAO * 0.3 WHEN TIPO = 'CONDENAÇÃO' THEN (PROVISAO * (1 - 0.3::DOUBLE)) / 6
       ELSE PROVISAO / QTD END AS PROVISAO_M_1_PARCELA
FROM rows r LEFT JOIN plan ON r.PROCESSO_ID = plan.PROCESSO_ID AND date_trunc('month', PRIMEIRO) = MES_FECH""")
def installment_control(spark, folder):
    line = F.col("LINHA")
    part = F.when(line % 3 == 0, "ÚLTIMA PARCELA DE ACORDO").otherwise("PARCELA DE ACORDO")
    paid = classified_payments(shapes.payments(spark, folder)).withColumn("PARCELAMENTO_ACORDO", F.when(line < 6, part))
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    closed = F.col("o_orderstatus") == "F"
    closings = orders.filter("o_orderstatus <> 'P'").select(
        key.alias("ID_PROCESSO"),
        F.lit("PARCELA DE ACORDO").alias("PARCELAMENTO_ACORDO"),
        F.lit(None).cast("string").alias("PARCELAMENTO_CONDENACAO"),
        F.when(closed, F.lit("1997-01-01").cast("date")).otherwise(F.trunc(F.to_date("o_orderdate"), "MM")).alias("MES_FECH"),
        F.when(closed, "INICIAL").otherwise("FINAL").alias("FASE_M"),
        F.col("o_totalprice").alias("PROVISAO_M_1"),
        F.col("o_totalprice").alias("PROVISAO_TOTAL_M_1"),
    )
    agreed = orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        key.alias("ID"), F.lit(4).alias("QUANTIDADE_DE_PARCELAS"), F.col("o_totalprice").alias("VALOR_DO_ACORDO_FECHADO"),
        *[F.lit(None).cast("double").alias(f"ALCADA_{i}") for i in (1, 2, 3)],
    )
    control = parcels.installment_control(paid, closings, agreed, since="1997-01-01")
    return control.select(
        "PROCESSO_ID", "SUB_TIPO", "DP_SUB_TIPO", "PARCELA", "QTD_PARCELAS_ACORDO", "QUITADO", "DATA_PAGTO", "DATA_DO_ACORDO",
        "DT_VENCIMENTO_PARCELA", "VALOR_PARCELA_PAGA", "VALOR_DO_ACORDO", "VALOR_PARCELA", "FASE", "PROVISAO_M_1_PARCELA",
    )


# ---- agency book --------------------------------------------------------------


@query(f"""
WITH {shapes.DAY_MONTHS}, {shapes.GUARANTEES},
p AS (
  SELECT l_orderkey AS P, CASE l_returnflag WHEN 'A' THEN l_extendedprice END AS a, CASE WHEN l_returnflag = 'N' THEN l_extendedprice END AS c, MES_CONTABIL
  FROM lineitem LEFT JOIN day_months ON l_shipdate::DATE = D WHERE l_quantity <= 46 AND l_quantity > 0),
ps AS (SELECT P, coalesce(sum(a), 0) AS a, coalesce(sum(c), 0) AS c, max(MES_CONTABIL) AS m FROM p GROUP BY 1),
gs AS (SELECT PROCESSO_ID AS P, sum(VALOR) AS g, max(MES_CONTABIL) AS m FROM released LEFT JOIN day_months ON LIBERADA_EM = D GROUP BY 1)
SELECT o_orderkey AS ID_PROCESSO, round(a, 2) AS ACORDO, round(c, 2) AS CONDENACAO, round(g, 2) AS GARANTIA, ps.m AS MES_PAGAMENTO, gs.m AS MES_GARANTIA,
  round(coalesce(a, 0) + coalesce(c, 0) + coalesce(g, 0), 2) AS TOTAL_PAGAMENTOS, o_orderpriority AS GRUPO,
  CASE WHEN o_orderstatus = 'F' THEN CASE WHEN coalesce(a, 0) > 1 THEN 'ACORDO' WHEN coalesce(c, 0) + coalesce(g, 0) > 1 THEN 'CONDENACAO' ELSE 'SEM ONUS' END END AS MOTIVO_ENC_AGRP
FROM orders LEFT JOIN ps ON o_orderkey = ps.P LEFT JOIN gs ON o_orderkey = gs.P""")
def agency_book(spark, folder):
    items = table(spark, folder, "lineitem")
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    paid = items.select(
        F.col("l_orderkey").alias("PROCESSO_ID"),
        F.when(flag == "A", "ACORDO - MEDIAÇÃO").when(flag == "N", "MULTA - REGULATÓRIO").otherwise("OUTRO").alias("SUB_TIPO"),
        F.when(quantity > 48, None).when(quantity > 46, "CANCELADO").otherwise("PAGO").alias("STATUS_DO_PAGAMENTO"),
        F.col("l_extendedprice").alias("VALOR"),
        F.to_date("l_shipdate").alias("DATA_EFETIVA_DO_PAGAMENTO"),
    )
    orders = table(spark, folder, "orders")
    closings = orders.select(
        F.col("o_orderkey").alias("ID_PROCESSO"), (F.col("o_orderstatus") == "F").cast("int").alias("ENCERRADOS")
    )
    managerial = orders.select(F.col("o_orderkey").alias("PROCESSO_ID"), F.col("o_orderpriority").alias("GRUPO"))
    # Guarantee types the agency knows: the labour types of the shape are among them.
    held = shapes.guarantees(spark, folder)
    book = agency.agency_book(closings, paid, held, managerial, dims.calendar(spark))
    amounts = ["ACORDO", "CONDENACAO", "GARANTIA", "TOTAL_PAGAMENTOS"]
    return rounded(book, *amounts).select("ID_PROCESSO", *amounts, "MES_PAGAMENTO", "MES_GARANTIA", "GRUPO", "MOTIVO_ENC_AGRP")


# ---- billing ------------------------------------------------------------------


@query("""
WITH t AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag AS OFFICE, substr(o_orderpriority, 1, 1) AS SERVICE, l_shipdate::DATE AS DAY,
    CASE WHEN l_linenumber = 1 THEN 'NÃO FATURADO' WHEN l_linenumber < 7 THEN 'FATURADO' END AS FATURAR, l_linestatus = 'F' AS LATE
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
prices AS (SELECT substr(o_orderpriority, 1, 1) AS SERVICE, max(o_totalprice) AS a, min(o_totalprice) AS r FROM orders GROUP BY 1),
h AS (SELECT DISTINCT l_orderkey AS K, substr(o_orderpriority, 1, 1) AS S, l_shipdate::DATE AS D FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 3),
v AS (
  SELECT t.*, CASE WHEN FATURAR = 'NÃO FATURADO' THEN 0 WHEN OFFICE = 'A' THEN a WHEN OFFICE = 'R' THEN r END AS VALOR,
         CASE WHEN OFFICE = 'A' THEN 0.1::DOUBLE WHEN OFFICE = 'R' THEN 25.0::DOUBLE END AS DESCONTO, h.K IS NOT NULL AS paid
  FROM t LEFT JOIN prices ON t.SERVICE = prices.SERVICE LEFT JOIN h ON l_orderkey = K AND t.SERVICE = S AND DAY = D)
SELECT l_orderkey AS PROCESSO_ID, l_partkey, l_suppkey, l_linenumber, SERVICE AS NATUREZA_DO_SERVICO, FATURAR, VALOR AS VALOR_TAREFA,
  CASE WHEN paid THEN 0 WHEN LATE AND VALOR > 0 AND DESCONTO < 1 THEN VALOR * (1 - DESCONTO) WHEN LATE AND VALOR > 0 THEN VALOR - DESCONTO ELSE VALOR END AS VALOR_FINAL,
  CASE WHEN paid OR NOT LATE THEN 0 ELSE DESCONTO END AS DESCONTO_SLA, CASE WHEN paid THEN 'Pago no mês' ELSE 'Não pago no mês' END AS STATUS_PAGAMENTO
FROM v""")
def calculator_billing(spark, folder):
    orders = table(spark, folder, "orders")
    service = F.substring("o_orderpriority", 1, 1)
    tasks = table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("PROCESSO_ID"), "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_returnflag").alias("ESCRITORIO"),
        F.concat(F.lit(V.TASK_PREFIX), service).alias("OBSERVACAO"),
        F.when(F.col("l_linenumber") == 1, "Não faturar").when(F.col("l_linenumber") < 7, "FATURAR").alias("ANALISE"),
        F.when(F.col("l_linestatus") == "F", V.LATE_STATUS).otherwise(V.ON_TIME_STATUS).alias("STATUS_DA_TAREFA"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("DATA_DE_CONFIRMACAO"),
    )
    prices = orders.groupBy(service.alias("TIPO_DE_TAREFA")).agg(
        F.max("o_totalprice").alias("A"), F.min("o_totalprice").alias("R"), F.max(F.lit(None).cast("double")).alias("N")
    )
    penalties = prices.select("TIPO_DE_TAREFA", F.lit(0.1).alias("A"), F.lit(25.0).alias("R"))
    history = tasks.filter("l_linenumber = 3").select(
        "PROCESSO_ID", F.substring("OBSERVACAO", -1, 1).alias("NATUREZA_DO_SERVICO"),
        F.to_date("DATA_DE_CONFIRMACAO", "dd/MM/yyyy").alias("DATA_DE_CONFIRMACAO"),
    )
    batches = [tasks.filter("l_linenumber < 4"), tasks.filter("l_linenumber >= 4")]
    bills = billing.calculator_billing(batches, prices, penalties, history)
    return bills.select(
        "PROCESSO_ID", "l_partkey", "l_suppkey", "l_linenumber", "NATUREZA_DO_SERVICO", "FATURAR", "VALOR_TAREFA", "VALOR_FINAL",
        "DESCONTO_SLA", "STATUS_PAGAMENTO",
    )


@query("""
WITH t AS (
  SELECT o_orderkey, c_nationkey::VARCHAR AS OFFICE, CASE o_orderpriority WHEN '1-URGENT' THEN 'MÉDICA' WHEN '2-HIGH' THEN 'CONTÁBIL' WHEN '3-MEDIUM' THEN 'AMBIENTAL' END AS REPORT,
    CASE o_orderstatus WHEN 'F' THEN 'ANEXAR QUESITO' WHEN 'O' THEN 'CÁLCULO' ELSE 'ACOMPANHAR' END AS TASK,
    CASE WHEN o_orderstatus = 'P' THEN 'NÃO FATURADO' ELSE 'FATURADO' END AS BILL, n_regionkey AS R
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderpriority <> '5-LOW'),
n AS (SELECT OFFICE, REPORT, count(*) AS n FROM t GROUP BY 1, 2),
v AS (
  SELECT t.*, CASE WHEN BILL = 'NÃO FATURADO' THEN 0
      WHEN t.REPORT = 'MÉDICA' AND R < 2 THEN CASE WHEN n <= 10 THEN 100 WHEN n <= 30 THEN 90 WHEN n <= 50 THEN 80 ELSE 70 END + t.OFFICE::INTEGER
      WHEN TASK = 'CÁLCULO' AND R = 4 THEN 55
      WHEN t.REPORT = 'CONTÁBIL' THEN 40 END::DOUBLE AS VALOR,
    CASE WHEN TASK = 'ANEXAR QUESITO' AND t.OFFICE <> '3' THEN 0.5::DOUBLE END AS DESCONTO
  FROM t JOIN n ON t.OFFICE = n.OFFICE AND t.REPORT IS NOT DISTINCT FROM n.REPORT),
h AS (SELECT o_custkey AS K, count(*) AS n, sum(o_totalprice) AS paid FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT o_orderkey AS PROCESSO_ID, OFFICE AS ESCRITORIO, REPORT AS PERICIA_AJUSTADA, VALOR, DESCONTO,
  CASE WHEN h.n IS NOT NULL THEN 0 ELSE VALOR * coalesce(DESCONTO, 1) END AS VALOR_FINAL, coalesce(h.n, 0) AS QTD_OCORRENCIAS_NO_HISTORICO,
  round(coalesce(paid, 0), 2) AS VALOR_PAGAMENTOS_ANTERIORES, CASE WHEN h.n IS NOT NULL THEN 'NÃO FATURAR' ELSE BILL END AS FATURAR,
  CASE WHEN h.n IS NOT NULL THEN 'NÃO FATURAR - PAGO EM MÊS ANTERIOR' WHEN BILL = 'FATURADO' THEN 'Faturar' ELSE 'não faturar' END AS ANALISE
FROM v LEFT JOIN h ON o_orderkey = K AND REPORT = 'MÉDICA' AND BILL = 'FATURADO' AND OFFICE = '5' AND TASK = 'CÁLCULO'""")
def expert_billing(spark, folder):
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("ESCRITORIO"))
    key, priority, status = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    tasks = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(key.cast("string"), F.lit("_x000D_")).alias("PROCESSO_ID"),
        F.lit(None).cast("string").alias("TAREFA_ID"),
        "ESCRITORIO",
        priority.alias("TIPO_DE_PERICIA"),
        F.when(status == "F", "ANEXAR QUESITO").when(status == "O", "CÁLCULO").otherwise("ACOMPANHAR").alias("TIPO_DA_TAREFA"),
        F.when(priority == "5-LOW", "EM ANÁLISE").when(status == "P", "não faturar").otherwise("Faturar").alias("ANALISE"),
    )
    reference = dim_from_rows(
        spark, [("1-URGENT", "MÉDICA"), ("2-HIGH", "CONTÁBIL"), ("3-MEDIUM", "AMBIENTAL")], "DE string, PARA string"
    )
    offices = table(spark, folder, "nation").select(F.col("n_nationkey").alias("n"), "n_regionkey", F.col("n_nationkey").cast("string").alias("ESCRITORIO"))
    band_prices = offices.filter("n_regionkey < 2").select(
        "ESCRITORIO", F.lit("MÉDICA").alias("TIPO_DE_PERICIA"), F.lit("X").alias("TIPO_ACAO"),
        *[(F.col("n") + 100.0 - 10 * i).alias(label) for i, (_, _, label) in enumerate(V.VOLUME_BANDS)],
    )
    task_prices = offices.filter("n_regionkey = 4").select("ESCRITORIO", F.lit("CÁLCULO").alias("TIPO"), F.lit(55.0).alias("VALOR"))
    report_prices = offices.select("ESCRITORIO", F.lit("CONTÁBIL").alias("TIPO_DE_PERICIA"), F.lit(40.0).alias("VALOR"))
    discounts = dim_from_rows(spark, [("ANEXAR QUESITO", 0.5), ("CÁLCULO", 0.1)], "QUESITO string, VALOR double")
    history = orders.filter("o_orderstatus = 'P'").select(
        F.col("o_custkey").cast("string").alias("PROCESSO_ID"), F.lit("MÉDICA").alias("TIPO_DE_PERICIA"), F.lit("FATURADO").alias("FATURAR"),
        F.lit("5").alias("FORNECEDOR"), F.lit("CÁLCULO").alias("TIPO_DA_TAREFA"), F.col("o_totalprice").alias("PRECO_FINAL"),
    )
    bills = billing.expert_billing(tasks, reference, band_prices, task_prices, report_prices, discounts, history, ["3"])
    return rounded(bills, "VALOR_PAGAMENTOS_ANTERIORES").select(
        "PROCESSO_ID", "ESCRITORIO", "PERICIA_AJUSTADA", "VALOR", "DESCONTO", "VALOR_FINAL", "QTD_OCORRENCIAS_NO_HISTORICO",
        "VALOR_PAGAMENTOS_ANTERIORES", "FATURAR", "ANALISE",
    )


# ---- tax status ---------------------------------------------------------------

_CURRENT_SQL = """previous AS (
  SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'ATIVO' WHEN c_mktsegment = 'MACHINERY' THEN 'REATIVADO' WHEN c_mktsegment = 'FURNITURE' THEN 'ENCERRADO' END AS prev,
         c_acctbal FROM customer),
current AS (
  SELECT * FROM (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'ENCERRADO' WHEN 'O' THEN 'ATIVO' END AS st,
      CASE WHEN o_orderpriority = '1-URGENT' THEN '4. Acordo/Vazio para Defesa' END AS motive, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_totalprice END AS prov,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
    FROM orders) WHERE rn = 1),
k AS (
  SELECT c_custkey, c_acctbal, prov, CASE WHEN motive IS NOT NULL THEN motive WHEN st IS NULL OR st = 'ATIVO' THEN prev ELSE st END AS kept
  FROM previous LEFT JOIN current ON c_custkey = o_custkey),
rolled AS (
  SELECT c_custkey, c_acctbal, CASE WHEN kept IN ('ATIVO', 'REATIVADO') AND prov = 0 THEN kept || ' - BAIXA POR REVERSÃO DE PROVISÃO' ELSE kept END AS status FROM k)"""


def _rolled_status(spark, folder):
    segment, status = F.col("c_mktsegment"), F.col("o_orderstatus")
    previous = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("ID_PROCESSO"),
        F.when(segment == "BUILDING", "ATIVO").when(segment == "MACHINERY", "REATIVADO").when(segment == "FURNITURE", "ENCERRADO").alias("STATUS"),
        F.col("c_acctbal").alias("INSS_DECAIDO"),
    )
    orders = table(spark, folder, "orders")
    closing_sheet = orders.select(
        F.col("o_custkey").alias("ID_PROCESSO"),
        F.when(status == "F", "ENCERRADO").when(status == "O", "ATIVO").alias("STATUS_M"),
        F.when(F.col("o_orderpriority") == "1-URGENT", V.SETTLEMENT_MOTIVE).alias("MOTIVO_MOVIMENTACAO"),
        F.when(F.col("o_orderkey") % 3 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("PROVISAO_TOTAL_M"),
        "o_orderdate", "o_orderkey",
    )
    return tax_status.roll_status(previous, closing_sheet, "2001-08-01", [F.desc("o_orderdate"), "o_orderkey"])


@query(f"""
WITH {_CURRENT_SQL}
SELECT c_custkey AS ID_PROCESSO, status AS STATUS, c_acctbal AS INSS_DECAIDO, DATE '2001-08-01' AS MES_FECH FROM rolled""")
def status_roll(spark, folder):
    return _rolled_status(spark, folder)


@query(f"""
WITH {_CURRENT_SQL}
SELECT DATE '2001-08-01' AS MES_FECH, round(sum(CASE WHEN status IN ('ATIVO', 'REATIVADO') THEN c_acctbal END), 2) AS INSS_DECAIDO FROM rolled""")
def open_tax_amount(spark, folder):
    return rounded(tax_status.open_amount(_rolled_status(spark, folder), "INSS_DECAIDO"), "INSS_DECAIDO")


@query("""
WITH seed AS (
  SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'ATIVO' WHEN 'MACHINERY' THEN 'REATIVADO' WHEN 'FURNITURE' THEN 'ENCERRADO' END AS prev, c_acctbal FROM customer),
cur AS (
  SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS m, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 = 0 THEN 'ENCERRADO' END AS st,
    CASE WHEN o_orderpriority = '1-URGENT' THEN '4. Acordo/Vazio para Defesa' END AS motive, o_orderkey % 3 = 0 AS zero FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderdate DESC, o_orderkey) = 1),
ev AS (SELECT o_custkey, m, coalesce(motive, st) AS new, zero FROM cur WHERE m > DATE '1995-03-01'),
asked AS (SELECT unnest([DATE '1996-12-01', DATE '1999-06-01', DATE '2001-08-01']) AS month)
SELECT c_custkey AS ID_PROCESSO, c_acctbal AS INSS_DECAIDO, month AS MES_FECH,
  coalesce(max_by(new, m) FILTER (new IS NOT NULL),
    CASE WHEN prev IN ('ATIVO', 'REATIVADO') AND coalesce(bool_or(zero), FALSE) THEN prev || ' - BAIXA POR REVERSÃO DE PROVISÃO' ELSE prev END) AS STATUS
FROM seed CROSS JOIN asked LEFT JOIN ev ON o_custkey = c_custkey AND m <= month
GROUP BY c_custkey, c_acctbal, month, prev""")
def status_history(spark, folder):
    """Tax status at three dates, carried over closings with gaps of years, from one pass."""
    segment, status, day = F.col("c_mktsegment"), F.col("o_orderstatus"), F.to_date("o_orderdate")
    known = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("ID_PROCESSO"),
        F.when(segment == "BUILDING", "ATIVO").when(segment == "MACHINERY", "REATIVADO").when(segment == "FURNITURE", "ENCERRADO").alias("STATUS"),
        F.col("c_acctbal").alias("INSS_DECAIDO"),
        F.lit("1995-03-01").cast("date").alias("MES_FECH"),
    )
    closings = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("ID_PROCESSO"),
        F.trunc(day, "MM").alias("MES_FECH"),
        F.when((status == "F") & (F.col("o_orderkey") % 4 == 0), "ENCERRADO").when(status == "O", "ATIVO").alias("STATUS_M"),
        F.when(F.col("o_orderpriority") == "1-URGENT", V.SETTLEMENT_MOTIVE).alias("MOTIVO_MOVIMENTACAO"),
        F.when(F.col("o_orderkey") % 3 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("PROVISAO_TOTAL_M"),
        "o_orderdate", "o_orderkey",
    )
    return tax_status.roll_months(known, closings, ["1996-12-01", "1999-06-01", "2001-08-01"], [F.desc("o_orderdate"), "o_orderkey"])


# ---- settlements and normalised tables --------------------------------------------------


@query("""
SELECT o_orderkey AS ID_PROCESSO, o_totalprice AS VALOR_DO_ACORDO_FECHADO, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus ELSE '' END AS A_VISTA_PARCELADO,
  (o_orderkey % 12)::INTEGER AS QUANTIDADE_DE_PARCELAS, o_orderdate::DATE AS DATA_ACORDO, '' AS SEMANA_NUMERO,
  date_trunc('month', o_orderdate)::DATE AS MES_DATA_ACORDO, CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END AS QTD_ACORDO, o_orderstatus AS A_VISTA_PARCELADO_1,
  CASE WHEN o_totalprice > 500000 THEN 'Acima R$ 500 mil' WHEN o_totalprice > 200000 THEN 'R$ 200 - 500 mil' WHEN o_totalprice > 100000 THEN 'R$ 100 - 200 mil'
       WHEN o_totalprice > 50000 THEN 'R$ 50 - 100 mil' WHEN o_totalprice > 1 THEN 'Até R$ 50 mil' END AS FAIXA
FROM orders""")
def weekly_settlements(spark, folder):
    status = F.col("o_orderstatus")
    sheet = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ID."),
        F.concat(F.lit("R$ "), format_brl(F.col("o_totalprice"))).alias("VALOR DO ACORDO FECHADO"),
        F.when(status != "P", status).otherwise("").alias("A VISTA/PARCELADO"),
        (F.col("o_orderkey") % 12).cast("string").alias("QUANTIDADE DE PARCELAS"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("DATA ACORDO"),
        status.alias("A VISTA-PARCELADO"),
    )
    return settlements.weekly_settlements(sheet)


@query("""
SELECT o_orderkey AS PROCESSO_ID, o_totalprice AS VALOR_TOTAL_A_PAGAR, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate::DATE END AS DATA_DE_REGISTRO,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS SITUACAO_DA_ACAO, NULL::VARCHAR AS OBSERVACAO
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate::DATE END, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, o_orderpriority
FROM orders WHERE o_orderstatus <> 'F'""")
def normalised_table(spark, folder):
    key = F.col("o_orderkey")
    sheet = table(spark, folder, "orders").select(
        F.concat(key.cast("string"), F.lit("_x000D_")).alias("Processo - ID"),
        F.when(F.col("o_orderstatus") == "P", "nan").otherwise(F.col("o_orderstatus")).alias("Situação da ação"),
        F.concat(F.lit("R$ "), format_brl(F.col("o_totalprice"))).alias("Valor total a pagar"),
        F.when(key % 4 == 0, "sem data").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("Data de registro"),
        F.lit("").alias("Unnamed: 35"),
        F.col("o_orderpriority").alias("Observação"),
        F.col("o_orderstatus").alias("status"),
    )
    closed = sheet.filter("status = 'F'").drop("status", "Observação")
    others = sheet.filter("status <> 'F'").drop("status")
    return normalise.normalised_table(
        [closed, others], ids=["PROCESSO_ID"], money=["VALOR_TOTAL_A_PAGAR"], drop=["Unnamed: 35"]
    )


@query("""
SELECT c_custkey AS "CODIGO", coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, '') AS "NOME_CLIENTE", c_acctbal AS "SALDO",
       coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS "SEGMENTO"
FROM customer""")
def cost_driver(spark, folder):
    sheet = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("codigo"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("nome (cliente)"),
        F.col("c_acctbal").alias("saldo"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segmento"),
        F.lit("repetido").alias("Saldo."),
    )
    return normalise.cost_driver(sheet)


@query("""
SELECT c_custkey AS "CHAVE_AREA", CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS "AREA_DE_ATUACAO" FROM customer""")
def payments_control(spark, folder):
    sheet = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("chave (área)"),
        F.when(F.col("c_mktsegment") == "BUILDING", "NaN").otherwise(F.col("c_mktsegment")).alias("Área de atuação"),
        F.lit(None).cast("string").alias("Unnamed: 35"),
    )
    return normalise.payments_control(sheet, {"CHAVE_(AREA)": "CHAVE_AREA"}, ["Unnamed: 35"])


@query("""
SELECT o_orderkey AS "PROCESSO_ID", o_orderdate::DATE AS "DATA_DE_REGISTRO", o_orderdate::DATE AS "DISTRIBUICAO",
       CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS "PERCENTUAL_EMPRESA", o_orderpriority AS "AREA_DO_DIREITO"
FROM orders""")
def managerial_base(spark, folder):
    day = F.to_date("o_orderdate")
    sheet = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("(Processo) ID"),
        F.date_format(day, "dd/MM/yyyy").alias("DATA DE REGISTRO"),
        F.col("o_orderdate").alias("DISTRIBUIÇÃO"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice").cast("string")).otherwise("-").alias("PERCENTUAL/EMPRESA"),
        F.col("o_orderpriority").alias("ÁREA DO DIREITO"),
    )
    return normalise.managerial_base(sheet, more_dates=["DISTRIBUIÇÃO"])


@query(f"""
WITH {shapes.CASES}
SELECT MES_FECH, sum(NOVOS)::BIGINT AS NOVOS, sum(ENCERRADOS)::BIGINT AS ENCERRADOS, sum(ESTOQUE)::BIGINT AS ESTOQUE,
       round(sum(VALOR), 2) AS PROVISAO_TOTAL_PASSIVO_M
FROM cases GROUP BY 1""")
def agency_totals(spark, folder):
    rows = shapes.cases(spark, folder).withColumnRenamed("VALOR", "PROVISAO_TOTAL_PASSIVO_M")
    return rounded(agency.monthly_totals(rows), "PROVISAO_TOTAL_PASSIVO_M")
