"""Classification rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import shapes
from catalog.registry import query, table
from closeworks.functions import dates, rules
from closeworks.functions import fixed_values as V

_SPELLINGS = ["EXECUÇÃO - TRT", " RECURSAL TST", "RECURSAL", "N/A", "CONHECIMENTO"]


def _phases(spark, folder):
    """A phase spelling per priority, missing for one in seven orders."""
    level = F.substring("o_orderpriority", 1, 1)
    phase = F.when(level == "1", _SPELLINGS[0])
    for i, spelling in enumerate(_SPELLINGS[1:], start=2):
        phase = phase.when(level == str(i), spelling)
    phase = F.when(F.col("o_orderkey") % 7 != 0, phase)
    return table(spark, folder, "orders").select("o_orderkey", phase.alias("FASE"))


_PHASES_SQL = "phases AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CASE substr(o_orderpriority, 1, 1) " + " ".join(
    f"WHEN '{i}' THEN '{s}'" for i, s in enumerate(_SPELLINGS, start=1)
) + " END END AS FASE FROM orders)"


@query(f"""
WITH {_PHASES_SQL}
SELECT o_orderkey,
  CASE WHEN FASE = 'N/A' THEN 'DEMAIS' WHEN FASE = 'EXECUÇÃO - TRT' THEN 'EXECUÇÃO' WHEN FASE = 'RECURSAL' THEN 'RECURSAL'
       ELSE FASE END AS closing,
  CASE WHEN FASE = 'N/A' THEN 'DEMAIS' WHEN FASE = 'EXECUÇÃO - TRT' THEN 'EXECUÇÃO'
       WHEN FASE = 'RECURSAL' THEN 'RECURSAL_TRT' ELSE FASE END AS book,
  CASE WHEN FASE IS NULL OR trim(FASE) = 'N/A' THEN 'DEMAIS' WHEN trim(FASE) = 'EXECUÇÃO - TRT' THEN 'EXECUÇÃO'
       WHEN trim(FASE) = 'RECURSAL' THEN 'RECURSAL_TRT' WHEN trim(FASE) = 'RECURSAL TST' THEN 'RECURSAL_TST'
       ELSE trim(FASE) END AS roll
FROM phases""")
def phase_groups(spark, folder):
    phase = F.col("FASE")
    return _phases(spark, folder).select(
        "o_orderkey",
        rules.group_phase(phase, V.CLOSING_PHASES).alias("closing"),
        rules.group_phase(phase).alias("book"),
        rules.group_phase(phase, null_label="DEMAIS").alias("roll"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'SIM' ELSE 'NÃO' END AS doc
FROM orders""")
def doc_flag(spark, folder):
    urgent = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), V.DOCUMENT_ANALYSES[0])
    other = urgent.when(F.col("o_orderpriority") == "5-LOW", "SEM ANÁLISE")
    return table(spark, folder, "orders").select("o_orderkey", rules.document_flag(other).alias("doc"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'ACORDO' WHEN p_size % 4 = 1 THEN 'DEFESA' WHEN p_size % 4 = 2 THEN p_type END AS strategy,
       CASE WHEN upper(p_name) LIKE '%AC%' THEN 'ACORDO' WHEN upper(p_name) LIKE '%DE%' THEN 'DEFESA'
            ELSE 'SEM ESTRATEGIA' END AS label
FROM part""")
def strategy_label(spark, folder):
    size = F.col("p_size") % 4
    written = F.when(size == 0, "ACOR").when(size == 1, " DEFESA").when(size == 2, F.col("p_type"))
    return table(spark, folder, "part").select(
        "p_partkey",
        rules.strategy(written).alias("strategy"),
        rules.strategy_label(F.upper("p_name"), "SEM ESTRATEGIA").alias("label"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '1998-01-01' THEN 'NOVO' ELSE 'LEGADO' END AS era FROM orders""")
def new_vs_legacy(spark, folder):
    era = rules.new_or_legacy(F.to_date("o_orderdate"), "1998-01-01")
    return table(spark, folder, "orders").select("o_orderkey", era.alias("era"))


_SPLITS = [
    ("AFRICA", ["NATION_0", "NATION_5"], "LOGISTICA", "ADMINISTRATIVO"),
    ("ASIA", ["NATION_2"], "LOGISTICA", "TECNOLOGIA"),
]


@query("""
SELECT n_nationkey, CASE WHEN r_name = 'AFRICA' AND n_name IN ('NATION_0', 'NATION_5') THEN 'LOGISTICA'
    WHEN r_name = 'AFRICA' THEN 'ADMINISTRATIVO' WHEN r_name = 'ASIA' AND n_name = 'NATION_2' THEN 'LOGISTICA'
    WHEN r_name = 'ASIA' THEN 'TECNOLOGIA' WHEN r_name = 'EUROPE' THEN 'OUTROS' ELSE r_name END AS grp
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def reporting_group(spark, folder):
    region = table(spark, folder, "region")
    nation = table(spark, folder, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    vp = F.when(F.col("r_name") == "EUROPE", "").otherwise(F.col("r_name"))
    return nation.select("n_nationkey", rules.reporting_group(vp, F.col("n_name"), _SPLITS).alias("grp"))


@query("""
SELECT o_orderkey,
  CASE WHEN o_totalprice > 450000 THEN 'PASSÍVEL PROVISÃO' WHEN o_orderstatus = 'F' THEN 'TERCEIRO SOLVENTE'
       WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'ESTRATEGICO' WHEN o_orderkey % 2 = 0 THEN 'DEFESA'
       ELSE 'PASSÍVEL PROVISÃO' END AS book,
  CASE WHEN o_totalprice > 450000 THEN 'PASSÍVEL PROVISÃO' WHEN o_orderkey % 2 = 0 THEN 'DEFESA'
       WHEN o_orderstatus = 'F' THEN 'TERCEIRO SOLVENTE' WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'ESTRATEGICO'
       ELSE 'PASSÍVEL PROVISÃO' END AS model
FROM orders""")
def nature_rules(spark, folder):
    inputs = (
        F.col("o_totalprice") - 450000,
        F.when(F.col("o_orderstatus") == "F", "TERCEIRO SOLVENTE"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "CONTENCIOSO COLETIVO"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "TRABALHISTA COLETIVO"),
        F.when(F.col("o_orderkey") % 2 == 0, "DEFESA"),
    )
    return table(spark, folder, "orders").select(
        "o_orderkey",
        rules.case_nature(*inputs).alias("book"),
        rules.case_nature(*inputs, defence_first=True).alias("model"),
    )


@query(f"""
WITH {shapes.CASES}
SELECT ID_PROCESSO, CASE WHEN ESTOQUE >= 1 AND month(MES_FECH) IN (3, 6, 9, 12) THEN 'SIM' END AS TRIM_ESTOQ FROM cases""")
def quarter_stock(spark, folder):
    flag = rules.quarter_stock(F.col("ESTOQUE"), F.col("MES_FECH"))
    return shapes.cases(spark, folder).select("ID_PROCESSO", flag.alias("TRIM_ESTOQ"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN
    CASE WHEN o_orderkey % 3 = 0 THEN 'ACORDO' WHEN o_orderkey % 3 = 1 THEN 'CONDENACAO' ELSE 'SEM ONUS' END END AS reason
FROM orders""")
def closing_reason(spark, folder):
    key = F.col("o_orderkey") % 3
    settled = F.when(key == 0, F.col("o_totalprice")).otherwise(F.lit(1.0))
    settled = F.when(key == 2, 0.0).otherwise(settled)
    paid = F.when(key == 1, F.col("o_totalprice")).otherwise(F.lit(0.5))
    closed = (F.col("o_orderstatus") == "F").cast("int")
    return table(spark, folder, "orders").select(
        "o_orderkey", rules.closing_reason(closed, settled, [paid, F.lit(0.25)]).alias("reason")
    )


@query("""
SELECT p_partkey,
  CASE WHEN p_type = 'PROMO' THEN 'VENDEDOR' WHEN p_type = 'SMALL' THEN 'CAIXA' ELSE 'OUTROS' END AS book,
  CASE p_type WHEN 'PROMO' THEN 'VENDEDOR' WHEN 'SMALL' THEN 'ASSESSOR DE ATENDIMENTO' WHEN 'LARGE' THEN 'CONS ADM LOJA'
       ELSE p_type END AS synonym,
  CASE WHEN p_size % 5 = 0 THEN 'TERCEIRO INSOLVENTE' WHEN p_size % 5 = 1 THEN 'OUTROS' WHEN p_type = 'PROMO' THEN 'VENDEDOR'
       ELSE 'OUTROS' END AS model
FROM part""")
def title_whitelist(spark, folder):
    kind = F.col("p_type")
    title = F.when(kind == "PROMO", "VENDEDOR").when(kind == "SMALL", "CAIXA").when(kind == "LARGE", "COORD ADM LOJA")
    title = title.otherwise(kind)
    size = F.col("p_size") % 5
    nature = F.when(size == 0, "TERCEIRO INSOLVENTE").when(size > 1, "PRÓPRIO")
    return table(spark, folder, "part").select(
        "p_partkey",
        rules.listed_title(title).alias("book"),
        rules.title_synonym(title).alias("synonym"),
        rules.model_title(title, nature).alias("model"),
    )


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'N/A' ELSE c_mktsegment END AS listed,
       CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'N/A' ELSE c_mktsegment END AS by_word
FROM customer""")
def party_override(spark, folder):
    segment = F.col("c_mktsegment")
    party = F.when(segment == "MACHINERY", V.MINISTRY_PARTIES[0]).when(segment == "BUILDING", "O MINISTÉRIO NOVO")
    return table(spark, folder, "customer").select(
        "c_custkey",
        rules.ministry_phase(party, segment).alias("listed"),
        rules.ministry_phase(party, segment, names=None).alias("by_word"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_shipdate::DATE - o_orderdate::DATE <= 90 THEN 'Contrato Experiência' ELSE 'Contrato Normal' END AS contract,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'Aprendiz' ELSE 'Demais Cargos' END AS title,
  CASE WHEN l_linestatus = 'F' THEN (l_shipdate::DATE >= o_orderdate::DATE)::INTEGER END AS agrees
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def contract_type(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("ordered"), "o_orderpriority"
    )
    joined = table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    shipped, ordered = F.to_date("l_shipdate"), F.col("ordered")
    title = F.when(F.col("o_orderpriority") == "5-LOW", "Jovem Aprendiz").otherwise(F.col("o_orderpriority"))
    case = F.when(F.col("l_linestatus") == "F", F.col("l_orderkey"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        rules.contract_kind(dates.days_between(ordered, shipped)).alias("contract"),
        rules.title_kind(title).alias("title"),
        rules.dates_agree(case, F.least(ordered, shipped), ordered).alias("agrees"),
    )


_BRACKETS_SQL = """CASE WHEN o_totalprice > 1 AND o_totalprice <= 50000 THEN 'Até R$ 50 mil'
  WHEN o_totalprice > 50000 AND o_totalprice <= 100000 THEN 'R$ 50 - 100 mil'
  WHEN o_totalprice > 100000 AND o_totalprice <= 200000 THEN 'R$ 100 - 200 mil'
  WHEN o_totalprice > 200000 AND o_totalprice <= 500000 THEN 'R$ 200 - 500 mil'
  WHEN o_totalprice > 500000 THEN 'Acima R$ 500 mil' END"""


@query(f"SELECT {_BRACKETS_SQL} AS FAIXA, count(*) AS n FROM orders GROUP BY 1")
def price_brackets(spark, folder):
    bracket = rules.settlement_bracket(F.col("o_totalprice"))
    return table(spark, folder, "orders").groupBy(bracket.alias("FAIXA")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {shapes.CASES}
SELECT ID_PROCESSO, CASE WHEN ESTOQUE = 1 OR NOVOS = 1 THEN '' ELSE PRIORIDADE END AS MOTIVO FROM cases""")
def blank_reason(spark, folder):
    reason = rules.blank_reason(F.col("ESTOQUE"), F.col("NOVOS"), F.col("PRIORIDADE"))
    return shapes.cases(spark, folder).select("ID_PROCESSO", reason.alias("MOTIVO"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'FATURADO' WHEN o_orderpriority = '2-HIGH' THEN 'NÃO FATURADO' END AS bill
FROM orders""")
def billable_flag(spark, folder):
    priority = F.col("o_orderpriority")
    analysis = F.when(priority == "1-URGENT", "ok: Faturar").when(priority == "2-HIGH", "não faturar (pago)")
    analysis = analysis.when(priority == "3-MEDIUM", "PENDENTE")
    return table(spark, folder, "orders").select("o_orderkey", rules.billable(analysis).alias("bill"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_shipdate::DATE - o_orderdate::DATE > 60 AND l_linenumber <> 2
       THEN CASE WHEN l_linenumber < 4 THEN l_extendedprice * (1 - l_discount) ELSE l_extendedprice - (l_linenumber * 10) END
       ELSE l_extendedprice END AS final
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def late_penalty(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("ordered"))
    joined = table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    late = dates.days_between(F.col("ordered"), F.to_date("l_shipdate")) > 60
    status = F.when(late, "Confirmados em Atraso").otherwise("Confirmados")
    line = F.col("l_linenumber")
    discount = F.when(line == 2, None).when(line < 4, F.col("l_discount")).otherwise((line * 10).cast("double"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        rules.late_penalty(status, F.col("l_extendedprice"), discount).alias("final"),
    )


_DAYS = "(DATE '2001-12-01' - o_orderdate::DATE)"
_MONTHS = """((2001 * 12 + 12) - (year(o_orderdate) * 12 + month(o_orderdate))
  - CASE WHEN 1 < day(o_orderdate) THEN 1 ELSE 0 END)"""


# Edges and labels are written out, apart from the lists the operator uses.
@query(f"""
WITH o AS (SELECT o_orderkey, o_orderstatus, {_DAYS} AS d, {_MONTHS} AS m FROM orders)
SELECT o_orderkey, d::INTEGER AS days, m::BIGINT AS months,
  CASE WHEN d <= 360 THEN 'até 1 ano' WHEN d <= 1080 THEN '1 - 3 anos' WHEN d <= 2160 THEN '3 - 6 anos' WHEN d <= 3240 THEN '6 - 9 anos'
    ELSE '+9 anos' END AS case_age,
  CASE WHEN d <= 360 THEN 'até 1 ano' WHEN d <= 720 THEN '1 - 2 anos' WHEN d <= 1080 THEN '2 - 3 anos' WHEN d <= 1440 THEN '3 - 4 anos'
    WHEN d <= 1800 THEN '4 - 5 anos' WHEN d <= 2160 THEN '5 - 6 anos' WHEN d <= 2520 THEN '6 - 7 anos' ELSE '+7 anos' END AS model_age,
  CASE WHEN d <= 360 THEN 'até 1 ano' WHEN d <= 720 THEN '1 - 2 anos' WHEN d <= 1080 THEN '2 - 3 anos' WHEN d <= 1440 THEN '3 - 4 anos'
    WHEN d <= 1800 THEN '4 - 5 anos' WHEN d <= 2160 THEN '5 - 6 anos' WHEN d <= 3600 THEN '6 - 10 anos' ELSE 'Acima de 10 anos' END AS tenure,
  CASE WHEN d <= 360 THEN 'até 1 ano' WHEN d <= 1080 THEN '1 - 3 anos' WHEN d <= 2160 THEN '3 - 5 anos' ELSE '+5 anos' END AS staff_tenure,
  CASE WHEN m <= 6 THEN 'até 6 meses' WHEN m <= 12 THEN '7 - 12 meses' WHEN m <= 18 THEN '13 - 18 meses' WHEN m <= 24 THEN '19 - 24 meses'
    ELSE '+24 meses' END AS stock_age,
  CASE WHEN o_orderstatus = 'P' THEN 'Sem info' WHEN m <= 12 THEN 'ATÉ 1 ANO' WHEN m <= 24 THEN '1 - 2 ANOS' WHEN m <= 36 THEN '2 - 3 ANOS'
    WHEN m <= 48 THEN '3 - 4 ANOS' WHEN m <= 60 THEN '4 - 5 ANOS' WHEN m <= 72 THEN '5 - 6 ANOS' WHEN m <= 84 THEN '6 - 7 ANOS'
    ELSE '+7 ANOS' END AS cluster
FROM o""")
def aging_bins(spark, folder):
    today = F.lit("2001-12-01").cast("date")
    ordered, status = F.to_date("o_orderdate"), F.col("o_orderstatus")
    aged = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        dates.days_between(ordered, today).alias("days"),
        dates.whole_months(ordered, today).alias("months"),
    )
    days, months = F.col("days"), F.col("months")
    return aged.select(
        "o_orderkey", "days", "months",
        rules.bin_label(days, V.CASE_DAY_BINS).alias("case_age"),
        rules.bin_label(days, V.MODEL_DAY_BINS).alias("model_age"),
        rules.bin_label(days, V.TENURE_DAY_BINS).alias("tenure"),
        rules.bin_label(days, V.STAFF_TENURE_BINS).alias("staff_tenure"),
        rules.bin_label(months, V.STOCK_MONTH_BINS).alias("stock_age"),
        rules.aging_cluster(F.when(status == "O", months), F.when(status == "F", months)).alias("cluster"),
    )
