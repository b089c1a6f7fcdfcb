"""Aggregations, pivots, de-duplication and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import shapes
from catalog.registry import query, rounded, table
from closeworks.functions import fixed_values as V
from closeworks.functions.rules import bin_label
from closeworks.operators import aggregates
from closeworks.plans.payments import cost_totals, guarantees_by_date, payment_fact, payment_totals


@query(f"""
WITH {shapes.CASES}
SELECT MES_FECH, sum(NOVOS)::BIGINT AS NOVOS, sum(ENCERRADOS)::BIGINT AS ENCERRADOS, sum(ESTOQUE)::BIGINT AS ESTOQUE,
       round(sum(VALOR), 2) AS VALOR
FROM cases GROUP BY 1""")
def monthly_indicators(spark, folder):
    cases = shapes.cases(spark, folder)
    return rounded(aggregates.monthly_indicators(cases, ["NOVOS", "ENCERRADOS", "ESTOQUE", "VALOR"]), "VALOR")


_TOTALS = ["ACORDO", "CONDENACAO", "PENHORA", "PENSAO", "OUTROS_PAGAMENTOS", "IMPOSTO", "GARANTIA", "TOTAL_PAGAMENTOS"]


@query(f"""
WITH {shapes.FACT}
SELECT PROCESSO_ID, DT_ULT_PGTO, {", ".join(f"round({c}, 2) AS {c}" for c in _TOTALS)} FROM totals""")
def case_payments(spark, folder):
    fact = payment_fact(shapes.payments(spark, folder), shapes.guarantees(spark, folder))
    return rounded(payment_totals(fact), *_TOTALS)


@query(f"""
WITH {shapes.CLASSIFIED}
SELECT PROCESSO_ID, round(sum(CUSTAS), 2) AS CUSTAS FROM classified WHERE CUSTAS IS NOT NULL GROUP BY 1""")
def case_costs(spark, folder):
    return rounded(cost_totals(shapes.payments(spark, folder)), "CUSTAS")


@query(f"""
WITH {shapes.GUARANTEES}
SELECT PROCESSO_ID, LIBERADA_EM AS DATA_EFETIVA_DO_PAGAMENTO, round(sum(VALOR), 2) AS GARANTIA FROM released GROUP BY 1, 2""")
def guarantee_sums(spark, folder):
    return rounded(guarantees_by_date(shapes.guarantees(spark, folder)), "GARANTIA")


@query("""
SELECT l_returnflag, l_linestatus, l_suppkey, count(l_orderkey) AS QTD, round(sum(l_extendedprice), 2) AS VALOR
FROM lineitem GROUP BY ALL""")
def attribute_counts(spark, folder):
    items, keys = table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey"]
    return rounded(aggregates.counts(items, keys, "QTD", "l_orderkey", {"VALOR": "l_extendedprice"}), "VALOR")


@query("SELECT o_orderpriority, count(*) AS QTD FROM orders GROUP BY 1")
def frequency(spark, folder):
    return aggregates.counts(table(spark, folder, "orders"), ["o_orderpriority"])


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_rows(spark, folder):
    return table(spark, folder, "orders").select("o_custkey", "o_orderstatus").distinct()


@query("""
SELECT o_custkey, o_orderkey, o_orderdate::DATE AS day, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def latest_per_key(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice"
    )
    return aggregates.keep_one(orders, ["o_custkey"], [F.desc("day"), "o_orderkey"])


@query("""
SELECT * EXCLUDE (n, l_shipdate), l_shipdate::DATE AS l_shipdate FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""")
def duplicate_keys(spark, folder):
    items = table(spark, folder, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    return aggregates.repeated_keys(items, ["l_orderkey", "l_linenumber"])


@query("""
SELECT n_name, c_mktsegment, upper(c_mktsegment) AS STATUS, count(c_custkey) AS QTD FROM customer
JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment IN ('BUILDING', 'FURNITURE') GROUP BY ALL""")
def headcount(spark, folder):
    active = table(spark, folder, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"))
    # Count by key first, so that the join carries one row per group.
    grouped = aggregates.counts(active, ["c_nationkey", "c_mktsegment"], "QTD", "c_custkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    named = grouped.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select("n_name", "c_mktsegment", F.upper("c_mktsegment").alias("STATUS"), "QTD")


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("""
SELECT p_brand, CASE WHEN p_type IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD') THEN p_type ELSE 'OUTROS' END AS p_type,
  round(sum(p_retailprice), 2) AS price FROM part GROUP BY ALL""")
def price_unpivot(spark, folder):
    part = table(spark, folder, "part")
    matrix = aggregates.pivot_sum(part, ["p_brand"], "p_type", _TYPES, "p_retailprice")
    return rounded(aggregates.to_long(matrix, ["p_brand"], "p_type", "price"), "price")


@query("SELECT l_orderkey, " + ", ".join(
    f"round(sum(CASE WHEN l_linenumber = {i} THEN l_extendedprice END), 2) AS \"{i}\"" for i in range(1, 6)
) + ", round(sum(CASE WHEN l_linenumber NOT BETWEEN 1 AND 5 THEN l_extendedprice END), 2) AS \"OUTROS\" FROM lineitem GROUP BY 1")
def installment_pivot(spark, folder):
    items = table(spark, folder, "lineitem")
    numbers = list(range(1, 6))
    wide = aggregates.pivot_sum(items, ["l_orderkey"], "l_linenumber", numbers, "l_extendedprice")
    return rounded(wide, *[str(n) for n in numbers], aggregates.OTHERS)


_BANDS_SQL = """CASE WHEN n > 0 AND n <= 10 THEN 0 WHEN n > 10 AND n <= 30 THEN 1 WHEN n > 30 AND n <= 50 THEN 2 ELSE 3 END"""


@query(f"""
WITH o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 < 9 THEN 'A' ELSE 'B' END AS kind FROM orders),
v AS (SELECT o_custkey, kind, count(*) AS n FROM o GROUP BY 1, 2),
p AS (SELECT o_custkey, kind, c_acctbal - 10 * ({_BANDS_SQL}) AS price FROM v JOIN customer ON o_custkey = c_custkey WHERE kind = 'A')
SELECT o_orderkey, price FROM o LEFT JOIN p ON o.o_custkey = p.o_custkey AND o.kind = p.kind""")
def volume_pricing(spark, folder):
    kind = F.when(F.col("o_orderkey") % 10 < 9, "A").otherwise("B")
    tasks = table(spark, folder, "orders").select("o_orderkey", "o_custkey", kind.alias("kind"))
    matrix = table(spark, folder, "customer").select(
        "c_custkey",
        F.lit("A").alias("TIPO"),
        *[(F.col("c_acctbal") - 10 * i).alias(label) for i, (_, _, label) in enumerate(V.VOLUME_BANDS)],
    )
    prices = aggregates.to_long(matrix, ["c_custkey", "TIPO"], "FAIXA", "VALOR")
    keys = {"o_custkey": "c_custkey", "kind": "TIPO"}
    return aggregates.volume_price(tasks, prices, keys, "FAIXA", "VALOR", "price").select("o_orderkey", "price")


@query("""
SELECT o_custkey, round(sum(CASE WHEN o_orderstatus IN ('O', 'P') THEN o_totalprice END), 2) AS ABERTO FROM orders GROUP BY 1""")
def conditional_sum(spark, folder):
    orders = table(spark, folder, "orders")
    is_open = F.col("o_orderstatus").isin("O", "P")
    return rounded(aggregates.sum_where(orders, ["o_custkey"], is_open, "o_totalprice", "ABERTO"), "ABERTO")


@query("""
SELECT o_custkey, o_orderkey, o_totalprice, rn::INTEGER AS POSICAO FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3""")
def top_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return aggregates.keep_first_n(orders, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 3)


@query("""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def highest_values(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("""
SELECT o_custkey, o_orderstatus, count(*) AS QTD FROM orders GROUP BY 1, 2 ORDER BY 1, 3 DESC, 2""")
def multi_key_sort(spark, folder):
    counted = aggregates.counts(table(spark, folder, "orders"), ["o_custkey", "o_orderstatus"])
    return counted.orderBy("o_custkey", F.desc("QTD"), "o_orderstatus")


@query(f"""
WITH v AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT CASE {_BANDS_SQL} WHEN 0 THEN 'ATÉ 10 PERÍCIAS' WHEN 1 THEN 'ENTRE 11 E 30 PERÍCIAS' WHEN 2 THEN 'ENTRE 31 E 50 PERÍCIAS'
       ELSE 'ACIMA DE 50 PERÍCIAS' END AS FAIXA, count(*) AS QTD FROM v GROUP BY 1""")
def volume_bands(spark, folder):
    volumes = aggregates.counts(table(spark, folder, "orders"), ["o_custkey"], "n")
    return aggregates.counts(volumes.withColumn("FAIXA", bin_label(F.col("n"), V.VOLUME_BANDS)), ["FAIXA"])
