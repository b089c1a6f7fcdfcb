"""Joins, calendars and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import dims, shapes
from catalog.registry import query, rounded, table
from closeworks.functions import text
from closeworks.functions.rules import dates_agree
from closeworks.operators import aggregates, filters, joins, periods
from closeworks.plans.payments import payment_fact
from closeworks.sources.dims import dim_from_rows


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'PRÓPRIA' ELSE n_name END AS BU,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'PRÓPRIA' ELSE r_name END AS VP,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'PRÓPRIA' ELSE n_name END AS DIRETORIA,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'PRÓPRIA' ELSE 'CHEFE ' || upper(r_name) END AS RESPONSAVEL_AREA,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'PROP' ELSE 'AREA ' || r_regionkey::VARCHAR END AS AREA_FUNCIONAL,
  n_name AS DESCRICAO_CENTRO_CUSTO
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_name <> 'NATION_7' LEFT JOIN region ON n_regionkey = r_regionkey""")
def org_lookup(spark, folder):
    nation = table(spark, folder, "nation").filter("n_name <> 'NATION_7'")
    units = nation.select(F.col("n_nationkey").alias("CENTRO_DE_CUSTO"), F.col("n_name").alias("BU"))
    areas = nation.join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("CENTRO"),
        F.col("n_name").alias("DESCRICAO"),
        F.col("r_name").alias("NOME2"),
        F.col("n_name").alias("NOME3"),
        F.concat(F.lit("chefe "), F.lower("r_name")).alias("NOME_RESPONSAVEL"),
        F.concat(F.lit("AREA "), F.col("r_regionkey").cast("string")).alias("AREA_FUNCIONAL"),
    )
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    found = joins.org_lookup(
        customer, units, areas, "c_nationkey", "c_mktsegment", ("MACHINERY", "PRÓPRIA", "PROP")
    )
    return found.drop("c_nationkey", "c_mktsegment")


@query("""
SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal > 5000""")
def inner_lookup(spark, folder):
    rich = table(spark, folder, "customer").filter("c_acctbal > 5000")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return joins.inner_lookup(orders, rich, {"o_custkey": "c_custkey"}, ["c_name"]).drop("o_custkey")


@query("""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS customer,
                  date_trunc('month', o_orderdate)::DATE AS month, o_totalprice FROM orders),
g AS (SELECT customer, month, count(*) AS n, max(o_totalprice) AS top FROM o GROUP BY 1, 2)
SELECT o_orderkey, o.customer, o.month, n, top FROM o
LEFT JOIN g ON o.customer IS NOT DISTINCT FROM g.customer AND o.month = g.month""")
def multi_key_lookup(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("customer"),
        F.trunc(F.to_date("o_orderdate"), "MM").alias("month"),
        "o_totalprice",
    )
    groups = orders.groupBy("customer", "month").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    found = joins.lookup(orders, groups, ["customer", "month"], ["n", "top"], null_safe=True)
    return found.drop("o_totalprice")


_FACT_COLS = ["ACORDO", "CONDENACAO", "PENHORA", "PENSAO", "OUTROS_PAGAMENTOS", "IMPOSTO", "GARANTIA"]


@query(f"""
WITH {shapes.FACT}
SELECT PROCESSO_ID, DIA AS DATA_EFETIVA_DO_PAGAMENTO, {", ".join(f"round({c}, 2) AS {c}" for c in _FACT_COLS)},
       round(TOTAL, 2) AS TOTAL_PAGAMENTOS
FROM fact""")
def payments_guarantees_full(spark, folder):
    fact = payment_fact(shapes.payments(spark, folder), shapes.guarantees(spark, folder))
    return rounded(fact, *_FACT_COLS, "TOTAL_PAGAMENTOS")


@query(f"""
WITH {shapes.DAY_MONTHS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, MES_CONTABIL
FROM lineitem LEFT JOIN day_months ON l_shipdate::DATE = D""")
def accounting_month(spark, folder):
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    return periods.assign_period(items, "l_shipdate", dims.calendar(spark)).drop("l_shipdate")


@query("""
WITH calendar AS (
  SELECT date_trunc('month', o_orderdate)::DATE AS MES_CONTABIL,
         min(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END)::DATE AS DT_INICIO,
         max(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END)::DATE AS DT_FIM
  FROM orders GROUP BY 1),
moved AS (
  SELECT MES_CONTABIL, DT_INICIO, CASE month(MES_CONTABIL) WHEN 3 THEN (DT_FIM + 9)::DATE
           WHEN 6 THEN (DT_INICIO - 1)::DATE ELSE DT_FIM END AS DT_FIM FROM calendar),
seen AS (
  SELECT *, max(DT_FIM) OVER (ORDER BY MES_CONTABIL, DT_INICIO ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM moved)
SELECT MES_CONTABIL, DT_INICIO, DT_FIM,
  CASE WHEN DT_INICIO > DT_FIM THEN 'INVERTIDO' WHEN DT_INICIO <= prev THEN 'SOBREPOSTO'
       WHEN DT_INICIO - prev > 1 THEN 'LACUNA' END AS PROBLEMA
FROM seen WHERE DT_INICIO > DT_FIM OR DT_INICIO <= prev OR DT_INICIO - prev > 1""")
def calendar_check(spark, folder):
    orders = table(spark, folder, "orders")
    day, status = F.to_date("o_orderdate"), F.col("o_orderstatus")
    calendar = orders.groupBy(F.trunc(day, "MM").alias("MES_CONTABIL")).agg(
        F.min(F.when(status == "F", day)).alias("DT_INICIO"), F.max(F.when(status == "O", day)).alias("DT_FIM")
    )
    month = F.month("MES_CONTABIL")
    end = F.when(month == 3, F.date_add("DT_FIM", 9)).when(month == 6, F.date_sub("DT_INICIO", 1))
    return periods.check_calendar(calendar.withColumn("DT_FIM", end.otherwise(F.col("DT_FIM"))))


_WINDOWS = [("19980105", "1995-01-01", "1997-12-31"), ("19990104", "1998-01-01", "1998-12-31"), ("20000103", "1999-01-01", "1999-06-30")]


@query("""
WITH w(f, a, b) AS (VALUES ('19980105', DATE '1995-01-01', DATE '1997-12-31'), ('19990104', DATE '1998-01-01', DATE '1998-12-31'),
                           ('20000103', DATE '1999-01-01', DATE '1999-06-30')),
s AS (SELECT o_custkey, o_orderdate::DATE AS day,
        CASE o_orderkey % 3 WHEN 0 THEN '19980105' WHEN 1 THEN '19990104' ELSE '20000103' END AS source FROM orders)
SELECT DISTINCT o_custkey, day, source FROM s JOIN w ON source = f WHERE day BETWEEN a AND b""")
def source_window(spark, folder):
    windows = dim_from_rows(spark, _WINDOWS, "ARQUIVO string, DT_INICIO date, DT_FIM date")
    key = F.col("o_orderkey") % 3
    source = F.when(key == 0, "19980105").when(key == 1, "19990104").otherwise("20000103")
    rows = table(spark, folder, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), source.alias("source"))
    return periods.in_source_window(rows, "source", "day", windows)


@query("""
SELECT o_orderkey, CASE strftime(o_orderdate, '%Y%m%d') WHEN '19980201' THEN DATE '1998-01-01' WHEN '19990503' THEN DATE '1999-04-01'
       ELSE date_trunc('month', o_orderdate)::DATE END AS MES_FECH
FROM orders""")
def file_month(spark, folder):
    exceptions = dim_from_rows(
        spark, [("19980201", "1998-01-01"), ("19990503", "1999-04-01")], "ARQUIVO string, MES_FECH date"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("file"))
    return periods.file_month(orders, "file", exceptions).drop("file")


# ---- merges -------------------------------------------------------------------


def _source_and_new(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    sums = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("o_totalprice"), F.min("l_returnflag").alias("o_orderstatus"),
        F.count(F.lit(1)).alias("n"),
    )
    new = sums.filter("n >= 4").select(
        # Every ninth key is one the orders do not have.
        F.when(F.col("l_orderkey") % 9 == 0, -1 - F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("o_orderkey"),
        F.when(F.col("o_orderstatus") != "N", F.col("o_orderstatus")).alias("o_orderstatus"),
        F.round("o_totalprice", 2).alias("o_totalprice"),
    )
    return orders, new


_NEW_SQL = """new AS (
  SELECT CASE WHEN l_orderkey % 9 = 0 THEN -1 - l_orderkey ELSE l_orderkey END AS o_orderkey,
         nullif(min(l_returnflag), 'N') AS o_orderstatus, round(sum(l_extendedprice), 2) AS o_totalprice
  FROM lineitem GROUP BY l_orderkey HAVING count(*) >= 4)"""


@query(f"""
WITH {_NEW_SQL}
SELECT a.o_orderkey, a.o_custkey, coalesce(b.o_orderstatus, a.o_orderstatus) AS o_orderstatus,
       coalesce(b.o_totalprice, a.o_totalprice) AS o_totalprice
FROM orders a LEFT JOIN new b ON a.o_orderkey = b.o_orderkey""")
def coalescing_merge(spark, folder):
    source, new = _source_and_new(spark, folder)
    return joins.merge_update(source, new, ["o_orderkey"])


@query(f"""
WITH {_NEW_SQL}
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_custkey, coalesce(b.o_orderstatus, a.o_orderstatus) AS o_orderstatus,
       coalesce(b.o_totalprice, a.o_totalprice) AS o_totalprice
FROM orders a FULL JOIN new b ON a.o_orderkey = b.o_orderkey""")
def outer_merge(spark, folder):
    source, new = _source_and_new(spark, folder)
    return joins.merge_update(source, new, ["o_orderkey"], how="outer")


@query(f"""
WITH {_NEW_SQL}
SELECT a.o_orderkey, a.o_custkey, CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_orderstatus ELSE a.o_orderstatus END AS o_orderstatus,
       a.o_totalprice
FROM orders a LEFT JOIN new b ON a.o_orderkey = b.o_orderkey""")
def merge_matched(spark, folder):
    source, new = _source_and_new(spark, folder)
    return joins.merge_update(source, new, ["o_orderkey"], columns=["o_orderstatus"], null_overwrites=True)


@query("""
WITH book AS (
  SELECT o_custkey AS ID_PROCESSO, o_orderkey AS LINHA, date_trunc('month', o_orderdate)::DATE AS MES_FECH,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS ENCERRADOS, o_orderdate::DATE AS DT_ULT_PGTO,
         o_totalprice AS ACORDO, 0.0::DOUBLE AS CONDENACAO, o_totalprice AS TOTAL_PAGAMENTOS
  FROM orders),
totals AS (
  SELECT o_custkey AS ID_PROCESSO, max(l_shipdate)::DATE AS DT_ULT_PGTO,
         round(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END), 2) AS ACORDO,
         round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 2) AS CONDENACAO
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O' GROUP BY 1),
latest AS (SELECT ID_PROCESSO, max(MES_FECH) AS m FROM book WHERE ENCERRADOS = 1 GROUP BY 1),
j AS (
  SELECT b.*, (l.m IS NOT NULL AND b.ENCERRADOS = 1) AS fresh, t.DT_ULT_PGTO AS d, coalesce(t.ACORDO, 0) AS a, coalesce(t.CONDENACAO, 0) AS c
  FROM book b LEFT JOIN latest l ON b.ID_PROCESSO = l.ID_PROCESSO AND b.MES_FECH = l.m LEFT JOIN totals t ON b.ID_PROCESSO = t.ID_PROCESSO)
SELECT ID_PROCESSO, LINHA, MES_FECH, ENCERRADOS, CASE WHEN fresh THEN coalesce(d, DT_ULT_PGTO) ELSE DT_ULT_PGTO END AS DT_ULT_PGTO,
  CASE WHEN fresh THEN a ELSE ACORDO END AS ACORDO, CASE WHEN fresh THEN c ELSE CONDENACAO END AS CONDENACAO,
  CASE WHEN fresh THEN round(a + c, 2) ELSE TOTAL_PAGAMENTOS END AS TOTAL_PAGAMENTOS
FROM j""")
def refresh_closed(spark, folder):
    orders, items = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    day = F.to_date("o_orderdate")
    book = orders.select(
        F.col("o_custkey").alias("ID_PROCESSO"),
        F.col("o_orderkey").alias("LINHA"),
        F.trunc(day, "MM").alias("MES_FECH"),
        (F.col("o_orderstatus") == "F").cast("int").alias("ENCERRADOS"),
        day.alias("DT_ULT_PGTO"),
        F.col("o_totalprice").alias("ACORDO"),
        F.lit(0.0).alias("CONDENACAO"),
        F.col("o_totalprice").alias("TOTAL_PAGAMENTOS"),
    )
    # Sum per order first: the shuffle by customer then carries one row per order.
    flag, price = F.col("l_returnflag"), F.col("l_extendedprice")
    by_order = items.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("last"), F.sum(F.when(flag == "A", price)).alias("a"), F.sum(F.when(flag == "R", price)).alias("r")
    )
    owners = orders.filter("o_orderstatus = 'O'").select("o_orderkey", F.col("o_custkey").alias("ID_PROCESSO"))
    totals = by_order.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("ID_PROCESSO").agg(
        F.to_date(F.max("last")).alias("DT_ULT_PGTO"),
        F.round(F.sum("a"), 2).alias("ACORDO"),
        F.round(F.sum("r"), 2).alias("CONDENACAO"),
    )
    return rounded(joins.refresh_closed(book, totals, ["ACORDO", "CONDENACAO"]), "TOTAL_PAGAMENTOS")


# ---- membership and matching ---------------------------------------------------------


@query("""
WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 50 <> 0 THEN o_custkey END AS customer, o_orderpriority, o_totalprice, year(o_orderdate) AS y FROM orders),
h AS (SELECT customer, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS paid FROM o WHERE y < 2000 GROUP BY 1, 2)
SELECT o_orderkey, h.n IS NOT NULL AS known, coalesce(h.n, 0) AS times, coalesce(paid, 0) AS paid
FROM o LEFT JOIN h ON o.customer IS NOT DISTINCT FROM h.customer AND o.o_orderpriority = h.o_orderpriority WHERE y >= 2000""")
def history_check(spark, folder):
    orders = table(spark, folder, "orders").withColumn(
        "customer", F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey"))
    )
    keys = ["customer", "o_orderpriority"]
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    history, current = orders.filter(F.col("o_orderdate") < cut), orders.filter(F.col("o_orderdate") >= cut)
    flagged = joins.flag_exists(current.select("o_orderkey", *keys), history, keys, "known", null_safe=True)
    counted = aggregates.history_totals(flagged, history, keys, "o_totalprice", "times", "paid")
    return rounded(counted.select("o_orderkey", "known", "times", "paid"), "paid")


@query("""
SELECT c_custkey, 'sem pedido' AS kind FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL
SELECT c_custkey, 'com pedido' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def known_and_unknown(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey")
    pending = table(spark, folder, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    unknown = joins.unknown_only(customer, pending, ["c_custkey"]).withColumn("kind", F.lit("sem pedido"))
    return unknown.union(joins.known_only(customer, pending, ["c_custkey"]).withColumn("kind", F.lit("com pedido")))


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND c_mktsegment NOT IN ('MACHINERY', 'BUILDING')
    THEN CASE o_orderpriority WHEN '1-URGENT' THEN 0.5 ELSE 0.8 END END::DOUBLE AS DESCONTO
FROM orders JOIN customer ON o_custkey = c_custkey""")
def conditional_discount(spark, folder):
    discounts = dim_from_rows(spark, [("1-URGENT", 0.5), ("2-HIGH", 0.8), ("5-LOW", 0.1)], "QUESITO string, VALOR double")
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    tasks = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    reduced = joins.discount_for(
        tasks, discounts, "o_orderpriority", "c_mktsegment", ["1-URGENT", "2-HIGH"], ["MACHINERY", "BUILDING"]
    )
    return reduced.select("o_orderkey", "DESCONTO")


@query("""
WITH m AS (SELECT o_custkey, max(date_trunc('month', o_orderdate)) AS last FROM orders GROUP BY 1)
SELECT o_orderkey, o.o_custkey, date_trunc('month', o_orderdate)::DATE AS month
FROM orders o JOIN m ON o.o_custkey = m.o_custkey AND date_trunc('month', o_orderdate) = last""")
def last_event_per_key(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.trunc(F.to_date("o_orderdate"), "MM").alias("month")
    )
    return joins.last_per_key(orders, "o_custkey", "month")


@query("""
WITH latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'P')
  WHERE rn = 1)
SELECT c_custkey, lpad(c_custkey::VARCHAR, 11, '0') AS CPF, o_orderkey AS ID_PROCESSO,
       CASE WHEN o_orderkey IS NOT NULL THEN (o_orderdate::DATE >= DATE '1999-01-01')::INTEGER END AS FLAG_DT_DISPENSA
FROM customer LEFT JOIN latest ON c_custkey = o_custkey""")
def termination_match(spark, folder):
    people = table(spark, folder, "customer").select(
        "c_custkey", text.normalize_tax_id(F.col("c_custkey")).alias("CPF")
    )
    new = table(spark, folder, "orders").filter("o_orderstatus = 'P'").select(
        text.normalize_tax_id(F.concat(F.lit("."), F.col("o_custkey").cast("string"))).alias("CPF"),
        F.col("o_orderkey").alias("ID_PROCESSO"),
        F.to_date("o_orderdate").alias("day"),
    )
    latest = aggregates.keep_one(filters.has_key(new, "CPF"), ["CPF"], [F.desc("day"), "ID_PROCESSO"])
    found = joins.lookup(people, latest, "CPF", ["ID_PROCESSO", "day"], derived=True)
    cut = F.lit("1999-01-01").cast("date")
    agrees = dates_agree(F.col("ID_PROCESSO"), F.least("day", cut), cut)
    return found.withColumn("FLAG_DT_DISPENSA", agrees).drop("day")
