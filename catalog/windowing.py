"""Ordered windows and installment plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import shapes
from catalog.registry import query, table
from closeworks.functions import dates
from closeworks.operators import aggregates, filters, installments, intervals, ordered, windows


_EVENTS_SQL = """e AS (
  SELECT user_id, ts, event_id, CASE WHEN event_type = 'error' THEN 'ENCERRADO' ELSE event_type END AS DP_FASE FROM events),
p AS (SELECT *, lag(DP_FASE) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ant FROM e),
t AS (
  SELECT *, CASE WHEN ant IS NULL AND DP_FASE IS NOT NULL THEN 0 WHEN ant = DP_FASE THEN 1
      WHEN ant <> DP_FASE AND DP_FASE <> 'ENCERRADO' THEN 2 WHEN ant IS NOT NULL AND DP_FASE = 'ENCERRADO' THEN 3 ELSE 4 END AS MUDOU_FASE,
    CASE WHEN ant <> DP_FASE THEN ant || ' - ' || DP_FASE END AS DP_FASE_MES
  FROM p)"""


def _transitions(spark, folder):
    phase = F.when(F.col("event_type") == "error", "ENCERRADO").otherwise(F.col("event_type"))
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", phase.alias("DP_FASE"))
    return windows.phase_transitions(events, "user_id", ["ts", "event_id"], "DP_FASE")


@query(f"""
WITH {_EVENTS_SQL}
SELECT event_id, user_id, DP_FASE, ant AS FASE_DO_MES_ANTERIOR, MUDOU_FASE, DP_FASE_MES FROM t""")
def phase_transitions(spark, folder):
    return _transitions(spark, folder).drop("ts")


@query(f"""
WITH {_EVENTS_SQL}
SELECT ts::DATE AS DIA, MUDOU_FASE, DP_FASE_MES, count(*) AS QTD FROM t GROUP BY ALL""")
def transition_matrix(spark, folder):
    rolled = _transitions(spark, folder).withColumn("DIA", F.to_date("ts"))
    return aggregates.counts(rolled, ["DIA", "MUDOU_FASE", "DP_FASE_MES"])


_DAYS = [f"2024-01-{d:02d}" for d in range(1, 29)]


@query(f"WITH {_EVENTS_SQL} SELECT user_id, " + ", ".join(
    f"min(CASE WHEN ts::DATE = DATE '{d}' THEN MUDOU_FASE END) AS \"{d}_code\","
    f" min(CASE WHEN ts::DATE = DATE '{d}' THEN DP_FASE_MES END) AS \"{d}_label\"" for d in _DAYS
) + """, min(CASE WHEN ts < DATE '2024-01-01' OR ts >= DATE '2024-01-29' OR ts IS NULL THEN MUDOU_FASE END) AS "OUTROS_code",
  min(CASE WHEN ts < DATE '2024-01-01' OR ts >= DATE '2024-01-29' OR ts IS NULL THEN DP_FASE_MES END) AS "OUTROS_label" FROM t GROUP BY 1""")
def phase_pivot(spark, folder):
    rolled = _transitions(spark, folder).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return aggregates.pivot_first(rolled, ["user_id"], "day", _DAYS, code="MUDOU_FASE", label="DP_FASE_MES")


@query("""
SELECT event_id, row_number() OVER (w ORDER BY event_type, event_id)::BIGINT AS rn,
  rank() OVER (w ORDER BY event_type)::BIGINT AS r, dense_rank() OVER (w ORDER BY event_type)::BIGINT AS dr
FROM events WINDOW w AS (PARTITION BY user_id)""")
def ranks(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    outputs = {"rn": ordered.row_number(), "r": ordered.rank("event_type"), "dr": ordered.dense_rank("event_type")}
    numbered = ordered.ordered(events, ["user_id"], ["event_type", "event_id"], outputs)
    return numbered.drop("user_id", "event_type")


_PART_ORDER = ["day", "l_extendedprice", "l_partkey", "l_suppkey", "l_linenumber"]


@query("""
WITH i AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate::DATE AS day FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY day, l_extendedprice, l_partkey, l_suppkey, l_linenumber)::BIGINT AS PARCELA,
  dense_rank() OVER (PARTITION BY l_orderkey ORDER BY day)::BIGINT AS DIA_PARCELA,
  min(day) OVER (PARTITION BY l_orderkey) AS DATA_DO_ACORDO,
  first_value(l_extendedprice) OVER (PARTITION BY l_orderkey ORDER BY day, l_extendedprice, l_partkey, l_suppkey, l_linenumber) AS ENTRADA,
  CASE WHEN sum(l_extendedprice) OVER (PARTITION BY l_orderkey) >=
    first_value(l_extendedprice) OVER (PARTITION BY l_orderkey ORDER BY day, l_extendedprice, l_partkey, l_suppkey, l_linenumber) / 0.30
    THEN 'SIM' ELSE 'NÃO' END AS QUITADO
FROM i""")
def installment_numbers(spark, folder):
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", F.to_date("l_shipdate").alias("day")
    )
    numbered = ordered.ordered(
        items, ["l_orderkey"], _PART_ORDER,
        {
            "PARCELA": ordered.row_number(),
            "DIA_PARCELA": ordered.dense_rank("day"),
            "DATA_DO_ACORDO": ordered.first("day"),
            "ENTRADA": ordered.first("l_extendedprice"),
            "__paid": ordered.total("l_extendedprice"),
        },
    )
    settled = F.when(F.col("__paid") >= F.col("ENTRADA") / 0.30, "SIM").otherwise("NÃO")
    return numbered.withColumn("QUITADO", settled).drop("__paid", "day", "l_extendedprice")


@query("""
SELECT o_orderkey, o_custkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1)::INTEGER AS QTDE
FROM orders""")
def count_once(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return windows.count_once(orders, ["o_custkey"], ["day", "o_orderkey"]).drop("day")


_HIGHEST_SQL = shapes.PAYMENTS + """, parts AS (
  SELECT PROCESSO_ID, LINHA, PLANO, VALOR, PAGO_EM, CASE WHEN LINHA = 1 THEN 0.5 ELSE LINHA END::DOUBLE AS NUMERO,
         CASE WHEN LINHA = 1 THEN VALOR / 0.3 ELSE VALOR END AS VALOR_TOTAL,
         CASE WHEN LINHA = 1 THEN VALOR / 0.3 - VALOR ELSE 0 END AS VALOR_RESTANTE
  FROM payments WHERE LINHA <= 5),
highest AS (SELECT PROCESSO_ID, max(NUMERO) AS MAIOR FROM parts GROUP BY 1),
marked AS (
  SELECT p.*, MAIOR, CASE WHEN MAIOR = NUMERO THEN 'SIM' ELSE 'NÃO' END AS E_MAIOR
  FROM parts p JOIN highest h ON p.PROCESSO_ID = h.PROCESSO_ID),
counted AS (
  SELECT *, CASE WHEN NUMERO = 0.5 AND E_MAIOR = 'SIM' THEN 6 WHEN E_MAIOR = 'SIM' AND NUMERO >= 1 THEN 6 - NUMERO ELSE 0 END::INTEGER AS FALTAM
  FROM marked)"""


@query(f"""
WITH {_HIGHEST_SQL}
SELECT PROCESSO_ID, LINHA, VALOR, NUMERO AS NUMERO_PARCELA, MAIOR AS MAIOR_PARCELA, E_MAIOR AS E_MAIOR_PARCELA FROM marked""")
def highest_installment(spark, folder):
    parts = filters.court_plan_parts(shapes.payments(spark, folder))
    marked = installments.highest_part(parts)
    return marked.select("PROCESSO_ID", "LINHA", "VALOR", "NUMERO_PARCELA", "MAIOR_PARCELA", "E_MAIOR_PARCELA")


@query("""
SELECT o_orderkey, n::INTEGER AS PARCELA, (o_orderdate::DATE + ((n - 1) * 30)::INTEGER)::DATE AS VENCIMENTO
FROM (SELECT o_orderkey, o_orderdate, unnest(generate_series(1, o_orderkey % 7)) AS n FROM orders)""")
def installment_schedule(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), (F.col("o_orderkey") % 7).cast("int").alias("left")
    )
    expanded = installments.expand_parts(orders, "left", "PARCELA")
    due = installments.due_date(F.col("day"), F.col("PARCELA"))
    return expanded.select("o_orderkey", "PARCELA", due.alias("VENCIMENTO"))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN o_totalprice * 0.3
       WHEN l_returnflag = 'A' THEN (o_totalprice * (1 - 0.3::DOUBLE)) / 6
       WHEN l_returnflag = 'R' AND l_linenumber <> 7 THEN o_totalprice / (7 - l_linenumber) END AS PROVISAO,
  CASE WHEN l_linenumber = 1 THEN l_extendedprice ELSE (l_extendedprice / 0.3 - l_extendedprice) / 6 END AS PARTE
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def provision_per_installment(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    items = table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    kind = F.when(F.col("l_returnflag") == "A", "CONDENAÇÃO").when(F.col("l_returnflag") == "R", "ACORDO")
    line = F.col("l_linenumber")
    provision = installments.provision_part(kind, line, F.col("o_totalprice"), 7 - line)
    return items.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", provision.alias("PROVISAO"),
        installments.conviction_part_value(line, F.col("l_extendedprice")).alias("PARTE"),
    )


@query("""
SELECT o_orderkey, rn::BIGINT AS rn, months::BIGINT AS gap FROM (
  SELECT o_orderkey, row_number() OVER w AS rn,
    (year(o_orderdate) * 12 + month(o_orderdate)) - (year(lag(o_orderdate) OVER w) * 12 + month(lag(o_orderdate) OVER w))
      - CASE WHEN day(o_orderdate) < day(lag(o_orderdate) OVER w) THEN 1 ELSE 0 END AS months
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))""")
def months_since_previous(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    numbered = ordered.ordered(
        orders, ["o_custkey"], ["day", "o_orderkey"], {"rn": ordered.row_number(), "before": ordered.lag("day")}
    )
    return numbered.select("o_orderkey", "rn", dates.whole_months(F.col("before"), F.col("day")).alias("gap"))


@query("""
SELECT event_id, (SELECT min(p.event_id) FROM events p WHERE p.event_type = 'purchase' AND p.user_id = e.user_id
    AND e.ts BETWEEN p.ts AND p.ts + INTERVAL 150 MINUTE) AS COMPRA
FROM events e""")
def events_after_purchases(spark, folder):
    """The first purchase of the user in whose 150 minutes an event lies; windows of one user overlap."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    held = events.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("DT_INICIO"), (F.col("ts") + F.expr("INTERVAL 150 MINUTES")).alias("DT_FIM"), F.col("event_id").alias("COMPRA")
    )
    return intervals.assign_interval(events, "ts", held, "COMPRA", "COMPRA", ["user_id"]).select("event_id", "COMPRA")


@query("""
SELECT e.event_id, min(p.event_id) AS FALHA FROM events e
LEFT JOIN (SELECT event_id, ts FROM events WHERE event_type = 'error') p ON e.ts BETWEEN p.ts AND p.ts + INTERVAL 10 MINUTE
GROUP BY e.event_id""")
def events_during_failures(spark, folder):
    """The earliest listed failure of any user that lasts while an event happens: one timeline for all rows."""
    events = table(spark, folder, "events").select("event_id", "ts", "event_type")
    held = events.where("event_type = 'error'").select(
        F.col("ts").alias("DT_INICIO"), (F.col("ts") + F.expr("INTERVAL 10 MINUTES")).alias("DT_FIM"), F.col("event_id").alias("FALHA")
    )
    return intervals.assign_interval(events, "ts", held, "FALHA", "FALHA").select("event_id", "FALHA")


@query("""
WITH held AS (SELECT user_id % 20 AS file, ts::DATE AS a, ts::DATE + 2 AS b FROM events WHERE event_type = 'signup' AND event_id % 50 = 0)
SELECT event_id, user_id % 20 AS file, ts::DATE AS day FROM events e
WHERE EXISTS (SELECT 1 FROM held h WHERE h.file = e.user_id % 20 AND e.ts::DATE BETWEEN h.a AND h.b)""")
def events_in_file_windows(spark, folder):
    """Rows whose day lies in one of the windows of their file, which has several."""
    events = table(spark, folder, "events")
    file, day = (F.col("user_id") % 20).alias("file"), F.to_date("ts")
    held = events.where("event_type = 'signup' AND event_id % 50 = 0").select(file, day.alias("DT_INICIO"), F.date_add(day, 2).alias("DT_FIM"))
    return intervals.in_intervals(events.select("event_id", file, day.alias("day")), "day", held, ["file"])


@query("""
SELECT event_id, last_value(CASE WHEN event_type IN ('purchase', 'error') THEN event_type END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id) AS SITUACAO
FROM events""")
def last_known_status(spark, folder):
    """The last status of a user that is known, carried over any number of rows without one."""
    status = F.when(F.col("event_type").isin("purchase", "error"), F.col("event_type"))
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", status.alias("status"))
    return ordered.ordered(events, ["user_id"], ["ts", "event_id"], {"SITUACAO": ordered.known("status")}).select("event_id", "SITUACAO")


@query("""
WITH held AS (SELECT o_custkey, o_orderdate::DATE AS a, (o_orderdate::DATE + (o_orderkey % 200)::INTEGER - 3)::DATE AS b FROM orders),
changes AS (
  SELECT o_custkey, moment, sum(d) AS d FROM (
    SELECT o_custkey, a AS moment, 1 AS d FROM held WHERE a <= b UNION ALL SELECT o_custkey, b + 1, -1 FROM held WHERE a <= b)
  GROUP BY o_custkey, moment HAVING sum(d) <> 0),
stretches AS (
  SELECT o_custkey, lag(moment) OVER w AS a, moment, sum(d) OVER w - d AS depth FROM changes WINDOW w AS (PARTITION BY o_custkey ORDER BY moment))
SELECT o_custkey, a::DATE AS DT_INICIO, (moment - 1)::DATE AS DT_FIM, depth::BIGINT AS PROFUNDIDADE, CASE depth WHEN 0 THEN 'LACUNA' ELSE 'SOBREPOSTO' END AS PROBLEMA
FROM stretches WHERE a IS NOT NULL AND depth <> 1
UNION ALL SELECT o_custkey, a, b, NULL, CASE WHEN a > b THEN 'INVERTIDO' ELSE 'ABERTO' END FROM held WHERE a > b OR a IS NULL OR b IS NULL""")
def customer_periods(spark, folder):
    """Gaps and overlaps of any depth in the periods of each customer."""
    day = F.to_date("o_orderdate")
    held = table(spark, folder, "orders").select(
        "o_custkey", day.alias("DT_INICIO"), F.date_add(day, (F.col("o_orderkey") % 200 - 3).cast("int")).alias("DT_FIM")
    )
    return intervals.check_intervals(held, ["o_custkey"])


@query("""
WITH held AS (SELECT l_suppkey, l_shipdate::TIMESTAMP AS a, l_shipdate::TIMESTAMP + (l_partkey % 9) * INTERVAL 1 DAY + INTERVAL 6 HOUR AS b FROM lineitem),
changes AS (
  SELECT l_suppkey, moment, sum(d) AS d FROM (
    SELECT l_suppkey, a AS moment, 1 AS d FROM held WHERE a <= b UNION ALL SELECT l_suppkey, b + INTERVAL 1 MICROSECOND, -1 FROM held WHERE a <= b)
  GROUP BY l_suppkey, moment HAVING sum(d) <> 0),
stretches AS (
  SELECT l_suppkey, lag(moment) OVER w AS a, moment, sum(d) OVER w - d AS depth FROM changes WINDOW w AS (PARTITION BY l_suppkey ORDER BY moment))
SELECT l_suppkey, a AS DT_INICIO, moment - INTERVAL 1 MICROSECOND AS DT_FIM, depth::BIGINT AS PROFUNDIDADE FROM stretches WHERE a IS NOT NULL""")
def shipments_under_way(spark, folder):
    """How many shipments of a supplier are under way at any time."""
    items, shipped = table(spark, folder, "lineitem"), F.col("l_shipdate").cast("timestamp_ntz")
    return intervals.depths(
        items.select(
            "l_suppkey",
            shipped.alias("DT_INICIO"),
            (shipped + F.make_dt_interval((F.col("l_partkey") % 9).cast("int"), F.lit(6))).alias("DT_FIM"),
        ),
        ["l_suppkey"],
    )
