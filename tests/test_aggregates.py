"""Filters, aggregations, pivots and installment plans."""

from pyspark.sql import functions as F

from closeworks.functions import fixed_values as V
from closeworks.operators import aggregates, filters, installments
from tests.helpers import day, rows


def _payments(spark):
    fields = "PROCESSO_ID int, SUB_TIPO string, STATUS_DO_PAGAMENTO string, VALOR double"
    return spark.createDataFrame(
        [
            (1, "FGTS", "Pago", 10.0),
            (1, "PENSÃO - CÍVEL", "PAGO", 5.0),
            (1, "FGTS", "cancelado", 1.0),
            (1, "FGTS", "x PAGAMENTO DEVOLVIDO y", 1.0),
            (1, "FGTS", None, 1.0),
            (1, "DESCONHECIDO", "PAGO", 1.0),
            (1, "INSS/IR - DARF E-SOCIAL", "PAGO", 1.0),
            (2, "ACORDO - CÍVEL", "PAGO", -3.0),
            (3, None, "PAGO", 1.0),
        ],
        fields,
    )


def test_only_valid_payments_stay(spark):
    assert [r["VALOR"] for r in filters.valid_payments(_payments(spark)).collect()] == [10.0, 5.0, -3.0]


def test_class_columns_add_up_to_the_classified_value(spark):
    classified = aggregates.classify_amounts(filters.valid_payments(_payments(spark)))
    classes = [F.coalesce(F.col(c), F.lit(0.0)) for c in V.PAYMENT_CLASSES]
    total = classified.agg(F.sum(sum(classes[1:], classes[0])), F.sum("VALOR")).first()
    assert total[0] == total[1] == 12.0


def test_positive_sums_count_a_pension(spark):
    df = spark.createDataFrame(
        [(1, None, 5.0), (1, None, None), (2, 3.0, -3.0), (3, -1.0, None), (4, 1.0, None)], "id int, a double, pension double"
    )
    assert rows(aggregates.positive_sums(df, ["id"], ["a", "pension"])) == [(1, 0.0, 5.0), (4, 1.0, 0.0)]


def test_valid_guarantees(spark):
    released, kind = day("2024-01-01"), "DEPÓSITO JUDICIAL"
    data = [
        (1, "ATIVO", "LEVANTADA", kind, released),
        (2, None, "LEVANTADA", kind, released),
        (3, "REMOVIDO", "LEVANTADA", kind, released),
        (4, "ATIVO", "CANCELADO", kind, released),
        (5, "ATIVO", "PAGAMENTO DEVOLVIDO", kind, released),
        (6, "ATIVO", None, kind, released),
        (7, "ATIVO", "LEVANTADA", "OUTRO", released),
        (8, "ATIVO", "LEVANTADA", kind, None),
    ]
    df = spark.createDataFrame(
        data, "id int, STATUS string, STATUS_DA_GARANTIA string, TIPO_GARANTIA string, DATA_DE_LEVANTAMENTO_PARTE_CONTRARIA date"
    )
    assert [r["id"] for r in filters.valid_guarantees(df).collect()] == [1]


def test_period_filters(spark):
    months = [(i, day(f"2024-{i:02d}-01")) for i in range(1, 13)] + [(13, None)]
    df = spark.createDataFrame(months, "id int, m date")
    assert [r["id"] for r in filters.in_period(df, "m", "2024-03-01", "2024-05-01").collect()] == [3, 4, 5]
    assert [r["id"] for r in filters.last_months(df, "m", "2024-06-15", 3).collect()] == [4, 5, 6]


def test_flags_and_text(spark):
    df = spark.createDataFrame([(1, 1, "Faturar"), (2, 0, None), (3, None, "x")], "id int, f int, t string")
    assert [r["id"] for r in filters.flagged(df, "f").collect()] == [1]
    assert [r["id"] for r in filters.not_flagged(df, "f").collect()] == [2, 3]
    assert [r["id"] for r in filters.contains(df, "t", "faturar").collect()] == [1]
    parts = [(1, "PARCELA DE ACORDO"), (2, "ÚLTIMA PARCELA DE ACORDO"), (3, "OUTRA"), (4, None)]
    df = spark.createDataFrame(parts, "id int, p string")
    assert [r["id"] for r in df.filter(filters.is_settlement_part(F.col("p"))).collect()] == [1, 2]


def test_pivots(spark):
    df = spark.createDataFrame(
        [("A", 1, 7), ("A", 2, 9), ("A", 3, 4), ("B", 1, 12), ("B", 2, 5), ("B", 9, 30), ("B", None, 2)], "id string, part int, v int"
    )
    wide = aggregates.pivot_sum(df, ["id"], "part", [1, 2, 3], "v")
    assert wide.columns == ["id", "1", "2", "3", aggregates.OTHERS]
    assert rows(wide) == [("A", 7, 9, 4, None), ("B", 12, 5, None, 32)]
    long = aggregates.to_long(wide.withColumn("4", F.lit(None).cast("bigint")), ["id"], "part", "v")
    assert long.count() == 6 and long.agg(F.sum("v")).first()[0] == df.agg(F.sum("v")).first()[0]
    two = aggregates.pivot_first(df, ["id"], "part", [1, 2], x="v", y="part")
    assert two.columns == ["id", "1_x", "1_y", "2_x", "2_y", "OUTROS_x", "OUTROS_y"]


def test_keep_one_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, "c", 1), (2, "z", None)], "k int, v string, m int")
    assert rows(aggregates.keep_one(df, ["k"], [F.desc("m"), "v"])) == [(1, "a", 2), (2, "z", None)]
    assert rows(aggregates.keep_first_n(df, ["k"], [F.desc("m"), "v"], 2)) == [(1, "a", 2, 1), (1, "b", 2, 2), (2, "z", None, 1)]
    plan = aggregates.keep_one(df, ["k"], ["v", "m"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_keep_one_does_not_depend_on_the_order_of_rows(spark):
    data = [(k, m, v, {"x": v}, [v, None]) for k in (1, 2) for m in (None, 5) for v in ("q", "b", None, "b")]
    fields = "k int, m int, v string, p map<string, string>, a array<string>"
    found = {
        tuple(map(str, rows(aggregates.keep_one(spark.createDataFrame(data[i:] + data[:i], fields).repartition(3), ["k"], [F.desc("m")]))))
        for i in range(0, len(data), 3)
    }
    assert len(found) == 1


def test_repeated_keys_shows_all_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    assert [r["v"] for r in aggregates.repeated_keys(df, ["k"]).orderBy("v").collect()] == ["a", "b", "d", "e"]


def test_counts_and_sums(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", None, 0), ("b", 2.0, 1)], "k string, v double, f int")
    assert rows(aggregates.counts(df, ["k"])) == [("a", 2), ("b", 1)]
    assert rows(aggregates.counts(df, ["k"], "n", "v")) == [("a", 1), ("b", 1)]
    assert rows(aggregates.sum_where(df, ["k"], F.col("f") == 1, "v", "s")) == [("a", 1.0), ("b", 2.0)]
    assert rows(aggregates.sums_by(df, ["k"], {"v": "V", "f": "N"})) == [("a", 1.0, 1), ("b", 2.0, 1)]
    assert rows(aggregates.monthly_indicators(df, {"v": "V"}, "k")) == [("a", 1.0), ("b", 2.0)]


def test_history_totals_match_missing_keys(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, k string")
    history = spark.createDataFrame([("x", 5.0), ("x", 6.0), (None, 7.0)], "key string, paid double")
    found = aggregates.history_totals(df, history, {"k": "key"}, "paid", "n", "total")
    assert rows(found) == [(1, "x", 2, 11.0), (2, None, 1, 7.0), (3, "y", 0, 0.0)]


def test_volume_prices(spark):
    tasks = spark.createDataFrame([(i, "O1", "M") for i in range(11)] + [(20, "O2", "M"), (21, "O1", None)], "id int, o string, r string")
    prices = spark.createDataFrame(
        [("O1", "M", "ATÉ 10 PERÍCIAS", 100.0), ("O1", "M", "ENTRE 11 E 30 PERÍCIAS", 90.0), ("O2", "M", "ATÉ 10 PERÍCIAS", 80.0)],
        "o string, r string, band string, price double",
    )
    found = aggregates.volume_price(tasks, prices, {"o": "o", "r": "r"}, "band", "price", "value")
    values = {r["id"]: r["value"] for r in found.collect()}
    assert values[0] == 90.0 and values[20] == 80.0 and values[21] is None and len(values) == 13


# ---- installments -------------------------------------------------------------


def _plans(spark):
    return spark.createDataFrame(
        [
            (1, "PARCELAMENTO 916 - 30%", 300.0),
            (2, "PARCELAMENTO 916 - 30%", 300.0),
            (2, "2ª PARCELA", 100.0),
            (2, "1 ª PARCELA", 100.0),
            (3, "6ª PARCELA", 50.0),
            (4, "SEM NÚMERO", 70.0),
            (5, "7ª PARCELA", 70.0),
        ],
        "PROCESSO_ID int, PARCELAMENTO_CONDENACAO string, VALOR double",
    )


def test_part_numbers(spark):
    numbered = installments.highest_part(_plans(spark)).select("PROCESSO_ID", "NUMERO_PARCELA", "MAIOR_PARCELA", "E_MAIOR_PARCELA")
    assert rows(numbered) == [
        (1, 0.5, 0.5, "SIM"), (2, 0.5, 2.0, "NÃO"), (2, 1.0, 2.0, "NÃO"), (2, 2.0, 2.0, "SIM"), (3, 6.0, 6.0, "SIM"),
        (4, None, None, "NÃO"), (5, 7.0, 7.0, "SIM"),
    ]


def test_remaining_parts_are_expanded(spark):
    counted = installments.remaining_parts(installments.highest_part(installments.plan_amounts(_plans(spark))))
    left = {(r["PROCESSO_ID"], r["NUMERO_PARCELA"]): r["PARCELAS_FALTANTES"] for r in counted.collect()}
    assert left == {(1, 0.5): 6, (2, 0.5): 0, (2, 1.0): 0, (2, 2.0): 4, (3, 6.0): 0, (4, None): 0, (5, 7.0): -1}
    expanded = installments.expand_parts(counted)
    assert expanded.groupBy("PROCESSO_ID").count().orderBy("PROCESSO_ID").collect() == [(1, 6), (2, 4)]
    first = expanded.filter("PROCESSO_ID = 1").first()
    assert abs(first["VALOR_TOTAL"] - 1000) < 1e-9 and abs(first["VALOR_POR_PARCELA"] - 700 / 6) < 1e-9


def test_due_dates_and_provisions(spark):
    df = spark.createDataFrame(
        [(1, "CONDENAÇÃO", 1, 7), (2, "CONDENAÇÃO", 3, 7), (3, "ACORDO", 2, 4), (4, "ACORDO", 1, 0), (5, "OUTRO", 1, 1)],
        "id int, kind string, part int, parts int",
    )
    due = installments.due_date(F.lit("2024-01-01").cast("date"), F.col("part"))
    share = installments.provision_part(F.col("kind"), F.col("part"), F.lit(1000.0), F.col("parts"))
    found = {r[0]: (str(r[1]), r[2]) for r in df.select("id", due, F.round(share, 2)).collect()}
    assert found == {
        1: ("2024-01-01", 300.0), 2: ("2024-03-01", 116.67), 3: ("2024-01-31", 250.0), 4: ("2024-01-01", None), 5: ("2024-01-01", None)
    }
    value = installments.conviction_part_value(F.col("part"), F.lit(300.0))
    assert [round(r[0], 2) for r in df.filter("id < 3").orderBy("id").select(value).collect()] == [300.0, 116.67]
