"""Joins, merges and calendars."""

import pytest
from pyspark.sql import functions as F

from closeworks.operators import joins, periods
from closeworks.sources import dims
from tests.helpers import day, rows

SOURCE = [(41, "Ines", "198806", 70, 0), (41, "Ines", "198807", 71, 0), (52, "Otto", "198807", 15, 1), (63, "Uma", "198809", 9, 0)]
NEW = [(41, "Ines", "198806", 88, 0), (52, "Otto", "198807", 15, 1)]
FIELDS = "id bigint, nome string, mes string, valor bigint, encerrado bigint"


def test_coalescing_merge_updates_matched_rows(spark):
    source, new = spark.createDataFrame(SOURCE, FIELDS), spark.createDataFrame(NEW, FIELDS)
    merged = joins.merge_update(source, new, ["id", "mes"])
    assert {(r["id"], r["mes"]): r["valor"] for r in merged.collect()} == {
        (41, "198806"): 88, (41, "198807"): 71, (52, "198807"): 15, (63, "198809"): 9
    }
    assert merged.count() == source.count()


def test_merge_of_listed_columns_lets_null_win(spark):
    source = spark.createDataFrame(SOURCE, FIELDS)
    new = spark.createDataFrame([(41, "Zoe", "198806", None, 1)], FIELDS)
    merged = joins.merge_update(source, new, ["id", "mes"], columns=["valor", "encerrado"], null_overwrites=True)
    changed = merged.filter("id = 41 AND mes = '198806'").first()
    assert (changed["nome"], changed["valor"], changed["encerrado"]) == ("Ines", None, 1)


@pytest.mark.parametrize("how, ids", [("left", [1, 2]), ("inner", [2]), ("right", [2, 3]), ("outer", [1, 2, 3])])
def test_merge_keeps_keys_for_every_kind_of_join(spark, how, ids):
    source = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    merged = joins.merge_update(source, new, ["id"], how)
    assert sorted(r["id"] for r in merged.collect()) == ids


def test_null_keys_match_nothing_in_a_merge(spark):
    source = spark.createDataFrame([(None, "a"), (1, "b")], "id int, v string")
    new = spark.createDataFrame([(None, "X"), (1, "B")], "id int, v string")
    assert rows(joins.merge_update(source, new, ["id"])) == [(1, "B"), (None, "a")]
    assert rows(joins.merge_update(source, new, ["id"], how="outer")) == [(1, "B"), (None, "X"), (None, "a")]
    for derived in (False, True):
        assert rows(joins.lookup(source, new, "id", {"v": "w"}, derived=derived)) == [(1, "b", "B"), (None, "a", None)]


def test_lookup_never_multiplies_and_can_match_nulls(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, k string")
    dim = spark.createDataFrame([("x", 10), (None, 20)], "key string, v int")
    assert rows(joins.lookup(df, dim, {"k": "key"}, {"v": "w"})) == [(1, "x", 10), (2, None, None), (3, "y", None)]
    assert rows(joins.lookup(df, dim, {"k": "key"}, {"v": "w"}, null_safe=True)) == [(1, "x", 10), (2, None, 20), (3, "y", None)]
    assert rows(joins.inner_lookup(df, dim, {"k": "key"}, ["v"])) == [(1, "x", 10)]


def test_lookup_replaces_a_column_of_the_same_name(spark):
    df = spark.createDataFrame([(1, "old")], "id int, v string")
    dim = spark.createDataFrame([(1, "new")], "id int, v string")
    assert rows(joins.lookup(df, dim, "id", ["v"])) == [(1, "new")]


def test_full_outer_join_fills_measures(spark):
    a = spark.createDataFrame([(1, "x", 5.0), (2, "x", 6.0)], "id int, d string, a double")
    b = spark.createDataFrame([(2, "x", 7.0), (3, "y", 8.0)], "id int, d string, b double")
    assert rows(joins.full_outer_coalesce(a, b, ["id", "d"])) == [(1, "x", 5.0, 0.0), (2, "x", 6.0, 7.0), (3, "y", 0.0, 8.0)]


def test_membership(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    history = spark.createDataFrame([(2,), (2,), (3,)], "id int")
    assert rows(joins.flag_exists(df, history, ["id"], "known")) == [(1, False), (2, True)]
    assert rows(joins.known_only(df, history, ["id"])) == [(2,)]
    assert rows(joins.unknown_only(df, history, ["id"])) == [(1,)]


def test_refresh_takes_all_amounts_on_the_latest_closed_row(spark):
    book = spark.createDataFrame(
        [
            (1, day("2024-01-01"), 1, 5.0, 1.0, day("2023-12-01"), 6.0),
            (1, day("2024-02-01"), 1, 5.0, 1.0, day("2023-12-01"), 6.0),
            (1, day("2024-03-01"), 0, 5.0, 1.0, day("2023-12-01"), 6.0),
            (2, day("2024-02-01"), 1, 7.0, 2.0, day("2023-11-01"), 9.0),
            (3, day("2024-02-01"), 0, 8.0, 0.0, None, 8.0),
        ],
        "ID_PROCESSO int, MES_FECH date, ENCERRADOS int, ACORDO double, PENSAO double, DT_ULT_PGTO date, TOTAL_PAGAMENTOS double",
    )
    totals = spark.createDataFrame([(1, 50.0, 3.0, day("2024-04-01"))], "ID_PROCESSO int, ACORDO double, PENSAO double, DT_ULT_PGTO date")
    found = rows(joins.refresh_closed(book, totals, ["ACORDO", "PENSAO"]))
    assert found[0][3:] == (5.0, 1.0, day("2023-12-01"), 6.0)
    assert found[1][3:] == (50.0, 3.0, day("2024-04-01"), 53.0)
    assert found[2][3:] == (5.0, 1.0, day("2023-12-01"), 6.0)
    # Closed without any payment: nothing paid, but the known date stays.
    assert found[3][3:] == (0.0, 0.0, day("2023-11-01"), 0.0)
    assert found[4][3:] == (8.0, 0.0, None, 8.0)


def test_organisation_with_override(spark):
    df = spark.createDataFrame([(1, 10, "EMPRESA A"), (2, 10, "EMPRESA B"), (3, 99, "EMPRESA A")], "id int, cc int, empresa string")
    units = spark.createDataFrame([(10, "LOJA")], "CENTRO_DE_CUSTO int, BU string")
    areas = spark.createDataFrame(
        [(10, "desc", "vp", "dir", "ana", "area")],
        "CENTRO int, DESCRICAO string, NOME2 string, NOME3 string, NOME_RESPONSAVEL string, AREA_FUNCIONAL string",
    )
    found = joins.org_lookup(df, units, areas, "cc", "empresa", ("EMPRESA B", "B", "BB"))
    chosen = found.select("id", "BU", "VP", "DIRETORIA", "RESPONSAVEL_AREA", "AREA_FUNCIONAL", "DESCRICAO_CENTRO_CUSTO")
    assert rows(chosen) == [
        (1, "LOJA", "vp", "dir", "ANA", "area", "desc"), (2, "B", "B", "B", "B", "BB", "desc"), (3,) + (None,) * 6
    ]


def test_discounts_apply_to_listed_tasks_only(spark):
    df = spark.createDataFrame([(1, "T1", "A"), (2, "T1", "X"), (3, "T2", "A"), (4, "T1", None)], "id int, task string, office string")
    discounts = spark.createDataFrame([("T1", 0.5), ("T2", 0.9)], "QUESITO string, VALOR double")
    found = joins.discount_for(df, discounts, "task", "office", ["T1"], ["X"])
    assert rows(found.select("id", "DESCONTO")) == [(1, 0.5), (2, None), (3, None), (4, 0.5)]


# ---- calendars ----------------------------------------------------------------


def test_calendar_is_checked(spark):
    faulty = dims.dim_from_rows(
        spark,
        [
            ("2024-01-01", "2023-12-20", "2024-01-19"),
            ("2024-02-01", "2024-01-25", "2024-02-19"),
            ("2024-03-01", "2024-02-10", "2024-03-19"),
            ("2024-04-01", "2024-05-20", "2024-04-19"),
            ("2024-05-01", "2024-04-20", "2024-05-19"),
        ],
        "MES_CONTABIL date, DT_INICIO date, DT_FIM date",
    )
    found = {str(r["MES_CONTABIL"]): r["PROBLEMA"] for r in periods.check_calendar(faulty).collect()}
    assert found == {"2024-02-01": "LACUNA", "2024-03-01": "SOBREPOSTO", "2024-04-01": "INVERTIDO"}


def test_the_shipped_calendar_has_one_known_gap(spark):
    found = periods.check_calendar(dims.accounting_calendar(spark)).collect()
    assert [(str(r["MES_CONTABIL"]), r["PROBLEMA"]) for r in found] == [("2022-09-01", "LACUNA")]


def test_a_date_gets_one_month_or_none(spark):
    calendar = dims.accounting_calendar(spark)
    days = ["2018-11-20", "2018-11-21", "2019-12-19", "2019-12-20", "2020-06-01", "2022-01-01", "2024-12-19", "2025-05-21", "2030-01-01", None]
    df = spark.createDataFrame([(i, day(d)) for i, d in enumerate(days)], "id int, d date")
    found = {r["id"]: r["MES_CONTABIL"] for r in periods.assign_period(df, "d", calendar).collect()}
    expected = ["2018-11-01", "2018-12-01", "2019-12-01", "2020-01-01", "2020-06-01", None, "2025-01-01", "2025-05-01", None, None]
    assert [found[i] for i in range(len(days))] == [day(e) for e in expected]


def test_overlaps_go_to_the_earliest_month(spark):
    calendar = dims.dim_from_rows(
        spark, [("2024-01-01", "2024-01-01", "2024-02-10"), ("2024-02-01", "2024-02-01", "2024-02-29")],
        "MES_CONTABIL date, DT_INICIO date, DT_FIM date",
    )
    df = spark.createDataFrame([(day("2024-02-10"),), (day("2024-02-11"),)], "d date")
    assert rows(periods.assign_period(df, "d", calendar)) == [
        (day("2024-02-10"), day("2024-01-01")), (day("2024-02-11"), day("2024-02-01"))
    ]


def test_last_second_of_a_month_belongs_to_it(spark):
    df = spark.sql("SELECT timestamp'2018-11-20 23:59:59' AS t")
    assert periods.assign_period(df, "t", dims.accounting_calendar(spark)).first()["MES_CONTABIL"] == day("2018-11-01")


def test_file_months_and_windows(spark):
    files = spark.createDataFrame([("20230201",), ("20230220",), ("20230221",), ("x",)], "f string")
    months = periods.file_month(files, "f", dims.file_months(spark))
    listed = [("20230201", day("2023-01-01")), ("20230220", day("2023-02-01"))]
    assert rows(months) == [*listed, ("20230221", day("2023-02-01")), ("x", None)]
    strict = periods.file_month(files, "f", dims.file_months(spark), unlisted_by_date=False)
    assert rows(strict) == [*listed, ("20230221", None), ("x", None)]
    events = spark.createDataFrame(
        [(1, "20230202", day("2023-01-31")), (1, "20230202", day("2023-01-31")), (2, "20230202", day("2023-02-01")), (3, "20990101", day("2023-01-01"))],
        "id int, f string, d date",
    )
    assert rows(periods.in_source_window(events, "f", "d", dims.hr_file_windows(spark))) == [(1, "20230202", day("2023-01-31"))]


def test_cut_calendar_follows_the_months(spark):
    cuts = {r["MES_FECH"]: r["DIA_CORTE"] for r in dims.cut_calendar(spark).collect()}
    assert cuts[day("2023-01-01")] == day("2023-02-01") and cuts[day("2025-01-01")] == day("2025-01-22")
    assert len(cuts) == 50


def test_last_rows_of_a_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "a", 2), (4, "b", 1), (5, "b", None)], "id int, k string, m int")
    assert [r[0] for r in rows(joins.last_per_key(df, "k", "m").select("id"))] == [2, 3, 4]


def test_literal_tables_are_small_enough_to_broadcast(spark):
    small = dims.dim_from_rows(spark, [(1, "a")], "k int, v string")
    plan = spark.range(5).join(small, F.col("id") == F.col("k"))._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
