"""Sheets whose types, names and dates change from month to month."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closeworks.functions import dates, text
from closeworks.operators import periods, schema, unions
from closeworks.plans import billing, entries, normalise, staff
from closeworks.sources import dims
from tests.helpers import apply, day, rows


def test_a_number_and_a_text_become_text(spark):
    a, b = spark.sql("SELECT 7 AS id, 1.5D AS v"), spark.sql("SELECT 'A5' AS id, '2,5' AS v, true AS x")
    both = unions.union_all([a, b])
    assert both.schema["id"].dataType == T.StringType()
    assert rows(both) == [("7", "1.5", None), ("A5", "2,5", True)]
    assert rows(unions.union_distinct(a, b.drop("x"))) == [("7", "1.5"), ("A5", "2,5")]


def test_large_ids_keep_their_digits_beside_doubles(spark):
    big = 2**53 + 1
    a, b = spark.sql(f"SELECT {big}L AS id"), spark.sql("SELECT 1.5D AS id")
    assert {r[0] for r in unions.union_all([a, b]).collect()} == {str(big), "1.5"}
    small = unions.union_all([spark.sql("SELECT 3 AS id"), b])
    assert small.schema["id"].dataType == T.DoubleType()


def test_sheets_with_other_headers_share_their_columns(spark):
    first = spark.sql("SELECT 11L AS `Processo - ID`, 'R$ 1.234,50' AS `Valor Pago`, '05/03/2024' AS `Data Pagto`")
    second = spark.sql("SELECT '12_x000D_' AS `PROCESSO ID`, 20.5D AS `VALOR PAGO`, date'2024-04-01' AS `Data  pagto`")
    table = normalise.normalised_table([first, second], ids=["PROCESSO_ID"], money=["VALOR_PAGO"])
    assert table.columns == ["PROCESSO_ID", "VALOR_PAGO", "DATA_PAGTO"]
    assert rows(table) == [(11, 1234.5, day("2024-03-05")), (12, 20.5, day("2024-04-01"))]


def test_eras_with_other_types(spark):
    old = spark.sql("SELECT 1L AS ID_PROCESSO, 12 AS FILIAL, date'2020-01-01' AS MES_FECH")
    new = spark.sql("SELECT '2' AS ID_PROCESSO, 'A5' AS FILIAL, date'2020-02-01' AS MES_FECH")
    both = entries.entries_base(old, new)
    assert both.count() == 2 and {r["FILIAL"] for r in both.collect()} == {"12", "A5"}


def test_text_dates_never_raise(spark):
    df = spark.createDataFrame([("2024-01-05",), ("05/01/2024",), ("n/d",), (None,)], "d string")
    found = periods.assign_period(df, "d", dims.accounting_calendar(spark))
    assert [r["MES_CONTABIL"] for r in found.collect()].count(day("2024-01-01")) == 2
    assert df.select(dates.as_date(df, "d")).count() == 4


def test_terminations_in_files_with_other_dates(spark):
    windows = spark.createDataFrame(
        [("20230202", day("2023-01-01"), day("2023-01-31"))], "ARQUIVO string, DT_INICIO date, DT_FIM date"
    )
    files = [
        spark.createDataFrame([("1", v, "2020-01-01", "HC 20230202.xlsx")], "CPF string, DESLIGAMENTO string, ADMISSAO string, SOURCE string")
        for v in ("2023-01-05", "06/01/2023", "sem data")
    ]
    files.append(spark.sql("SELECT '1' AS CPF, date'2023-01-07' AS DESLIGAMENTO, '?' AS ADMISSAO, 'HC 20230202.xlsx' AS SOURCE"))
    found = staff.reported_terminations(files, windows)
    assert sorted(r["DESLIGAMENTO"] for r in found.collect()) == [day("2023-01-05"), day("2023-01-06"), day("2023-01-07")]


@pytest.mark.parametrize(
    ("written", "number"),
    [("123.7", None), ("123.0", 123), ("123.", 123), ("1.5E2", 150), ("1.55E1", None), (" 7_x000D_", 7), ("9007199254740993", 9007199254740993), ("x", None), ("-4", -4)],
)
def test_ids_are_exact(spark, written, number):
    assert apply(spark, text.coerce_id, [written]) == [number]


def test_placeholder_ids_match_nobody(spark):
    people = spark.createDataFrame([("1", "000.000.000-00"), ("2", "123")], "MATRICULA string, CPF string")
    people = people.withColumn("DATA_DESLIGAMENTO", F.lit("2024-01-01").cast("date"))
    book = spark.createDataFrame([(i, "00000000000") for i in range(5)] + [(9, "00000000123")], "ID_PROCESSO int, PARTE_CONTRARIA_CPF string")
    book = book.withColumns({"MES_FECH": F.lit("2024-01-01").cast("date"), "NOVOS": F.lit(1)})
    managerial = spark.createDataFrame([], "PROCESSO_ID int, PARTE_CONTRARIA_CPF string, MATRICULA string")
    study = staff.termination_study(people, book, managerial)
    assert rows(study.select("MATRICULA", "ID_PROCESSO", "QTDE")) == [("00000001", None, 1), ("00000002", 9, 1)]


def test_prices_that_differ_by_action(spark):
    prices = spark.createDataFrame(
        [("E", "MÉDICA", "X", 100.0), ("E", "MÉDICA", "Y", 300.0), ("F", "MÉDICA", "X", 50.0)],
        "ESCRITORIO string, TIPO_DE_PERICIA string, TIPO_ACAO string, `ATÉ 10 PERÍCIAS` double",
    )
    assert rows(billing.unambiguous_prices(prices).select("ESCRITORIO", "VALOR")) == [("E", None), ("F", 50.0)]
    assert rows(billing.unambiguous_prices(prices, ["TIPO_ACAO"]).select("ESCRITORIO", "TIPO_ACAO", "VALOR")) == [
        ("E", "X", 100.0), ("E", "Y", 300.0), ("F", "X", 50.0)
    ]
    assert rows(billing.ambiguous_prices(prices).select("ESCRITORIO", "MENOR", "MAIOR")) == [("E", 100.0, 300.0)]


def test_letter_case_does_not_tell_columns_apart(spark):
    a, b = spark.sql("SELECT 1 AS Id, 'x' AS nome"), spark.sql("SELECT 2L AS ID, 'y' AS Nome, true AS novo")
    both = unions.union_all([a, b])
    assert both.columns == ["Id", "nome", "novo"] and both.schema["Id"].dataType == T.LongType()
    assert rows(both.select("ID", "nome")) == [(1, "x"), (2, "y")]
    assert rows(unions.union_distinct(a, b.drop("novo"))) == [(1, "x"), (2, "y")]
    assert rows(unions.union_distinct(a, a.toDF("ID", "NOME"))) == [(1, "x")]
    assert rows(entries.entries_base(a.toDF("Id_Processo", "x"), b.select("ID", "Nome").toDF("ID_PROCESSO", "X")).select("id_processo")) == [(1,), (2,)]
    assert schema.spellings([a, b]) == {"Id": ["Id", "ID"], "nome": ["nome", "Nome"], "novo": [None, "novo"]}
    assert unions.type_conflicts([a, b]) == {"Id": ["int", "bigint"]}


def test_two_spellings_in_one_sheet_are_an_error(spark):
    with pytest.raises(ValueError, match="'Id' and 'ID'"):
        unions.union_all([spark.sql("SELECT 1 AS Id, 2 AS ID"), spark.sql("SELECT 3 AS id")])


def test_lost_values_are_counted(spark):
    a = spark.createDataFrame([("1", 1), ("x", None), (None, 3), ("y", 4)], "Codigo string, valor int")
    b = spark.createDataFrame([(1.5,), (None,)], "CODIGO double")
    wanted = "CODIGO bigint, VALOR string, OUTRO date"
    assert sorted(rows(schema.lost_values([a, b], wanted))) == [(0, "CODIGO", 2), (0, "VALOR", 0), (1, "CODIGO", 0)]
    seen = Observation("perdidos")
    assert [r[0] for r in schema.conform_observed(a, wanted, seen).select("CODIGO").collect()] == [1, None, None, None]
    assert seen.get == {"CODIGO": 2, "VALOR": 0}
    assert schema.conform_observed(a.select("valor"), "OUTRO date", Observation()).columns == ["OUTRO"]
