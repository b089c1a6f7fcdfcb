"""Column names, order and types."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closeworks.operators import cleaning, schema, unions
from tests.helpers import day, rows


def test_names_are_cleaned_once(spark):
    assert schema.adjust_names(["Data (de) início", "a-b.c_d/e"]) == ["DATA_DE_INÍCIO", "A_B_C_D_E"]
    df = spark.createDataFrame([(1, 2, 3)], ["a|b", "a?b;", "ok"])
    assert schema.adjust_column_names(df).columns == ["A_B", "A_B", "OK"]
    assert schema.adjust_names(["a|b"]) == ["A|B"]


def test_compress_accents_and_snake(spark):
    df = spark.createDataFrame([(1, 2)], ["  código   do  item ", "Ação/Nº (%)"])
    assert schema.compress_column_names(df).columns == ["código do item", "Ação/Nº (%)"]
    assert schema.strip_accents_columns(df).columns == ["  codigo   do  item ", "Acao/No (%)"]
    assert schema.snake_columns(df).columns == ["codigo_do_item", "acao_no"]
    assert schema.snake_columns(df, upper=True).columns == ["CODIGO_DO_ITEM", "ACAO_NO"]


def test_signs_in_names():
    assert schema.plain_letters("N° – Situação ½º") == "Ndeg - Situacao 12o"
    assert schema.without_marks("N° Requisição") == "N° Requisicao"


def test_repeated_names(spark):
    df = spark.createDataFrame([(1, "a", 2, 3)], ["id", "name", "x", "y"]).toDF("id", "name", "id", "id")
    first = schema.dedupe_columns_first(df)
    assert first.columns == ["id", "name"] and rows(first) == [(1, "a")]
    suffixed = schema.dedupe_columns_suffix(df)
    assert suffixed.columns == ["id", "name", "id_1", "id_2"] and rows(suffixed) == [(1, "a", 2, 3)]
    taken = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"]).toDF("id", "id_1", "id")
    assert schema.dedupe_columns_suffix(taken).columns == ["id", "id_1", "id_2"]


def test_selection_helpers(spark):
    a = spark.createDataFrame([(1, 2, 3)], ["x", "y", "z"])
    b = spark.createDataFrame([(4, 5)], ["z", "x"])
    left, right = schema.common_columns(a, b)
    assert left.columns == right.columns == ["x", "z"]
    assert rows(right) == [(5, 4)]
    assert schema.find_columns(a, "x") == ["x"]
    assert schema.existing(a, ["q", "z", "x"]) == ["z", "x"]
    assert schema.insert_after(a, "x", "new", F.lit("")).columns == ["x", "new", "y", "z"]
    assert schema.empty_frame(a, a.schema).count() == 0
    assert schema.rename(a, {"x": "X", "missing": "M"}).columns == ["X", "y", "z"]


def test_conform_fills_and_casts(spark):
    df = spark.createDataFrame([("1", "x", "2024-01-05"), ("a", None, "31")], ["n", "t", "d"])
    found = schema.conform(df, "d date, n int, extra double")
    assert [f.dataType for f in found.schema] == [T.DateType(), T.IntegerType(), T.DoubleType()]
    assert rows(found) == [(day("2024-01-05"), 1, None), (None, None, None)]


def test_missing_columns_are_reported(spark):
    df = spark.createDataFrame([(1,)], ["a"])
    with pytest.raises(ValueError, match="missing"):
        cleaning.to_number(df, ["a", "missing"])


def test_cleaning_on_columns(spark):
    df = spark.createDataFrame(
        [(1, "  a   b ", float("nan"), "1,5", 7.0, "nan", "05/06/24"), (2, None, 2.0, "x", None, "k", None)],
        "id int, t string, f double, m string, n double, z string, d string",
    )
    assert rows(cleaning.compress_values(df, ["t"]).select("id", "t")) == [(1, "a b"), (2, None)]
    assert rows(cleaning.nan_to_null(df).select("id", "f")) == [(1, None), (2, 2.0)]
    assert rows(cleaning.parse_money(df, ["m", "n"]).select("id", "m", "n")) == [(1, 1.5, 7.0), (2, 0.0, 0.0)]
    assert rows(cleaning.null_text(df).select("id", "z")) == [(1, None), (2, "k")]
    assert rows(cleaning.fill_defaults(df, {"n": 1.0, "t": "-"}).select("id", "t", "n")) == [(1, "  a   b ", 7.0), (2, "-", 1.0)]
    assert rows(cleaning.parse_dates(df, ["d"]).select("id", "d")) == [(1, day("2024-05-06")), (2, None)]
    assert rows(cleaning.replace_chars(df, ["m"], ",", ".").select("id", "m")) == [(1, "1.5"), (2, "x")]
    assert rows(cleaning.coerce_ids(df, ["m"], fill_zero=True).select("id", "m")) == [(1, 0), (2, 0)]
    assert rows(cleaning.blank_nulls(df).select("id", "t", "n")) == [(1, "  a   b ", 7.0), (2, "", None)]


def test_timestamps_become_dates(spark):
    df = spark.sql("SELECT 1 AS id, timestamp'2024-01-05 10:00:00' AS a, timestamp_ntz'2024-01-06 11:00:00' AS b")
    assert rows(cleaning.parse_dates(df, ["a", "b"])) == [(1, day("2024-01-05"), day("2024-01-06"))]
    assert rows(cleaning.coerce_dates(df, ["a"]).select("a")) == [(day("2024-01-05"),)]


# ---- unions -------------------------------------------------------------------


def _monthly(spark):
    a = spark.createDataFrame([("jan", "Alice", 100), ("jan", "Bob", 200), ("jan", "Carl", 300)], ["competencia", "name", "value"])
    b = spark.createDataFrame([("fev", "Alice", 50), ("fev", "David", 400)], ["competencia", "name", "value"])
    c = spark.createDataFrame([("mar", "Alice", 50), ("mar", "David", 400)], ["competencia", "name", "%ótra"])
    return a, b, c


def test_union_by_name_pads_missing_columns(spark):
    a, b, c = _monthly(spark)
    found = unions.union_all([a, b, c])
    assert found.columns == ["competencia", "name", "value", "%ótra"]
    assert found.count() == 7
    assert rows(found.filter("competencia = 'mar'")) == [("mar", "Alice", None, 50), ("mar", "David", None, 400)]


def test_harmonised_union(spark):
    old = spark.createDataFrame([(1, "7", 1.5, "a")], "`id processo` int, `Código` string, valor double, obs string")
    new = spark.createDataFrame([(2, 8, 2, "2024-01-05")], "ID_PROCESSO bigint, codigo int, VALOR int, data string").withColumn(
        "data", F.to_date("data")
    )
    repeated = spark.createDataFrame([(3, 9, "x")], "a bigint, b int, c string").toDF("ID processo", "VALOR", "valor")
    found = unions.union_harmonized([old, new, repeated])
    assert found.columns == ["ID_PROCESSO", "CODIGO", "VALOR", "OBS", "DATA"]
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "string", "double", "string", "date"]
    assert rows(found) == [(1, "7", 1.5, "a", None), (2, "8", 2.0, None, day("2024-01-05")), (3, None, 9.0, None, None)]
    cleaned = [unions.clean_snapshot(df) for df in (old, new, repeated)]
    assert unions.type_conflicts(cleaned) == {
        "ID_PROCESSO": ["int", "bigint"], "CODIGO": ["string", "int"], "VALOR": ["double", "int"]
    }


@pytest.mark.parametrize(
    "a, b, wide",
    [
        ("int", "bigint", "bigint"), ("int", "double", "double"), ("float", "double", "double"), ("date", "timestamp", "timestamp"),
        ("date", "timestamp_ntz", "timestamp_ntz"), ("int", "string", "string"), ("date", "int", "string"), ("void", "int", "int"),
    ],
)
def test_wider_types(a, b, wide):
    kind = lambda name: T.StructType.fromDDL(f"c {name}")[0].dataType
    assert unions.wider_type(kind(a), kind(b)) == unions.wider_type(kind(b), kind(a)) == kind(wide)


def test_distinct_union(spark):
    a, b, _ = _monthly(spark)
    assert unions.union_distinct(a.unionAll(a), b.select("value", "name", "competencia")).count() == 5
