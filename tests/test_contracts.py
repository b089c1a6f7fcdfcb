"""Histories whose periods differ in columns and types."""

import pytest

from closeworks.sources import contracts
from tests.helpers import day, rows


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


JAN, FEB, MAR = (day(f"2024-0{m}-01") for m in (1, 2, 3))


def history(spark, path):
    contracts.write_drifting(frame(spark, [(1, 10, JAN), (2, None, JAN)], "ID int, VALOR int, MES_FECH date"), path)
    contracts.write_drifting(frame(spark, [("a", 2**60, 3, FEB)], "NOTA string, valor bigint, ID int, mes_fech date"), path, "mes_fech")
    return contracts.write_drifting(frame(spark, [("1,5", 4, MAR)], "Valor string, ID int, MES_FECH date"), path)


def read(spark, path, **options):
    return sorted(rows(contracts.read_drifting(spark, path, **options)), key=str)


def test_periods_keep_their_types_and_are_read_as_the_widest(spark, tmp_path):
    path = str(tmp_path / "book")
    contract = history(spark, path)
    assert contract.schema.simpleString() == "struct<ID:int,VALOR:string,MES_FECH:date,NOTA:string>"
    assert read(spark, path) == [(1, "10", JAN, None), (2, None, JAN, None), (3, str(2**60), FEB, "a"), (4, "1,5", MAR, None)]
    held = {str(p.relative_to(path).parent) for p in (tmp_path / "book" / "rows").rglob("*.parquet")}
    assert held == {f"rows/v{n}/MES_FECH=2024-0{n + 1}-01" for n in range(3)}
    assert read(spark, path, start="2024-02-01", end="2024-02-28", columns=["nota", "ID"]) == [("a", 3)]
    drift = {tuple(r) for r in contracts.widened(spark, path).collect()}
    assert drift == {
        ("VALOR", "int", "string", "2024-01-01"),
        ("NOTA", None, "string", "2024-01-01"),
        ("VALOR", "bigint", "string", "2024-02-01"),
        ("NOTA", None, "string", "2024-03-01"),
    }


def test_a_period_written_again_under_another_shape(spark, tmp_path):
    path = str(tmp_path / "book")
    history(spark, path)
    before = {p for p in (tmp_path / "book").rglob("*.parquet") if "2024-03" not in str(p)}
    for _ in range(2):
        contract = contracts.write_drifting(frame(spark, [(5, 7, MAR)], "ID int, VALOR int, MES_FECH date"), path)
        # text is gone from the listed periods, so numbers are numbers again
        assert contract.schema["VALOR"].dataType.simpleString() == "bigint"
        assert read(spark, path) == [(1, 10, JAN, None), (2, None, JAN, None), (3, 2**60, FEB, "a"), (5, 7, MAR, None)]
    assert before - {p for p in (tmp_path / "book").rglob("*.parquet")} == set()


def test_scans_read_the_wanted_periods_and_columns_only(spark, tmp_path):
    path = str(tmp_path / "book")
    history(spark, path)
    plan = contracts.read_drifting(spark, path, start="2024-02-01", columns=["ID"])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    # the shape of January alone is not even scanned
    assert len(scans) == 2 and "VALOR" not in plan and "NOTA" not in plan
    assert all("PartitionFilters: [isnotnull(MES_FECH" in scan and "DataFilters: []" in scan for scan in scans)


def test_what_is_refused_and_what_is_empty(spark, tmp_path):
    path = str(tmp_path / "book")
    with pytest.raises(ValueError, match="nothing was written"):
        contracts.read_drifting(spark, path)
    empty = frame(spark, [], "ID int, MES_FECH date")
    assert contracts.write_drifting(empty, path).periods == {}
    history(spark, path)
    assert len(contracts.write_drifting(empty, path).periods) == 3
    with pytest.raises(ValueError, match="without MES_FECH"):
        contracts.write_drifting(frame(spark, [(1, None)], "ID int, MES_FECH date"), path)
    with pytest.raises(TypeError, match="MES_FECH is string"):
        contracts.write_drifting(frame(spark, [(1, "2024-01-01")], "ID int, MES_FECH string"), path)
    with pytest.raises(ValueError, match="letter case"):
        contracts.write_drifting(frame(spark, [(1, 2, JAN)], "ID int, id int, MES_FECH date"), path)
    assert len(read(spark, path)) == 4
