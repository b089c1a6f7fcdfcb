"""Corrections of a stored history."""

import pytest

from closeworks.sources import merges, snapshots
from tests.helpers import day, rows

SCHEMA = "ID int, VALOR double, NOTA string, MES_FECH date"


def history(spark, path):
    data = [(i, float(i), f"n{i}", day(f"2024-0{m}-01")) for m in (1, 2, 3) for i in range(5)]
    snapshots.write_period(spark.createDataFrame(data, SCHEMA), path)
    return data


def files(path):
    return {p.parent.name: {q.name for q in p.parent.glob("*.parquet")} for p in path.rglob("*.parquet")}


def read(spark, path):
    return sorted(rows(snapshots.read_table(spark, path).select("ID", "VALOR", "NOTA", "MES_FECH")), key=str)


def test_only_touched_periods_are_written(spark, tmp_path):
    path = tmp_path / "book"
    data = history(spark, str(path))
    before = files(path)
    feb, apr = day("2024-02-01"), day("2024-04-01")
    updates = spark.createDataFrame([(1, 10.0, None, feb), (77, 7.0, "new", feb), (1, 4.0, "april", apr)], SCHEMA)
    expected = {(r[0], r[3]): r for r in data} | {(1, feb): (1, 10.0, "n1", feb), (77, feb): (77, 7.0, "new", feb), (1, apr): (1, 4.0, "april", apr)}
    for _ in range(2):  # a run that is repeated changes nothing
        merges.merge_periods(updates, str(path), ["ID"])
        assert read(spark, str(path)) == sorted(expected.values(), key=str)
    after = files(path)
    for month in ("MES_FECH=2024-01-01", "MES_FECH=2024-03-01"):
        assert after[month] == before[month]
    assert after["MES_FECH=2024-02-01"] != before["MES_FECH=2024-02-01"] and "MES_FECH=2024-04-01" in after


def test_matched_rows_only_and_nulls_that_win(spark, tmp_path):
    path = str(tmp_path / "book")
    history(spark, path)
    updates = spark.createDataFrame([(1, None, "x", day("2024-01-01")), (99, 1.0, "x", day("2024-01-01"))], SCHEMA)
    merges.merge_periods(updates, path, ["ID"], how="left", columns=["VALOR"], null_overwrites=True)
    january = [r for r in read(spark, path) if r[3] == day("2024-01-01")]
    assert len(january) == 5 and (1, None, "n1", day("2024-01-01")) in january


def test_nothing_is_touched_by_empty_or_wrong_updates(spark, tmp_path):
    path = tmp_path / "book"
    data = history(spark, str(path))
    before = files(path)
    merges.merge_periods(spark.createDataFrame([], SCHEMA), str(path), ["ID"])
    with pytest.raises(ValueError, match="without MES_FECH"):
        merges.merge_periods(spark.createDataFrame([(1, 1.0, "x", None)], SCHEMA), str(path), ["ID"])
    with pytest.raises(ValueError, match="OUTRA"):
        merges.merge_periods(spark.createDataFrame([(1, day("2024-01-01"), 3)], "ID int, MES_FECH date, OUTRA int"), str(path), ["ID"])
    assert files(path) == before and read(spark, str(path)) == sorted(data, key=str)
