"""Stored partial aggregates against totals of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from closeworks.sources import merges, rollups, snapshots
from tests.helpers import day, rows

SCHEMA = "ID int, FASE string, VALOR double, MES_FECH date"
MONTHS = [day(f"2024-0{m}-01") for m in range(1, 6)]
MEASURES = {
    "QTD": rollups.number_of_rows(),
    "COM_VALOR": rollups.filled("VALOR"),
    "SOMA": rollups.total("VALOR"),
    "MEDIA": rollups.average("VALOR"),
    "MENOR": rollups.smallest("VALOR"),
    "MAIOR": rollups.largest("VALOR"),
}


def plainly(df, keys):
    v = F.col("VALOR")
    found = df.groupBy(*keys).agg(F.count(F.lit(1)), F.count(v), F.sum(v), F.avg(v), F.min(v), F.max(v))
    return sorted(rows(found), key=str)


def book(spark, path, seed=1):
    r = random.Random(seed)
    data = [(i, r.choice(["A", "B", None]), r.choice([None, 1.0, 2.0, 8.0]), r.choice(MONTHS)) for i in range(200)]
    snapshots.write_period(spark.createDataFrame([*data, (900, "Z", None, MONTHS[0])], SCHEMA), path)


def test_a_corrected_month_alone_is_read_again(spark, tmp_path):
    path, stored = str(tmp_path / "book"), str(tmp_path / "totals")
    book(spark, path)
    rollups.refresh(snapshots.read_table(spark, path), stored, ["FASE"], MEASURES)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "totals").rglob("*.parquet")}
    fixed = spark.createDataFrame([(1000, "A", 64.0, MONTHS[2]), (1001, "new", 32.0, MONTHS[2])], SCHEMA)
    merges.merge_periods(fixed, path, ["ID"])
    history = snapshots.read_table(spark, path)
    for _ in range(2):
        rollups.refresh(history, stored, ["FASE"], MEASURES, [MONTHS[2]])
        for keys in ([], ["FASE"], ["MES_FECH"], ["MES_FECH", "FASE"]):
            assert sorted(rows(rollups.totals(spark, stored, keys, MEASURES)), key=str) == plainly(history, keys)
    some = rollups.totals(spark, stored, ["FASE"], MEASURES, start="2024-02-01", end="2024-03-31")
    assert sorted(rows(some), key=str) == plainly(history.where(F.col("MES_FECH").isin(MONTHS[1:3])), ["FASE"])
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "totals").rglob("*.parquet")}
    assert {p: t for p, t in files.items() if "2024-03" not in str(p)} == {p: t for p, t in after.items() if "2024-03" not in str(p)}


def test_a_month_without_rows_any_more(spark, tmp_path):
    path, stored = str(tmp_path / "book"), str(tmp_path / "totals")
    book(spark, path)
    history = snapshots.read_table(spark, path)
    rollups.refresh(history, stored, ["FASE"], MEASURES)
    left = history.where(F.col("MES_FECH") != MONTHS[1])
    rollups.refresh(left, stored, ["FASE"], MEASURES, [MONTHS[1], "2030-01-01"])
    for keys in (["FASE"], ["MES_FECH"]):
        assert sorted(rows(rollups.totals(spark, stored, keys, MEASURES)), key=str) == plainly(left, keys)


def test_only_the_wanted_months_are_scanned(spark, tmp_path):
    path, stored = str(tmp_path / "book"), str(tmp_path / "totals")
    book(spark, path)
    rollups.refresh(snapshots.read_table(spark, path), stored, ["FASE"], MEASURES)
    plan = rollups.totals(spark, stored, ["FASE"], {"QTD": MEASURES["QTD"]}, start="2024-04-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(MES_FECH" in plan and "SOMA" not in plan


def test_names_that_clash(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="FASE"):
        rollups.partials(df, ["FASE"], {"FASE": rollups.total("VALOR")})
    assert rollups.partials(df, ["FASE"], MEASURES).count() == 0
