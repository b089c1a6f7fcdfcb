"""Totals from stored partial aggregates: a new or corrected period is read once, all others only as what is stored of them.

A rollup holds a row per period and combination of keys, with the parts that each measure is combined from: sums, counts,
smallest and largest values, and both sum and count for an average. It is partitioned by period like the history, so
totals of any periods and any of the keys come from a table that grows with the combinations, not with the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closeworks.operators.filters import in_period
from closeworks.operators.schema import quoted
from closeworks.sources.snapshots import read_table, write_period

ROWS = "__rows"


@dataclass(frozen=True)
class Measure:
    """A measure over a column, which for `rows` is none."""

    kind: str
    column: str = ""

    def parts(self, name: str) -> dict[str, Column]:
        """What is stored of a period."""
        value = quoted(self.column) if self.column else F.lit(1)
        made = {"total": F.sum, "smallest": F.min, "largest": F.max, "rows": F.count, "filled": F.count}
        if self.kind == "average":
            return {f"{name}__sum": F.sum(value), f"{name}__filled": F.count(value)}
        return {name: made[self.kind](value)}

    def combined(self, name: str) -> Column:
        """The measure from what is stored."""
        if self.kind == "average":
            return F.try_divide(F.sum(quoted(f"{name}__sum")), F.sum(quoted(f"{name}__filled")))
        return {"smallest": F.min, "largest": F.max}.get(self.kind, F.sum)(quoted(name))


def total(column: str) -> Measure:
    return Measure("total", column)


def average(column: str) -> Measure:
    return Measure("average", column)


def smallest(column: str) -> Measure:
    return Measure("smallest", column)


def largest(column: str) -> Measure:
    return Measure("largest", column)


def filled(column: str) -> Measure:
    """Values that are not null."""
    return Measure("filled", column)


def number_of_rows() -> Measure:
    return Measure("rows")


def partials(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Measure], period: str = "MES_FECH") -> DataFrame:
    """A row per period and keys with the parts of the measures and the rows they are of. Rows without a period are left out."""
    taken = {part for name, measure in measures.items() for part in measure.parts(name)} & {period, ROWS, *keys}
    if taken:
        raise ValueError(f"measures named like keys: {sorted(taken)}")
    parts = [column.alias(part) for name, measure in measures.items() for part, column in measure.parts(name).items()]
    return df.where(quoted(period).isNotNull()).groupBy(*map(quoted, [period, *keys])).agg(*parts, F.count(F.lit(1)).alias(ROWS))


def refresh(
    history: DataFrame,
    path: str,
    keys: Sequence[str],
    measures: Mapping[str, Measure],
    periods: Sequence[date | str] | None = None,
    period: str = "MES_FECH",
) -> None:
    """Store the parts of the given periods of the history, by default of all that it holds, in place of those stored before.

    Only these periods are read. A given period without rows is stored as one empty row, so that what was stored of it is replaced.
    """
    rows = history
    if periods is not None:
        kind = history.schema[period].dataType
        rows = history.where(quoted(period).isin(*[F.lit(p).cast(kind) for p in periods]))
    new = partials(rows, keys, measures, period)
    if periods:
        listed = F.explode(F.array(*[F.lit(p).cast(kind) for p in periods])).alias(period)
        empty = history.sparkSession.range(1).select(listed, F.lit(0).cast("bigint").alias(ROWS))
        new = new.unionByName(empty, allowMissingColumns=True)
    write_period(new, path, period)


def totals(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    measures: Mapping[str, Measure],
    period: str = "MES_FECH",
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """The measures per combination of `keys`, which may name the period, over the periods from `start` to `end`."""
    stored = in_period(read_table(spark, path), period, start, end).where(f"{ROWS} > 0")
    return stored.groupBy(*map(quoted, keys)).agg(*[measure.combined(name).alias(name) for name, measure in measures.items()])
