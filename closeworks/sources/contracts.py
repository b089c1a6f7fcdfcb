"""Periods whose columns and types drift, kept as they came beside a contract of what they hold.

A history is a folder with two tables. `rows/v<N>` holds the periods of one shape, partitioned by period, each with the types it was
written with; no file is written again when a later period brings a wider type. `contract` has a row per written
period with the shape's number and schema, and the last row of a period counts. A reader knows from it, without opening
files, which periods have which shape, reads each shape with its own schema, and brings all to the common schema of the
contract. Rows of a period that was written again under another shape are not listed any more, so they are never read.

The contract is written after the rows, so a run that fails before that leaves the old rows of a period readable where its shape
changed, and a run that is repeated ends with the same rows. One job writes a history at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closeworks.operators.filters import in_period
from closeworks.operators.schema import conform, quoted, resolved
from closeworks.operators.unions import wider_type
from closeworks.sources.snapshots import read_table, write_period

LOG = "NUMERO bigint, VERSAO int, ESQUEMA string, PERIODO string"


@dataclass(frozen=True)
class Contract:
    """The shapes of a history by their numbers, the shape of each period, and the writes so far."""

    shapes: dict[int, T.StructType]
    periods: dict[str, int]
    writes: int

    @property
    def schema(self) -> T.StructType:
        """All columns in the order and spelling of first sight, each with the widest type of any listed shape."""
        wide: dict[str, T.StructField] = {}
        for number in sorted(set(self.periods.values())):
            for field in self.shapes[number].fields:
                known = wide.setdefault(field.name.lower(), field)
                wide[field.name.lower()] = T.StructField(known.name, wider_type(known.dataType, field.dataType))
        return T.StructType(list(wide.values()))


def read_contract(spark: SparkSession, path: str) -> Contract:
    """The contract of a history; one without any periods where nothing was written yet.

    What reaches the driver is a row per period and shape that it ever had, which grows with the calendar, not with the rows.
    """
    try:
        log = read_table(spark, f"{path}/contract", LOG)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return Contract({}, {}, 0)
    held = log.groupBy("VERSAO", "PERIODO").agg(F.max("NUMERO").alias("NUMERO"), F.max("ESQUEMA").alias("ESQUEMA")).collect()
    held = sorted(held, key=lambda row: row["NUMERO"])
    return Contract(
        {row["VERSAO"]: T.StructType.fromDDL(row["ESQUEMA"]) for row in held},
        dict(sorted({row["PERIODO"]: row["VERSAO"] for row in held}.items())),
        max((row["NUMERO"] for row in held), default=0),
    )


def write_drifting(df: DataFrame, path: str, period: str = "MES_FECH") -> Contract:
    """Write or replace the periods that `df` holds, with its columns and types as they are, and list them in the contract.

    Columns are written in the spelling that the contract knows. A row without a period is an error, and so is a type of
    the period that differs from the contract's.
    """
    spark = df.sparkSession
    contract = read_contract(spark, path)
    spelt = {field.name.lower(): field.name for number in sorted(contract.shapes) for field in reversed(contract.shapes[number].fields)}
    df = df.select(*[quoted(field.name).alias(spelt.get(lower, field.name)) for lower, field in resolved(df).items()])
    period = spelt.get(period.lower(), period)
    shape = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    for known in contract.shapes.values():
        if known[period].dataType != shape[period].dataType:
            raise TypeError(f"{period} is {shape[period].dataType.simpleString()} here and {known[period].dataType.simpleString()} before")
    ddl = shape.toDDL()
    same = [number for number, known in contract.shapes.items() if known.toDDL() == ddl]
    number = same[0] if same else max(contract.shapes, default=-1) + 1
    periods = [row[0] for row in df.select(quoted(period).cast("string")).distinct().collect()]
    if None in periods:
        raise ValueError(f"rows without {period}")
    if not periods:
        return contract
    write_period(df, f"{path}/rows/v{number}", period)
    log = [(contract.writes + 1, number, ddl, p) for p in sorted(periods)]
    spark.createDataFrame(log, LOG).coalesce(1).write.mode("append").parquet(f"{path}/contract")
    listed = dict(sorted((contract.periods | dict.fromkeys(periods, number)).items()))
    return Contract(contract.shapes | {number: shape}, listed, contract.writes + 1)


def read_drifting(
    spark: SparkSession,
    path: str,
    period: str = "MES_FECH",
    start: date | str | None = None,
    end: date | str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The periods from `start` to `end` in the schema of the contract, or the given columns of it.

    Each shape is one scan that reads its listed periods only. A column that a shape does not have is null there.
    """
    contract = read_contract(spark, path)
    if not contract.periods:
        raise ValueError(f"nothing was written to {path}")
    schema = contract.schema
    if columns is not None:
        known = {field.name.lower(): field for field in schema.fields}
        schema = T.StructType([known[name.lower()] for name in columns])
    scans = []
    for number in sorted(set(contract.periods.values())):
        listed = [p for p, held in contract.periods.items() if held == number]
        shape = contract.shapes[number]
        rows = read_table(spark, f"{path}/rows/v{number}", shape)
        rows = rows.where(quoted(period).isin(*[F.lit(p).cast(shape[period].dataType) for p in listed]))
        scans.append(conform(in_period(rows, period, start, end), schema))
    return reduce(DataFrame.unionAll, scans)


def widened(spark: SparkSession, path: str) -> DataFrame:
    """(COLUNA, TIPO, TIPO_LIDO, PERIODO): each column of each listed period whose type is not the contract's, TIPO null where it is missing."""
    contract = read_contract(spark, path)
    wide = {field.name.lower(): field for field in contract.schema.fields}
    out = []
    for p, number in contract.periods.items():
        own = {field.name.lower(): field.dataType.simpleString() for field in contract.shapes[number].fields}
        out += [(f.name, own.get(lower), f.dataType.simpleString(), p) for lower, f in wide.items() if own.get(lower) != f.dataType.simpleString()]
    return spark.createDataFrame(out, "COLUNA string, TIPO string, TIPO_LIDO string, PERIODO string")
