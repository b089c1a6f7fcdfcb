"""Monthly snapshots as one table partitioned by closing month, and split outputs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closeworks.functions.dates import name_date
from closeworks.operators.filters import in_period
from closeworks.operators.schema import quoted


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, merge_schema: bool = False
) -> DataFrame:
    """Parquet table. For snapshots with different columns name the full schema; merging the
    schemas of all files instead opens every file and is for small tables."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; without a schema the types are inferred, which reads the data twice."""
    reader = spark.read.option("header", "true")
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    return reader.schema(schema).csv(path)


def read_snapshots(
    spark: SparkSession,
    path: str,
    period: str = "MES_FECH",
    start: date | str | None = None,
    end: date | str | None = None,
    schema: T.StructType | str | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Snapshots from `start` to `end`; only the directories of those periods are read."""
    return in_period(read_table(spark, path, schema, merge_schema), period, start, end)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_period(df: DataFrame, path: str, period: str = "MES_FECH", mode: str = "overwrite") -> None:
    """Write snapshots by period; overwriting replaces only the periods that `df` holds.

    Rebalancing gives each period few files of even size, however large one period is.
    """
    (
        df.hint("rebalance", period)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period)
        .parquet(path)
    )


def file_safe(col: Column) -> Column:
    """Text that can be part of a path: blanks to `_`, slashes to `-`, the rest dropped."""
    name = F.regexp_replace(F.trim(col), r"[\\*?:\"<>|]", "")
    return F.translate(name, " /", "_-")


def write_split(df: DataFrame, key: str, path: str, form: str = "csv", mode: str = "overwrite") -> None:
    """One directory per value of `key`, rows without a value left out.

    A value with a large share of the rows is written as several files.
    """
    split = df.filter(quoted(key).isNotNull()).withColumn("ARQUIVO", file_safe(quoted(key)))
    writer = split.hint("rebalance", "ARQUIVO").write.mode(mode).partitionBy("ARQUIVO")
    if form == "csv":
        writer = writer.option("header", "true")
    writer.format(form).save(path)


def snapshot_copy(spark: SparkSession, source: str, target: str, run_date: date | str) -> None:
    """Copy of a table under the given date."""
    copy = read_table(spark, source).withColumn("DATA_COPIA", F.lit(run_date).cast("date"))
    copy.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "DATA_COPIA"
    ).parquet(target)


def tag_source_period(
    df: DataFrame,
    name: Column,
    pattern: str = r"(\d{8})\.xlsx$",
    layout: str = "yyyyMMdd",
) -> DataFrame:
    """Add SOURCE, the date in its name as DATA_ARQUIVO and its month as MES_REF."""
    day = name_date(name, pattern, layout)
    return df.withColumns({"SOURCE": name, "DATA_ARQUIVO": day, "MES_REF": F.trunc(day, "MM")})


def named_like(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Rows of files whose name matches a regular expression."""
    return df.filter(F.col(name).rlike(pattern))
