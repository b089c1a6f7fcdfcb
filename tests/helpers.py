"""Small helpers of the tests."""

from datetime import date

from pyspark.sql import functions as F


def day(text):
    return None if text is None else date.fromisoformat(text)


def rows(df, *order):
    """Rows as tuples, in the given order or sorted by their text."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r)) if not order else found


def column(df, value, key="id"):
    """Values of an expression by key."""
    return {r[0]: r[1] for r in df.select(key, value.alias("v")).collect()}


def apply(spark, change, values, kind="string"):
    """Results of a column function on single values, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"id int, v {kind}")
    found = column(df, change(F.col("v")))
    return [found[i] for i in range(len(values))]
