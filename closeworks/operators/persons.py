"""One person behind several identifiers: rows that share any identifier, directly or through other rows, are of one person.

Identifiers are linked where a row has them together. Their connected components are found by rounds of two steps that hang
every identifier on a smaller one: first all larger neighbours on the smallest, then the smaller ones as well. Each round is written to
the shared folder and read again; only counts and one checksum reach the driver. No identifier's links are collected: the
smallest is found by an aggregate and looked up, so one identifier may have any number of links.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.operators.joins import lookup
from closeworks.operators.schema import quoted
from closeworks.sources.merges import shared_folder


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hung(links: DataFrame, larger: bool) -> DataFrame:
    """Links (a, b), a > b, after one step: neighbours that are larger than a node, or smaller, hang on the smallest around it."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else links
    smallest = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    found = lookup(both, smallest, "a", ["low"], derived=True)
    hung = found.where("b > a" if larger else "b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    if not larger:
        hung = hung.unionAll(smallest.select("a", F.col("low").alias("b")))
    return hung.where("a > b").distinct()


def same_person(links: DataFrame) -> DataFrame:
    """(identifier, person): the smallest identifier that links (a, b) reach, for each that has a link to another."""
    folder = shared_folder(links.sparkSession)
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    now, number, seen = _written(ordered, f"{folder}/0"), 0, None
    while True:
        print_ = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if print_ == seen:
            break
        seen, number = print_, number + 1
        now = _written(_hung(_hung(now, True), False), f"{folder}/{number}")
    roots = now.select(F.col("b").alias("identifier")).distinct()
    return now.toDF("identifier", "person").unionByName(roots.withColumn("person", F.col("identifier")))


def identifiers(columns: Mapping[str, Column]) -> Column:
    """The identifiers of a row as texts that begin with their kind; those that are null are left out."""
    return F.array_compact(F.array(*[F.concat(F.lit(f"{kind}:"), column.cast("string")) for kind, column in columns.items()]))


def with_person(frames: Sequence[DataFrame], column: str, name: str = "PESSOA") -> list[DataFrame]:
    """The frames with the person of each row, from arrays of identifiers in `column`, over all frames together.

    A person is named by the smallest of its identifiers. Rows without any identifier have none.
    """
    def linked(df: DataFrame) -> DataFrame:
        ids = quoted(column)
        several = df.where(F.size(ids) > 1).select(F.get(ids, F.lit(0)).alias("a"), F.explode(ids).alias("b"))
        return several.where("a <> b").distinct()

    links = linked(frames[0])
    for df in frames[1:]:
        links = links.unionAll(linked(df))
    known = same_person(links)
    out = []
    for df in frames:
        own = df.withColumn("__first", F.get(quoted(column), F.lit(0)))
        found = lookup(own, known, {"__first": "identifier"}, {"person": "__person"}, derived=True)
        out.append(found.withColumn(name, F.coalesce("__person", "__first")).select(*map(quoted, [*df.columns, name])))
    return out
