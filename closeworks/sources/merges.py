"""Corrections merged into a stored history: only the periods they touch are read and written again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closeworks.operators.joins import merge_update
from closeworks.operators.schema import quoted
from closeworks.sources.dims import MAX_BROADCAST_ROWS
from closeworks.sources.snapshots import read_table, write_period, write_table


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder that the cluster names in spark.checkpoint.dir; a local session without one gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        named = tempfile.mkdtemp(prefix="closeworks-")
    return f"{named.rstrip('/')}/closeworks/{uuid.uuid4().hex}"


def merge_periods(
    updates: DataFrame,
    path: str,
    keys: Sequence[str],
    period: str = "MES_FECH",
    how: str = "outer",
    columns: Sequence[str] | None = None,
    null_overwrites: bool = False,
) -> None:
    """Merge rows into the history at `path`, which is partitioned by period. For the way values win see `merge_update`.

    `updates` holds each key of a period once. The periods it names are the only ones that are read, by pruning of partitions, and
    replaced; files of all others stay as they are. Updates and merged periods are written beside the history first and then put
    in its place, so that a run that fails before leaves the history as it was, and a run that is repeated ends with the same
    rows. An update without a period is an error, as is one that is not in the history's columns.
    """
    spark = updates.sparkSession
    stored = read_table(spark, path)
    strange = sorted(set(updates.columns) - set(stored.columns))
    if strange:
        raise ValueError(f"columns not in the history: {strange}")
    beside = shared_folder(spark)
    write_table(updates, f"{beside}/updates")
    new = spark.read.schema(updates.schema).parquet(f"{beside}/updates")
    if new.where(quoted(period).isNull()).limit(1).count():
        raise ValueError(f"updates without {period}")
    touched = new.select(quoted(period).cast(stored.schema[period].dataType).alias(period)).distinct()
    if touched.count() <= MAX_BROADCAST_ROWS:
        touched = F.broadcast(touched)
    old = stored.join(touched, period, "left_semi")
    merged = merge_update(old, new, [*keys, period], how, columns, null_overwrites).select(*map(quoted, stored.columns))
    write_table(merged, f"{beside}/merged")
    write_period(spark.read.schema(merged.schema).parquet(f"{beside}/merged"), path, period)
