"""Tables that a job writes and reads again: they cut its lineage and are kept where all executors see them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from closeworks.session import configure

#: Rows and bytes that Python on the executors gets at once, as texts may be long.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

FOLDER = "spark.checkpoint.dir"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that these operators count on."""
    for name, value in BATCHES.items():
        spark.conf.set(name, value)
    return configure(spark)


def folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names; only a session without one, as in tests, gets its own."""
    named = spark.conf.get(FOLDER, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = tempfile.mkdtemp(prefix="closeworks-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{folder(spark)}/closeworks/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read from a table in the shared folder."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
