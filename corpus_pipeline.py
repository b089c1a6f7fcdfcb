"""The corpus pipeline: stages from raw documents to packed bins, each written as Parquet for the next.

Each stage works on all that its predecessor kept. All but the last return the columns of the documents; the last
returns one row per bin, with the documents, first words and sizes of its pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closeworks.llm.decontaminate import decontaminate
from closeworks.llm.jaccard_join import drop_similar
from closeworks.llm.packing import pack_documents
from closeworks.llm.quality_rules import quality_filter
from closeworks.llm.secret_scan import mask_secrets
from closeworks.llm.store import prepared, table, written


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    prepared(spark)
    return quality_filter(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, a similarity of 0.8) the document with the smallest id."""
    prepared(spark)
    return drop_similar(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, table(prepared(spark), sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and their length kept right."""
    prepared(spark)
    masked = mask_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of pieces of the documents."""
    prepared(spark)
    return pack_documents(docs)


STAGES = [
    ("quality rules", good_texts),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: Votes weighed by expectation-maximisation, components and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage but the last is written and read again."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
