"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closeworks.llm import warc
from closeworks.llm.decontaminate import contamination_report
from closeworks.llm.fill_middle import fill_middle_report
from closeworks.llm.hard_negatives import hard_negatives
from closeworks.llm.jaccard_join import similar_groups
from closeworks.llm.license_scan import find_licences
from closeworks.llm.lsh_forest import near_duplicates
from closeworks.llm.packing import pack_documents
from closeworks.llm.perspectives import rotate
from closeworks.llm.quality_rules import quality_report
from closeworks.llm.secret_scan import secret_report
from closeworks.llm.sql import SQL
from closeworks.llm.store import new_path, prepared, table, written
from closeworks.llm.suffix_dedup import repeats_report
from closeworks.llm.url_filter import judge_urls


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(prepared(spark), sf_dir, "documents"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(prepared(spark), sf_dir, "pages").select("page_id", "url", "html")
    return judge_urls(pages).drop("url", "html")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(prepared(spark), "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    records = written(warc.measured(warc.read(spark, path), payload=False), "records")
    return warc.captures_report(warc.assemble(records))


def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rotate(table(prepared(spark), sf_dir, "conversations"))
    mask = F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return rows.withColumn("mask", F.concat_ws(",", mask))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(prepared(spark), sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_report(table(prepared(spark), sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licences(table(prepared(spark), sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(prepared(spark), sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(prepared(spark), sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle_report(table(prepared(spark), sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_, label = F.col("vec_id"), F.col("label").cast("bigint")
    rows = table(prepared(spark), sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(rows, id_ % 100 == 0)


def op13_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(prepared(spark), sf_dir, "documents"))


__all__ = ["QUERIES", "SQL"]
QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_warc,
        op3_perspectives,
        op4_secret_scan,
        op5_quality_rules,
        op6_suffix_dedup,
        op7_license_scan,
        op8_packing,
        op9_decontamination,
        op10_jaccard_join,
        op11_fill_middle,
        op12_hard_negatives,
        op13_lsh_forest,
    )
}
