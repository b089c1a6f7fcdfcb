"""Registered corpus queries against their SQL, and the stages of the pipeline against plain Python."""

import os

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from closeworks.llm import jaccard_join, quality_rules, secret_scan
from closeworks.llm.queries import QUERIES, SQL
from closeworks.llm.store import table, written
from tests.llm import test_decontaminate, test_jaccard_join, test_quality_rules
from tools.check_queries import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    ours = QUERIES[name](spark, FOLDER).toArrow()
    assert ours.num_rows > 0
    if name in SQL:
        assert difference(ours, connect(FOLDER).sql(SQL[name]).to_arrow_table()) is None


@pytest.mark.parametrize("name", ["op3_perspectives", "op4_secret_scan", "op5_quality_rules", "op7_license_scan"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "NestedLoop", "CartesianProduct"))


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_of_the_pipeline(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "quality rules",
        "n-gram Jaccard join",
        "benchmark decontamination",
        "secret scans",
        "best-fit packing",
    ]
    docs = table(spark, FOLDER, "documents")

    def run(name, df):
        return written(stages[name](spark, df, FOLDER), "stage")

    good = run("quality rules", docs)
    assert good.columns == docs.columns
    kept = {r["doc_id"] for r in quality_rules.quality_report(docs).where("kept").collect()}
    assert {d for d, _ in rows(good)} == kept
    assert not any(test_quality_rules.brute(t)[-1] for _, t in rows(good))

    single = run("n-gram Jaccard join", good)
    groups = test_jaccard_join.brute(rows(good), 5, 80)
    assert sorted(d for d, _ in rows(single)) == sorted({g for _, _, g in groups})

    clean = run("benchmark decontamination", single)
    items = [(r["item_id"], r["text"]) for r in table(spark, FOLDER, "benchmark").collect()]
    hit = {r[0] for r in test_decontaminate.brute(rows(single), items) if r[-1]}
    assert {d for d, _ in rows(clean)} == {d for d, _ in rows(single)} - hit

    masked = run("secret scans", clean)
    assert masked.columns == docs.columns and masked.where("n_chars <> length(text)").count() == 0
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.secret_report(clean).collect()}
    expected = []
    for doc, text in rows(clean):
        cuts = [tuple(map(int, s.split(":")[1:])) for s in spans[doc].split(",") if s]
        done, at = "", 0
        for start, end in cuts:
            if start >= at:
                done += text[at:start] + secret_scan.MASK
            at = max(at, end)
        expected.append((doc, done + text[at:]))
    assert sorted(rows(masked)) == sorted(expected)

    bins = run("best-fit packing", masked).collect()
    assert {d for b in bins for d in b["doc_ids"]} == {d for d, _ in rows(masked)}
    assert sum(b["n_words"] for b in bins) == sum(len(t.split()) for _, t in rows(masked))
    assert len(corpus_pipeline.run(spark, FOLDER).collect()) == len(bins)


def test_the_pipeline_on_no_documents(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), "stage")
        assert docs.count() == 0, name
    assert jaccard_join.similar_groups(table(spark, FOLDER, "documents").limit(0)).count() == 0
