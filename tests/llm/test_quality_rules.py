"""Measures against plain Python, the estimate on made-up votes, and verdicts on labelled texts."""

import os
import random
import re

import pytest

from closeworks.llm import quality_rules as Q

SCHEMA = "doc_id long, text string"
DATA = "/root/testdata/sf0.1"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k : k + 8]), []).append(k)
    repeated = {p for places in windows.values() if len(places) > 1 for k in places for p in range(k, k + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 20 or 100 * len(repeated) > 30 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed)


def texts():
    r = random.Random(9)
    some = []
    for i in range(200):
        words = [r.choice(["a", "bb", "é😀", "#x", "|", "C!"]) for _ in range(r.randrange(60))]
        if words and r.random() < 0.5:
            words += words[: r.randrange(1, 30)]
        some.append((i, "".join(w + r.choice([" ", "\n", "\t", " \n ", "\r\n"]) for w in words)))
    return some + [(500, None), (501, ""), (502, "\n\n \n"), (503, "x y z " * 3000), (None, "w " * 8), (1, "a b\na b"), (1, "a b\na b")]


def test_measures(spark):
    docs = texts()
    rows = Q.quality_report(spark.createDataFrame(docs, SCHEMA)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = sorted((str(r["doc_id"]), *(r[k] for k in names)) for r in rows)
    assert got == sorted((str(d), *brute(t)) for d, t in docs)
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_estimate_finds_how_good_a_rule_is(spark):
    r = random.Random(4)
    counts = {}
    for _ in range(4000):
        good = r.random() < 0.85
        votes = []
        for k in range(len(Q.RULES)):
            bad_vote = r.random() < (0.004 if good else 0.3 + 0.05 * k)
            votes.append(-1 if bad_vote else (1 if k in (0, 8) and r.random() < (0.9 if good else 0.1) else 0))
        counts[tuple(votes)] = counts.get(tuple(votes), 0) + 1
    columns = ", ".join(f"{x} int" for x in Q.RULES) + ", count long"
    patterns = spark.createDataFrame([(*k, n) for k, n in counts.items()], columns).coalesce(1)
    model = Q.estimate(patterns)
    assert abs(model.prior - 0.85) < 0.04
    assert all(abs(model.on_bad[k][0] - (0.3 + 0.05 * k)) < 0.08 for k in range(len(Q.RULES)))
    assert all(good[0] <= 0.02 for good in model.on_good)


def test_no_rows_and_kept_columns(spark):
    assert Q.quality_report(spark.createDataFrame([], SCHEMA)).collect() == []
    plain = " ".join(f"word{k}" for k in range(80))
    docs = [(1, plain, 7), (2, "A!! B!! " * 40, 7), (3, None, 7), (4, plain + " more", 7)]
    df = spark.createDataFrame(docs, SCHEMA + ", Measures int")
    kept = Q.quality_filter(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="given tables not present")
def test_verdicts_on_labelled_texts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet").withColumnRenamed("quality", "label")
    rows = Q.quality_report(docs).join(labels, "doc_id").where("not base_failed").select("label", "kept").collect()
    good = [r["kept"] for r in rows if r["label"] == 1]
    bad = [r["kept"] for r in rows if r["label"] == 0]
    assert sum(good) / len(good) > 0.98
    assert sum(bad) / len(bad) < 0.1
