"""Removed bytes against all strings of 50 bytes in a dictionary."""

import hashlib
import random
import re

import pytest

from closeworks.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string"
LAST = 1 << 63


def brute(docs):
    first = {}
    for i, text in docs:
        data, own = (text or "").encode(), LAST if i is None else i
        for p in range(len(data) - 49):
            first[data[p : p + 50]] = min(first.get(data[p : p + 50], LAST), own)
    out = []
    for i, text in docs:
        data, own = (text or "").encode(), LAST if i is None else i
        gone = bytearray(len(data))
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < own:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts():
    r = random.Random(5)
    pool = ["".join(r.choice("abcé ") for _ in range(r.randrange(40, 200))) for _ in range(20)]
    docs = []
    for i in range(80):
        parts = [r.choice([r.choice(pool), "a" * r.randrange(120), "".join(r.choice("abcdefg ") for _ in range(60))]) for _ in range(r.randrange(6))]
        docs.append((i, "".join(parts)))
    edge = [(900, None), (901, ""), (902, "x" * 49), (903, "x" * 50), (904, "x" * 51), (905, pool[0] * 300)]
    return docs + edge + [(None, docs[3][1]), (None, docs[3][1]), (7, docs[9][1]), (7, docs[7][1])]


def found(df):
    return sorted((tuple(r) for r in S.repeats_report(df).collect()), key=str)


@pytest.mark.parametrize("sizes", [{}, {"BUCKET_BYTES": 5000, "COLLECTION": 3000, "STEP": 700}, {"BUCKET_BYTES": 9000, "RUN": 7}])
def test_against_brute_force(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(S, name, value)
    docs = texts()
    assert found(spark.createDataFrame(docs, SCHEMA)) == brute(docs)


def test_a_gram_that_one_text_has_several_times(spark):
    r = random.Random(3)
    docs = []
    for i in range(120):
        words = []
        for _ in range(r.randrange(1, 5)):
            words += [r.choice(["the", "that", "thestionti", "chheit", "erü", "Of"])] * r.randrange(1, 12)
        docs.append((i, " ".join(words)))
    assert found(spark.createDataFrame(docs, SCHEMA)) == brute(docs)


def test_no_rows_and_other_columns(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    docs = [(2, "y" * 60, "b", 1), (1, "y" * 55, "a", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, bucket string, id int")
    assert found(df) == brute([d[:2] for d in docs])


def test_spans_and_kept_bytes(spark):
    df = spark.createDataFrame([(1, "p" * 50), (2, "q" + "p" * 52 + "r")], SCHEMA)
    row = S.remove_repeats(df).where("doc_id = 2").first()
    assert [tuple(s) for s in row["spans"]] == [(1, 53)] and bytes(row["kept"]) == b"qr"


def test_many_copies_of_one_text(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_BYTES", 2000)
    docs = [(i, "the same sentence over and over again, " * 3) for i in range(300)]
    rows = found(spark.createDataFrame(docs, SCHEMA))
    assert sum(r[2] == 0 for r in rows) == 1 and rows == brute(docs)
