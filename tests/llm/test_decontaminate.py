"""Hit words against all windows in a dictionary."""

import hashlib
import random
import re

import pytest

from closeworks.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).update([] if item is None else [str(item)])
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def text(r, n):
    return "".join(r.choice(["a", "b", "c", "É", "x1", "Zed", "zed", "q_9"]) + r.choice([" ", "\n", "--", "."]) for _ in range(n))


def tables():
    r = random.Random(2)
    docs = [(i, text(r, r.randrange(60))) for i in range(150)]
    docs += [(None, None), (5, ""), (6, text(r, 5000)), (6, "É")]
    items = [(i, text(r, r.choice([0, 9, 10, 12, 15]))) for i in range(20)] + [(None, "a b c a b c a"), (3, None), (40, "zed")]
    some = [w for _, w in items if len(words(w)) >= 10]
    docs += [(1000 + i, text(r, 30) + some[i % len(some)].upper() + text(r, 30)) for i in range(40)]
    return docs, items


@pytest.mark.parametrize("limit", [1_000_000, 60])
@pytest.mark.parametrize("longer", [0, 8])
def test_against_brute_force(spark, limit, longer):
    docs, items = tables()
    items = [x for x in items if len(words(x[1])) >= longer]
    got = D.contamination_report(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), limit=limit)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = tables()
    none = D.contamination_report(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS))
    assert none.collect() == []
    clean = D.contamination_report(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS))
    assert sorted((tuple(r) for r in clean.collect()), key=str) == brute(docs, [])


def test_rows_without_hits_stay_as_they_are(spark):
    docs, items = tables()
    items = [x for x in items if len(words(x[1])) >= 10]
    df = spark.createDataFrame([(*d, "x") for d in docs], DOCS + ", found string")
    kept = D.decontaminate(df, spark.createDataFrame(items, ITEMS))
    clean = [d[0] for d, row in zip(docs, (brute([d], items)[0] for d in docs)) if not row[5]]
    assert kept.columns == df.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, clean))
    assert {r["found"] for r in kept.collect()} == {"x"}
