"""Bins against a plain best fit, and what every packing must hold."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from closeworks.llm import packing as K

SCHEMA = "doc_id long, text string, source string"


def plain(items, capacity, limit):
    """Items (size, source, cluster) into the tightest compatible bin; lists of places."""
    bins = []
    for k, (size, source, cluster) in enumerate(items):
        fits = [
            (capacity - sum(items[x][0] for x in one), n)
            for n, one in enumerate(bins)
            if sum(items[x][0] for x in one) + size <= capacity
            and (source is None or sum(items[x][1] == source for x in one) < limit)
            and (cluster is None or all(items[x][2] != cluster for x in one))
        ]
        if fits:
            bins[min(fits)[1]].append(k)
        else:
            bins.append([k])
    return bins


@pytest.mark.parametrize("seed", range(6))
def test_one_shard_is_the_plain_best_fit(seed):
    r = random.Random(seed)
    rows = [(r.randrange(60), r.choice([None, 1, 2, 3]), r.choice([None, 7, 8, *range(20, 60)])) for _ in range(120)]
    rows = sorted(((s, i, so, c) for i, (s, so, c) in enumerate(rows)), key=lambda x: (-x[0], x[1]))
    t = pa.table(
        {
            "doc_id": pa.array([x[1] for x in rows], pa.int64()),
            "start": pa.array([0] * len(rows), pa.int64()),
            "size": pa.array([x[0] for x in rows], pa.int64()),
            "source": pa.array([x[2] for x in rows], pa.int64()),
            "cluster": pa.array([x[3] for x in rows], pa.int64()),
            "shard": pa.array([3] * len(rows), pa.int64()),
        }
    )
    got = K.pack(t, 100, 2)
    expected = plain([(x[0], x[2], x[3]) for x in rows], 100, 2)
    assert got["doc_ids"].to_pylist() == [[rows[k][1] for k in one] for one in expected]
    assert got["bin_id"].to_pylist() == [(3 << 32) + k for k in range(len(expected))]


def documents():
    r = random.Random(1)
    docs = [(i, " ".join(r.choice("abcdef") for _ in range(r.choice([0, 3, 20, 50, 120, 250]))), r.choice(["hot", "hot", "x", None])) for i in range(300)]
    return docs + [(400 + i, "the very same text", "y") for i in range(40)] + [(500, None, "z"), (None, "a b", None), (7, "again", "x")]


@pytest.mark.parametrize("shard_words", [4_000_000, 2000])
def test_bins_hold_every_word_once_and_no_conflict(spark, monkeypatch, shard_words):
    monkeypatch.setattr(K, "SHARD_WORDS", shard_words)
    docs = documents()
    bins = K.pack_documents(spark.createDataFrame(docs, SCHEMA), capacity=100, source_limit=2).collect()
    sizes = Counter()
    source = {d: s for d, _, s in docs if d != 7}
    for b in bins:
        assert sum(b["sizes"]) == b["n_words"] <= 100
        named = Counter(source.get(d) for d in b["doc_ids"])
        assert all(n <= 2 for s, n in named.items() if s is not None)
        assert sum(d is not None and 400 <= d < 440 for d in b["doc_ids"]) <= 1
        for d, start, size in zip(b["doc_ids"], b["starts"], b["sizes"]):
            sizes[d] += size
            assert start % 100 == 0
    assert len({b["bin_id"] for b in bins}) == len(bins)
    expected = Counter()
    for d, text, _ in docs:
        expected[d] += len((text or "").split())
    assert {d: n for d, n in sizes.items() if n} == {d: n for d, n in expected.items() if n}
    assert set(sizes) == {d for d, _, _ in docs}


def test_no_rows(spark):
    assert K.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []
