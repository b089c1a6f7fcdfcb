"""Near duplicates by sorted signatures against all pairs in plain Python."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from closeworks.llm import lsh_forest as L
from closeworks.llm import words as W
from tests.llm.test_jaccard_join import SCHEMA, brute, corpus


def found(df, **options):
    return sorted((tuple(r) for r in L.near_duplicates(df, **options).collect()), key=str)


def expected(docs, size=2, percent=80):
    return sorted(((i, n, c, i == c) for i, n, c in brute(docs, size, percent)), key=str)


@pytest.mark.parametrize("sizes", [{}, {"DENSE": 8, "CELL": 5}, {"BROADCAST_ROWS": 0}])
def test_against_all_pairs(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(L, name, value)
    docs = corpus(n=250)
    assert found(spark.createDataFrame(docs, SCHEMA)) == expected(docs)


def test_other_sizes_and_columns(spark):
    docs = corpus(9, 150)
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], SCHEMA + ", component_id int, region string")
    assert found(df, size=5, percent=80) == expected(docs, 5, 80)


def test_a_chain_and_a_large_family(spark):
    r = random.Random(5)
    words = [f"v{i}" for i in range(600)]
    docs = [(1000 - k, " ".join(words[3 * k : 3 * k + 100])) for k in range(30)]
    for k in range(400):  # near copies of one text, each with a word of its own
        text = words[200:320]
        text[r.randrange(len(text))] = f"own{k}"
        docs.append((2000 + k, " ".join(text)))
    docs += [(5000 + k, " ".join(words[400:480])) for k in range(300)]  # equal copies
    rows = found(spark.createDataFrame(docs, SCHEMA))
    assert rows == expected(docs)
    assert {971, 2000, 5000} <= {c for _, _, c, kept in rows if kept}


def test_defined_cases(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    docs = [(1, None), (2, ""), (2, ""), (None, " "), (None, "same here"), (None, "same here"), (5, "One"), (4, "one"), (4, "one")]
    docs += [(6, "very long " * 100_000), (7, "very long " * 99_000), (8, "x" * 500_000), (9, "x" * 500_000)]
    rows = found(spark.createDataFrame(docs, SCHEMA))
    assert rows == sorted(((i, n, c, i == c) for i, n, c in brute(docs, 2, 80)), key=str)
    assert [r for r in rows if r[0] is None and r[1]] == [(None, 1, None, True)] * 2


FORM = "region long, rest long, set long, leader long, near boolean, component long, s1 long, s2 long"


def sketches(r, n, components):
    """Entries of few regions whose sketches are close to one of three."""
    base = [r.getrandbits(128) for _ in range(3)]
    rows = []
    for k in range(n):
        bits = r.choice(base)
        for _ in range(r.randrange(30)):
            bits ^= 1 << r.randrange(128)
        halves = [int(np.uint64(x & (2**64 - 1)).view(np.int64)) for x in (bits, bits >> 64)]
        rows.append((r.choice([1, 1, 1, 2, 3]), r.getrandbits(60), k, 0, r.random() < 0.7, r.choice(components), *halves))
    return rows + [(9, 5, n, n, True, n, 0, 0), (9, 5, n + 1, n, False, n, 0, 0)]


def apart(rows):
    out = set()
    small = {a for a in {x[0] for x in rows} if sum(x[0] == a for x in rows) <= L.NEIGHBOURS + 1}
    for x, y in combinations([x for x in rows if x[0] not in small], 2):
        differ = sum(bin((x[k] ^ y[k]) & (2**64 - 1)).count("1") for k in (6, 7))
        if x[0] == y[0] and x[5] != y[5] and not (x[4] and y[4]) and differ <= L.FAR:
            out.add((min(x[2], y[2]), max(x[2], y[2])))
    return out


@pytest.mark.parametrize("cell", [2048, 7])
def test_sets_far_from_leaders_meet_in_cells(spark, monkeypatch, cell):
    monkeypatch.setattr(L, "CELL", cell)
    rows = sketches(random.Random(8), 300, [0] * 20 + [1, 2, 3, 4])
    got = [tuple(x) for x in L.far_pairs(spark.createDataFrame(rows, FORM)).collect()]
    assert len(got) == len(set(got)) and set(got) == apart(rows) != set()


def test_neighbours_share_the_longest_prefixes(spark):
    rows = [(1, 16 * k, k, 0, False, k, 0, 0) for k in range(100)]
    rows += [(2, 0, 200, 0, False, 1, 0, 0), (2, 9, 201, 0, False, 1, 0, 0), (3, 0, 300, 0, True, 1, 0, 0), (3, 0, 301, 0, True, 2, 0, 0)]
    got = {tuple(x) for x in L.neighbours(spark.createDataFrame(rows, FORM).coalesce(1)).collect()}
    within = {(k, k + d) for k in range(100) for d in range(1, L.NEIGHBOURS + 1) if k + d < 100}
    assert got <= within and len(got) >= len(within) - 100


@pytest.mark.parametrize("cell", [2048, 9])
def test_sets_around_leaders_meet_in_cells(spark, monkeypatch, cell):
    monkeypatch.setattr(L, "CELL", cell)
    r, rows, sets = random.Random(6), [], {}
    for leader in (1000, 2000):
        base = set(range(leader, leader + r.randrange(40, 90)))
        for k in range(120):
            one = set(r.sample(sorted(base), len(base) - r.randrange(14))) | {r.randrange(leader + 100, leader + 125) for _ in range(r.randrange(12))}
            sets[leader + k] = one
            component = r.choice([leader] * 5 + [leader + k, leader + 500])
            rows.append((leader, leader + k, component, len(base), len(one), len(base & one), sorted(base ^ one)))
    form = "leader long, set long, component long, all long, n long, common long, differ array<long>"
    component = {x[1]: x[2] for x in rows}
    true = set()
    for x, y in combinations(rows, 2):
        a, b = sets[x[1]], sets[y[1]]
        if x[0] == y[0] and x[2] != y[2] and 100 * len(a & b) >= 80 * len(a | b):
            true.add((x[1], y[1]))
    got = {tuple(x) for x in L.around_leaders(spark.createDataFrame(rows, form), 80).collect()}
    between = [{frozenset((component[a], component[b])) for a, b in some} for some in (got, true)]
    assert got <= true and between[0] == between[1] and len(between[0]) > 20


def test_dense_regions_go_deeper(spark, monkeypatch):
    monkeypatch.setattr(L, "DENSE", 20)
    r = random.Random(1)
    rows = [(a, sum(r.randrange(3) << 16 * k for k in range(4)), k, 0, 0) for k, a in enumerate([1] * 100 + [2] * 15 + [3])]
    listed = L.regions(spark.createDataFrame(rows, L.ENTRIES)).collect()
    together = set()
    for x, y in combinations(listed, 2):
        if x["region"] == y["region"]:
            together.add((min(x["set"], y["set"]), max(x["set"], y["set"])))
    fields = {x[2]: [x[1] >> 16 * k & 0xFFFF for k in range(4)] for x in rows}
    deep = {(a, b) for a, b in combinations(range(100), 2) if sum(p == q for p, q in zip(fields[a], fields[b], strict=True)) >= 2}
    assert together == deep | set(combinations(range(100, 115), 2))


def test_leaders_have_most_company(spark):
    rows = [(1, 0, k, 0, -1 if k == 7 else 0, 3) for k in range(10)] + [(2, 0, k, 0, 0, 2) for k in (4, 5)] + [(3, 0, k, 0, 0, 2) for k in (5, 90)]
    got = {(x["region"], x["set"]): (x["leader"], x["near"]) for x in L.led(spark.createDataFrame(rows, L.ENTRIES + ", sets long")).collect()}
    assert got == {(a, b): (5, b != 7) for a, _, b, *_ in rows}


def test_signatures_estimate_similarity():
    r = random.Random(2)
    words = [f"w{k}" for k in range(5000)]
    text = [r.choice(words) for _ in range(400)]
    texts = [" ".join(text), " ".join(text[:360] + [r.choice(words) for _ in range(40)]), " ".join(r.choice(words) for _ in range(400)), ""]
    (part,) = W.chunks(pa.array(texts, pa.string()))
    grams, bounds = L._sets(part, 2)
    values = L.signatures(grams, bounds)
    sets = [set(grams[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for a, b in ((0, 1), (0, 2)):
        true = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        assert abs((values[a] == values[b]).mean() - true) < 0.17
    assert len(np.unique(values[0])) > L.MINHASHES * 0.9 and not values[3].any()
