"""Hard negatives against plain inner products and sorted lists."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from closeworks.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, planes int"


def brute(rows, k=5, m=10, low=30, high=90):
    valid, width = set(), 1
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        width = max(width, len(vector))
        valid.add((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    valid = {(i, label, v + (0,) * (width - len(v))) for i, label, v in valid}
    out = []
    for i, label, v in valid:
        if i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), j, other) for j, other, w in valid]
        for minus, j, _ in sorted(x for x in scored if x[2] == label and x[1] != i)[:k]:
            score = -minus
            near = sorted((s, n) for s, n, other in scored if other != label and low * score <= -100 * s <= high * score)
            out += [(i, j, rank + 1, n, score, -s) for rank, (s, n) in enumerate(near[:m])]
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, H.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()))


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 20), st.integers(1, 70), st.integers(1, 20), st.randoms(use_true_random=False))
def test_scores(n, width, bits, random):
    rng = np.random.default_rng(random.randrange(2**32))
    most = 1 << (bits - 1)
    x, y = (np.zeros((n, -(-width // 8) * 8), np.int64) for _ in range(2))
    x[:, :width], y[:, :width] = (rng.integers(-most, most, (n, width)) for _ in range(2))
    packed = H.planes(x, bits)
    assert (H.unpacked(packed) == x).all()
    assert (H.scores(H.subset_sums(y, np.int64), packed) == x @ y.T).all()


def test_many_rows(spark, monkeypatch):
    for name, value in {"ANCHORS": 3, "LEAST_ROWS": 50, "CELLS": 7, "TABLES": 2, "LOOKUPS": 16}.items():
        monkeypatch.setattr(H, name, value)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 11))
    rows = []
    for i in range(900):
        label = int(rng.integers(4)) if i % 3 else 0  # a hot label
        rows.append((i, (0.3 * centres[int(rng.integers(4))] + 0.2 * rng.normal(size=11)).tolist(), label))
    assert found(spark, rows) == brute(rows)


def test_defined_cases(spark):
    one = [0.5, -0.25, 0.125]
    rows = [
        (0, one, 1), (0, one, 1), (0, [0.5, 0.5, 0.5], 1), (0, one, 2), (100, one, 1), (100, [], 1), (200, [0.0] * 3, 3),
        (-300, [-0.4, 0.1, 0.0], 1), (1, one, 1), (2, one, 1), (3, [0.5], 1), (4, one, 1), (5, one, 1), (6, one, 1),
        (7, [0.25, -0.1, 0.1], 2), (8, [0.25, -0.1, 0.1], 2), (9, [0.4, 0.0], 4), (10, [1e-30, -1e-30, 0.0], 3),
        (None, one, 1), (11, None, 1), (12, one, None), (13, [0.5, None], 2), (14, [float("nan"), 1.0], 2),
        (400, [float("inf")], 1), (15, [0.3, float("-inf")], 2), (300, [-0.4, 0.1, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.2], 1),
    ]
    rows += [(20 + k, [0.2 + 0.01 * (k % 3), -0.1, 0.1], 2) for k in range(15)]
    result = found(spark, rows)
    assert result == brute(rows) and len(result) > 50


def test_copies_of_one_row(spark):
    rows = [(100, [0.5, 0.5], 1)] * 500 + [(k, [0.5, 0.5], 1) for k in range(1, 60)] + [(k, [0.4, 0.4], 2) for k in range(200, 900)]
    assert found(spark, rows) == brute(rows)


def test_large_components(spark):
    rows = [(100 * k, [1000.0 * k, -2000.0, 3.0], k % 2) for k in range(12)]
    assert found(spark, rows) == brute(rows)
    with pytest.raises(ValueError, match="too large"):
        found(spark, [(100, [1e30], 1)])


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [0.1], 1), (100, [], 2)]) == []
