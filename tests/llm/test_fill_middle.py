"""Fill-in-the-middle examples against a plain cut into units."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from closeworks.llm import words as W
from closeworks.llm.fill_middle import Marks, cuts, fill_middle, fill_middle_report, spaces

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = st.text(st.sampled_from("ab é漢😀\t\n\x0b\x0e\x08\x1f\x21\x85\xa0<>PSM"), max_size=40)


def plain(doc_id, text):
    text = text or ""
    tokens = UNIT.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:low], tokens[low:high], tokens[high:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (doc_id, n, "plain", None, None, text)
    if h[3] % 100 < 80:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(TEXTS, st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1)), max_size=12))
def test_cuts(rows):
    texts = [r[0] for r in rows]
    for part in W.chunks(pa.array(texts, pa.string())):
        some = rows[part.first :][: len(part.bounds) - 1]
        n, a, b, prefix, middle = cuts(part, *(np.array([r[k] for r in some], np.int64) for k in (1, 2)))
        for k, (text, x, y) in enumerate(some):
            tokens = UNIT.findall(text)
            low, high = sorted((x % (len(tokens) + 1), y % (len(tokens) + 1)))
            p, m = "".join(tokens[:low]), "".join(tokens[low:high])
            assert n[k] == len(tokens)
            assert (a[k] - part.bounds[k], b[k] - a[k]) == (len(p.encode()), len(m.encode()))
            assert (prefix[k], middle[k]) == (len(p), len(m))


def test_every_byte_in_every_place():
    for place in range(8):
        data = np.full((256, 8), ord("x"), np.uint8)
        data[:, place] = np.arange(256)
        marks = spaces(data.reshape(-1).view("<u8")).view(np.uint8).reshape(256, 8)
        assert np.flatnonzero(marks[:, place]).tolist() == [9, 10, 11, 12, 13, 32]
        assert not np.delete(marks, place, axis=1).any()


def test_rank_and_select_over_full_and_empty_words():
    rng = np.random.default_rng(1)
    flags = rng.random(8 * 50) < np.repeat(rng.choice([0, 0.1, 1], 50), 8)
    marks = Marks(np.where(flags, 0x80, 0).astype(np.uint8).view("<u8"))
    at = np.flatnonzero(flags)
    assert marks.select(np.arange(1, len(at) + 1)).tolist() == at.tolist()
    inside = np.arange(len(flags))
    assert marks.rank(inside).tolist() == (np.cumsum(flags) - flags).tolist()


ROWS = [
    (1, "one two  three\nfour "), (2, None), (3, ""), (4, "   "), (5, "has <S> in it"), (6, "<P"), (7, "a<S <M P> b"),
    (8, "é漢😀 \t x" * 50), (8, "another text of the same id"), (None, "no id here"), (None, "no id here"),
    (9, "word " * 200_000), (10, "x" * 1_000_000), (-11, "below zero"),
] + [(k, f"row {k} with some words < P > to be cut <") for k in range(100, 300)]


def test_rows(spark):
    docs = spark.createDataFrame([(a, b, "f", 1) for a, b in ROWS], "doc_id bigint, text string, form string, n int")
    found = sorted(map(tuple, fill_middle(docs).collect()), key=repr)
    assert found == sorted((plain(a, b) for a, b in ROWS), key=repr)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}
    report = fill_middle_report(docs).collect()
    digests = {hashlib.sha256((t or "").encode()).hexdigest() for _, t in ROWS}
    assert {r.restored_sha256 for r in report} == digests
    assert sorted(r.output_sha256 for r in report) == sorted(hashlib.sha256(r[5].encode()).hexdigest() for r in found)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_empty_table(spark, kind):
    docs = spark.createDataFrame([], f"doc_id {kind}, text string")
    assert fill_middle_report(docs).collect() == []
