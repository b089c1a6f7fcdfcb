"""Word and n-gram hashes against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from closeworks.llm import words as W

VISIBLE = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAzZ09é😀 \t\n.-_", max_size=30)), max_size=12)


def plain(texts, pattern):
    return [pattern.findall(bytes(W.LOWER[np.frombuffer((t or "").encode(), np.uint8)])) for t in texts]


def found(texts, kind, limit):
    out = []
    for part in W.chunks(pa.array(texts, pa.string()), limit):
        w = W.words(part, kind)
        for row in range(len(part.bounds) - 1):
            a, b = w.bounds[row], w.bounds[row + 1]
            out.append([(W.LOWER[part.data[s:e]].tobytes(), h) for s, e, h in zip(w.starts[a:b], w.ends[a:b], w.hashes[a:b])])
    return out


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([1, 7, 1000]))
def test_words_are_those_of_the_pattern_and_equal_words_have_equal_hashes(texts, limit):
    names = {}
    for kind, pattern in ((W.VISIBLE, VISIBLE), (W.ALNUM, ALNUM)):
        got = found(texts, kind, limit)
        assert [[w for w, _ in row] for row in got] == plain(texts, pattern)
        for row in got:
            for word, h in row:
                assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_shingles_of_rows(texts, size):
    names = {}
    for part in W.chunks(pa.array(texts, pa.string())):
        grams, rows = W.shingles(W.words(part), size)
        expected = plain(texts[part.first : part.first + len(part.bounds) - 1], VISIBLE)
        for row, found_words in enumerate(expected):
            runs = [tuple(found_words[k : k + size]) for k in range(max(1, len(found_words) - size + 1))] if found_words else []
            own = grams[rows == row]
            assert len(own) == len(runs)
            for run, h in zip(runs, own, strict=True):
                assert names.setdefault(run, h) == h
    assert len(set(names.values())) == len(names)


def test_pieces_of_a_long_text_give_the_same_hashes(monkeypatch):
    text = pa.array(["ab cde f " * 50 + "long" * 40 + " end"])
    whole = W.words(next(W.chunks(text)))
    monkeypatch.setattr(W, "PIECE_BYTES", 7)
    cut = W.words(next(W.chunks(text)))
    assert (whole.hashes == cut.hashes).all() and len(set(cut.hashes.tolist())) == 5


def test_a_long_text_is_a_chunk_of_its_own():
    parts = list(W.chunks(pa.array(["a b", "c " * 5000, None, "d"]), limit=100))
    assert [len(p.bounds) - 1 for p in parts] == [1, 1, 2]
