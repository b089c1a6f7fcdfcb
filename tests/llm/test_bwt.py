"""The transform and its common prefixes against sorted suffixes."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from closeworks.llm import bwt

STRINGS = st.lists(st.text(alphabet="abc", min_size=1, max_size=12), min_size=1, max_size=9)


def sorted_suffixes(strings):
    """Each suffix with its string and offset; ends sort before symbols and among each other by string."""
    out = [([(1, ord(c)) for c in s[k:]] + [(0, i)], i, k) for i, s in enumerate(strings) for k in range(len(s) + 1)]
    return sorted(out)


def common(a, b):
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@settings(max_examples=100, deadline=None)
@given(STRINGS)
def test_build(strings):
    lengths = np.array([len(s) for s in strings])
    codes = np.frombuffer("".join(strings).encode(), np.uint8) - 96
    found = bwt.build(codes, np.cumsum(lengths) - lengths, lengths)
    rows = sorted_suffixes(strings)
    assert found.symbols.tolist() == [ord(strings[i][k - 1]) - 96 if k else 0 for _, i, k in rows]
    assert found.prefixes.tolist() == [0] + [common(a[0], b[0]) for a, b in zip(rows, rows[1:])]
    for text, offset, row in zip(*bwt.suffix_rows(found, lengths, 2)):
        assert rows[row][1:] == (text, offset)
        assert lengths[text] - offset >= 2


def test_nothing():
    none = np.zeros(0, np.int64)
    assert len(bwt.build(none, none, none).symbols) == 0
