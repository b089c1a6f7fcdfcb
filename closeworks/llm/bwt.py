"""Burrows-Wheeler transform and common prefixes of a collection of short strings, built column by column.

Round j inserts the j-th symbol from the end of every string that is long enough. What the collection's
transform and its longest common prefixes were is read from one file, front to back, and what they become is
written to another. Each string ends with a mark of its own, smaller than all symbols.
"""

from __future__ import annotations

import os
import tempfile
from typing import NamedTuple

import numpy as np

#: Common prefixes are told apart up to this length.
CAP = 255


class Collection(NamedTuple):
    """Symbol before each suffix in sorted order (0: none), and the common prefix with the suffix before it."""

    symbols: np.ndarray
    prefixes: np.ndarray


def _minima(values: np.ndarray, after: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """Least value in each range (after, upto]; ranges go from right to left, so that gaps cost nothing."""
    if not len(after):
        return np.zeros(0, values.dtype)
    order = np.argsort(-after, kind="stable")
    pairs = np.empty(2 * len(after), np.int64)
    pairs[0::2], pairs[1::2] = after[order] + 1, upto[order] + 1
    found = np.empty(len(after), values.dtype)
    found[order] = np.minimum.reduceat(np.r_[values, values[:1]], pairs)[0::2]
    return found


def _insert(b: np.ndarray, lcp: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Rows of the suffixes that the symbols at some rows make, their common prefixes, and those of the rows after them.

    n: number of strings, whose empty suffixes come first.
    """
    order = np.argsort(b, kind="stable")
    place = np.empty(len(b), np.int64)
    place[order] = np.arange(len(b))
    none = int(np.count_nonzero(b == 0))
    k = place[at]
    before, after = order[np.maximum(k - 1, 0)], order[np.minimum(k + 1, len(b) - 1)]
    has_before = (k > 0) & (b[before] == b[at])
    has_after = (k + 1 < len(b)) & (b[after] == b[at])
    own = np.zeros(len(at), np.uint8)
    least = _minima(lcp, before[has_before], at[has_before])
    own[has_before] = np.minimum(least, CAP - 1) + 1
    next_ = np.zeros(len(at), np.uint8)
    least = _minima(lcp, at[has_after], after[has_after])
    next_[has_after] = np.minimum(least, CAP - 1) + 1
    return n + k - none, own, next_, has_after


class _Column:
    """An array that grows from round to round, in two files of its last size that take turns."""

    def __init__(self, folder: str, name: str, size: int):
        self.files = [np.memmap(os.path.join(folder, f"{name}-{k}"), np.uint8, "w+", shape=size) for k in (0, 1)]
        self.size = 0

    def read(self) -> np.ndarray:
        return self.files[0][: self.size]

    def write(self, old: np.ndarray, new: np.ndarray, values: np.ndarray) -> np.ndarray:
        """What was read, at the rows `old`, and new values at the rows `new`."""
        before = self.files[0][: self.size]
        self.size = len(old)
        target = self.files[1][: self.size]
        target[old] = before if len(before) else 0
        target[new] = values
        self.files.reverse()
        return target


def build(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Collection:
    """The collection of strings of codes from 1, given by their first place and length, none of them empty."""
    n = len(starts)
    total = n + int(lengths.sum())
    if not n:
        return Collection(np.zeros(0, np.uint8), np.zeros(0, np.uint8))
    with tempfile.TemporaryDirectory() as folder:
        symbols, prefixes = _Column(folder, "symbols", total), _Column(folder, "prefixes", total)
        active = row = np.arange(n)
        everywhere = np.ones(n, bool)
        symbols.write(everywhere, row, codes[starts + lengths - 1])
        prefixes.write(everywhere, row, 0)
        for j in range(1, int(lengths.max()) + 1):
            on = lengths[active] >= j
            active, row = active[on], row[on]
            rows, own, next_, has_next = _insert(symbols.read(), prefixes.read(), row, n)
            left = lengths[active] - j
            symbol = np.where(left > 0, codes[starts[active] + np.maximum(left - 1, 0)], 0)
            old = np.ones(symbols.size + len(rows), bool)
            old[rows] = False
            symbols.write(old, rows, symbol)
            # the row after a new one may be new too, and then says the same
            prefixes.write(old, rows, own)[rows[has_next] + 1] = next_[has_next]
            row = rows
        return Collection(np.array(symbols.read()), np.array(prefixes.read()))


def suffix_rows(c: Collection, lengths: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, row) of every suffix of at least some length, by walking the transform from the ends."""
    n = len(lengths)
    order = np.argsort(c.symbols, kind="stable")
    step = np.empty(len(order), np.int64)
    step[order] = np.arange(len(order)) + n - int(np.count_nonzero(c.symbols == 0))
    active, row = np.arange(n), np.arange(n)
    out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 3]
    for j in range(1, int(lengths.max(initial=0)) + 1):
        on = lengths[active] >= j
        active, row = active[on], step[row[on]]
        if j >= least:
            out.append((active, lengths[active] - j, row))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))
