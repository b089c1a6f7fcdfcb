"""Words of many texts at once, as arrays over the bytes of an Arrow batch.

A text is UTF-8; a null text is an empty one. Words are runs of word bytes that end with their text.
Letters A-Z are lower-cased. Nothing here depends on how rows are dealt to batches, so a task that
runs again gives the same hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are handled at once; a longer text is handled alone.
CHUNK_BYTES = 500_000
#: Bytes that are summed at once, also of a longer text.
PIECE_BYTES = 1_000_000

#: Odd, so that it has an inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Word bytes: all but white space.
VISIBLE = np.ones(256, dtype=bool)
VISIBLE[[32, 9, 10, 11, 12, 13]] = False

#: Word bytes: digits, letters and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


class Texts(NamedTuple):
    """Some rows of a batch: first row, their bytes in one array, and where each text starts and the last ends."""

    first: int
    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    """Word by word: hash, first byte, byte after the last, and the row; bounds: the first word of each row."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    bounds: np.ndarray


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of an Arrow column, a bounded number of bytes at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        after = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        after = min(after, n)
        yield Texts(first, data[offsets[first] : offsets[after]], offsets[first : after + 1] - offsets[first])
        first = after


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """A fixed 64-bit value for each byte, equal for A-Z and a-z."""
    return mixed(np.arange(1, 257, dtype=np.uint64))[LOWER]


class Powers:
    """Powers of BASE and of its inverse, as far as they were asked for."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            cls.up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, BASE, np.uint64)])
            cls.down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, pow(BASE, -1, 1 << 64), np.uint64)])
        return cls.up[:n], cls.down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chained(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Hash of a sequence whose two parts have these hashes."""
    return mixed(first * np.uint64(BASE) + then)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of some words, by sums over the bytes from the first to the last."""
    base = starts[0]
    part = data[base : ends[-1]]
    up, down = Powers.of(len(part) + 1)
    sums = np.empty(len(part) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_letters()[part] * up[:-1], out=sums[1:])
    return mixed((sums[ends - base] - sums[starts - base]) * down[starts - base] + (ends - starts).astype(np.uint64))


def words(texts: Texts, kind: np.ndarray = VISIBLE) -> Words:
    """The words of some texts."""
    data, bounds = texts.data, texts.bounds
    inside = kind[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    before = np.r_[False, inside[:-1]] if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.r_[inside[1:], False] if len(data) else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # one word at least, and as many as end within a piece
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE_BYTES, "right")))
        hashes[at:upto] = _hashes(data, starts[at:upto], ends[at:upto])
        at = upto
    first = np.searchsorted(starts, bounds)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    return Words(hashes, starts, ends, rows, first)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of `size` words; a row with fewer words, but any, has all its words as one run."""
    h, rows = found.hashes, found.rows
    n = np.diff(found.bounds)
    if len(h) >= size:
        run = h[: len(h) - size + 1].copy()
        for k in range(1, size):
            run = chained(run, h[k : len(h) - size + 1 + k])
        whole = rows[: len(run)] == rows[size - 1 :]
        run, at = run[whole], rows[: len(run)][whole]
    else:
        run, at = np.zeros(0, np.uint64), np.zeros(0, rows.dtype)
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        first, last = found.bounds[short], found.bounds[short + 1]
        one = h[first].copy()
        for k in range(1, size):
            more = first + k < last
            one[more] = chained(one[more], h[first[more] + k])
        run, at = np.r_[run, mixed(one + n[short].astype(np.uint64))], np.r_[at, short]
    return run, at
