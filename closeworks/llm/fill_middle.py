"""Fill-in-the-middle examples: texts cut at two unit ends and put together in another order.

A unit is a word with the white space before it, or the white space that ends a text. The bytes of many texts are
viewed as 64-bit words, and all eight bytes of a word are handled by the same arithmetic: the bytes that end a unit are
marked by their highest bit, marks are counted per word, and the k-th unit end is found by a search in the running counts
and then within its word. No unit is ever made as a string.

Where the cuts fall and which form a text gets depends on the hash of a seed and the id alone, so a task that runs
again gives the same rows.

Defined cases: a null text is empty, an empty text is plain, and so is one that contains a sentinel; a null id is hashed as
an empty one; rows with equal ids each keep their row; texts of any length are cut as a whole; an empty table gives no rows;
other columns are left out, so their names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.llm import words as W

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: A byte's highest bit, its other bits, and its lowest one, in each byte of a word.
HIGH, REST, ONES = (np.uint64(int.from_bytes(bytes([x]) * 8)) for x in (0x80, 0x7F, 0x01))


def _at_least(low: np.ndarray, least: int) -> np.ndarray:
    """Marks of the bytes of at least this value; their highest bits are 0."""
    return low + ONES * np.uint64(0x80 - least)


def spaces(words: np.ndarray) -> np.ndarray:
    """Marks of the bytes 0x20 and 0x09 to 0x0D."""
    low = words & REST
    blank = ~_at_least(low ^ (ONES * np.uint64(0x20)), 1)
    control = _at_least(low, 0x09) & ~_at_least(low, 0x0E)
    return (blank | control) & ~words & HIGH


class Marks:
    """Marked bytes of an array of words, counted so that marks before a byte and the k-th mark are found at once."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, byte: np.ndarray) -> np.ndarray:
        """Marks before each of these bytes."""
        word, within = byte >> 3, (byte & 7).astype(np.uint64)
        below = (np.uint64(1) << (within << np.uint64(3))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte of each k-th mark, k from 1."""
        word = np.searchsorted(self.before[1:], k)
        rest, left = self.marks[word], k - self.before[word]
        for passed in range(1, 8):  # drop the lowest mark until the wanted one is the lowest
            rest = np.where(left > passed, rest & (rest - np.uint64(1)), rest)
        lowest = rest & (~rest + np.uint64(1))
        return (word << 3) + (np.bitwise_count(lowest - np.uint64(1)) >> 3)


def units(texts: W.Texts) -> tuple[Marks, Marks]:
    """Marks of the bytes that end a unit, and of those that begin a code point."""
    data, bounds = texts.data, texts.bounds
    padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
    padded[: len(data)] = data
    words = padded.view("<u8")
    space = spaces(words)
    following = space >> np.uint64(8)
    following[:-1] |= space[1:] << np.uint64(56)
    ends = ~space & following & HIGH
    last = bounds[1:][np.diff(bounds) > 0] - 1
    ends.view(np.uint8)[last] = 0x80
    begins = ~(words & ~(words << np.uint64(1))) & HIGH
    return Marks(ends), Marks(begins)


def cuts(texts: W.Texts, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
    """Units of each text, and bytes and code points of its prefix and its middle.

    They end after `first` and `second` units, whichever is less for the prefix, modulo the number of units plus one.
    """
    ends, begins = units(texts)
    start = texts.bounds[:-1]
    done = ends.rank(texts.bounds)
    n = np.diff(done)
    places = [start]
    for k in np.sort([first % (n + 1), second % (n + 1)], axis=0):
        at = start.copy()
        some = k > 0
        at[some] = ends.select((done[:-1] + k)[some]) + 1
        places.append(at)
    points = [begins.rank(x) for x in places]
    return n, places[1], places[2], points[1] - points[0], points[2] - points[1]


def _dice(seed: int, key: str) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def fill_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, percent: int = 50, suffix_first: int = 80
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of each row.

    percent: share of the texts that are cut, as far as they can be. suffix_first: share of these whose suffix comes first (spm);
    the others begin with their prefix (psm). Texts that aren't cut are plain and have no lengths.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    h1, h2, h3, h4 = _dice(seed, key)
    taken = whole.contains(PREFIX) | whole.contains(SUFFIX) | whole.contains(MIDDLE)
    form = F.when((whole == "") | taken | (h3 % 100 >= percent), "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    rows = docs.select(F.col(key).alias("id"), whole.alias("text"), h1.alias("h1"), h2.alias("h2"), form.alias("form"))
    kind = rows.schema["id"].dataType.simpleString()
    marks = [x.encode() for x in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch.column(1)):
                some = batch.slice(part.first, len(part.bounds) - 1)
                first, second = (some.column(k).to_numpy() for k in (2, 3))
                forms = some.column(4).to_pylist()
                n, a, b, prefix, middle = cuts(part, first, second)
                data, bounds, plain = memoryview(part.data), part.bounds, np.array([x == "plain" for x in forms])
                out = [_put(data[s:x], data[x:y], data[y:e], form, *marks) for s, x, y, e, form in zip(
                    bounds[:-1].tolist(), a.tolist(), b.tolist(), bounds[1:].tolist(), forms, strict=True
                )]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array(n),
                        some.column(4),
                        pa.array(prefix, mask=plain),
                        pa.array(middle, mask=plain),
                        pa.array(out, pa.binary()).cast(pa.string()),
                    ],
                    ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    schema = f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", key)


def _put(prefix: memoryview, middle: memoryview, suffix: memoryview, form: str, p: bytes, s: bytes, m: bytes) -> bytes:
    if form == "plain":
        return b"".join((prefix, middle, suffix))
    return b"".join((p, prefix, s, suffix, m, middle) if form == "psm" else (s, suffix, p, prefix, m, middle))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of. Only plain texts contain sentinels of their own."""
    pieces = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm, spm = (1, 3, 2), (2, 3, 1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(*(pieces[k] for k in psm)))
        .otherwise(F.concat(*(pieces[k] for k in spm)))
    )


def fill_middle_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Lengths of each row's pieces, and hashes of its output and of the text that is restored from it."""
    rows = fill_middle(docs, key, text)
    digest = {"output_sha256": F.col("output"), "restored_sha256": restored(F.col("output"), F.col("form"))}
    hashed = {name: F.sha2(F.encode(x, "UTF-8"), 256) for name, x in digest.items()}
    return rows.withColumns(hashed).drop("output")
