"""Benchmark decontamination by Wu-Manber search over words.

The patterns are windows of consecutive benchmark words. Search goes over word hashes: a table of blocks
of words says how far a place may be skipped, the hash of a whole window selects the patterns to look at,
and words are compared before a hit counts. Shorter windows, of items with few words, have tables of their
own, one per length. The patterns of a block of the benchmark have a bounded size and are broadcast;
a larger benchmark takes several passes over the documents, one per block.

Defined cases: null texts have no words; an item without words has no window; items with the same id are one
item; items without id still hit words, but are neither counted nor listed; documents are judged row by row,
so repeated rows and null ids keep their rows; empty tables give empty results or no hits; columns of
the input keep their names, added ones step aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.llm import words as W
from closeworks.llm.names import fresh
from closeworks.operators.schema import quoted

WINDOW = 10
#: Words of a block of the shift tables.
BLOCK = 2
#: Bits of a block's hash that are looked up first.
MARK = np.uint64(0xFFFFF)
#: Benchmark text that one pass looks for; its tables are a small multiple of that.
PASS_BYTES = 1_000_000


class Patterns(NamedTuple):
    """Windows of one length: sorted hashes, for each the bytes of its words and its items; and the shift table.

    marks holds the low bits of the blocks in the table, which most blocks of a text don't have.
    """

    length: int
    hashes: np.ndarray
    texts: list[bytes]
    items: list[tuple[str, ...]]
    blocks: np.ndarray
    shifts: np.ndarray
    marks: np.ndarray


def _joined(texts: W.Texts, found: W.Words, first: int, length: int) -> bytes:
    """Lower-cased words, one space between each."""
    some = zip(found.starts[first : first + length], found.ends[first : first + length], strict=True)
    return b" ".join(W.LOWER[texts.data[a:b]].tobytes() for a, b in some)


def _run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of `length` words, across rows too."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    run = hashes[: len(hashes) - length + 1].copy()
    for k in range(1, length):
        run = W.chained(run, hashes[k : len(hashes) - length + 1 + k])
    return run


def build(ids: list[str | None], texts: list[str | None], window: int = WINDOW) -> list[Patterns]:
    """Search tables of some items, one per window length."""
    column = pa.array([None if t is None else t.encode() for t in texts], pa.large_binary())
    by_length: dict[int, dict[bytes, tuple[int, set[str], list[int]]]] = {}
    for part in W.chunks(column):
        found = W.words(part, W.ALNUM)
        for row in range(len(part.bounds) - 1):
            first, after = int(found.bounds[row]), int(found.bounds[row + 1])
            length = min(window, after - first)
            if not length:
                continue
            owner = ids[part.first + row]
            runs = _run_hashes(found.hashes[first:after], length)
            for k, h in enumerate(runs):
                known = by_length.setdefault(length, {}).setdefault(
                    _joined(part, found, first + k, length), (int(h), set(), found.hashes[first + k : first + k + length])
                )
                if owner is not None:
                    known[1].add(owner)
    return [_tables(length, known) for length, known in sorted(by_length.items())]


def _tables(length: int, known: dict[bytes, tuple[int, set[str], np.ndarray]]) -> Patterns:
    block = min(BLOCK, length)
    texts = sorted(known, key=lambda t: (known[t][0], t))
    hashes = np.array([known[t][0] for t in texts], np.uint64)
    rows = np.stack([known[t][2] for t in texts])
    # a block that ends j words before the end of a pattern allows a skip of j; others skip past it all
    ends = np.concatenate([_blocks(rows, block, length - 1 - j) for j in range(length - block + 1)])
    skips = np.repeat(np.arange(length - block + 1), len(texts))
    order = np.lexsort((skips, ends))
    blocks, at = np.unique(ends[order], return_index=True)
    items = [tuple(sorted(known[t][1])) for t in texts]
    marks = np.zeros(int(MARK) + 1, bool)
    marks[blocks & MARK] = True
    return Patterns(length, hashes, texts, items, blocks, skips[order][at], marks)


def _blocks(rows: np.ndarray, block: int, end: int) -> np.ndarray:
    run = rows[:, end - block + 1]
    for k in range(1, block):
        run = W.chained(run, rows[:, end - block + 1 + k])
    return run


def _search(texts: W.Texts, found: W.Words, p: Patterns) -> tuple[np.ndarray, list[int]]:
    """First words of the places where a pattern occurs, and the pattern of each."""
    block = min(BLOCK, p.length)
    n = len(found.hashes)
    if n < p.length:
        return np.zeros(0, np.int64), []
    keys = _run_hashes(found.hashes, block)  # of the block that starts at each word
    shift = np.full(len(keys), p.length - block + 1)
    some = np.flatnonzero(p.marks[keys & MARK])
    at = np.minimum(np.searchsorted(p.blocks, keys[some]), len(p.blocks) - 1)
    known = p.blocks[at] == keys[some]
    shift[some[known]] = p.shifts[at[known]]
    # all rows are walked side by side, each from the end of its first window, in pieces of bounded length
    starts, ends = _pieces(found.bounds, p.length)
    here, stop = starts + p.length - 1, ends
    places = []
    while len(here):
        skip = shift[here - block + 1]
        places.append(here[skip == 0])
        here = here + np.maximum(skip, 1)
        on = here < stop
        here, stop = here[on], stop[on]
    last = np.sort(np.concatenate(places)) if places else np.zeros(0, np.int64)
    first = last - p.length + 1
    run = np.zeros(len(first), np.uint64)
    for k in range(p.length):
        word = found.hashes[first + k]
        run = W.chained(run, word) if k else word
    low, high = np.searchsorted(p.hashes, run, "left"), np.searchsorted(p.hashes, run, "right")
    hits, which = [], []
    for place in np.flatnonzero(high > low):
        text = _joined(texts, found, int(first[place]), p.length)
        for k in range(low[place], high[place]):
            if p.texts[k] == text:
                hits.append(int(first[place]))
                which.append(k)
    return np.array(hits, np.int64), which


#: Words of a row that are walked as one piece.
PIECE = 256


def _pieces(bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of the rows that hold a window: first word, and the word after the last end of a window in it."""
    n = np.diff(bounds) - length + 1  # windows of each row
    rows = np.flatnonzero(n > 0)
    count = -(-n[rows] // PIECE)
    row = np.repeat(rows, count)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = bounds[row] + inner * PIECE
    after = np.minimum(first + PIECE, bounds[row] + n[row])
    return first, after + length - 1


def _passes(benchmark: DataFrame, key: str, text: str, limit: int) -> Iterator[list]:
    """The benchmark in blocks of a bounded size, one empty block for an empty one; rows come partition by partition."""
    rows, size, whole = [], 0, True
    for row in benchmark.select(F.col(key).cast("string"), text).toLocalIterator():
        rows.append(row)
        size += len(row[1] or "")
        if size >= limit:
            yield rows
            rows, size, whole = [], 0, False
    if rows or whole:
        yield rows


def hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", limit: int = PASS_BYTES
) -> tuple[DataFrame, str]:
    """The rows with a struct of n_words, n_hit and items, and the name of that column.

    With more blocks than one, the rows pass through the search of each block in turn. Words that several
    blocks hit are counted once, as each pass hands on the places of the words it hit.
    """
    name = fresh(docs, "found")
    spark = docs.sparkSession
    kind = "struct<n_words:bigint,places:binary,items:array<string>>"
    out = docs.withColumn(name, F.lit(None).cast(kind))
    schema = out.schema
    at = out.columns.index(text)
    for rows in _passes(benchmark, item, "text", limit):
        tables = spark.sparkContext.broadcast(build([r[0] for r in rows], [r[1] for r in rows]))

        def run(batches: Iterator[pa.RecordBatch], tables=tables) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                known = batch.column(batch.num_columns - 1)
                for part in W.chunks(batch.column(at)):
                    n = len(part.bounds) - 1
                    yield _found(batch.slice(part.first, n), part, known.slice(part.first, n), tables.value)

        out = out.mapInArrow(run, schema)
    return out, name


def _found(batch: pa.RecordBatch, texts: W.Texts, known: pa.Array, tables: list[Patterns]) -> pa.RecordBatch:
    """The rows with what this pass and those before it have found."""
    result = []
    found = W.words(texts, W.ALNUM)
    change = np.zeros(len(found.hashes) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for p in tables:
        first, which = _search(texts, found, p)
        np.add.at(change, first, 1)
        np.add.at(change, first + p.length, -1)
        for row, k in zip(found.rows[first], which, strict=True):
            items.setdefault(int(row), set()).update(p.items[k])
    hit = np.cumsum(change[:-1]) > 0
    total = np.r_[0, np.cumsum(hit)]
    for row, before in enumerate(known.to_pylist()):
        a, b = found.bounds[row], found.bounds[row + 1]
        own = hit[a:b] if total[b] > total[a] else None
        named = items.get(row, set())
        if before is not None and before["places"]:
            earlier = np.unpackbits(np.frombuffer(before["places"], np.uint8), count=int(b - a)).astype(bool)
            own = earlier if own is None else own | earlier
        if before is not None:
            named = named | set(before["items"])
        places = np.packbits(own).tobytes() if own is not None else b""
        result.append({"n_words": int(b - a), "places": places, "items": sorted(named)})
    field = batch.schema.field(batch.num_columns - 1)
    arrays = [*batch.columns[:-1], pa.array(result, field.type)]
    return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)


def _hit_words(places: Column) -> Column:
    """Set bits of a binary value, by its hex digits."""
    digits = F.hex(places)
    ones = {1: "1248", 2: "3569AC", 3: "7BDE", 4: "F"}

    def times(letters: str) -> Column:
        return F.length(digits) - F.length(F.translate(digits, letters, ""))

    return sum((k * times(letters) for k, letters in ones.items()), F.lit(0)).cast("long")


def contamination_report(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    limit: int = PASS_BYTES,
) -> DataFrame:
    """Per row: n_words, n_hit, n_items, digest of the items' ids, and whether any word is hit."""
    out, name = hits(docs.select(key, text), benchmark, text, item, limit)
    found = F.col(name)
    hit, items = _hit_words(found["places"]), found["items"]
    return out.select(
        key,
        found["n_words"].alias("n_words"),
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """The rows without a hit word, with their own columns."""
    out, name = hits(docs, benchmark, text, item)
    return out.where(F.length(F.col(name)["places"]) == 0).select(*map(quoted, docs.columns))
