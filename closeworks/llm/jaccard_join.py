"""Exact join of documents whose word n-grams have at least a given Jaccard similarity.

Relations between sets are used to skip work, twice:

- Index lists. The rarest n-grams of a set are its prefix; similar sets share one of them. The sets of an
  n-gram form a list, walked in blocks that are ordered by set size and by position in the prefix. Blocks
  whose sizes or positions rule out enough common n-grams are skipped as a whole, and bit signatures bound
  the difference of the sets of the other blocks.
- Answers. Equal sets are one set. Sets similar to a leader join its component; only sets of different
  components are compared further, and the overlaps of two sets with the same leader, which are known, give
  bounds that decide many of these pairs without the sets themselves.

The order of n-grams goes by how often their hash cell occurs in the whole corpus. The cells are a fixed
number of counters; frequent n-grams stand out from their noise at any corpus size, and any order is right.

n-grams and sets are known by 64-bit hashes. Defined cases: a text without words, or null, has the empty set,
which links with nothing; fewer words than an n-gram's are one n-gram; rows with equal sets are linked, also
with equal ids; null ids keep their rows, and the smallest id that is not null names the component, null
if there is none; empty tables give empty results; columns of the input keep their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.llm import words as W
from closeworks.llm.components import components
from closeworks.llm.names import fresh
from closeworks.llm.store import written
from closeworks.operators.joins import lookup
from closeworks.operators.schema import quoted

#: Counters of the frequency sketch, and how many travel in a row.
CELLS = 1 << 20
CELLS_PER_ROW = 1 << 16
#: Words of 64 bits of a signature, and the largest set that has one: beyond it bits are too crowded to tell.
SIGNATURE = 8
SIGNED_SIZE = 1200
#: Sets of a list that are compared with each other in one task; longer lists are cut into such parts.
LIST = 4096
#: Sets of a block of a list.
STRIDE = 256
#: Lists of up to so many sets are probed for partners before signatures are joined.
PROBED = 16
#: Lists of up to so many sets hand on all their fitting pairs.
SHORT = 8
#: Rows of keys that may be broadcast (8 bytes each); more are shuffled.
BROADCAST_ROWS = 1_000_000


def required(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Common n-grams that sets of these sizes need."""
    return -(-percent * (n + m) // (100 + percent))


def _sets(texts: W.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of each text, and where each text's start."""
    grams, rows = W.shingles(W.words(texts), size)
    order = np.lexsort((grams, rows))
    grams, rows = grams[order], rows[order]
    if len(grams):
        keep = np.r_[True, (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])]
        grams, rows = grams[keep], rows[keep]
    return grams, np.searchsorted(rows, np.arange(len(texts.bounds)))


def _names(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; that of the empty set is 0."""
    sums = np.r_[np.uint64(0), np.cumsum(W.mixed(grams))]
    sizes = np.diff(bounds)
    names = W.chained(sums[bounds[1:]] - sums[bounds[:-1]], sizes.astype(np.uint64))
    return np.where(sizes > 0, names, np.uint64(0))


def _signatures(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Parity of the n-grams of each set that fall on each bit; two signatures differ in no more bits than the sets."""
    n, width = len(bounds) - 1, SIGNATURE * 64
    bit = (W.mixed(grams + np.uint64(1)) % np.uint64(width)).astype(np.int64)
    falls = np.bincount(np.repeat(np.arange(n) * width, np.diff(bounds)) + bit, minlength=n * width)
    return np.packbits((falls & 1).astype(np.uint8), bitorder="little").view(np.uint64).reshape(n, SIGNATURE)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _texts(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, W.Texts]]:
    for batch in batches:
        for part in W.chunks(batch.column(text)):
            yield batch.slice(part.first, len(part.bounds) - 1), part


def members(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Per row: its id, the size and name of its set, its signature, and the hash of its text."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in _texts(batches, 1):
            grams, bounds = _sets(part, size)
            n = np.diff(bounds)
            bits = _signatures(grams, bounds)
            signature = [bits[i].tobytes() if 0 < n[i] <= SIGNED_SIZE else None for i in range(len(n))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(n.astype(np.int64)),
                    pa.array(_signed(_names(grams, bounds))),
                    pa.array(signature, pa.binary()),
                ],
                ["id", "text_hash", "n", "set", "bits"],
            )

    return rows.mapInArrow(run, f"id {kind}, text_hash bigint, n bigint, set bigint, bits binary")


def frequencies(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """How often the n-grams of each cell occur as members of a set, over all rows."""
    schema = "part int, task int, counts binary"

    def emit(counts: dict[int, np.ndarray], task: int) -> Iterator[pa.RecordBatch]:
        for part, values in sorted(counts.items()):
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "task": [task], "counts": [values.tobytes()]},
                pa.schema([("part", pa.int32()), ("task", pa.int32()), ("counts", pa.binary())]),
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for _, part in _texts(batches, 0):
            grams, _ = _sets(part, size)
            total += np.bincount((grams % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        if total.any():
            task = int(total.sum() % 64)
            yield from emit(dict(enumerate(total.reshape(-1, CELLS_PER_ROW))), task)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, values in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                more = np.frombuffer(values.as_buffer(), np.int64)
                sums[part] = sums[part] + more if part in sums else more
        yield from emit(sums, 0)

    counted = docs.select(text).mapInArrow(count, schema)
    summed = counted.repartition("part", "task").mapInArrow(add, schema).repartition("part").mapInArrow(add, schema)
    out = np.zeros((CELLS // CELLS_PER_ROW, CELLS_PER_ROW), np.int64)
    for row in summed.collect():  # CELLS counters, whatever the corpus
        out[row["part"]] += np.frombuffer(bytes(row["counts"]), np.int64)
    return out.reshape(-1)


def _prefixes(docs: DataFrame, text: str, size: int, percent: int, counts: np.ndarray) -> DataFrame:
    """The rarest n-grams of each set, enough for similar sets to share one: (gram, set, n, pos)."""
    # ties in the order are broken by the hash, and counts above 2 ** 32 are all alike
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, 2**32 - 1).astype(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen = shared.value, set()
        for _, part in _texts(batches, 0):
            grams, bounds = _sets(part, size)
            names, n = _names(grams, bounds), np.diff(bounds)
            first = np.array([i for i, x in enumerate(names.tolist()) if n[i] and x not in seen and not seen.add(x)], np.int64)
            if len(seen) > 100_000:
                seen.clear()  # repeated sets are also dropped where lists meet
            rows = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((grams, cells[(grams % np.uint64(CELLS)).astype(np.int64)], rows))
            length = n[first] - -(-percent * n[first] // 100) + 1
            row = np.repeat(first, length)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_signed(grams[order[bounds[row] + pos]])),
                    pa.array(_signed(names[row])),
                    pa.array(n[row].astype(np.int32)),
                    pa.array(pos.astype(np.int32)),
                ],
                ["gram", "set", "n", "pos"],
            )

    return docs.select(text).mapInArrow(run, "gram bigint, set bigint, n int, pos int")


def _together(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt out by some keys, and sorted by them and the set.

    They are dealt by a hash of their own: a repartition by keys that a join has just used would be left out, and adaptive
    execution may then read the join's shuffle in another way that takes the rows of a key apart.
    """
    dealt = rows.withColumn("dealt", F.xxhash64(*keys)).repartition("dealt")
    return dealt.sortWithinPartitions(*keys, "set")


def _partnered(rows: list[np.ndarray], percent: int) -> np.ndarray:
    """Which entries of whole lists (gram, set, n, pos) to keep: those that sizes and positions leave a partner.

    Lists of more than PROBED entries are kept as they are.
    """
    gram, _, n, pos = (x.astype(np.int64) for x in rows)
    first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
    size = np.diff(np.r_[first, len(gram)])
    keep = np.repeat(size > PROBED, size)
    left = np.repeat(first + size, size) - np.arange(len(gram))
    left[keep] = 0
    for d in range(1, PROBED):
        i = np.flatnonzero(left > d)
        if not len(i):
            break
        j = i + d
        need = required(n[i], n[j], percent)
        fits = 1 + np.minimum(n[i] - pos[i] - 1, n[j] - pos[j] - 1) >= need
        keep[i[fits]] = keep[j[fits]] = True
    return keep


def _shared(entries: DataFrame, percent: int) -> DataFrame:
    """The entries whose n-gram a set has too that may be similar; equal entries count once.

    Rows stream through. Of a list that goes on with the next batch either few rows are held, or all so far are kept.
    """
    names = ["gram", "set", "n", "pos"]

    def batch_of(rows: list[np.ndarray], keep: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in rows], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, t) for t in (np.int64, np.int64, np.int32, np.int32)]
        kept_whole = last_set = None  # the n-gram whose rows so far are kept, and the last set among them
        for batch in batches:
            rows = [np.r_[h, batch.column(k).to_numpy()] for k, h in enumerate(held)]
            gram, name = rows[0], rows[1]
            new = np.r_[True, (gram[1:] != gram[:-1]) | (name[1:] != name[:-1])]
            if kept_whole is not None and len(gram):
                new[0] = gram[0] != kept_whole or name[0] != last_set
            rows = [x[new] for x in rows]
            gram = rows[0]
            if kept_whole is not None:
                more = int(np.searchsorted(gram, kept_whole, "right"))
                if more:
                    last_set = rows[1][more - 1]
                    yield batch_of(rows, np.arange(more))
                    rows = [x[more:] for x in rows]
                    gram = rows[0]
            if not len(gram):
                held = rows
                continue
            cut = int(np.searchsorted(gram, gram[-1]))
            if len(gram) - cut > PROBED:
                kept_whole, last_set, cut = gram[-1], rows[1][-1], len(gram)
            whole = [x[:cut] for x in rows]
            yield batch_of(whole, _partnered(whole, percent)) if cut else batch_of(whole, np.zeros(0, bool))
            held = [x[cut:] for x in rows]
        if len(held[0]):
            yield batch_of(held, _partnered(held, percent))

    return _together(entries, "gram").mapInArrow(run, "gram bigint, set bigint, n int, pos int")


LISTED = "gram bigint, p int, q int, c int, set bigint, n int, pos int, bits binary, component bigint, leader bigint, common int, leader_n int"
PAIRS = "a bigint, b bigint, na int, nb int, sure boolean, kept boolean"


class _List:
    """Sets that share n-grams, as arrays."""

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def of(cls, t: pa.Table) -> _List:
        def array(name: str) -> np.ndarray:
            return t[name].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)

        column = t["bits"].combine_chunks()
        signed = column.is_valid().to_numpy(zero_copy_only=False)
        bits = np.zeros((len(signed), SIGNATURE), np.uint64)
        if signed.any():
            joined = b"".join(column.drop_null().to_pylist())
            bits[signed] = np.frombuffer(joined, np.uint64).reshape(-1, SIGNATURE)
        names = ("gram", "p", "q", "c", "set", "n", "pos", "component", "leader", "common", "leader_n")
        return cls(bits=bits, signed=signed, **{k: array(k) for k in names})

    def __len__(self) -> int:
        return len(self.n)

    def __getitem__(self, rows: slice | np.ndarray) -> _List:
        return _List(**{k: v[rows] for k, v in self.__dict__.items()})

    def starts(self) -> np.ndarray:
        """First rows of the lists, which follow one another, and the number of rows."""
        same = (self.gram[1:] == self.gram[:-1]) & (self.p[1:] == self.p[:-1]) & (self.q[1:] == self.q[:-1])
        return np.r_[0, np.flatnonzero(~same) + 1, len(self)]

    def fits(self, i: np.ndarray, j: np.ndarray, percent: int, across: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether sizes, positions and signatures allow the sets at i and j; their least difference; whether it is sure.

        The bound by positions holds for the first n-gram that two sets share, so similar sets fit in that list.
        across: only pairs of different components; overlaps with a common leader decide some of them.
        """
        ni, nj = self.n[i], self.n[j]
        need = required(ni, nj, percent)
        fits = 1 + np.minimum(ni - self.pos[i] - 1, nj - self.pos[j] - 1) >= need
        fits &= (np.minimum(ni, nj) >= need) & (self.set[i] != self.set[j])
        fits &= (self.p[i] == self.q[i]) | (self.c[i] != self.c[j])
        differ = np.bitwise_count(self.bits[i] ^ self.bits[j]).sum(axis=-1, dtype=np.int64)
        differ *= self.signed[i] & self.signed[j]
        fits &= differ <= ni + nj - 2 * need
        sure = np.zeros(fits.shape, bool)
        if across:
            led = (self.leader[i] == self.leader[j]) & (self.leader_n[i] > 0) & (self.leader_n[j] > 0)
            ci, cj = self.common[i], self.common[j]
            fits &= self.component[i] != self.component[j]
            fits &= ~led | (np.minimum(ci, cj) + np.minimum(ni - ci, nj - cj) >= need)
            sure = led & (ci + cj - self.leader_n[i] >= need)
        return fits, differ, sure

    def blocks(self, percent: int, across: bool) -> tuple[np.ndarray, ...]:
        """Fitting pairs (i, j) of one list, with their least difference and whether they are sure."""
        out = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)]
        for a in range(0, len(self), STRIDE):
            for b in range(a, len(self), STRIDE):
                if self._skips(slice(a, a + STRIDE), slice(b, b + STRIDE), percent, across):
                    continue
                i, j = np.arange(a, min(a + STRIDE, len(self)))[:, None], np.arange(b, min(b + STRIDE, len(self)))[None, :]
                fits, differ, sure = self.fits(i, j, percent, across)
                x, y = np.nonzero(fits & (i < j))
                out.append((x + a, y + b, differ[x, y], sure[x, y]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _skips(self, i: slice, j: slice, percent: int, across: bool) -> bool:
        """Whether no pair of two blocks can be similar, by their sizes and positions."""
        ni, nj = self.n[i], self.n[j]
        if 100 * ni.max() < percent * nj.min() or 100 * nj.max() < percent * ni.min():
            return True
        if across and len({self.component[i].min(), self.component[i].max(), self.component[j].min(), self.component[j].max()}) == 1:
            return True
        most = 1 + min((ni - self.pos[i] - 1).max(), (nj - self.pos[j] - 1).max())
        return bool(most < required(ni.min(), nj.min(), percent))

    def by_size(self) -> _List:
        """One list in the order of its blocks: sizes that are close, then positions."""
        return self[np.lexsort((self.pos, (np.log(np.maximum(self.n, 1)) * 20).astype(np.int64)))]

    def stars(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of the fitting pairs those that tie a set to its neighbour with most pairs."""
        degree = np.bincount(i, minlength=len(self)) + np.bincount(j, minlength=len(self))
        rank = np.empty(len(self), np.int64)
        rank[np.lexsort((self.set, -degree))] = np.arange(len(self))
        best = rank.copy()
        np.minimum.at(best, i, rank[j])
        np.minimum.at(best, j, rank[i])
        return np.flatnonzero((best[i] == rank[j]) | (best[j] == rank[i]))

    def closest(self, i: np.ndarray, j: np.ndarray, differ: np.ndarray) -> np.ndarray:
        """Of the fitting pairs the least different one of each two components."""
        low = np.minimum(self.component[i], self.component[j])
        high = np.maximum(self.component[i], self.component[j])
        order = np.lexsort((differ, high, low))
        new = np.r_[True, (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])]
        return order[new]

    def pairs(self, i: np.ndarray, j: np.ndarray, sure: np.ndarray, lone: np.ndarray) -> pa.RecordBatch:
        """Pairs in the order of their names, and kept rows for the sets that have any."""
        swap = self.set[i] > self.set[j]
        a, b = np.where(swap, j, i), np.where(swap, i, j)
        none = np.zeros(len(lone), np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[self.set[a], self.set[lone]]),
                pa.array(np.r_[self.set[b], none]),
                pa.array(np.r_[self.n[a], none].astype(np.int32)),
                pa.array(np.r_[self.n[b], none].astype(np.int32)),
                pa.array(np.r_[sure, none.astype(bool)]),
                pa.array(np.r_[np.zeros(len(a), bool), np.ones(len(lone), bool)]),
            ],
            ["a", "b", "na", "nb", "sure", "kept"],
        )


def _pairs(rows: _List, percent: int, mode: str) -> Iterator[pa.RecordBatch]:
    """Pairs of some whole lists. All pairs of a short list count, of a longer one those that the mode selects."""
    across = mode != "stars"
    starts = rows.starts()
    size = np.diff(starts)
    left = np.repeat(starts[1:], size) - np.arange(len(rows))  # rows of the list from here on
    short = np.repeat(size <= SHORT, size)
    for d in range(1, SHORT):
        i = np.flatnonzero(short & (left > d))
        fits, _, sure = rows.fits(i, i + d, percent, across)
        i = i[fits]
        if len(i):
            lone = np.zeros(0, np.int64) if across else np.unique(np.r_[i, i + d])
            yield rows.pairs(i, i + d, sure[fits], lone)
    for k in np.flatnonzero(size > SHORT):
        one = rows[starts[k] : starts[k + 1]].by_size()
        i, j, differ, sure = one.blocks(percent, across)
        if not len(i):
            continue
        lone = np.zeros(0, np.int64) if across else np.unique(np.r_[i, j])
        some = {"stars": lambda: one.stars(i, j), "closest": lambda: one.closest(i, j, differ)}  # noqa: B023
        at = some[mode]() if mode in some else np.arange(len(i))
        yield one.pairs(i[at], j[at], sure[at], lone)


def _candidates(lists: DataFrame, percent: int, mode: str) -> DataFrame:
    """Pairs of the lists, each list or part of a long one walked by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            key = [t[k].to_numpy() for k in ("gram", "p", "q")]
            cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0))
            whole = int(cuts[-1]) + 1 if len(cuts) else 0
            held = t.slice(whole)
            if whole:
                yield from _pairs(_List.of(t.slice(0, whole)), percent, mode)
        if held is not None:
            yield from _pairs(_List.of(held), percent, mode)

    return _together(lists, "gram", "p", "q").mapInArrow(run, PAIRS)


def _dealt(lists: DataFrame) -> DataFrame:
    """Lists with the parts (p, q) that are compared with each other: one for most, all pairs of parts for long ones."""
    long = lists.groupBy("gram").count().where(F.col("count") > LIST)
    parts = F.coalesce(F.ceil(F.col("count") / LIST), F.lit(1)).cast("int")
    joined = lists.join(_few(written(long, "long")), "gram", "left").withColumn("k", parts).drop("count")
    joined = joined.withColumn("c", F.pmod(F.xxhash64("set"), F.col("k")).cast("int"))
    joined = joined.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    return joined.withColumn("p", F.least("c", "o")).withColumn("q", F.greatest("c", "o")).drop("o", "k")


def _few(df: DataFrame) -> DataFrame:
    """A table of keys, to be broadcast if its rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _sets_of(docs: DataFrame, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """The n-grams of the wanted sets (set, text_hash)."""
    keys = _few(wanted.select(F.col("text_hash").alias("text_hash_")).distinct())
    rows = docs.select(F.col(text).alias("text")).join(keys, F.xxhash64("text") == F.col("text_hash_"), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in _texts(batches, 0):
            grams, bounds = _sets(part, size)
            names = _signed(_names(grams, bounds))
            _, first = np.unique(names, return_index=True)
            offsets = np.r_[0, np.cumsum(np.diff(bounds)[first])]
            flat = np.concatenate([grams[bounds[k] : bounds[k + 1]] for k in first]) if len(first) else grams
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(_signed(flat)))
            yield pa.RecordBatch.from_arrays([pa.array(names[first]), lists], ["set", "grams"])

    found = rows.mapInArrow(run, "set bigint, grams array<bigint>")
    return found.join(_few(wanted.select("set").distinct()), "set", "left_semi").dropDuplicates(["set"])


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with the number of their common n-grams; only the sets of pairs are shuffled."""
    pairs = written(pairs, "pairs")
    named = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    sets = sets.join(_few(written(named, "named")), "set", "left_semi")
    a = sets.select(F.col("set").alias("a"), F.col("grams").alias("grams_a"))
    b = sets.select(F.col("set").alias("b"), F.col("grams").alias("grams_b"))
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", common.alias("common"))


def _similar(percent: int) -> Column:
    return 100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))


def links(docs: DataFrame, found: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """Links (a, b) between sets that connect just the sets that similar pairs connect."""
    entries = _shared(_prefixes(docs, text, size, percent, frequencies(docs, text, size)), percent)
    signatures = found.where("n > 0").select("set", "bits").dropDuplicates(["set"])
    none = {"component": "bigint", "leader": "bigint", "common": "int", "leader_n": "int"}
    columns = [x.split()[0] for x in LISTED.split(", ")]
    entries = written(entries, "entries")
    lists = _dealt(written(entries.join(signatures, "set"), "lists"))
    lists = lists.withColumns({k: F.lit(None).cast(v) for k, v in none.items()}).select(*columns)
    first = written(_candidates(lists, percent, "stars").distinct(), "pairs")

    near = _few(written(first.where("kept").select(F.col("a").alias("set")).distinct(), "near"))
    wanted = found.join(near, "set", "left_semi").groupBy("set").agg(F.min("text_hash").alias("text_hash"))
    sets = written(_sets_of(docs, text, size, written(wanted, "wanted")), "sets")
    lists = written(lists.drop(*none).join(near, "set", "left_semi"), "lists")

    tried = written(_overlaps(first.where("not kept").select("a", "b", "na", "nb"), sets), "tried")
    linked = tried.where(_similar(percent)).select("a", "b")
    led = tried.select("a", "na", "b", "common").union(tried.select("b", "nb", "a", "common"))
    for mode in ("closest", "rest"):
        labels = components(linked)
        leader = _leaders(led)
        now = lists.join(labels.withColumnRenamed("id", "set"), "set", "left").join(leader, "set", "left")
        now = now.withColumn("component", F.coalesce("component", "set")).select(*columns)
        pairs = _candidates(_apart(now), percent, mode).drop("kept").distinct()
        pairs = written(pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        sure = pairs.where("sure").select("a", "b")
        more = written(_overlaps(pairs.where("not sure").select("a", "b", "na", "nb"), sets), "tried")
        tried = tried.unionByName(more)
        linked = linked.union(sure).union(more.where(_similar(percent)).select("a", "b"))
    return linked


def _leaders(led: DataFrame) -> DataFrame:
    """For each set the leader it has most n-grams in common with."""
    best = F.max(F.struct("common", "leader", "leader_n"))
    found = led.toDF("leader", "leader_n", "set", "common").groupBy("set").agg(best.alias("best"))
    return found.select("set", "best.leader", "best.common", "best.leader_n")


def _apart(lists: DataFrame) -> DataFrame:
    """The parts of lists that hold sets of different components."""
    key = ["gram", "p", "q"]
    mixed = lists.groupBy(*key).agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    return lists.join(mixed.select(*key), key, "left_semi")


def _grouped(docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """Per row: id, text_hash, n and the group its set belongs to, null for the empty set."""
    found = written(members(docs, key, text, size), "members")
    labels = components(links(docs, found, text, size, percent))
    joined = found.join(labels.withColumnRenamed("id", "set"), "set", "left")
    group = F.when(F.col("n") > 0, F.coalesce("component", "set"))
    return joined.select("id", "text_hash", "n", group.alias("group"))


def similar_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, percent: int = 85
) -> DataFrame:
    """Per row: id, size of its set, and the smallest id that links reach, itself included."""
    rows = _grouped(docs, key, text, size, percent)
    smallest = rows.where("group is not null").groupBy("group").agg(F.min("id").alias("smallest"))
    # looked up so that adaptive execution can split a group of very many rows
    return lookup(rows, smallest, "group", ["smallest"], derived=True).select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("smallest")).alias("component_id"),
    )


def drop_similar(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """One row of each group: that with the smallest id, null ids last; of several such rows the smallest in all columns.

    Rows without words all stay.
    """
    rows = written(_grouped(docs, key, text, size, percent), "groups").where("group is not null")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_hash"))
    best = rows.groupBy("group").agg(first.alias("best"))
    counted = rows.groupBy("group", "id", "text_hash").count()
    counted = lookup(counted, best, "group", ["best"], derived=True)
    stays = F.col("best.id").eqNullSafe(F.col("id")) & (F.col("best.text_hash") == F.col("text_hash"))
    id_, hash_, repeated = (fresh(docs, x) for x in ("id_", "text_hash_", "repeated_"))
    # rows that go, and rows that are found several times, of which one stays
    marked = counted.select(F.col("id").alias(id_), F.col("text_hash").alias(hash_), stays.alias(repeated), "count")
    marked = written(marked.where((~F.col(repeated)) | (F.col("count") > 1)).drop("count"), "marked")
    marked = _few(marked)
    same = docs[key].eqNullSafe(marked[id_]) & (F.xxhash64(docs[text]) == marked[hash_])
    others = docs.join(marked, same, "left_anti")
    twice = docs.join(marked.where(repeated), same, "left_semi")
    one = F.min(F.struct(*map(quoted, docs.columns))).alias("row")
    return others.unionByName(twice.groupBy(F.col(key), F.xxhash64(text).alias(hash_)).agg(one).select("row.*"))
