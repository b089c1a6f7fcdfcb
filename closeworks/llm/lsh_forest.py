"""Near-duplicate documents by a forest of sorted MinHash signatures, with links confirmed on whole sets.

A signature is the least hash of a set of word n-grams under each of MINHASHES functions. Each tree of the forest orders the
signatures by positions of its own; sets that agree in the first DEPTH of them are a region of the tree. Sets of 80 %
similarity miss each other in all 32 trees once in 2e7 such pairs, more similar ones far more rarely. Dense regions go deeper: two of
the next four positions must agree as well, in any of their six pairs, which keeps 97 of 100 such pairs of a tree together.

Each region has a leader, that of its sets which has most company in all trees, so that the sets around one text share few
leaders. Sets are compared with the leaders of their regions. What these links don't connect is compared further:

- sets far from a region's leader with their neighbours in its sorted order, which have the longest common prefixes, and in a region
  with more sets than such neighbours with all of them;
- sets near the same leader with each other. By how each of them differs from the leader, bounds and then exact
  overlaps follow without the sets themselves.

Sets are dealt to cells for that, each with a bounded number of them, so that nothing is left out. A sketch of one bit per
function travels with each set and tells near from far, with a margin of six standard deviations. Near pairs are
confirmed by the n-grams themselves.

n-grams and sets are known by 64-bit hashes. Defined cases: a text without words, or null, has the empty set, which links
with nothing; fewer words than an n-gram's are one n-gram; rows with equal sets are linked, also with equal ids; null ids keep their
rows, and the smallest id that is not null names the component, null if there is none; a row is kept if its id names its
component, and so are rows with a null id in a component without a name; an empty table gives no rows; other columns are
left out, so their names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.llm import words as W
from closeworks.llm.components import components
from closeworks.llm.store import written
from closeworks.operators.joins import inner_lookup, lookup

MINHASHES, DEPTH = 128, 4
TREES = MINHASHES // DEPTH
#: Bits of two sketches that may differ. Sets of 80 % similarity differ in 13 of 128, with a standard deviation of 3.4.
FAR = 34
#: Bits in which a set near its leader may differ; unrelated sets differ in 64, with a standard deviation of 5.7.
NEAR = 50
#: Neighbours on each side in a sorted order.
NEIGHBOURS = 4
#: Sets of a region beyond which it goes deeper, and sets of each side of a cell.
DENSE = CELL = 2048
#: Pairs that are looked at together, those whose differences are compared, and 64-bit words of such a comparison.
PAIRS, COMPARED, WORDS = 1 << 18, 1 << 13, 256
#: Rows of keys that may be broadcast (8 bytes each); more are shuffled.
BROADCAST_ROWS = 1_000_000
#: Distinct sets that a task remembers so as to sign a set once.
REMEMBERED = 100_000

MULTIPLIERS = W.mixed(np.arange(1, MINHASHES + 1, dtype=np.uint64)) | np.uint64(1)


def _sets(texts: W.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of each text, and where each text's start."""
    grams, rows = W.shingles(W.words(texts), size)
    order = np.lexsort((grams, rows))
    grams, rows = grams[order], rows[order]
    new = np.r_[True, (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])][: len(grams)]
    return grams[new], np.searchsorted(rows[new], np.arange(len(texts.bounds)))


def _names(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set."""
    sums = np.r_[np.uint64(0), np.cumsum(W.mixed(grams))]
    return W.chained(sums[bounds[1:]] - sums[bounds[:-1]], np.diff(bounds).astype(np.uint64)).view(np.int64)


def signatures(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(set, function): the least hash of each set that is not empty; 0 for empty ones."""
    out = np.zeros((len(bounds) - 1, MINHASHES), np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        for k, factor in enumerate(MULTIPLIERS):
            hashes = ((grams * factor) >> np.uint64(32)).astype(np.uint32)
            out[some, k] = np.minimum.reduceat(hashes, bounds[some])
    return out


def members(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Per row: id, hash of its text, size and name of its set, and its signature unless the task has given it before."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in W.chunks(batch.column(1)):
                some = batch.slice(part.first, len(part.bounds) - 1)
                grams, bounds = _sets(part, size)
                names, n = _names(grams, bounds), np.diff(bounds)
                if len(seen) > REMEMBERED:
                    seen.clear()
                new = [k > 0 and x not in seen and not seen.add(x) for k, x in zip(n.tolist(), names.tolist(), strict=True)]
                signed = [x.tobytes() if fresh else None for x, fresh in zip(signatures(grams, bounds), new, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(2), pa.array(n.astype(np.int64)), pa.array(names), pa.array(signed, pa.binary())],
                    ["id", "text_hash", "n", "set", "signature"],
                )

    return rows.mapInArrow(run, f"id {kind}, text_hash bigint, n bigint, set bigint, signature binary")


def entries(signed: DataFrame) -> DataFrame:
    """(region, rest, set, s1, s2) for each tree: the region's name, the next four positions in order, and the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, MINHASHES)
            sketch = np.packbits((values & 1).astype(np.uint8), axis=1, bitorder="little").view(np.int64)
            trees = values.reshape(-1, TREES, DEPTH).astype(np.uint64)
            region = np.broadcast_to(W.mixed(np.arange(1, TREES + 1, dtype=np.uint64)), trees.shape[:2])
            rest = np.zeros(trees.shape[:2], np.uint64)
            for k in range(DEPTH):
                region = W.chained(region, trees[:, :, k])
                rest = (rest << np.uint64(16)) | (np.roll(trees[:, :, k], -1, axis=1) & np.uint64(0xFFFF))
            sets = np.repeat(batch.column(0).to_numpy(), TREES)
            bits = np.repeat(sketch, TREES, axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (region.ravel().view(np.int64), rest.ravel().view(np.int64), sets, bits[:, 0], bits[:, 1])],
                ["region", "rest", "set", "s1", "s2"],
            )

    return signed.select("set", "signature").mapInArrow(run, ENTRIES)


ENTRIES = "region bigint, rest bigint, set bigint, s1 bigint, s2 bigint"


def _few(df: DataFrame) -> DataFrame:
    """A written table of keys, to be broadcast if its rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def regions(forest: DataFrame) -> DataFrame:
    """The entries that share a region with another set, in deeper regions where there are too many."""
    ends = [F.min("set").alias("first"), F.max("set").alias("last")]
    shared = forest.groupBy("region").agg(*ends, F.count("*").alias("sets")).where("first <> last")
    listed = written(inner_lookup(forest, shared, "region", ["sets"], derived=True), "listed")
    field = [F.shiftrightunsigned("rest", 48 - 16 * k).bitwiseAND(0xFFFF) for k in range(DEPTH)]
    both = [(j, k) for j in range(DEPTH) for k in range(j + 1, DEPTH)]
    six = F.array(*[F.xxhash64("region", F.lit(j), F.lit(k), field[j], field[k]) for j, k in both])
    dense = listed.where(F.col("sets") > DENSE).withColumn("region", F.explode(six)).drop("sets")
    deeper = dense.groupBy("region").agg(*ends, F.count("*").alias("sets")).where("first <> last")
    deeper = inner_lookup(dense, deeper, "region", ["sets"], derived=True)
    return listed.where(F.col("sets") <= DENSE).unionByName(deeper)


def led(listed: DataFrame) -> DataFrame:
    """The entries with their region's leader, and whether they are near it."""
    company = listed.groupBy("set").agg(F.sum("sets").alias("company"))
    known = lookup(listed, company, "set", ["company"], derived=True)
    best = known.groupBy("region").agg(F.max(F.struct("company", "set", "s1", "s2")).alias("best"))
    known = lookup(known, best, "region", ["best"], derived=True)
    differ = sum(F.bit_count(F.col(k).bitwiseXOR(F.col(f"best.{k}"))) for k in ("s1", "s2"))
    kept = ["region", "rest", "set", "s1", "s2"]
    return known.select(*kept, F.col("best.set").alias("leader"), (differ <= NEAR).alias("near"))


def _arrays(t: pa.Table, *names: str) -> list[np.ndarray]:
    return [t[k].combine_chunks().to_numpy(zero_copy_only=False) for k in names]


def _apart(t: pa.Table, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """Those pairs (i, j) of entries which are of different components, not both near their leader, and near each other."""
    sets, component, near, s1, s2 = _arrays(t, "set", "component", "near", "s1", "s2")
    at = np.flatnonzero((component[i] != component[j]) & ~(near[i] & near[j]))
    i, j = i[at], j[at]
    one, two = (np.bitwise_count((x[i] ^ x[j]).view(np.uint64)).astype(np.int64) for x in (s1, s2))
    i, j = i[one + two <= FAR], j[one + two <= FAR]
    return _pair_batch(sets[i], sets[j])


def neighbours(mixed: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets that are close in a region's order, where their prefixes are longest, and not both near its leader."""
    order = ["region", "rest", "set"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            before = held.num_rows if held is not None else 0
            t = pa.concat_tables([held, t]) if held is not None else t
            (region,) = _arrays(t, "region")
            for step in range(1, NEIGHBOURS + 1):
                j = np.arange(max(before, step), len(region))
                j = j[region[j] == region[j - step]]
                yield _apart(t, j - step, j)
            held = t.slice(max(0, t.num_rows - NEIGHBOURS))

    ordered = mixed.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("region", "set", "component", "near", "s1", "s2").mapInArrow(run, "a bigint, b bigint").distinct()


def _cells(rows: DataFrame, key: str, visits: Column, sizes: DataFrame) -> DataFrame:
    """Rows dealt to cells, where each visitor meets each row of its key at home. sizes: rows and visitors of each key."""
    known = inner_lookup(rows.withColumn("visits", visits), sizes, key, ["all_", "others"], derived=True)

    def blocks(count: str) -> Column:
        return F.ceil(F.col(count) / CELL)

    def own(count: str, salt: int) -> Column:
        return F.pmod(F.xxhash64("set", F.lit(salt)), blocks(count))

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), blocks(count) - 1))

    home = known.withColumn("x", own("all_", 1)).withColumn("y", each("others")).withColumn("visits", F.lit(False))
    away = known.where("visits").withColumn("y", own("others", 2)).withColumn("x", each("all_"))
    dealt = home.unionByName(away).withColumn("cell", F.xxhash64(key, "x", "y"))
    return dealt.drop("x", "y", "all_", "others").repartition("cell").sortWithinPartitions("cell", "visits")


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """(rows, i, j): visitors i and rows at home j of whole cells, a bounded number of pairs at a time."""

    def met(t: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
        cell, visits = _arrays(t, "cell", "visits")
        new = np.r_[True, cell[1:] != cell[:-1]]
        starts, number = np.flatnonzero(new), np.cumsum(new) - 1
        at_home = np.add.reduceat((~visits).astype(np.int64), starts)
        visitor = np.flatnonzero(visits)
        first, many = starts[number[visitor]], at_home[number[visitor]]
        upto = np.cumsum(many)
        at = 0
        while at < len(visitor):
            after = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
            n = many[at:after]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield t, np.repeat(visitor[at:after], n), np.repeat(first[at:after], n) + place
            at = after

    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]) if held is not None else t
        (cell,) = _arrays(t, "cell")
        whole = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0  # cells come in their order
        held = t.slice(whole)
        if whole:
            yield from met(t.slice(0, whole))
    if held is not None and held.num_rows:
        yield from met(held)


def far_pairs(mixed: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets of a region, of different components, that are not both near its leader but near each other.

    Only of regions with more sets than neighbours() compares with each other.
    """
    sizes = mixed.groupBy("region").agg(F.count("*").alias("all_"), F.count_if(~F.col("near")).alias("others"))
    sizes = sizes.where((F.col("others") > 0) & (F.col("all_") > NEIGHBOURS + 1))
    dealt = _cells(mixed.drop("rest", "leader"), "region", ~F.col("near"), sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, i, j in _meetings(batches):
            yield _apart(t, i, j)

    return dealt.select("cell", "visits", "set", "component", "near", "s1", "s2").mapInArrow(run, "a bigint, b bigint").distinct()


def _common(lists: pa.ListArray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common elements of the lists i and j, by bits for those elements that several lists have."""
    used, places = np.unique(np.r_[i, j], return_inverse=True)
    some = lists.take(pa.array(used))
    owner = np.repeat(np.arange(len(used)), some.value_lengths().to_numpy(zero_copy_only=False))
    _, element, times = np.unique(some.flatten().to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
    repeated = times > 1
    bit = (np.cumsum(repeated) - 1)[element]
    owner, bit = owner[repeated[element]], bit[repeated[element]]
    out = np.zeros(len(i), np.int64)
    left, right = places[: len(i)], places[len(i) :]
    for at in range(0, int(repeated.sum()), 64 * WORDS):
        inside = (bit >= at) & (bit < at + 64 * WORDS)
        bits = np.zeros((len(used), WORDS), np.uint64)
        word, within = np.divmod(bit[inside] - at, 64)
        np.bitwise_or.at(bits, (owner[inside], word), np.uint64(1) << within.astype(np.uint64))
        for k in range(0, len(i), COMPARED):
            both = bits[left[k : k + COMPARED]] & bits[right[k : k + COMPARED]]
            out[k : k + COMPARED] += np.bitwise_count(both).sum(axis=1, dtype=np.int64)
    return out


def around_leaders(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between sets near the same leader (leader, set, component, all, n, common, differ), one for two components.

    all, n, common: sizes of the leader and the set, and of what they have in common. differ: what only one of them has.
    """
    tally = rows.groupBy("leader", "component").count()
    most = F.max(F.struct("count", "component")).alias("most")
    sizes = tally.groupBy("leader").agg(F.sum("count").alias("all_"), most)
    sizes = sizes.select("leader", "all_", (F.col("all_") - F.col("most.count")).alias("others"), F.col("most.component").alias("main"))
    sizes = sizes.where("others > 0")
    known = inner_lookup(rows, sizes, "leader", ["main"], derived=True)
    dealt = _cells(known, "leader", F.col("component") != F.col("main"), sizes).drop("main")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, i, j in _meetings(batches):
            sets, component, all_, n, common = _arrays(t, "set", "component", "all", "n", "common")
            need = -(-percent * (n[i] + n[j]) // (100 + percent))
            most = np.minimum(common[i], common[j]) + np.minimum(n[i] - common[i], n[j] - common[j])
            at = np.flatnonzero((component[i] != component[j]) & (most >= need))
            i, j, need = i[at], j[at], need[at]
            overlap = common[i] + common[j] - all_[i] + _common(t["differ"].combine_chunks(), i, j)
            i, j = i[overlap >= need], j[overlap >= need]
            between = np.sort(np.stack([component[i], component[j]], axis=1), axis=1)
            _, one = np.unique(between, axis=0, return_index=True) if len(i) else (None, np.zeros(0, np.int64))
            yield _pair_batch(sets[i[one]], sets[j[one]])

    columns = ["cell", "visits", "set", "component", "all", "n", "common", "differ"]
    return dealt.select(*columns).mapInArrow(run, "a bigint, b bigint").distinct()


def _sets_of(docs: DataFrame, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """(set, grams) of the wanted sets (set, text_hash)."""
    keys = _few(written(wanted.select(F.col("text_hash").alias("hash")).distinct(), "keys"))
    rows = docs.select(F.col(text).alias("text")).join(keys, F.xxhash64("text") == F.col("hash"), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch.column(0)):
                grams, bounds = _sets(part, size)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(grams.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(_names(grams, bounds)), lists], ["set", "grams"])

    found = rows.mapInArrow(run, "set bigint, grams array<bigint>")
    return found.join(wanted.select("set"), "set", "left_semi").dropDuplicates(["set"])


class Overlaps:
    """Common n-grams of pairs of sets, whose n-grams are kept in a table."""

    def __init__(self, docs: DataFrame, found: DataFrame, text: str, size: int, pairs: DataFrame):
        named = written(pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct(), "named")
        known = found.where("n > 0").join(_few(named), "set", "left_semi")
        wanted = written(known.groupBy("set").agg(F.min("text_hash").alias("text_hash")), "wanted")
        self.sets = written(_sets_of(docs, text, size, wanted), "sets")
        common = F.size(F.array_intersect("grams_a", "grams_b"))
        sizes = [F.size("grams_a").alias("na"), F.size("grams_b").alias("nb")]
        self.pairs = written(self.joined(pairs).select("a", "b", *sizes, common.alias("common")), "overlaps")

    def joined(self, pairs: DataFrame) -> DataFrame:
        """Pairs with the n-grams of both sets."""
        a, b = (self.sets.select(F.col("set").alias(x), F.col("grams").alias(f"grams_{x}")) for x in "ab")
        return pairs.join(a, "a").join(b, "b")

    def links(self, percent: int) -> DataFrame:
        return self.pairs.where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _labelled(rows: DataFrame, labels: DataFrame, key: str, column: str) -> DataFrame:
    """The rows whose key's rows are of different components, with the component of the set in the column."""
    now = lookup(rows, labels, {column: "id"}, ["component"], derived=True)
    now = now.withColumn("component", F.coalesce("component", column))
    apart = now.groupBy(key).agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    return inner_lookup(now, apart, key, derived=True)


def links(docs: DataFrame, found: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """Links (a, b) between similar sets that connect those that all similar pairs connect."""
    forest = written(led(written(regions(entries(found.where("signature is not null"))), "regions")), "forest")
    pairs = forest.where(F.col("near") & (F.col("leader") != F.col("set")))
    pairs = written(pairs.select(F.col("leader").alias("a"), F.col("set").alias("b")).distinct(), "pairs")
    stars = Overlaps(docs, found, text, size, pairs)
    linked = stars.links(percent)

    labels = components(linked)
    mixed = written(_labelled(forest, labels, "region", "set"), "mixed")
    far = written(neighbours(mixed).union(far_pairs(mixed)).distinct(), "pairs")
    linked = linked.union(Overlaps(docs, found, text, size, far).links(percent))

    around = written(_labelled(stars.pairs, labels, "a", "b"), "around")
    only = [F.array_except(f"grams_{x}", f"grams_{y}") for x, y in ("ab", "ba")]
    around = stars.joined(around).select(
        F.col("a").alias("leader"), F.col("b").alias("set"), "component", F.col("na").cast("bigint").alias("all"),
        F.col("nb").cast("bigint").alias("n"), F.col("common").cast("bigint").alias("common"), F.concat(*only).alias("differ"),
    )
    return linked.union(written(around_leaders(around, percent), "links"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 2, percent: int = 80) -> DataFrame:
    """Per row: id, size of its set, the smallest id that links reach, itself included, and whether that is its own."""
    found = written(members(docs, key, text, size), "members")
    labels = components(links(docs, found, text, size, percent)).withColumnRenamed("id", "set")
    group = F.when(F.col("n") > 0, F.coalesce("component", "set"))
    rows = lookup(found.select("id", "n", "set"), labels, "set", ["component"], derived=True).withColumn("group", group)
    smallest = rows.where("group is not null").groupBy("group").agg(F.min("id").alias("smallest"))
    rows = lookup(rows, smallest, "group", ["smallest"], derived=True)
    component = F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("smallest"))
    return rows.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )
