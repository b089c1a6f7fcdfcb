"""Hard negatives: for anchors and their nearest rows of the same label, the nearest rows of other labels within a window of scores.

Scores are inner products of whole numbers, found by the method of the four Russians. Eight dimensions are a group, and for
each group of an anchor a table holds the sums of all 256 subsets of its components. A candidate's components are kept as
bit planes, eight dimensions of a plane to a byte, so a byte picks an entry of a table. Lookups of a plane are added, the
planes are shifted into each other from the highest, which is that of the sign and counts as negative, and the result
is the full exact score. No candidate is left out by an index.

All anchors meet all rows in cells, one of a block of anchors with one of a block of rows. Both are dealt by a hash, so a
cell is bounded whatever the labels and ids are, and hands on at most a few rows per anchor. Anchors meet the rows twice:
first those of their label, and when their positives are known those of the others.

Defined cases: rows with a null id, label or vector, or a component that is null or not finite, take no part; rows that
are equal in id, label and scaled vector are one row; other rows with one id are rows and anchors of their own, and no
positives of each other; a shorter vector counts as one that ends in zeros; an anchor without positives has no rows; ties go by the
smaller id; components so large that a score might not fit 64 bits are an error; an empty table gives no rows.
Other columns are left out, so their names don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closeworks.llm.store import written

#: Anchors of a cell, and the least and most rows of one.
ANCHORS = 2048
LEAST_ROWS, MOST_ROWS = 1024, 32_768
#: Cells that a block of anchors has at least, as far as there are rows for them.
CELLS = 64
#: Anchors whose tables are made at once, and rows that are looked up at once.
TABLES, LOOKUPS = 64, 4096


def _matrix(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    """Whole components of each vector, with zeros up to the width."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(vectors), width), np.int64)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out[np.repeat(np.arange(len(vectors)), sizes), place] = np.floor(scale * values)
    return out


def planes(components: np.ndarray, bits: int) -> np.ndarray:
    """Bytes of each row's bit planes (row, plane, group), the plane of the sign first."""
    shifts = np.arange(bits - 1, -1, -1)[None, :, None]
    return np.packbits((components[:, None, :] >> shifts & 1).astype(np.uint8), axis=2, bitorder="little")


def unpacked(found: np.ndarray) -> np.ndarray:
    """The components that these planes were made of."""
    ones = np.unpackbits(found, axis=2, bitorder="little").astype(np.int64)
    weights = np.int64(1) << np.arange(found.shape[1] - 1, -1, -1)
    weights[0] = -weights[0]
    return np.einsum("rpd,p->rd", ones, weights)


def subset_sums(components: np.ndarray, kind: type) -> np.ndarray:
    """Table of each group (group, byte, anchor): sums of the components whose bits a byte has."""
    groups = components.T.reshape(-1, 8, len(components)).astype(kind)
    sums = np.zeros((len(groups), 256, len(components)), kind)
    for d in range(8):  # the subsets with this component are those without it, and it
        np.add(sums[:, : 1 << d], groups[:, d : d + 1], out=sums[:, 1 << d : 2 << d])
    return sums


def scores(tables: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Scores (row, anchor) of rows with these planes."""
    out = np.zeros((len(found), tables.shape[2]), tables.dtype)
    more = np.empty((min(len(found), LOOKUPS), tables.shape[2]), tables.dtype)
    for at in range(0, len(found), LOOKUPS):
        sums, bytes_ = out[at : at + LOOKUPS], np.ascontiguousarray(found[at : at + LOOKUPS].transpose(1, 2, 0))
        for k, plane in enumerate(bytes_):
            if k:
                sums <<= 1
            for table, picked in zip(tables, plane, strict=True):
                sums += np.take(table, picked, axis=0, out=more[: len(sums)], mode="clip")
            if not k:
                np.negative(sums, out=sums)
    return out


def first_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    group = group[order]
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)])
    rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
    return order[rank < k]


class _Rows:
    """Rows of a cell as arrays."""

    def __init__(self, t: pa.Table, shape: tuple[int, int]):
        self.id, self.label, self.row = (t[k].to_numpy() for k in ("id", "label", "row"))
        joined = b"".join(t["planes"].to_pylist())
        self.planes = np.frombuffer(joined, np.uint8).reshape(len(self.id), *shape) if joined else np.zeros((0, *shape), np.uint8)


def _blocks(anchors: _Rows, rows: _Rows, kind: type, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchors, rows, scores): blocks of anchors of one label with the rows of that label, or of all others."""
    for label in np.unique(anchors.label):
        theirs = np.flatnonzero((rows.label == label) == same)
        ours = np.flatnonzero(anchors.label == label)
        found = rows.planes[theirs]
        for at in range(0, len(ours) if len(theirs) else 0, TABLES):
            block = ours[at : at + TABLES]
            yield block, theirs, scores(subset_sums(unpacked(anchors.planes[block]), kind), found)


class Miner:
    """Scaled vectors in a table, and the numbers that tell how they are dealt to cells."""

    def __init__(self, rows: DataFrame, key: str, vector: str, label: str, anchor: Column, scale: int):
        finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        valid = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))
        rows = rows.where(valid).select(
            F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
            F.col(vector).cast("array<double>").alias("vector"), anchor.alias("anchor"),
        )
        largest = F.max(F.array_max(F.transform("vector", lambda x: F.abs(F.floor(x * scale)).cast("double"))))
        seen = rows.agg(F.max(F.size("vector")).alias("width"), largest.alias("largest")).first()
        width, most = max(seen["width"] or 0, 1), int(seen["largest"] or 0)
        if 100 * width * (most + 1) ** 2 >= 2**63:
            raise ValueError(f"components up to {most} are too large for exact 64-bit scores")
        self.kind = np.int32 if width * (most + 1) ** 2 < 2**31 else np.int64
        self.shape = bits, groups = most.bit_length() + 1, -(-width // 8)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = planes(_matrix(batch.column(2), 8 * groups, scale), bits).reshape(len(batch), bits * groups)
                kept = pa.array([x.tobytes() for x in found], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), kept, batch.column(3)], ["id", "label", "planes", "anchor"]
                )

        packed = rows.mapInArrow(pack, "id bigint, label bigint, planes binary, anchor boolean")
        packed = packed.groupBy("id", "label", "planes").agg(F.max(F.coalesce("anchor", F.lit(False))).alias("anchor"))
        self.rows = written(packed.withColumn("row", F.xxhash64("id", "label", "planes")), "vectors")
        self.anchors = self.rows.where("anchor")
        n, asking = self.rows.agg(F.count("*"), F.count_if("anchor")).first()
        self.p = max(1, -(-asking // ANCHORS))
        self.q = max(1, -(-n // min(max(n // CELLS, LEAST_ROWS), MOST_ROWS)))

    def cells(self, anchors: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        """What the function makes of the anchors and the rows of each cell (p, q)."""

        def block(name: str, n: int) -> Column:
            return F.pmod(F.xxhash64("row", F.lit(name)), F.lit(n)).cast("int").alias(name)

        def all_of(name: str, n: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

        named = [F.col(x).alias(x) for x in anchors.columns]  # columns of their own: both sides come from one table
        left = anchors.select(*named, block("p", self.p), all_of("q", self.q))
        right = self.rows.select("id", "label", "row", "planes", block("q", self.q), all_of("p", self.p))
        return left.groupBy("p", "q").cogroup(right.groupBy("p", "q")).applyInArrow(run, schema)

    def positives(self, k: int) -> DataFrame:
        """(row, anchor_id, positive_id, positive_score): the first k rows of each anchor's label with another id."""
        shape, kind = self.shape, self.kind

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            anchors, rows = _Rows(left, shape), _Rows(right, shape)
            out = [[np.zeros(0, np.int64)] * 4]
            for ours, theirs, found in _blocks(anchors, rows, kind, same=True):
                other = anchors.id[ours][None, :] != rows.id[theirs][:, None]
                found = np.where(other, found, np.iinfo(kind).min)
                last = max(len(theirs) - k, 0)
                least = np.partition(found, last, axis=0)[last]
                place, which = np.nonzero(other & (found >= least))
                score, ids = found[place, which].astype(np.int64), rows.id[theirs[place]]
                at = first_of(which, score, ids, k)
                asked = ours[which[at]]
                out.append([anchors.row[asked], anchors.id[asked], ids[at], score[at]])
            names = ["row", "anchor_id", "positive_id", "positive_score"]
            return pa.table([np.concatenate(x) for x in zip(*out, strict=True)], names=names)

        schema = "row bigint, anchor_id bigint, positive_id bigint, positive_score bigint"
        ranked = Window.partitionBy("row", "anchor_id").orderBy(F.desc("positive_score"), "positive_id")
        found = self.cells(self.anchors.select("id", "label", "row", "planes"), run, schema)
        return found.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= k).drop("place")

    def negatives(self, positives: DataFrame, k: int, low: int, high: int) -> DataFrame:
        """(row, anchor_id, positive_score, rank, negative_id, negative_score) for each score of an anchor's positives."""
        shape, kind = self.shape, self.kind
        wanted = positives.groupBy("row", F.col("anchor_id").alias("id")).agg(F.collect_set("positive_score").alias("wanted"))
        anchors = self.anchors.select("id", "label", "row", "planes").join(wanted, ["row", "id"])

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            anchors, rows = _Rows(left, shape), _Rows(right, shape)
            lists = [sorted(x) for x in left["wanted"].to_pylist()]
            slots = max(map(len, lists), default=0)
            wanted = np.array([x + x[-1:] * (slots - len(x)) for x in lists], np.int64).reshape(len(lists), slots)
            new = np.c_[np.ones((len(lists), 1), bool), wanted[:, 1:] != wanted[:, :-1]][:, :slots]
            least, most = -(-low * wanted // 100), high * wanted // 100
            out = [[np.zeros(0, np.int64)] * 5]
            for ours, theirs, found in _blocks(anchors, rows, kind, same=False):
                place, which = np.nonzero((found >= least[ours].min(axis=1)) & (found <= most[ours].max(axis=1)))
                score, ids = found[place, which].astype(np.int64), rows.id[theirs[place]]
                for slot in range(slots):
                    asked = ours[which]
                    fits = np.flatnonzero(new[asked, slot] & (score >= least[asked, slot]) & (score <= most[asked, slot]))
                    at = fits[first_of(which[fits], score[fits], ids[fits], k)]
                    asked = asked[at]
                    out.append([anchors.row[asked], anchors.id[asked], wanted[asked, slot], ids[at], score[at]])
            names = ["row", "anchor_id", "positive_score", "negative_id", "negative_score"]
            return pa.table([np.concatenate(x) for x in zip(*out, strict=True)], names=names)

        schema = "row bigint, anchor_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
        group = ["row", "anchor_id", "positive_score"]
        ranked = Window.partitionBy(*group).orderBy(F.desc("negative_score"), "negative_id")
        return self.cells(anchors, run, schema).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): negatives of each anchor and positive.

    anchor: which rows ask. Components count as floor(scale * x). A negative's score lies between low and high percent of the
    positive's. An anchor has the given number of positives, and each of them that of negatives, or as many as there are.
    """
    miner = Miner(rows, key, vector, label, anchor, scale)
    near = written(miner.positives(positives), "positives")
    found = miner.negatives(near, negatives, low, high)
    joined = near.join(found, ["row", "anchor_id", "positive_score"])
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
