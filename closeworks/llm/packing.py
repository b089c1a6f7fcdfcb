"""Best-fit packing of documents into bins of a fixed number of words, under conflicts.

Documents are cut into pieces of at most a bin. Pieces are dealt to shards of a bounded number of words by a hash, and
each shard is packed by itself: largest piece first, into the open bin with the least room that suffices, where
bins are kept in the order of their room and the search goes on to the next bin until one is compatible. A bin
carries a bitmap of the sources that may not enter any more, as SOURCE_LIMIT of their pieces are in, and one of the
duplicate clusters in it, of which it never holds two pieces.

Defined cases: a null or empty text is one piece of 0 words; a null source, or a null cluster, conflicts with
nothing; rows with equal id are packed as they are, each by itself; an empty table gives no bins; of further
columns only those named are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.llm import native
from closeworks.llm.store import written

CAPACITY = 2048
SOURCE_LIMIT = 3
#: Words that are packed together; about that many divided by CAPACITY bins.
SHARD_WORDS = 4_000_000
#: Pieces that are packed together, where texts are short.
SHARD_PIECES = 20_000

BINS = "bin_id bigint, n_words bigint, doc_ids array<bigint>, starts array<bigint>, sizes array<bigint>"


def same_words(text: Column) -> Column:
    """A cluster of texts that have the same words, letter case and white space aside; null without words."""
    words = native.words(F.lower(native.whole(text)))
    return F.when(F.size(words) > 0, F.xxhash64(words))


def pieces(docs: DataFrame, key: str, text: str, source: str, cluster: Column, capacity: int) -> DataFrame:
    """(doc_id, start, size, source, cluster): the pieces of each document, in words."""
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.size(native.words(native.whole(text))).cast("long").alias("n"),
        F.xxhash64(F.coalesce(source, F.lit(""))).alias("source_hash"),
        F.col(source).isNull().alias("no_source"),
        cluster.alias("cluster"),
    )
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(capacity).cast("long"))
    return rows.select(
        "doc_id",
        "n",
        F.explode(starts).alias("start"),
        F.when(~F.col("no_source"), F.col("source_hash")).alias("source"),
        "cluster",
    ).select("doc_id", "start", F.least(F.col("n") - F.col("start"), F.lit(capacity)).alias("size"), "source", "cluster")


class Bins:
    """Open bins in the order of their room."""

    def __init__(self, capacity: int, source_limit: int):
        self.capacity, self.limit = capacity, source_limit
        self.order: list[tuple[int, int]] = []  # (room, bin)
        self.full_sources: list[int] = []
        self.clusters: list[int] = []
        self.held: list[dict[int, int]] = []
        self.items: list[list[int]] = []

    def place(self, item: int, size: int, source: int, cluster: int) -> None:
        """Put an item into the tightest compatible bin. source and cluster are bits, or -1."""
        source_bit = 1 << source if source >= 0 else 0
        cluster_bit = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            room, k = self.order[at]
            if not (self.full_sources[k] & source_bit or self.clusters[k] & cluster_bit):
                del self.order[at]
                break
            at += 1
        else:
            room, k = self.capacity, len(self.items)
            self.full_sources.append(0)
            self.clusters.append(0)
            self.held.append({})
            self.items.append([])
        self.items[k].append(item)
        self.clusters[k] |= cluster_bit
        if source >= 0:
            held = self.held[k]
            held[source] = held.get(source, 0) + 1
            if held[source] >= self.limit:
                self.full_sources[k] |= source_bit
        insort(self.order, (room - size, k))


def _bits(column: pa.ChunkedArray, least: int) -> np.ndarray:
    """A small number for each value that occurs at least so often, -1 for others and nulls."""
    values = column.combine_chunks()
    codes = values.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    counts = np.bincount(codes[codes >= 0], minlength=1)
    number = np.where(counts >= least, np.cumsum(counts >= least) - 1, -1)
    return np.where(codes >= 0, number[codes], -1)


def pack(t: pa.Table, capacity: int = CAPACITY, source_limit: int = SOURCE_LIMIT) -> pa.Table:
    """The bins of one shard of pieces."""
    t = t.sort_by([("size", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("cluster", "ascending")])
    size = t["size"].to_numpy()
    # what can't conflict here needs no bit
    source, cluster = _bits(t["source"], source_limit + 1), _bits(t["cluster"], 2)
    bins = Bins(capacity, source_limit)
    for item in range(len(size)):
        bins.place(item, int(size[item]), int(source[item]), int(cluster[item]))
    shard = t["shard"][0].as_py() if len(size) else 0
    ids, starts = t["doc_id"].to_pylist(), t["start"].to_pylist()
    return pa.table(
        {
            "bin_id": pa.array([(shard << 32) + k for k in range(len(bins.items))], pa.int64()),
            "n_words": pa.array([int(size[x].sum()) for x in bins.items], pa.int64()),
            "doc_ids": pa.array([[ids[k] for k in x] for x in bins.items], pa.list_(pa.int64())),
            "starts": pa.array([[starts[k] for k in x] for x in bins.items], pa.list_(pa.int64())),
            "sizes": pa.array([size[x].tolist() for x in bins.items], pa.list_(pa.int64())),
        }
    )


def pack_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    cluster: Column | None = None,
    capacity: int = CAPACITY,
    source_limit: int = SOURCE_LIMIT,
) -> DataFrame:
    """One row per bin: its words, and the document, first word and size of each piece.

    cluster: documents with an equal value are duplicates; by default those that have the same words.
    """
    found = pieces(docs, key, text, source, same_words(F.col(text)) if cluster is None else cluster, capacity)
    found = written(found, "pieces")
    total = found.agg(F.sum("size").alias("words"), F.count("*").alias("pieces")).first()
    shards = 1 + max((total["words"] or 0) // SHARD_WORDS, total["pieces"] // SHARD_PIECES)
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "cluster"), F.lit(shards)))

    def run(t: pa.Table) -> pa.Table:
        return pack(t, capacity, source_limit)

    return dealt.groupBy("shard").applyInArrow(run, BINS)
