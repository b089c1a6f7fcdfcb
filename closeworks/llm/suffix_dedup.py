"""Repeated bytes, found by a multi-document Burrows-Wheeler transform with common prefixes.

A byte is removed if a string of LENGTH bytes that covers it also starts in a document with a smaller id. The
construction inserts one symbol per string and round, so strings must be short, and equal strings must meet:

- Each run of neighbouring LENGTH-byte strings whose smallest hash of GRAM bytes is the same is one short text. Equal
  strings have equal smallest hashes, so all texts of a hash form a collection that is complete by itself.
- Texts are held in buckets of documents. A bucket names each of its hashes once, and hears which of them another
  document has; only texts of those are sent on, equal ones of a bucket once, with their smallest id.
- For each range of hashes the transform is built column by column. Suffixes whose common prefixes are LENGTH or longer
  are one string; the smallest id of its texts goes back to the buckets, as a bit per string.

No step collects a group of copies: a bucket sends any text or hash once, however many documents have it.
Hashes of 64 bits tell GRAM bytes and whole texts apart.

Defined cases: a null text is empty, and nothing is removed; a null id is larger than all others; rows with equal ids,
or without, take nothing from each other; empty tables give empty results; columns other than id and text are
not used.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.llm import bwt
from closeworks.llm import words as W

LENGTH = 50
GRAM = 16
#: Most strings of one text, a bit each: so many hold one gram.
RUN = LENGTH - GRAM + 1
#: Bytes of the documents of a bucket, and bytes that are hashed at once.
BUCKET_BYTES = 8_000_000
STEP = 1 << 20
#: Symbols of a collection that is built at once, if its hashes allow.
COLLECTION = 400_000
NO_ID = np.iinfo(np.int64).max

REPLY = "bucket int, range int, kind int, data binary"
SHARED, MASKS = 0, 1


class Runs(NamedTuple):
    """Short texts of a bucket: first byte, number of strings, smallest hash, hash of the text, and row."""

    starts: np.ndarray
    counts: np.ndarray
    hashes: np.ndarray
    contents: np.ndarray
    rows: np.ndarray


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each `width` neighbours."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs(data: np.ndarray, bounds: np.ndarray) -> Runs:
    """The short texts of some documents; they depend on the bytes and the order of the documents alone."""
    letters = W.mixed(np.arange(1, 257, dtype=np.uint64))
    out: list[Runs] = []
    for first in range(0, len(data) - LENGTH + 1, STEP):
        part = data[first : first + STEP + LENGTH - 1]
        up, down = W.Powers.of(len(part) + 1)
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(letters[part] * up[:-1], out=sums[1:])
        grams = W.mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(part) - GRAM + 1])
        least = _least(grams, LENGTH - GRAM + 1)
        # where strings of each row of this part start
        low = int(np.searchsorted(bounds, first, "right")) - 1
        high = int(np.searchsorted(bounds, first + len(least), "left"))
        begin = np.clip(bounds[low:high] - first, 0, len(least))
        after = np.clip(bounds[low + 1 : high + 1] - LENGTH + 1 - first, begin, len(least))
        size = after - begin
        if not size.sum():
            continue
        r = np.repeat(np.arange(low, high), size)
        inside = np.arange(len(r)) + np.repeat(begin - (np.cumsum(size) - size), size)
        h = least[inside]
        new = np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])]
        head = np.flatnonzero(new)
        since = np.arange(len(h)) - np.repeat(head, np.diff(np.r_[head, len(h)]))
        head = np.flatnonzero(since % RUN == 0)
        count = np.diff(np.r_[head, len(h)])
        # a run ends where its document does, so its places are neighbours
        start = inside[head]
        end = start + count + LENGTH - 1
        content = W.mixed((sums[end] - sums[start]) * down[start] + count.astype(np.uint64))
        out.append(Runs(start + first, count, h[head], content, r[head]))
    if not out:
        return Runs(*(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64)))
    return Runs(*(np.concatenate(x) for x in zip(*out, strict=True)))


class Bucket:
    """The documents of a bucket in a fixed order, and their short texts."""

    def __init__(self, t: pa.Table):
        t = t.sort_by([("id", "ascending"), ("text", "ascending")])
        self.number = t["bucket"][0].as_py()
        self.ids = t["id"]
        self.order = t["id"].combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)
        parts = list(W.chunks(t["text"], limit=1 << 62))
        self.data, self.bounds = parts[0].data, parts[0].bounds
        self.runs = runs(self.data, self.bounds)
        # rows go by id, and a stable sort keeps that: the first and last of a hash have its smallest and largest id
        h = self.runs.hashes
        at = np.argsort(h, kind="stable")
        new = np.r_[True, h[at][1:] != h[at][:-1]] if len(h) else np.zeros(0, bool)
        head = np.flatnonzero(new)
        ids = self.order[self.runs.rows[at]]
        self.hashes = h[at[head]]
        self.several = ids[head] != ids[np.r_[head[1:], len(h)] - 1] if len(h) else new
        self.hash_of = np.empty(len(h), np.int64)
        self.hash_of[at] = np.cumsum(new) - 1

    def texts(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The runs with a shared hash, the distinct text of each, and of each text the first run, of its smallest id."""
        some = np.flatnonzero(shared[self.hash_of])
        content = self.runs.contents[some]
        at = np.argsort(content, kind="stable")
        some, content = some[at], content[at]
        new = np.r_[True, content[1:] != content[:-1]] if len(some) else np.zeros(0, bool)
        return some, np.cumsum(new) - 1, some[new]


def _range(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return (W.mixed(hashes) % np.uint64(ranges)).astype(np.int64)


def _by_range(number: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The places of each range that occurs, in their order."""
    at = np.argsort(number, kind="stable")
    cuts = np.flatnonzero(np.diff(number[at])) + 1
    return [(int(number[x[0]]), x) for x in np.split(at, cuts) if len(x)]


def _bits(values: np.ndarray) -> bytes:
    return np.packbits(values).tobytes()


def _names(ranges: int):
    def run(t: pa.Table) -> pa.Table:
        bucket = Bucket(t)
        rows = [
            {"range": k, "bucket": bucket.number, "hashes": bucket.hashes[x].tobytes(), "several": _bits(bucket.several[x])}
            for k, x in _by_range(_range(bucket.hashes, ranges))
        ]
        kinds = [("range", pa.int32()), ("bucket", pa.int32()), ("hashes", pa.binary()), ("several", pa.binary())]
        return pa.Table.from_pylist(rows, pa.schema(kinds))

    return run


def _shared(t: pa.Table) -> pa.Table:
    """For each bucket of a range which of its hashes another document has."""
    found = [np.frombuffer(x, np.uint64) for x in t["hashes"].to_pylist()]
    several = [
        np.unpackbits(np.frombuffer(x, np.uint8), count=len(h)).astype(bool)
        for x, h in zip(t["several"].to_pylist(), found, strict=True)
    ]
    every = np.sort(np.concatenate(found))
    twice = every[1:][every[1:] == every[:-1]]
    both = np.sort(np.concatenate([twice, *(h[s] for h, s in zip(found, several, strict=True))]))
    both = np.r_[both, np.uint64(0)]  # for what lies beyond the last
    data = [_bits(both[np.searchsorted(both[:-1], h)] == h) for h in found]
    return _replies(t["bucket"].to_pylist(), t["range"][0].as_py(), SHARED, data)


def _replies(buckets: list[int], number: int, kind: int, data: list[bytes]) -> pa.Table:
    n = len(buckets)
    return pa.table(
        {
            "bucket": pa.array(buckets, pa.int32()),
            "range": pa.array([number] * n, pa.int32()),
            "kind": pa.array([kind] * n, pa.int32()),
            "data": pa.array(data, pa.binary()),
        }
    )


def _read(replies: pa.Table, kind: int) -> dict[int, bytes]:
    rows = zip(replies["range"].to_pylist(), replies["kind"].to_pylist(), replies["data"].to_pylist(), strict=True)
    return {r: d for r, k, d in rows if k == kind}


def _is_shared(bucket: Bucket, replies: pa.Table, ranges: int) -> np.ndarray:
    """Whether another document has each hash of a bucket."""
    told = _read(replies, SHARED)
    out = np.zeros(len(bucket.hashes), bool)
    for k, x in _by_range(_range(bucket.hashes, ranges)):
        out[x] = np.unpackbits(np.frombuffer(told[k], np.uint8), count=len(x)).astype(bool)
    return out


def _sent(ranges: int):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        kinds = [("range", pa.int32()), ("bucket", pa.int32())]
        kinds += [(k, pa.binary()) for k in ("hashes", "counts", "ids", "texts")]
        rows = []
        if len(docs):
            bucket = Bucket(docs)
            r = bucket.runs
            _, _, first = bucket.texts(_is_shared(bucket, replies, ranges))
            for k, x in _by_range(_range(r.hashes[first], ranges)):
                one = first[x]
                sizes = r.counts[one] + LENGTH - 1
                place = np.repeat(r.starts[one] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                rows.append(
                    {
                        "range": k,
                        "bucket": bucket.number,
                        "hashes": r.hashes[one].tobytes(),
                        "counts": r.counts[one].astype(np.uint8).tobytes(),
                        "ids": bucket.order[r.rows[one]].tobytes(),
                        "texts": pa.compress(bucket.data[place].tobytes(), "zstd", asbytes=True),
                    }
                )
        return pa.Table.from_pylist(rows, pa.schema(kinds))

    return run


def _smallest(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each text and each of its strings the smallest id of a text with that string."""
    c = bwt.build(codes, starts, lengths)
    text, offset, row = bwt.suffix_rows(c, lengths, LENGTH)
    value = np.full(len(c.symbols), NO_ID)
    value[row] = ids[text]
    head = np.flatnonzero(c.prefixes < LENGTH)
    least = np.minimum.reduceat(value, head)
    out = np.full((len(starts), RUN), NO_ID)
    out[text, offset] = least[np.searchsorted(head, row, "right") - 1]
    return out


def _masks(t: pa.Table) -> pa.Table:
    """For each bucket of a range, and each text it sent, which of its strings a smaller id has."""

    def joined(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(x, kind) for x in t[name].to_pylist()])

    hashes, counts, ids = joined("hashes", np.uint64), joined("counts", np.uint8).astype(np.int64), joined("ids", np.int64)
    sizes = counts + LENGTH - 1
    own = [len(x) for x in t["counts"].to_pylist()]
    ends = np.cumsum(sizes)
    cuts = ends[np.cumsum(own) - 1]
    texts = [
        pa.decompress(x, decompressed_size=int(n), codec="zstd", asbytes=True)
        for x, n in zip(t["texts"].to_pylist(), np.diff(np.r_[0, cuts]), strict=True)
    ]
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = ends - sizes
    codes = np.cumsum(np.bincount(data, minlength=256) > 0).astype(np.uint8)[data]  # 0 marks the ends of strings

    # equal texts are one, with their smallest id
    content, around = _contents(data, starts, sizes, hashes)
    at = np.lexsort((ids, content))
    new = np.r_[True, content[at][1:] != content[at][:-1]]
    text = np.empty(len(at), np.int64)
    text[at] = np.cumsum(new) - 1
    first = at[new]

    # a string of a text alone has the smallest id of that text; others go to collections, by hash
    smallest = np.where(np.arange(RUN) < counts[first][:, None], ids[first][:, None], NO_ID)
    some = np.flatnonzero(_met(around[first], hashes[first]))
    some = some[np.argsort(hashes[first[some]], kind="stable")]
    one = first[some]
    total = np.cumsum(sizes[one])
    last = np.flatnonzero(np.r_[hashes[one][1:] != hashes[one][:-1], True]) if len(one) else some
    piece = np.repeat(total[last] // COLLECTION, np.diff(np.r_[-1, last]))
    for x in np.split(np.arange(len(one)), np.flatnonzero(np.diff(piece)) + 1):
        smallest[some[x]] = _smallest(codes, starts[one[x]], sizes[one[x]], ids[one[x]])
    bit = np.uint64(1) << np.arange(RUN, dtype=np.uint64)
    masks = ((smallest[text] < ids[:, None]) * bit).sum(axis=1, dtype=np.uint64)
    parts = np.split(masks, np.cumsum(own)[:-1])
    return _replies(t["bucket"].to_pylist(), t["range"][0].as_py(), MASKS, [x.tobytes() for x in parts])


#: Places that the smallest gram can have in a string, in groups; a string with it in a group holds the gram with as many
#: bytes before it as the group's first place, and as many after it as follow at its last place.
PLACES = [(k * (LENGTH - GRAM + 1) // 4, (k + 1) * (LENGTH - GRAM + 1) // 4 - 1) for k in range(4)]


def _contents(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each text, and for each group of PLACES a hash of its smallest gram with the bytes around it.

    Texts lie one after the other. 0 tells that the bytes are not all in the text, 1 that the gram is several times in it.
    """
    letters = W.mixed(np.arange(1, 257, dtype=np.uint64))
    content = np.empty(len(starts), np.uint64)
    around = np.zeros((len(starts), len(PLACES)), np.uint64)
    step = max(1, STEP // (RUN + LENGTH))
    for k in range(0, len(starts), step):
        start, size, own = starts[k : k + step], sizes[k : k + step], hashes[k : k + step]
        base = start[0]
        part = data[base : start[-1] + size[-1]]
        start = start - base
        up, down = W.Powers.of(len(part) + 1)
        sums = np.r_[np.uint64(0), np.cumsum(letters[part] * up[:-1])]

        def hashed(a: np.ndarray, b: np.ndarray, sums=sums, down=down) -> np.ndarray:
            return W.mixed((sums[b] - sums[a]) * down[a])

        content[k : k + step] = W.mixed((sums[start + size] - sums[start]) * down[start] + size.astype(np.uint64))
        grams = hashed(np.arange(len(part) - GRAM + 1), np.arange(GRAM, len(part) + 1))
        text = np.repeat(np.arange(len(start)), size)[: len(grams)]
        places = np.flatnonzero(grams == own[text])
        places = places[places + GRAM <= (start + size)[text[places]]]
        text = text[places]
        times = np.bincount(text, minlength=len(start))
        place = np.zeros(len(start), np.int64)
        place[text] = places
        for group, (least, most) in enumerate(PLACES):
            a, b = place - least, place + LENGTH - most
            there = (a >= start) & (b <= start + size)
            value = np.where(there, hashed(np.maximum(a, 0), np.minimum(b, len(part))) | np.uint64(2), np.uint64(0))
            around[k : k + step, group] = np.where(times == 1, value, np.uint64(1))
    return content, around


def _met(around: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which distinct texts may share a string: those with equal bytes around their gram, or of a hash that can't tell."""
    met = np.isin(hashes, hashes[(around == 1).any(axis=1)])
    for value in around.T:
        at = np.argsort(value, kind="stable")
        same = value[at][1:] == value[at][:-1]
        found = np.zeros(len(value), bool)
        found[at[1:]] |= same
        found[at[:-1]] |= same
        met |= found & (value > 1)
    return met


def _removed(bucket: Bucket, replies: pa.Table, ranges: int) -> np.ndarray:
    """Whether each byte of a bucket is removed."""
    r = bucket.runs
    some, text, first = bucket.texts(_is_shared(bucket, replies, ranges))
    covered = np.zeros(len(bucket.data) + LENGTH, bool)  # whether the string that starts here is repeated
    if len(first):
        told = _read(replies, MASKS)
        mask = np.zeros(len(first), np.uint64)
        for k, x in _by_range(_range(r.hashes[first], ranges)):
            mask[x] = np.frombuffer(told[k], np.uint64)
        later = bucket.order[r.rows[some]] > bucket.order[r.rows[first]][text]
        every = (np.uint64(1) << r.counts[some].astype(np.uint64)) - np.uint64(1)
        found = np.where(later, every, mask[text])
        for k in range(RUN):
            covered[r.starts[some[(found >> np.uint64(k)) & np.uint64(1) > 0]] + k] = True
    upto = np.cumsum(covered, dtype=np.int32)
    before = np.r_[np.zeros(LENGTH, np.int32), upto[: len(bucket.data)]][: len(bucket.data)]
    return upto[: len(bucket.data)] > before


def _kept(ranges: int):
    kinds = [
        ("id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.binary()),
    ]

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(docs):
            return pa.Table.from_pylist([], pa.schema(kinds))
        bucket = Bucket(docs)
        gone = _removed(bucket, replies, ranges)
        edge = np.zeros(len(gone) + 1, bool)
        edge[bucket.bounds] = True
        before = np.r_[False, gone[:-1]] if len(gone) else gone
        after = np.r_[gone[1:], False] if len(gone) else gone
        starts = np.flatnonzero(gone & (~before | edge[:-1]))
        ends = np.flatnonzero(gone & (~after | edge[1:])) + 1
        cut = np.searchsorted(starts, bucket.bounds)
        rows = np.repeat(np.arange(len(bucket.bounds) - 1), np.diff(cut))
        base = bucket.bounds[rows]
        pairs = pa.StructArray.from_arrays([pa.array(starts - base), pa.array(ends - base)], ["start", "end"])
        left = np.r_[0, np.cumsum(~gone)][bucket.bounds]
        rest = bucket.data[~gone].tobytes()
        kept = [rest[a:b] for a, b in zip(left[:-1], left[1:], strict=True)]
        return pa.table(
            {
                "id": bucket.ids.combine_chunks(),
                "n_bytes": pa.array(np.diff(bucket.bounds)),
                "spans": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pairs),
                "kept": pa.array(kept, pa.binary()),
            },
            schema=pa.schema(kinds),
        )

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_bytes, spans of removed bytes, and the bytes that are kept."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    number = 1 + size // BUCKET_BYTES
    bucket = F.pmod(F.xxhash64(key, text), F.lit(number)).cast("int").alias("bucket")
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("text"), bucket)
    named = rows.groupBy("bucket").applyInArrow(
        _names(number), "range int, bucket int, hashes binary, several binary"
    )
    shared = named.groupBy("range").applyInArrow(_shared, REPLY)
    sent = (
        rows.groupBy("bucket")
        .cogroup(shared.groupBy("bucket"))
        .applyInArrow(_sent(number), "range int, bucket int, hashes binary, counts binary, ids binary, texts binary")
    )
    masks = sent.groupBy("range").applyInArrow(_masks, REPLY)
    kept = (
        rows.groupBy("bucket")
        .cogroup(shared.unionByName(masks).groupBy("bucket"))
        .applyInArrow(_kept(number), "id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
    )
    return kept.withColumnRenamed("id", key)


def repeats_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its bytes, the number of removed bytes and of their spans, and the digest of what is kept."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return remove_repeats(docs.select(key, text), key, text).select(
        key,
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
