"""WARC archives: written from pages, read record by record, and assembled into one row per capture.

Archives are gzip files of WARC/1.1 records that Spark's text writer makes, so tasks that run again replace
their files. They are read as a stream: a task holds one batch of lines and one record at a time, and a file is
read by one task, as gzip files are. Request, response and metadata records of a capture name each other
in WARC-Concurrent-To, in either direction and over any number of steps; a capture nests all that lead to it.

Of captures with equal payloads (of at least a given size) those with the largest page id are responses; the others are
revisits that refer to the one of them with the largest url.

Defined cases: a null html is an empty payload; rows equal in page id, url and html are a capture each, told apart by a
number in their record ids; null ids are smaller than others and leave the id out of the metadata; a null url leaves the
target out; line breaks in a url are percent-encoded; records without an anchor are left out of captures and stay in the
records; a record that leads to several captures at the same distance belongs to the one with the smallest id; of records
with one id one counts; empty tables give empty archives and results; further columns of the pages are not written.
What is no record (no version line, no readable length, no line break after that length) becomes one record of the type
`malformed` that holds its first lines, and reading goes on at the next line that begins with a version.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closeworks.llm.store import new_path
from closeworks.operators.joins import lookup

#: Copies of one row whose records are written by one task.
COPIES = 10_000
END = "\r\n"
ALPHABET_IN = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
ALPHABET_OUT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "type string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
    "digest string, content_type string, http string, payload binary"
)


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of some bytes; 10 hex digits are 8 of base 32."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, k, 10), 16, 32), 8, "0") for k in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), ALPHABET_IN, ALPHABET_OUT)


def _uuid(kind: str, *parts: Column) -> Column:
    """A record id that is the same whenever the record is written."""
    h = F.md5(F.concat_ws("\n", F.lit(kind), *(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts)))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: str, headers: dict[str, Column], *block: Column) -> Column:
    """A record without the two line ends after it, its block in pieces; headers that are null are left out."""
    size = sum((F.octet_length(piece) for piece in block[1:]), F.octet_length(block[0]))
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}")]
    lines += [F.concat(F.lit(f"{k}: "), v) for k, v in headers.items()]
    lines.append(F.concat(F.lit("Content-Length: "), size.cast("string")))
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END), *block)


def _numbered(pages: DataFrame, min_bytes: int) -> DataFrame:
    """The pages with digest, the number of each among equal rows, and the first capture with their payload.

    Equal rows are folded before they are shuffled, and the html is shuffled once: what is known of equal payloads is found from
    names of the rows. Many copies of a row are dealt to tasks in blocks of numbers.
    """
    rows = pages.select(
        "page_id",
        F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("digest", base32_sha1(F.col("html").cast("binary")))
    rows = rows.withColumns(
        {"name": _uuid("row", F.col("page_id"), F.col("url"), F.col("digest")), "long": F.octet_length("html") >= min_bytes}
    )
    names = rows.groupBy("name", "page_id", "url", "digest", "long").agg(F.count(F.lit(1)).alias("copies"))
    first = names.where("long").groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("first"))
    known = lookup(names, first, "digest", ["first"], derived=True)
    is_first = F.col("first").isNull() | ~F.col("long") | F.col("first.page_id").eqNullSafe(F.col("page_id"))
    known = known.withColumn("is_first", is_first).drop("long")
    texts = rows.groupBy("name").agg(F.first("html").alias("html"))
    few = texts.join(known.where(F.col("copies") <= COPIES), "name").withColumns({"from": F.lit(1).cast("bigint"), "to": F.col("copies")})
    last = F.floor((F.col("copies") - 1) / COPIES).cast("bigint")
    many = texts.join(known.where(F.col("copies") > COPIES), "name")
    many = many.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).repartition("name", "block")
    start = F.col("block") * COPIES
    many = many.withColumns({"from": start + 1, "to": F.least(start + COPIES, F.col("copies"))}).drop("block")
    return few.unionByName(many).withColumn("copy", F.explode(F.sequence("from", "to")))


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write request, response or revisit, and metadata records of each row of pages (page_id, url, html)."""
    known = _numbered(pages, min_bytes)

    own = (F.col("page_id"), F.col("url"), F.col("digest"), F.col("copy"))
    name = _uuid("response", *own)
    date, url = F.lit(DATE), F.col("url")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.octet_length("html").cast("string"),
        F.lit(END + END),
    )
    common = {"WARC-Date": date, "WARC-Target-URI": url}
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    content = F.lit("application/http; msgtype=response")
    response = _record(
        "response",
        {"WARC-Record-ID": name, **common, "WARC-Payload-Digest": digest, "Content-Type": content},
        http,
        F.col("html"),
    )
    refers = _uuid("response", F.col("first.page_id"), F.col("first.url"), F.col("digest"), F.lit(1))
    revisit = _record(
        "revisit",
        {
            "WARC-Record-ID": name,
            **common,
            "WARC-Payload-Digest": digest,
            "WARC-Refers-To": refers,
            "WARC-Profile": F.lit(PROFILE),
            "Content-Type": content,
        },
        http,
    )
    target = F.coalesce(F.nullif(F.regexp_extract("url", "^[^:]*://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    host = F.coalesce(F.regexp_extract("url", "://([^/?#]*)", 1), F.lit(""))
    request = _record(
        "request",
        {
            "WARC-Record-ID": _uuid("request", *own),
            **common,
            "WARC-Concurrent-To": name,
            "Content-Type": F.lit("application/http; msgtype=request"),
        },
        F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(END + END)),
    )
    metadata = _record(
        "metadata",
        {
            "WARC-Record-ID": _uuid("metadata", *own),
            **common,
            "WARC-Concurrent-To": name,
            "Content-Type": F.lit("application/warc-fields"),
        },
        F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(END)), F.lit("")),
    )
    records = known.select(
        F.explode(F.array(request, F.when(F.col("is_first"), response).otherwise(revisit), metadata)).alias("value")
    )
    # pages compress well at any level, and the fastest takes a fraction of the time
    packed = records.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    packed.option("lineSep", END + END).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the gzip archives in a folder."""
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    schema = spark.createDataFrame([], RECORD).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kind = to_arrow_schema(schema)
        file, stream = None, _Stream()
        for batch in batches:
            files = batch.column(0).to_pylist()
            values = batch.column(1).to_pylist()
            start = 0
            rows: list[dict] = []
            while start < len(values):
                end = start + 1
                while end < len(values) and files[end] == files[start]:
                    end += 1
                if files[start] != file:
                    rows += stream.end()
                    file, stream = files[start], _Stream()
                rows += stream.add(b"\n".join(values[start:end]) + b"\n")
                start = end
            if rows:
                yield pa.RecordBatch.from_pylist(rows, kind)
        if rows := stream.end():
            yield pa.RecordBatch.from_pylist(rows, kind)

    return lines.mapInArrow(run, schema)


VERSION = b"WARC/1."
BREAKS = b"\r\n"


def _fields(head: bytes) -> dict[str, list[str]]:
    """Named fields after the first line, with lower-case names."""
    out: dict[str, list[str]] = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out.setdefault(name.strip().lower().decode("utf-8", "replace"), []).append(value.strip().decode("utf-8", "replace"))
    return out


def _record_of(head: bytes, block: bytes) -> dict:
    """A record from the lines of its head and its block."""
    named = _fields(head)
    one = {k: v[0] for k, v in named.items()}
    http, payload = None, block
    if one.get("content-type", "").startswith("application/http"):
        first, _, payload = block.partition(b"\r\n\r\n")
        http = first.decode("utf-8", "replace")
    return {
        "type": one.get("warc-type"),
        "record_id": one.get("warc-record-id"),
        "concurrent_to": named.get("warc-concurrent-to", []),
        "refers_to": one.get("warc-refers-to"),
        "target_uri": one.get("warc-target-uri"),
        "date": one.get("warc-date"),
        "digest": one.get("warc-payload-digest"),
        "content_type": one.get("content-type"),
        "http": http,
        "payload": payload,
    }


def _malformed(head: bytes) -> dict:
    """A report of what is no record, under no id, so that no capture takes it in."""
    return dict.fromkeys(_record_of(b"", b""), None) | {"type": "malformed", "concurrent_to": [], "payload": head}


class _Stream:
    """The records of one file, from its bytes piece by piece. Pieces are joined once a record can be whole."""

    def __init__(self) -> None:
        self.pieces: list[bytes] = []
        self.held = 0
        self.needed = 0
        self.lost = False

    def add(self, piece: bytes) -> list[dict]:
        self.pieces.append(piece)
        self.held += len(piece)
        if self.held < self.needed:
            return []
        rest, out = self._parsed(b"".join(self.pieces))
        self.pieces, self.held = [rest], len(rest)
        return out

    def end(self) -> list[dict]:
        """What the file left unfinished. A record that only lacks the line breaks after it is whole."""
        data = b"".join(self.pieces)
        # the reader of lines gives the last line of a file a break that it may not have had
        _, out = self._parsed(data + BREAKS + BREAKS, final=True)
        return out

    def _parsed(self, data: bytes, final: bool = False) -> tuple[bytes, list[dict]]:
        """The records at the start of some bytes, and what is left of them."""
        at, out = 0, []
        while True:
            while data[at : at + 1] and data[at] in BREAKS:
                at += 1
            left = len(data) - at
            if left < len(VERSION) and not (final and left):
                self.needed = len(VERSION)
                return data[at:], out
            head = data.find(b"\r\n\r\n", at)
            if data.startswith(VERSION, at):
                if head < 0:
                    self.needed = 2 * left
                    return data[at:], out
                size = (_fields(data[at:head]).get("content-length") or [""])[0]
                if size.isascii() and size.isdigit():
                    start = head + 4
                    end = start + int(size)
                    if end + len(BREAKS) <= len(data) and data[end] in BREAKS:
                        self.lost = False
                        out.append(_record_of(data[at:head], data[start:end]))
                        at = end
                        continue
                    if not final and end + len(BREAKS) > len(data):
                        self.needed = end + 2 * len(BREAKS) - at
                        return data[at:], out
            # no record: it is told once, and left for the next line that begins with a version
            if not self.lost:
                out.append(_malformed(data[at : head if head >= 0 else len(data)]))
                self.lost = True
            following = data.find(b"\n" + VERSION, at)
            if following < 0:
                keep = 0 if final else len(VERSION)
                self.needed = 0
                return data[max(at, len(data) - keep) :], out
            at = following + 1


def _anchors(records: DataFrame) -> DataFrame:
    """(record_id, anchor): the response or revisit that a record leads to by the fewest concurrent-to links, either way.

    Records at one more step are found in each round from those of the round before, until none is. Only ids are read and written.
    """
    spark = records.sparkSession
    base = new_path(spark, "anchors")
    ids = records.select("record_id", "type", "concurrent_to")
    to = ids.select("record_id", F.explode("concurrent_to").alias("other"))
    both = to.union(to.select(F.col("other"), F.col("record_id"))).distinct()
    main = ids.where(F.col("type").isin("response", "revisit")).select("record_id").distinct()
    both.join(main, "record_id", "left_anti").write.parquet(f"{base}/links")
    links = spark.read.schema("record_id string, other string").parquet(f"{base}/links")
    held = "record_id string, anchor string"

    def step(waiting: DataFrame, reached: DataFrame, number: int) -> DataFrame:
        near = waiting.join(reached.toDF("other", "anchor"), "other").groupBy("record_id").agg(F.min("anchor").alias("anchor"))
        near.write.parquet(f"{base}/steps/{number}")
        return spark.read.schema(held).parquet(f"{base}/steps/{number}")

    number, reached = 0, step(links, main.select("record_id", "record_id"), 0)
    while not reached.isEmpty():
        links.join(reached, "record_id", "left_anti").write.parquet(f"{base}/left/{number}")
        links = spark.read.schema(links.schema).parquet(f"{base}/left/{number}")
        if links.isEmpty():
            break
        number += 1
        reached = step(links, reached, number)
    return spark.read.schema(held).option("recursiveFileLookup", "true").parquet(f"{base}/steps")


def measured(records: DataFrame, payload: bool = True) -> DataFrame:
    """The records with payload_bytes and payload_digest of the full payload, for revisits as they state them.

    payload=False leaves the payloads of responses out, so that they are not shuffled.
    """
    size = F.regexp_extract("http", r"(?i)(?:^|\n)content-length: *([0-9]+)", 1)
    stated = F.col("type") == "revisit"
    found = records.withColumns(
        {
            "payload_bytes": F.when(stated, F.nullif(size, F.lit(""))).otherwise(F.octet_length("payload")).cast("long"),
            "payload_digest": F.when(stated, F.regexp_replace("digest", "^sha1:", "")).otherwise(
                base32_sha1(F.col("payload"))
            ),
        }
    )
    return found if payload else found.withColumn("payload", F.when(F.col("type") != "response", F.col("payload")))


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture from measured records, with its response and all its request and metadata records nested.

    Records are joined through their ids; each id counts once. Arrays are in the order of their ids.
    """
    body = F.struct("record_id", "target_uri", "date", "http", F.col("payload").alias("body"))
    response = records.where(F.col("type").isin("response", "revisit")).select(
        "record_id",
        F.struct(
            "type",
            "record_id",
            "target_uri",
            "date",
            "http",
            "payload_bytes",
            "payload_digest",
            "payload",
        ).alias("response"),
        "refers_to",
    )
    others = records.where(F.col("type").isin("request", "metadata")).select("record_id", "type", body.alias("body"))
    others = others.join(_anchors(records), "record_id").dropDuplicates(["record_id"])

    def of(kind: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("type") == kind, F.col("body"))))

    sides = others.groupBy("anchor").agg(of("request").alias("requests"), of("metadata").alias("metadata"))
    # rows of one capture that were written several times are alike
    captures = response.dropDuplicates(["record_id"]).join(sides, F.col("record_id") == F.col("anchor"), "left")
    none = F.array().cast(sides.schema["requests"].dataType)
    return captures.select(
        "record_id",
        F.coalesce("requests", none).alias("requests"),
        "response",
        F.coalesce("metadata", none).alias("metadata"),
        "refers_to",
    )


def page_id(metadata: Column, kind: str = "bigint") -> Column:
    """The first page id that metadata records hold."""
    found = F.transform(metadata, lambda m: F.regexp_extract(m["body"].cast("string"), "(?m)^page-id: *(.*?)\r?$", 1))
    return F.get(F.filter(found, lambda text: text != ""), F.lit(0)).cast(kind)


def captures_report(captures: DataFrame) -> DataFrame:
    """Per capture: page_id, payload_bytes, payload_digest, record_type and the page whose response it revisits."""
    named = captures.select("record_id", "refers_to", "response", page_id(F.col("metadata")).alias("page_id"))
    # a response looks itself up, so that responses don't all meet under a null key
    named = named.withColumn("first_id", F.coalesce("refers_to", "record_id"))
    held = named.select(F.col("record_id").alias("first_id"), F.col("page_id").alias("first_page"))
    return named.join(held, "first_id", "left").select(
        "page_id",
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.when(F.col("refers_to").isNotNull(), F.col("first_page")).alias("refers_to"),
        F.col("response.target_uri").alias("target_uri"),
    )
