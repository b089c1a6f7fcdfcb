"""Archives written, read back and assembled, against plain Python."""

import base64
import hashlib

from closeworks.llm import warc
from closeworks.llm.store import new_path

SCHEMA = "page_id long, url string, html string"
PAGES = [
    (1, "http://a.b/c?d#e", "<html>\r\n\r\nWARC/1.1\r\n\r\n</html>"),
    (2, "http://a\r\nb/", "same"),
    (3, "x", "same"),
    (3, "x", "same"),
    (4, None, None),
    (5, "u", ""),
    (None, "n", "same"),
    (6, "é", "é\x00\n\n\n"),
    (7, "a", "\r\n\r\n"),
    (8, "q", "é" * 200000),
]


def brute(pages):
    def rank(page, url):
        return (-2 if page is None else page, url or "")

    best = {}
    for page, url, html in pages:
        data = (html or "").encode()
        best[data] = max(best.get(data, (-3, "")), rank(page, url))
    out = []
    for page, url, html in pages:
        data = (html or "").encode()
        first = best[data][0] == rank(page, url)[0]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "response" if first else "revisit", None if first else best[data][0]))
    return sorted(out, key=str)


def archive(spark, pages, **options):
    path = new_path(spark, "warc")
    warc.write(spark.createDataFrame(pages, SCHEMA), path, **options)
    return warc.read(spark, path)


def report(records):
    rows = warc.captures_report(warc.assemble(warc.measured(records, payload=False))).collect()
    return sorted((tuple(r)[:5] for r in rows), key=str)


def test_round_trip(spark):
    records = archive(spark, PAGES)
    assert report(records) == brute(PAGES)
    full = warc.assemble(warc.measured(records))
    payloads = {r["response"]["target_uri"]: bytes(r["response"]["payload"]) for r in full.collect() if r["response"]["type"] == "response"}
    assert payloads["http://a.b/c?d#e"] == PAGES[0][2].encode()
    assert payloads["é"] == PAGES[7][2].encode() and payloads["a"] == b"\r\n\r\n"
    one = full.where("response.target_uri = 'http://a.b/c?d#e'").first()
    assert one["requests"][0]["http"].startswith("GET /c?d HTTP/1.1\r\nHost: a.b")
    assert bytes(one["metadata"][0]["body"]) == b"page-id: 1\r\n"


def test_no_pages(spark):
    assert report(archive(spark, [])) == []


def test_many_equal_payloads(spark):
    pages = [(k, f"http://h/{k}", "one page" if k % 3 else f"page {k}") for k in range(300)]
    assert report(archive(spark, pages)) == brute(pages)


def test_small_payloads_are_never_revisited(spark):
    rows = report(archive(spark, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "xyz"), (4, "d", "xyz")], min_bytes=3))
    assert [(r[0], r[3], r[4]) for r in rows] == [(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]


def test_records_name_each_other_in_any_direction(spark):
    rows = [
        ("response", "r1", ["q1"], None, "u"),
        ("request", "q1", [], None, "u"),
        ("metadata", "m1", ["q1"], None, "u"),
        ("metadata", "m2", ["nowhere"], None, "u"),
        ("response", "r2", [], None, "v"),
    ]
    assert nested(spark, rows) == {"r1": (["q1"], ["m1"]), "r2": ([], [])}


def nested(spark, rows):
    filled = [(*r, "d", None, None, "", bytearray(b"x")) for r in rows]
    got = warc.assemble(warc.measured(spark.createDataFrame(filled, warc.RECORD))).collect()
    return {r["record_id"]: ([q["record_id"] for q in r["requests"]], [m["record_id"] for m in r["metadata"]]) for r in got}


def test_all_records_of_a_capture_and_long_chains(spark):
    chain = [("metadata", f"m{k}", [f"m{k - 1}" if k else "r1"], None, "u") for k in range(5)]
    rows = [
        ("response", "r1", ["gone"], None, "u"),
        ("request", "q2", ["r1"], None, "u"),
        ("request", "q1", ["r1"], None, "u"),
        ("request", "q3", ["gone"], None, "u"),
        *chain,
        ("response", "r2", [], None, "v"),
        ("request", "p1", ["r2", "m4"], None, "v"),
        ("metadata", "lonely", ["nothing"], None, "w"),
    ]
    assert nested(spark, rows) == {"r1": (["q1", "q2", "q3"], ["m0", "m1", "m2"]), "r2": (["p1"], ["m3", "m4"])}


def test_many_copies_of_a_row(spark, monkeypatch):
    monkeypatch.setattr(warc, "COPIES", 7)
    pages = [(1, "u", "many")] * 30 + [(2, "v", "many")] * 7 + [(3, "w", "other")] * 8
    assert report(archive(spark, pages)) == brute(pages)


GOOD = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <%d>\r\nContent-Length: 4\r\n\r\na\r\nb\r\n\r\n"


def parsed(data, size):
    stream, out = warc._Stream(), []
    for at in range(0, len(data), size):
        out += stream.add(data[at : at + size])
    return [(r["type"], r["record_id"]) if r["type"] != "malformed" else "malformed" for r in out + stream.end()]


def test_malformed_records_are_told_and_passed_over():
    wrong = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: ten\r\n\r\n0123456789\r\n\r\n"
    missing = b"WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n"
    short = (GOOD % 5).replace(b": 4", b": 1")
    cut_off = (GOOD % 6).replace(b": 4", b": 400")
    long = (GOOD % 8).replace(b": 4", b": 9")
    whole = [GOOD % 1, long, GOOD % 1, wrong, GOOD % 2, missing, GOOD % 3, b"no record\r\n" * 9, GOOD % 4, short, GOOD % 7, cut_off]
    data = b"".join(whole)
    seen = [("response", "<%d>" % k) for k in range(9)]
    told = "malformed"
    want = [seen[1], told, seen[1], told, seen[2], told, seen[3], told, seen[4], seen[5], told, seen[7], told]
    for size in (1, 2, 3, 7, 64, 1000, len(data)):
        assert parsed(data, size) == want, size
    assert parsed(GOOD % 1 + b"\r\n", 9) == [seen[1]] and parsed((GOOD % 1)[:-4] + b"\n", 5) == [seen[1]]
    assert parsed(b"", 1) == [] and parsed(b"WAR", 1) == ["malformed"]


def test_a_malformed_file_among_others(spark):
    path = new_path(spark, "warc")
    warc.write(spark.createDataFrame(PAGES, SCHEMA), path)
    lines = spark.createDataFrame([("WARC/1.1\r\nWARC-Type: response\r\nContent-Length: x\r\n\r\nbody",)], "value string")
    lines.coalesce(1).write.mode("append").option("compression", "gzip").text(path)
    records = warc.read(spark, path)
    assert report(records) == brute(PAGES)
    assert records.where("type = 'malformed'").count() == 1
