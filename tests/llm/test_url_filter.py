"""Rules against plain Python, splits of made-up names, and held-out accuracy of the classifier."""

import random
import re

from closeworks.llm import url_filter as U

SCHEMA = "page_id long, url string, html string"


def brute(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = re.search("[/?#]", rest)
        end = cut.start() if cut else len(rest)
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        path = re.split("[?#]", rest[end:], maxsplit=1)[0]
    fits = [
        (len(r.host + r.path), r.host + r.path, r.verdict)
        for r in U.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def test_rules(spark):
    tails = ["", "/", "/es/x", "/en/1", "/en/2?q", "/fr/a#b", "/de/", "?x/de/", "#/de/", "/DE/"]
    hosts = ["org", "x.org", "example.org", "A.Example.ORG", "notexample.org", "com", "b.com", "xcom", "É.com", "", "net"]
    urls = [f"http://{h}{t}" for h in hosts for t in tails] + [None, "", "no url", "a://b://c/d", "://org/", "x\ny://org/\nz"]
    df = spark.createDataFrame([(i, u, "some text") for i, u in enumerate(urls)] + [(None, urls[3], None), (1, urls[1], "")], SCHEMA)
    for r in U.judge_urls(df).collect():
        host, path, rule, verdict = brute(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")
        assert (r["block_probability"] is None) == (rule is not None)


def test_names_are_split_into_frequent_words(spark):
    counts = spark.createDataFrame([("green", 50), ("tea", 40), ("house", 60), ("greenhouse", 20), ("a", 300)], "word string, count long")
    names = spark.createDataFrame([("greenteahouse",), ("greenhouse",), ("zzgreen",), ("",), ("ateahouse",)], "name string")
    got = {r["name"]: r["words"] for r in U.segment(names, counts).collect()}
    assert got == {
        "greenteahouse": ["green", "tea", "house"],
        "greenhouse": ["greenhouse"],
        "zzgreen": ["zz", "green"],
        "ateahouse": ["a", "tea", "house"],
    }


def test_held_out_accuracy(spark):
    r = random.Random(8)
    good, bad, both = ["garden", "school", "library", "recipe"], ["casino", "poker", "jackpot", "bet"], ["online", "best", "my"]
    pages, truth = [], {}
    for i in range(600):
        words, is_bad = (bad, True) if r.random() < 0.4 else (good, False)
        name = "".join(r.choice([words, both])[0] if k % 2 else r.choice(words) for k in range(3))
        zone = ("com", "org")[r.random() < 0.5]
        folder = "de" if is_bad else "fr"
        ruled = i % 2 == 0
        host = f"{name}.{'com' if ruled else 'net'}"
        path = f"/{folder}/{i}" if ruled else f"/{zone}/{i}"
        pages.append((i, f"http://{host}{path}", " ".join(good + bad + both)))
        if not ruled:
            truth[i] = "block" if is_bad else "allow"
    rows = U.judge_urls(spark.createDataFrame(pages, SCHEMA)).where("rule is null").collect()
    assert len(rows) == len(truth)
    assert sum(x["verdict"] == truth[x["page_id"]] for x in rows) / len(rows) > 0.95


def test_no_rows_and_clashing_names(spark):
    assert U.judge_urls(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, "http://org/", "t", "own")], SCHEMA + ", Verdict string")
    out = U.judge_urls(df)
    assert out.columns == ["page_id", "url", "html", "Verdict", "host", "path", "rule", "verdict_", "block_probability"]
    assert out.first()["Verdict"] == "own" and out.first()["verdict_"] == "allow"
