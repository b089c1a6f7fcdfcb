"""Groups of similar documents against all pairs in plain Python."""

import random
import re
from collections import defaultdict

import pytest

from closeworks.llm import jaccard_join as J
from closeworks.llm.components import components

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(docs, size):
    for _, text in docs:
        words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        yield {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def brute(docs, size, percent):
    sets = list(sets_of(docs, size))
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for i, one in enumerate(sets):
        common = defaultdict(int)
        for gram in one:
            for j in lists[gram]:
                common[j] += 1
            lists[gram].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(one) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if sets[i] and doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    rows = [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)]
    return sorted(rows, key=str)


def corpus(seed=3, n=300):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    base = [[r.choice(words) for _ in range(r.randrange(1, 80))] for _ in range(8)]
    docs = []
    for i in range(n):
        text = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
            k = r.randrange(len(text))
            text[k : k + 1] = r.choice([[], [r.choice(words)], [text[k], r.choice(words)]])
            text = text or ["x"]
        docs.append((i, r.choice([" ", "\n", "\t "]).join(text)))
    return docs + [(None, docs[0][1]), (3, docs[5][1]), (7000, None), (7001, " \t"), (7002, ""), (7003, "é É"), (7004, "É é")]


def found(df, **options):
    return sorted((tuple(r) for r in J.similar_groups(df, **options).collect()), key=str)


@pytest.mark.parametrize(
    ("sizes", "size", "percent"),
    [({}, 4, 85), ({"STRIDE": 16, "SHORT": 2, "PROBED": 4}, 5, 80), ({"LIST": 32, "SHORT": 3, "SIGNED_SIZE": 20}, 4, 85)],
)
def test_against_all_pairs(spark, monkeypatch, sizes, size, percent):
    for name, value in sizes.items():
        monkeypatch.setattr(J, name, value)
    docs = corpus()
    assert found(spark.createDataFrame(docs, SCHEMA), size=size, percent=percent) == brute(docs, size, percent)


def test_shuffled_keys_give_the_same(spark, monkeypatch):
    docs = corpus(4, 120)
    monkeypatch.setattr(J, "BROADCAST_ROWS", 0)
    assert found(spark.createDataFrame(docs, SCHEMA)) == brute(docs, 4, 85)


def test_lists_stay_together_under_adaptive_plans(spark):
    docs = corpus(11, 500)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        assert found(spark.createDataFrame(docs, SCHEMA).repartition(7)) == brute(docs, 4, 85)
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


def test_a_chain_of_links_is_one_component(spark):
    words = [f"v{i}" for i in range(200)]
    docs = [(100 - k, " ".join(words[3 * k : 3 * k + 100])) for k in range(20)]
    rows = found(spark.createDataFrame(docs, SCHEMA))
    assert rows == brute(docs, 4, 85) and {r[2] for r in rows} == {81}


def test_no_rows_no_words(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    docs = [(1, None), (2, ""), (2, ""), (None, " ")]
    assert found(spark.createDataFrame(docs, SCHEMA)) == brute(docs, 4, 85)


def test_one_row_of_each_group_stays(spark):
    docs = [d for d in corpus(6, 150) if d[0] not in (None, 3)]
    docs += [docs[8], docs[8]]
    df = spark.createDataFrame([(*d, k) for k, d in enumerate(docs)], SCHEMA + ", id_ int")
    kept = J.drop_similar(df, size=4, percent=85)
    assert kept.columns == df.columns
    rows = kept.collect()
    groups = brute(docs, 4, 85)
    assert sorted(r["doc_id"] for r in rows if WORD.search(r["text"] or "")) == sorted({g for _, n, g in groups if n})
    assert [r["id_"] for r in rows if r["doc_id"] == docs[8][0]] in ([], [8])
    assert sorted(r["doc_id"] for r in rows if not WORD.search(r["text"] or "")) == [7000, 7001, 7002]


def test_components(spark):
    pairs = [(k, k + 1) for k in range(50)] + [(100, 200), (300, 200), (5, 5), (400, 400)] + [(1000, k) for k in range(1001, 1400)]
    rows = {r[0]: r[1] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert rows == {**dict.fromkeys(range(51), 0), 100: 100, 200: 100, 300: 100, **dict.fromkeys(range(1000, 1400), 1000)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
