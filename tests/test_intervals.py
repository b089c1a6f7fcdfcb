"""Moments in intervals against a plain test of all pairs."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from closeworks.operators import intervals as I
from closeworks.operators import ordered as O
from tests.helpers import rows

START = datetime(2024, 1, 1)


def moments(r, n, keys):
    out = [(k, r.choice(keys), START + timedelta(minutes=r.randrange(3000), microseconds=r.choice([0, 0, 1]))) for k in range(n)]
    return out + [(-1, None, START), (-2, keys[0], None)]


def windows(r, n, keys):
    out = []
    for k in range(n):
        start = START + timedelta(minutes=r.randrange(3000))
        out.append((r.choice([*keys, "other"]), start, start + timedelta(minutes=r.choice([0, 5, 60, 700, -3])), f"w{k:03d}"))
    return out + [(None, START, START, "x"), (keys[0], None, START, "x"), (keys[0], START, None, "x"), (keys[0], START, START, None)]


def brute(points, held, keyed):
    out = []
    for k, key, at in points:
        fits = [w for g, a, b, w in held if (not keyed or (key is not None and g == key)) and None not in (a, b, at, w) and a <= at <= b]
        out.append((k, key, at, min(fits, default=None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("hot", [1_000_000, 25])
def test_as_all_pairs(spark, monkeypatch, keyed, hot):
    monkeypatch.setattr(O, "HOT", hot)
    r = random.Random(hot)
    points, held = moments(r, 300, ["a", "a", "b", "c"]), windows(r, 60, ["a", "b"])
    held = [w for w in held if keyed or w[0] is not None]
    df = spark.createDataFrame(points, "id int, file string, at timestamp")
    table = spark.createDataFrame(held, "file string, DT_INICIO timestamp, DT_FIM timestamp, w string")
    found = I.assign_interval(df, "at", table, "w", "w", ["file"] if keyed else [])
    assert found.columns == ["id", "file", "at", "w"]
    assert sorted(rows(found), key=str) == brute(points, held, keyed)
    if keyed:
        inside = sorted(rows(I.in_intervals(df, "at", table, ["file"])), key=str)
        assert inside == sorted((x[:3] for x in brute(points, [h[:3] + (h[3] or "y",) for h in held], True) if x[3]), key=str)


def test_segments_are_disjoint(spark):
    held = [("a", 1, 10, "m2"), ("a", 5, 20, "m1"), ("a", 21, 21, "m3"), ("a", 30, 29, "m0"), ("b", 1, 1, "m9"), ("a", 1, 10, "m2")]
    found = rows(I.segments(spark.createDataFrame(held, "k string, s int, e int, l string"), ["k"], "s", "e", "l"))
    assert sorted(found) == [("a", 1, 5, "m2"), ("a", 5, 11, "m1"), ("a", 11, 21, "m1"), ("a", 21, 22, "m3"), ("b", 1, 2, "m9")]


def most_rows(df):
    """Rows of the plan step that put out most of them."""

    def below(plan):
        metric = plan.metrics().get("numOutputRows")
        yield metric.get().value() if metric.isDefined() else 0
        for k in range(plan.children().size()):
            yield from below(plan.children().apply(k))

    return max(below(df._jdf.queryExecution().executedPlan()))


@pytest.mark.parametrize("lengths", [[400], [1 << k for k in range(12)], [0, 1, 90, 1 << 20]], ids=["one", "powers", "few"])
@pytest.mark.parametrize("hot", [1_000_000, 40])
def test_deep_overlaps_cost_no_more_rows(spark, monkeypatch, lengths, hot):
    monkeypatch.setattr(O, "HOT", hot)
    r = random.Random(hot + len(lengths))
    held = [(k, a, a + r.choice(lengths)) for k, a in enumerate(r.choices(range(-300, 300), k=300))]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = I.segments(spark.createDataFrame(held, "l int, s int, e int").withColumn("k", F.lit(1)), ["k"], "s", "e", "l")
        made = rows(found)
        assert most_rows(found) <= 4 * len(held)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    cuts = sorted({b for _, s, e in held for b in (s, e + 1)})
    want = [(1, a, b, min((k for k, s, e in held if s <= a and b <= e + 1), default=None)) for a, b in zip(cuts, cuts[1:])]
    assert sorted(made) == [w for w in want if w[3] is not None]


def test_widest_numbers(spark):
    low, high = -(1 << 63), (1 << 63) - 2
    held = [(3, low, high), (2, low, low), (2, high, high), (1, -1, 0)]
    found = I.segments(spark.createDataFrame(held, "l int, s long, e long").withColumn("k", F.lit(1)), ["k"], "s", "e", "l")
    want = [(1, low, low + 1, 2), (1, low + 1, -1, 3), (1, -1, 1, 1), (1, 1, high, 3), (1, high, high + 1, 2)]
    assert sorted(tuple(r) for r in found.collect()) == want


def test_dates_empty_tables_and_wrong_types(spark):
    days = spark.createDataFrame([(date(2024, 1, 31),), (date(2024, 2, 1),), (None,)], "d date")
    months = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 31), "jan")], "DT_INICIO date, DT_FIM date, m string")
    assert set(rows(I.assign_interval(days, "d", months, "m", "m"))) == {(date(2024, 1, 31), "jan"), (date(2024, 2, 1), None), (None, None)}
    assert {r[1] for r in rows(I.assign_interval(days, "d", months.limit(0), "m", "m"))} == {None}
    assert rows(I.assign_interval(days.limit(0), "d", months, "m", "m")) == []
    with pytest.raises(TypeError, match="different types"):
        I.assign_interval(days.withColumnRenamed("d", "x").selectExpr("cast(x as timestamp) as x"), "x", months, "m", "m")


@pytest.mark.parametrize("hot", [1_000_000, 20])
def test_depths_and_problems_as_counted_day_by_day(spark, monkeypatch, hot):
    monkeypatch.setattr(O, "HOT", hot)
    r = random.Random(hot)
    held = []
    for _ in range(150):
        start = date(2024, 1, 1) + timedelta(days=r.randrange(400))
        held.append((r.choice(["a", "a", "b", None]), start, start + timedelta(days=r.choice([0, 1, 3, 20, -2]))))
    held += held[:10] + [("a", None, date(2024, 1, 1)), ("b", date(2024, 1, 1), None), ("one", date(2024, 1, 1), date(2024, 1, 1))]
    frame = spark.createDataFrame(held, "k string, DT_INICIO date, DT_FIM date")
    good = [h for h in held if None not in h[1:] and h[1] <= h[2]]
    want = []
    for key in {h[0] for h in good}:
        own = [h[1:] for h in good if h[0] == key]
        at, last, end = min(a for a, _ in own), None, max(b for _, b in own)
        while at <= end:
            depth = sum(a <= at <= b for a, b in own)
            if last and last[3] == depth:
                last[2] = at
            else:
                last = [key, at, at, depth]
                want.append(last)
            at += timedelta(days=1)
    assert sorted(rows(I.depths(frame, ["k"])), key=str) == sorted(map(tuple, want), key=str)
    problems = [(*w, "LACUNA" if w[3] == 0 else "SOBREPOSTO") for w in want if w[3] != 1]
    problems += [(*h, None, "ABERTO" if None in h[1:] else "INVERTIDO") for h in held if h not in good]
    assert sorted(rows(I.check_intervals(frame, ["k"])), key=str) == sorted(problems, key=str)


def test_depths_of_timestamps_and_numbers(spark):
    t = [START + timedelta(minutes=m) for m in range(4)]
    tick = timedelta(microseconds=1)
    frame = spark.createDataFrame([(1, t[0], t[2]), (1, t[1], t[3])], "k int, DT_INICIO timestamp, DT_FIM timestamp")
    assert rows(I.depths(frame, ["k"]).orderBy("DT_INICIO")) == [(1, t[0], t[1] - tick, 1), (1, t[1], t[2], 2), (1, t[2] + tick, t[3], 1)]
    numbers = spark.createDataFrame([(1, 5), (7, 9), (10, 10)], "DT_INICIO int, DT_FIM int")
    assert sorted(rows(I.depths(numbers, []))) == [(1, 5, 1), (6, 6, 0), (7, 10, 1)]
    assert rows(I.check_intervals(numbers.limit(0), [])) == []
