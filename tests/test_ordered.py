"""Numbers, ranks and previous values against plain windows, with and without hot keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from closeworks.operators import ordered as O
from tests.helpers import rows

OUTPUTS = {
    "n": O.row_number(), "r": O.rank("day"), "d": O.dense_rank("day"), "d2": O.dense_rank("day", "kind"),
    "before": O.lag("value"), "start": O.first("value"), "paid": O.total("amount"), "top": O.highest("value"),
    "known": O.known("value"),
}
SCHEMA = "`the key` string, day date, kind string, id int, value string, amount bigint, d string"


def table(spark, n=3000, seed=1):
    r = random.Random(seed)
    days = [f"2024-{m:02d}-{d:02d}" for m in (1, 2, 3) for d in range(1, 29)]
    data = []
    for k in range(n):
        key = r.choice(["hot", "hot", "hot", None, "b", f"k{k % 200}"])
        day = r.choice([None, *days]) if key != "b" else r.choice(days[:2])
        data.append((key, day, r.choice(["x", "y", None]), k, r.choice([None, str(k)]), r.choice([None, k]), "taken"))
    return spark.createDataFrame([(a, b, *x) for a, b, *x in data], SCHEMA.replace("day date", "day string")).withColumn("day", F.to_date("day"))


def plain(df):
    key = Window.partitionBy("the key")
    w = key.orderBy("day", "kind", "id")
    return df.drop("d").withColumns({
        "n": F.row_number().over(w), "r": F.rank().over(key.orderBy("day")), "d": F.dense_rank().over(key.orderBy("day")),
        "d2": F.dense_rank().over(key.orderBy("day", "kind")), "before": F.lag("value").over(w),
        "start": F.first("value").over(w), "paid": F.sum("amount").over(key), "top": F.max("value").over(key),
        "known": F.last("value", ignorenulls=True).over(w),
    })


@pytest.mark.parametrize(("hot", "broadcast"), [(1_000_000, 100), (300, 100), (40, 0), (1, 100_000)])
def test_as_plain_windows(spark, monkeypatch, hot, broadcast):
    monkeypatch.setattr(O, "HOT", hot)
    monkeypatch.setattr(O, "BROADCAST_PARTS", broadcast)
    df = table(spark)
    result = O.ordered(df, ["the key"], ["day", "kind", "id"], OUTPUTS)
    assert result.columns == plain(df).columns
    assert dict(result.dtypes)["n"] == dict(result.dtypes)["d"] == "bigint"
    assert sorted(rows(result), key=str) == sorted(rows(plain(df)), key=str)


def test_a_hot_key_is_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(O, "HOT", 2000)
    n = 40_000
    df = spark.range(n).select((F.col("id") % 2 * F.col("id")).alias("k"), (F.hash("id") % 1000).alias("day"), "id")
    found = O.ordered(df, ["k"], ["day", "id"], {"n": O.row_number(), "before": O.lag("id")})
    parts = O._cuts(df, O._hot(df, ["k"]), ["k"], ["day", "id"]).collect()
    assert [(r["k"], len(r["__cuts"])) for r in parts] == [(0, 9)]
    hot = df.where("k = 0").withColumn("part", F.lit(0))
    for c in parts[0]["__cuts"]:
        later = (F.col("day") > c["o0"]) | ((F.col("day") == c["o0"]) & (F.col("id") >= c["o1"]))
        hot = hot.withColumn("part", F.col("part") + later.cast("int"))
    sizes = [r["count"] for r in hot.groupBy("part").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * 2000  # half of all rows are of one key, and no task gets more than a few of its parts
    w = Window.partitionBy("k").orderBy("day", "id")
    assert rows(found.where("k = 0").orderBy("n").select("n", "id", "before")) == rows(
        df.withColumns({"n": F.row_number().over(w), "before": F.lag("id").over(w)}).where("k = 0").orderBy("n").select("n", "id", "before")
    )


def test_one_shuffle_and_one_sort_without_hot_keys(spark):
    found = O.ordered(table(spark), ["the key"], ["day", "kind", "id"], {k: OUTPUTS[k] for k in ("n", "d", "before", "paid")})
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1 and "Join" not in plan


def test_counts_of_another_table(spark, monkeypatch):
    monkeypatch.setattr(O, "HOT", 50)
    df = table(spark, 600)
    some = df.where("id % 3 <> 0")
    found = O.ordered(some, ["the key"], ["day", "kind", "id"], OUTPUTS, counted=df)
    assert sorted(rows(found), key=str) == sorted(rows(plain(some)), key=str)


def test_equal_rows_empty_tables_and_wrong_ranks(spark, monkeypatch):
    monkeypatch.setattr(O, "HOT", 10)
    same = spark.createDataFrame([("a", 1)] * 100, "k string, t int")
    assert sorted(r["n"] for r in O.ordered(same, ["k"], ["t"], {"n": O.row_number()}).collect()) == list(range(1, 101))
    assert rows(O.ordered(same.limit(0), ["k"], ["t"], {"n": O.row_number()})) == []
    with pytest.raises(ValueError, match="first columns"):
        O.ordered(table(spark, 10), ["the key"], ["day", "id"], {"r": O.rank("id")})


def test_part_is_the_number_of_cuts_not_above(spark):
    frame = spark.createDataFrame([(n, v) for n in [*range(12), None] for v in [None, *range(-1, 25)]], "n int, v int")
    cuts = F.when(F.col("n") == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), 2 * F.col("n") - 2, F.lit(2)))
    cuts = F.when(F.col("n").isNotNull(), F.transform(cuts, lambda c: F.struct(c.alias("o0"))))
    frame = frame.withColumn("__cuts", cuts)
    found = frame.select("n", "v", O._part(O._place(["v"]), 11)).collect()
    assert [(n, v, part) for n, v, part in found] == [(n, v, sum(2 * k <= v for k in range(n or 0)) if v is not None else 0) for n, v, _ in found]
