"""Windows in blocks against brute force, also with one key that has most of the rows."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from closeworks.operators import aggregates, joins, windows
from tests.helpers import rows

FIELDS = "k int, t int, i int, v double, s string"


def _skewed(seed=7, size=3000):
    """A third of the rows on key 0, another part without a key or time."""
    pick = random.Random(seed)
    data = []
    for i in range(size):
        key = 0 if pick.random() < 1 / 3 else pick.randrange(1, 40)
        key = None if pick.random() < 0.05 else key
        time = None if pick.random() < 0.03 else pick.randrange(60)
        value = None if pick.random() < 0.1 else round(pick.random() * 100, 2)
        data.append((key, time, i, value, pick.choice(["A", "B", "ENCERRADO", None])))
    return data


def _brute(data):
    """Expected window values per row id."""
    def least(x):
        return (x is not None, x)

    by_key = {}
    for row in data:
        by_key.setdefault(row[0], []).append(row)
    expected = {}
    for group in by_key.values():
        group.sort(key=lambda r: (least(r[1]), r[2]))
        values = [r[3] for r in group if r[3] is not None]
        times = []
        for n, row in enumerate(group):
            if row[1] not in times:
                times.append(row[1])
            earlier = sum(1 for r in group if least(r[1]) < least(row[1]))
            expected[row[2]] = (
                n + 1, len(times), earlier + 1, group[n - 1][4] if n else None, group[0][3],
                max(values, default=None), round(sum(values), 2) if values else None,
            )
    return expected


def _found(df, block):
    result = windows.per_key(
        df, ["k"], ["t", "i"], block,
        {
            "rn": windows.row_number(), "dr": windows.dense_rank(1), "r": windows.rank(1), "prev": windows.lag("s"),
            "first": windows.first("v"), "top": windows.highest("v"), "sum": windows.total("v"),
        },
    )
    assert result.columns == [*df.columns, "rn", "dr", "r", "prev", "first", "top", "sum"]
    picked = result.select("i", "rn", "dr", "r", "prev", "first", "top", F.round("sum", 2)).collect()
    return {r[0]: tuple(r)[1:] for r in picked}


def test_blocks_give_the_same_as_brute_force(spark):
    data = _skewed()
    df = spark.createDataFrame(data, FIELDS).repartition(6)
    assert _found(df, [F.col("t"), F.floor(F.col("i") / 100)]) == _brute(data)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.integers(0, 5)),
            st.one_of(st.none(), st.integers(0, 9)), st.sampled_from(["A", "B", None]),
        ),
        min_size=1, max_size=30,
    ),
    width=st.integers(1, 40),
)
def test_any_block_width_gives_the_same(spark, data, width):
    numbered = [(k, t, i, None if v is None else float(v), s) for i, (k, t, v, s) in enumerate(data)]
    df = spark.createDataFrame(numbered, FIELDS)
    assert _found(df, [F.col("t"), F.floor(F.col("i") / width)]) == _brute(numbered)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string", "double"])
def test_blocks_of_every_type_match_nulls(spark, kind):
    df = spark.sql(
        f"SELECT id % 3 AS k, id, CASE WHEN id % 4 = 0 THEN NULL ELSE CAST({{}} AS {kind}) END AS b FROM range(24)".format(
            "date'2024-01-01' + CAST(id % 5 AS int)" if kind not in ("string", "double") else "id % 5"
        )
    )
    found = windows.per_key(df, ["k"], ["b", "id"], [F.col("b")], {"rn": windows.row_number()})
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("b", "id")))
    assert rows(found.select("id", "rn")) == rows(plain.select("id", "rn"))


def test_rows_are_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(_skewed(size=50), FIELDS)
        plan = windows.per_key(df, ["k"], ["t", "i"], [F.col("t")], {"prev": windows.lag("s")})
        text = plan._jdf.queryExecution().executedPlan().toString()
        # Rows, partial summaries, summaries by key, and summaries to the rows.
        assert text.count("Exchange hashpartitioning") == 4
        assert "SinglePartition" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("width", [1, 2, 50])
def test_ranks_within_blocks(spark, width):
    df = spark.createDataFrame(_skewed(), FIELDS)
    found = windows.per_key(
        df, ["k"], ["t", "i"], [F.floor(F.col("t") / width)], {"dr": windows.dense_rank_by("t"), "rn": windows.row_number(), "sum": windows.total("i")}
    )
    expected = {i: (v[1], v[0]) for i, v in _brute(_skewed()).items()}
    assert {r["i"]: (r["dr"], r["rn"]) for r in found.collect()} == expected
    assert found.agg(F.max("sum")).first()[0] == df.groupBy("k").agg(F.sum("i").alias("s")).agg(F.max("s")).first()[0]


def test_ranks_on_ties(spark):
    df = spark.createDataFrame([("A1", 2, 1), ("A1", 1, 2), ("A2", 3, 3), ("A1", 1, 4)], "a string, b int, id int")
    found = windows.per_key(
        df, ["a"], ["b", "id"], [F.col("b")], {"dr": windows.dense_rank(), "r": windows.rank(), "rn": windows.row_number()}
    )
    assert rows(found.select("id", "dr", "r", "rn")) == [(1, 2, 3, 3), (2, 1, 1, 1), (3, 1, 1, 1), (4, 1, 1, 2)]


def test_first_date_of_each_id(spark):
    data = [(111, "1", "2020-12-01"), (111, "2", "2021-01-01"), (111, "3", "2021-02-01"), (222, "1", "2021-02-01"), (222, "2", "2021-03-01")]
    df = spark.createDataFrame(data, "id int, part string, d string")
    found = windows.per_key(df, ["id"], ["d"], [F.substring("d", 1, 4)], {"first_date": windows.first("d")})
    assert [r["first_date"] for r in found.orderBy("id", "part").collect()] == ["2020-12-01"] * 3 + ["2021-02-01"] * 2


def test_transitions_total(spark):
    df = spark.createDataFrame(_skewed(), FIELDS).select("k", "t", "i", F.col("s").alias("DP_FASE"))
    rolled = windows.phase_transitions(df, "k", ["t", "i"], "DP_FASE")
    codes = {r["MUDOU_FASE"]: r["count"] for r in rolled.groupBy("MUDOU_FASE").count().collect()}
    assert set(codes) == {0, 1, 2, 3, 4} and sum(codes.values()) == df.count()


def test_each_key_is_counted_once(spark):
    df = spark.createDataFrame(_skewed(), FIELDS)
    once = windows.count_once(df, ["k"], ["t", "i"])
    assert once.agg(F.sum("QTDE")).first()[0] == df.select("k").distinct().count()


# ---- one hot key in the other operators ---------------------------------------------------


def test_hot_key_in_keep_one_and_repeated_keys(spark):
    data = _skewed()
    df = spark.createDataFrame(data, FIELDS)
    kept = {r["k"]: r["i"] for r in aggregates.keep_one(df, ["k"], [F.desc("i")]).collect()}
    assert kept == {k: max(r[2] for r in data if r[0] == k) for k in {r[0] for r in data}}
    several = {k for k in {r[0] for r in data} if sum(r[0] == k for r in data) > 1}
    assert aggregates.repeated_keys(df, ["k"]).count() == sum(r[0] in several for r in data)


def test_hot_key_in_lookup_and_merge(spark):
    df = spark.createDataFrame(_skewed(), FIELDS)
    dim = df.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert joins.lookup(df, dim, "k", ["n"]).count() == df.count()
    new = dim.select("k", F.lit(1.0).alias("v"))
    merged = joins.merge_update(df, new, ["k"])
    assert merged.count() == df.count()
    assert merged.filter("k = 0 AND v <> 1").count() == 0


SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "20",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_skew(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL_SKEW}
    for name, value in SMALL_SKEW.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _split(result) -> bool:
    """Whether the executed plan reads a skewed partition in several tasks."""
    whole = result.agg(*[F.max(c) for c in result.columns])
    whole.collect()
    return "skew=true" in whole._jdf.queryExecution().executedPlan().toString()


def test_adaptive_execution_splits_a_hot_key(small_skew):
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.xxhash64("id") % 1000)
    df = small_skew.range(400_000, numPartitions=8).select(key.alias("k"), "id", (F.col("id") % 97).alias("v"))
    grouped = df.groupBy("k").agg(F.max("v").alias("m"))
    assert _split(joins.lookup(df, grouped, "k", ["m"], derived=True))
    assert _split(joins.inner_lookup(df, grouped, "k", ["m"], derived=True))
    assert _split(joins.flag_exists(df, df.filter("v = 1"), ["k"], "known"))
    assert _split(joins.known_only(df, df.filter("v = 1"), ["k"]))
    assert _split(joins.unknown_only(df, df.filter("k = 5"), ["k"]))
    assert _split(joins.merge_update(df, grouped.withColumnRenamed("m", "v"), ["k"], how="outer"))
    assert _split(aggregates.repeated_keys(df, ["k"]))
    assert _split(aggregates.history_totals(df, df, ["k"], "v", "n", "total"))
