"""Lookup of moments in intervals: dates or timestamps, with or without a key, overlapping or not.

Overlapping intervals are split at their bounds into segments that are disjoint, of which each has one label. A moment then
lies in the last segment that began before it, or in none. Rows and the beginnings of segments are sorted together
for that, and the last segment is known from the rows before (`ordered.known`). No pairs of rows and intervals are made, one
timeline for all rows is cut into ranges like a hot key, and the intervals may be as many as the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closeworks.operators import ordered
from closeworks.operators.schema import quoted


def _number(df: DataFrame, name: str) -> Column:
    """Days of a date, microseconds of a timestamp."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(quoted(name)).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(quoted(name).cast("timestamp"))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return quoted(name).cast("bigint")
    raise TypeError(f"{name} is neither a date, a timestamp nor a whole number")


def _bounds(intervals: DataFrame, keys: Sequence[str], start: str, end: str, label: str) -> DataFrame:
    """(keys, __a, __b, __label): the intervals that hold anything, as [a, b)."""
    bounds = intervals.select(
        *map(quoted, keys), _number(intervals, start).alias("__a"), (_number(intervals, end) + 1).alias("__b"), quoted(label).alias("__label")
    )
    return bounds.where("__a < __b").dropna(subset=[*keys, "__label"])


def _lanes() -> list[tuple[Column, Column]]:
    """Two ways to give [a, b) a lane and a middle in (a, b] so that intervals of one lane meet only if they share their middle.

    The middle is the multiple of the highest power of two in (a, b], the lane that power: few lanes if lengths differ much. Or the
    middle is the first multiple of the highest power of two that is no longer than the interval; such an interval ends before the next
    but one, so each third middle shares a lane: three lanes for each power among the lengths.
    """
    bits = F.length(F.bin(F.col("__a").bitwiseXOR(F.col("__b"))))
    highest = F.expr("shiftright(__b, __bits - 1)")
    long = F.coalesce(F.length(F.bin(F.expr("try_subtract(__b, __a)"))), F.lit(64))
    after = F.expr("shiftright(__a, __bits - 1)") + 1
    return [(bits, F.struct(F.col("__bits").alias("lane"), highest.alias("nth"))),
            (long, F.struct((F.col("__bits") * 3 + F.pmod(after, F.lit(3))).cast("int").alias("lane"), after.alias("nth")))]


def segments(intervals: DataFrame, keys: Sequence[str], start: str, end: str, label: str) -> DataFrame:
    """(keys, __from, __to, __label): disjoint segments [from, to) with the smallest label of the closed intervals that hold them.

    Intervals without a bound, a key or a label, and those that end before they start, hold nothing.

    Intervals of one lane that share their middle all hold what lies between their last start and their first end, so their smallest
    label only falls from start to start and only rises from end to end: a running minimum from either side. Others of the lane
    do not meet them, so a lane has one label at a time, and a segment has the smallest of all lanes. An interval is two
    rows, however many others it overlaps.
    """
    named = [quoted(k) for k in keys]
    bounds = _bounds(intervals, keys, start, end, label)
    ways = [bounds.withColumn("__bits", bits).select("*", at.alias("__at")) for bits, at in _lanes()]
    used = [sorted(r[0] for r in way.select("__at.lane").distinct().collect()) for way in ways]
    lanes, bounds = min(zip(used, ways), key=lambda u: len(u[0]))
    # Starts go up and ends go down, so that each sees the labels it needs before it.
    opens = F.struct(F.lit(True).alias("__opens"), F.col("__a").alias("__place"))
    closes = F.struct(F.lit(False).alias("__opens"), (-F.col("__b")).alias("__place"))
    changes = bounds.select(*named, "__label", F.col("__at.lane").alias("__lane"), F.col("__at.nth").alias("__nth"), F.inline(F.array(opens, closes)))
    moment = F.when(F.col("__opens"), F.col("__place")).otherwise(-F.col("__place")).alias("__to")
    lowest = {"__lowest": ordered.lowest_before("__label"), "__past": ordered.lag("__place")}
    steps = ordered.ordered(changes, [*keys, "__lane", "__nth", "__opens"], ["__place", "__label"], lowest)
    since = F.struct(F.when(F.col("__opens"), F.least("__lowest", "__label")).otherwise(F.col("__lowest")).alias("label"))
    states = steps.where("__past IS NULL OR __past <> __place").select(
        *named, moment, *[F.when(F.col("__lane") == n, since).alias(f"__since_{n}") for n in lanes]
    )
    held = {f"__held_{n}": ordered.known_before(f"__since_{n}") for n in lanes}
    cut = ordered.ordered(states, keys, ["__to"], {"__from": ordered.lag("__to"), **held}, changes.select(*named, moment))
    smallest = F.array_min(F.array(F.lit(None), *[F.col(f"{n}.label") for n in held])).alias("__label")
    # Of changes at one moment, the first ends the segment before it.
    return cut.where("__from < __to").select(*named, "__from", "__to", smallest).where("__label IS NOT NULL")


def assign_interval(
    df: DataFrame,
    at: str,
    intervals: DataFrame,
    name: str,
    label: str,
    keys: Sequence[str] = (),
    start: str = "DT_INICIO",
    end: str = "DT_FIM",
) -> DataFrame:
    """Add the smallest label of the closed intervals that hold the moment `at`; null outside of all.

    `keys` are columns of both tables: an interval then holds for rows with its key only. `at`, `start` and `end` are all dates, all
    timestamps or all whole numbers.
    """
    if type(df.schema[at].dataType) is not type(intervals.schema[start].dataType):
        raise TypeError(f"{at} and {start} are of different types")
    df = df.drop(name)
    keys, own = list(keys), ["__one"]
    if not keys:
        df_, intervals = df.withColumn("__one", F.lit(0)), intervals.withColumn("__one", F.lit(0))
    else:
        df_, own = df, keys
    found = segments(intervals, own, start, end, label)
    begin = found.select(
        *map(quoted, own), F.col("__from").alias("__t"), F.lit(0).alias("__row"), F.struct("__to", "__label").alias("__segment")
    )
    rows = df_.withColumns({"__t": _number(df_, at), "__row": F.lit(1)})
    both = rows.unionByName(begin, allowMissingColumns=True)
    named = [quoted(k) for k in own]
    bound = F.explode(F.array("__a", "__b")).alias("__t")
    bounds = _bounds(intervals, own, start, end, label).select(*named, bound, F.lit(0).alias("__row"))
    counted = rows.select(*named, "__t", "__row").unionByName(bounds)
    seen = ordered.ordered(both, own, ["__t", "__row"], {"__last": ordered.known("__segment")}, counted).where("__row = 1")
    inside = F.col("__t") < F.col("__last.__to")
    return seen.withColumn(name, F.when(inside, F.col("__last.__label"))).select(*map(quoted, [*df.columns, name]))


def in_intervals(
    df: DataFrame, at: str, intervals: DataFrame, keys: Sequence[str], start: str = "DT_INICIO", end: str = "DT_FIM"
) -> DataFrame:
    """The rows whose moment lies in any of the closed intervals of their key, which may have several."""
    marked = assign_interval(df, at, intervals.withColumn("__in", F.lit(1)), "__held", "__in", keys, start, end)
    return marked.where("__held = 1").drop("__held")


def _moment(df: DataFrame, name: str, number: Column) -> Column:
    """The date, timestamp or whole number that `_number` made a number of."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(number.cast("int"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(number).cast(kind)
    return number.cast(kind)


def depths(intervals: DataFrame, keys: Sequence[str], start: str = "DT_INICIO", end: str = "DT_FIM") -> DataFrame:
    """(keys, start, end, PROFUNDIDADE): for each key its time cut into the longest stretches that equally many closed intervals hold,
    from its first interval to its last; 0 where none does.

    Each interval counts one up at its start and one down after its end. These changes are summed per key and moment, and their sum
    so far is the depth: no pairs of intervals are made, at any depth. Intervals without a bound or that end before they start are left out;
    a null key is a key.
    """
    named = [quoted(k) for k in keys]
    a, b = _number(intervals, start), _number(intervals, end) + 1
    bounds = intervals.select(*named, a.alias("__a"), b.alias("__b")).where("__a < __b")
    change = F.explode(F.array(*[F.struct(F.col(c).alias("at"), F.lit(d).cast("bigint").alias("by")) for c, d in (("__a", 1), ("__b", -1))]))
    changes = bounds.select(*named, change.alias("c")).groupBy(*named, F.col("c.at").alias("__at")).agg(F.sum("c.by").alias("__by"))
    counted = ordered.ordered(
        changes.where("__by <> 0"), keys, ["__at"], {"__sum": ordered.running("__by"), "__from": ordered.lag("__at")}
    )
    return counted.where("__from IS NOT NULL").select(
        *named,
        _moment(intervals, start, F.col("__from")).alias(start),
        _moment(intervals, end, F.col("__at") - 1).alias(end),
        (F.col("__sum") - F.col("__by")).alias("PROFUNDIDADE"),
    )


def check_intervals(intervals: DataFrame, keys: Sequence[str], start: str = "DT_INICIO", end: str = "DT_FIM") -> DataFrame:
    """(keys, start, end, PROFUNDIDADE, PROBLEMA): what is wrong with the intervals of each key.

    LACUNA is a stretch between intervals, SOBREPOSTO one that two or more of them hold, with their number, INVERTIDO an interval that
    ends before it starts and ABERTO one without a bound. Intervals that are repeated overlap themselves.
    """
    depth = F.col("PROFUNDIDADE")
    kind = F.when(depth == 0, "LACUNA").when(depth > 1, "SOBREPOSTO")
    stretches = depths(intervals, keys, start, end).withColumn("PROBLEMA", kind).where("PROBLEMA IS NOT NULL")
    a, b = _number(intervals, start), _number(intervals, end)
    wrong = F.when(a.isNull() | b.isNull(), "ABERTO").when(a > b, "INVERTIDO")
    rows = intervals.select(*map(quoted, [*keys, start, end]), F.lit(None).cast("bigint").alias("PROFUNDIDADE"), wrong.alias("PROBLEMA"))
    return stretches.unionAll(rows.where("PROBLEMA IS NOT NULL"))
