"""Numbers, ranks and previous values per key from one shuffle and one sort, with hot keys cut by ranges of the order.

A plain window sends all rows of a key to one task. Keys with more than HOT rows are therefore found first, by a count that
is combined per task. Their order is sampled, cut at quantiles into parts of about HOT rows, and a window is
evaluated per key and part. One small row per part then carries counts, sums and the last row on to the later parts, as
prefix sums do. Keys that are not hot are one part, and without a hot key the plan is that of a plain window.

Rows that are equal in the columns of a rank stay in one part, so a rank never goes on within a tie.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closeworks.operators.joins import lookup
from closeworks.operators.schema import quoted

#: Rows of a key, or of a part of one, for one task.
HOT = 1_000_000
#: Rows of a part in the sample that the cuts are taken from.
SAMPLED = 64
#: Parts whose carried rows may be broadcast; beyond that they are shuffled.
BROADCAST_PARTS = 100_000


@dataclass(frozen=True)
class Ordered:
    """One output of `ordered`: its kind, the column it reads, and the first columns of the order that a rank goes by."""

    kind: str
    column: str = ""
    by: tuple[str, ...] = ()


def row_number() -> Ordered:
    return Ordered("number")


def rank(*by: str) -> Ordered:
    """Rank with gaps by the first columns of the order."""
    return Ordered("rank", by=by)


def dense_rank(*by: str) -> Ordered:
    """Rank without gaps by the first columns of the order."""
    return Ordered("dense", by=by)


def lag(column: str) -> Ordered:
    """Value of the row before."""
    return Ordered("lag", column)


def known(column: str) -> Ordered:
    """Last value so far that is not null, the row's own included."""
    return Ordered("known", column)


def known_before(column: str) -> Ordered:
    """Last value of the rows before that is not null."""
    return Ordered("before", column)


def lowest_before(column: str) -> Ordered:
    """Minimum of the rows before."""
    return Ordered("lowest", column)


def first(column: str) -> Ordered:
    """Value of the first row of the key."""
    return Ordered("first", column)


def total(column: str) -> Ordered:
    """Sum over the key."""
    return Ordered("total", column)


def running(column: str) -> Ordered:
    """Sum so far, the row's own value included; null while all values are."""
    return Ordered("running", column)


def highest(column: str) -> Ordered:
    """Maximum over the key."""
    return Ordered("highest", column)


def _place(names: Sequence[str]) -> Column:
    return F.struct(*[quoted(name).alias(f"o{i}") for i, name in enumerate(names)])


def _hot(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, __n, __parts) of the hot keys: their rows and the parts they need."""
    many = counted.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > HOT)
    return many.withColumn("__parts", F.ceil(F.col("__n") / HOT).cast("int"))


def _cuts(counted: DataFrame, hot: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(keys, __cuts) of the hot keys: where their order is cut into parts."""
    rows = lookup(counted.select(*map(quoted, dict.fromkeys([*keys, *by]))), hot, keys, ["__n", "__parts"], null_safe=True, how="inner")
    every = F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("__n") / (F.col("__parts") * SAMPLED)))
    sample = rows.withColumn("__place", _place(by)).where(F.pmod(F.xxhash64(*map(quoted, by)), every) == 0)
    sorted_ = sample.groupBy(*map(quoted, keys)).agg(
        F.max("__parts").alias("__parts"), F.sort_array(F.collect_list("__place")).alias("__sample")
    )
    picked = F.transform(
        F.sequence(F.lit(1), F.col("__parts") - 1),
        lambda i: F.get("__sample", F.floor(i * F.size("__sample") / F.col("__parts")).cast("int")),
    )
    return sorted_.select(*map(quoted, keys), F.array_distinct(picked).alias("__cuts"))


def _part(place: Column, most: int) -> Column:
    """How many of the row's cuts, at most `most`, are not above its place: found by halves, with no look at each cut."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(most, 1).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get("__cuts", n + step - 1) <= place, n + step).otherwise(n))


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: Mapping[str, Ordered],
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add the outputs for each row of a key, ordered ascending by the columns of `order`, nulls first. Numbers are bigint.

    Hot keys are looked for in `counted`, by default the rows themselves: where these come from costly steps, give a
    table that has these keys and order columns and at least as many rows per key. An order with ties leaves open how equal
    rows are numbered, as any window does.
    """
    base = df.drop(*[n for n in outputs if n in df.columns])
    keys, order = list(keys), list(order)
    ranked = min((len(spec.by) for spec in outputs.values() if spec.kind in ("rank", "dense")), default=len(order))
    for spec in outputs.values():
        if list(spec.by) != order[: len(spec.by)] or (spec.kind in ("rank", "dense") and not spec.by):
            raise ValueError(f"a rank goes by the first columns of the order, not by {spec.by}")
    counted = base if counted is None else counted
    hot = _hot(counted, keys)
    parts, most = hot.agg(F.sum("__parts"), F.max("__parts")).first()
    if not parts:
        return _numbered(base, keys, order, outputs).select(*map(quoted, base.columns), *[F.col(f"__out_{n}").alias(n) for n in outputs])

    def sized(dim: DataFrame) -> DataFrame:
        return F.broadcast(dim) if parts <= BROADCAST_PARTS else dim

    cuts = _cuts(counted, sized(hot), keys, order[:ranked])
    cut = lookup(base, sized(cuts), keys, ["__cuts"], null_safe=True)
    part = _part(_place(order[:ranked]), most - 1)
    cut = cut.select(*map(quoted, base.columns), F.col("__cuts").isNotNull().alias("__hot"), part.alias("__part"))
    rows = _numbered(cut, [*keys, "__part"], order, outputs)
    carried = _carried(rows.where("__hot"), keys, order, outputs)
    found = lookup(rows, sized(carried), [*keys, "__part"], [f"__in_{n}" for n in outputs], null_safe=True)
    return found.select(*map(quoted, base.columns), *[_joined(n, spec).alias(n) for n, spec in outputs.items()])


def _numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], outputs: Mapping[str, Ordered]) -> DataFrame:
    """Each output within the keys, and the number of the row where it is needed later."""
    group = Window.partitionBy(*map(quoted, keys))
    rows = group.orderBy(*map(quoted, order))
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = rows.rowsBetween(Window.unboundedPreceding, -1)

    def value(spec: Ordered) -> Column:
        if spec.kind == "number":
            return F.row_number().over(rows).cast("bigint")
        if spec.kind in ("rank", "dense"):
            by = group.orderBy(*map(quoted, spec.by))
            return (F.rank() if spec.kind == "rank" else F.dense_rank()).over(by).cast("bigint")
        if spec.kind == "lag":
            return F.lag(quoted(spec.column)).over(rows)
        if spec.kind == "first":
            return F.first(quoted(spec.column)).over(so_far)
        if spec.kind == "known":
            return F.last(quoted(spec.column), ignorenulls=True).over(so_far)
        if spec.kind == "before":
            return F.last(quoted(spec.column), ignorenulls=True).over(before)
        if spec.kind == "lowest":
            return F.min(quoted(spec.column)).over(before)
        if spec.kind == "running":
            return F.sum(quoted(spec.column)).over(so_far)
        return (F.sum if spec.kind == "total" else F.max)(quoted(spec.column)).over(group)

    values = {f"__out_{n}": value(spec) for n, spec in outputs.items()}
    if any(spec.kind == "lag" for spec in outputs.values()):
        values["__begins"] = F.row_number().over(rows) == 1
    return df.withColumns(values)


def _carried(rows: DataFrame, keys: Sequence[str], order: Sequence[str], outputs: Mapping[str, Ordered]) -> DataFrame:
    """One row per key and part: what the parts before it give, or all parts of the key."""
    place = _place(order)

    def summary(name: str, spec: Ordered) -> Column:
        if spec.kind in ("number", "rank"):
            return F.count(F.lit(1))
        if spec.kind == "dense":
            return F.max(f"__out_{name}")
        if spec.kind in ("lag", "first"):
            pick = F.max_by if spec.kind == "lag" else F.min_by
            return pick(F.struct(quoted(spec.column).alias("v")), place)
        if spec.kind in ("known", "before"):
            filled = quoted(spec.column).isNotNull()
            return F.max_by(F.when(filled, quoted(spec.column)), F.when(filled, place))
        if spec.kind == "running":
            return F.sum(quoted(spec.column))
        if spec.kind == "lowest":
            return F.min(quoted(spec.column))
        return F.max(f"__out_{name}")

    every = Window.partitionBy(*map(quoted, keys))
    upto = every.orderBy("__part")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)

    def carry(name: str, spec: Ordered) -> Column:
        one = F.col(f"__sum_{name}")
        if spec.kind in ("number", "rank", "dense"):
            return F.coalesce(F.sum(one).over(before), F.lit(0).cast("bigint"))
        if spec.kind == "lag":
            return F.lag(one).over(upto)
        if spec.kind in ("known", "before"):
            return F.last(one, ignorenulls=True).over(before)
        if spec.kind == "running":
            return F.sum(one).over(before)
        if spec.kind == "lowest":
            return F.min(one).over(before)
        if spec.kind == "first":
            return F.first(one).over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return (F.sum if spec.kind == "total" else F.max)(one).over(every)

    summed = rows.groupBy(*map(quoted, keys), "__part").agg(*[summary(n, s).alias(f"__sum_{n}") for n, s in outputs.items()])
    return summed.select(*map(quoted, keys), "__part", *[carry(n, s).alias(f"__in_{n}") for n, s in outputs.items()])


def _joined(name: str, spec: Ordered) -> Column:
    own, carried = F.col(f"__out_{name}"), F.col(f"__in_{name}")
    if spec.kind in ("number", "rank", "dense"):
        return own + F.coalesce(carried, F.lit(0).cast("bigint"))
    if spec.kind == "lag":
        return F.when(F.col("__hot") & F.col("__begins"), carried["v"]).otherwise(own)
    if spec.kind in ("known", "before"):
        return F.coalesce(own, carried)
    if spec.kind == "lowest":
        return F.least(own, carried)
    if spec.kind == "running":
        return F.coalesce(own + carried, own, carried)
    return F.when(F.col("__hot"), carried["v"] if spec.kind == "first" else carried).otherwise(own)
