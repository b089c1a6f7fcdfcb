"""Sums so far and other windows per key in blocks that the caller names.

Numbers, ranks and previous values need no blocks: see `ordered`.

A plain window sends all rows of a key to one task. Values of a whole key (first, total, highest) need no window:
they are aggregates, combined per task, that are looked up. For numbers, ranks and previous values a key is
cut into blocks, for instance months, that follow the order of the window. Rows are numbered within their block;
one small summary row per block carries the rest over to the next blocks. Blocks may be nested, coarse ones first:
then each level is carried within the level above, and no task holds all blocks of a key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closeworks.functions.rules import transition_code, transition_label
from closeworks.operators import ordered
from closeworks.operators.joins import lookup
from closeworks.operators.schema import quoted


@dataclass(frozen=True)
class Windowed:
    """One output of `per_key`: numbers of rows or values so far, or a value of the previous row.

    `local` is the value within the block, ordered by the columns `by` or by the whole order; a number adds the sum of `size` over earlier blocks, at the level of the first
    `depth` block columns; without a size the highest local value counts. `previous` names the column whose value in the last row before the block is carried instead.
    """

    local: Callable[[WindowSpec], Column] | None = None
    by: tuple[str, ...] = ()
    size: Column | None = None
    depth: int | None = None
    previous: str | None = None


@dataclass(frozen=True)
class Overall:
    """One output of `per_key` that is the same for all rows of a key.

    `aggregate` is given the order of rows; `combine` makes one value of those of the blocks, given their order.
    """

    aggregate: Callable[[Column], Column]
    combine: Callable[[Column, Column], Column]


def _without_nulls(df: DataFrame, names: Sequence[str]) -> dict[str, Column]:
    """Two columns without nulls per name: the value or a default, and whether it is null.

    Joining on them by plain equality matches null with null and, unlike `<=>`, keeps the
    partitioning that the window already has.
    """
    columns: dict[str, Column] = {}
    for i, name in enumerate(names):
        kind = df.schema[name].dataType
        default = "1970-01-01" if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else 0
        default = "" if isinstance(kind, T.StringType) else default
        columns[f"__value_{i}"] = F.coalesce(quoted(name), F.lit(default).cast(kind))
        columns[f"__null_{i}"] = F.isnull(quoted(name))
    return columns


def row_number() -> Windowed:
    return Windowed(local=lambda w: F.row_number().over(w), size=F.count(F.lit(1)))


def dense_rank(depth: int | None = None) -> Windowed:
    """Rank without gaps by the first `depth` block columns (all, if not given)."""
    return Windowed(size=F.max(F.lit(1)), depth=depth)


def dense_rank_by(*columns: str) -> Windowed:
    """Rank without gaps by the first columns of the order. Rows that are equal there must share a block."""
    return Windowed(local=lambda w: F.dense_rank().over(w), by=columns)


def rank(depth: int | None = None) -> Windowed:
    """Rank with gaps by the first `depth` block columns (all, if not given)."""
    return Windowed(size=F.count(F.lit(1)), depth=depth)


def lag(column: str) -> Windowed:
    return Windowed(local=lambda w: F.lag(column).over(w), previous=column)


def first(column: str) -> Overall:
    """Value of the first row of the key."""
    one = F.struct(quoted(column).alias("v"))
    return Overall(lambda order: F.min_by(one, order)["v"], lambda value, order: F.min_by(F.struct(value.alias("v")), order)["v"])


def total(column: str) -> Overall:
    """Sum over the whole key."""
    return Overall(lambda order: F.sum(column), lambda value, order: F.sum(value))


def highest(column: str) -> Overall:
    """Maximum over the whole key."""
    return Overall(lambda order: F.max(column), lambda value, order: F.max(value))


def per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Sequence[Column],
    outputs: Mapping[str, Windowed | Overall],
) -> DataFrame:
    """Add window values per key, ordered ascending by the columns of `order`.

    `block` must never decrease along the order. One block of one key has to fit a task, and so have the
    blocks of a level within one of the level above, so choose them after the data: the year and month of the ordering
    date, or the day and two ranges of ids. Numbers are bigint. The input is read again for the summaries and for the
    values of whole keys; after costly steps pass in a written table.
    """
    windowed = {n: spec for n, spec in outputs.items() if isinstance(spec, Windowed)}
    overall = {n: spec for n, spec in outputs.items() if isinstance(spec, Overall)}
    base = df.drop(*[n for n in outputs if n in df.columns])
    if windowed:
        result = _numbered(base, keys, order, block, windowed, overall)
    else:
        position = F.struct(*map(quoted, order))
        values = base.groupBy(*map(quoted, keys)).agg(*[spec.aggregate(position).alias(n) for n, spec in overall.items()])
        result = lookup(base, values, list(keys), list(overall), null_safe=True, derived=True)
    return result.select(*[quoted(c) for c in base.columns], *[quoted(n) for n in outputs])


def _numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Sequence[Column],
    outputs: Mapping[str, Windowed],
    overall: Mapping[str, Overall],
) -> DataFrame:
    blocks = {f"__block_{i}": column for i, column in enumerate(block)}
    blocked = df.withColumns(blocks)
    safe = _without_nulls(blocked, [*keys, *blocks])
    keyed = blocked.withColumns(safe)
    inside = Window.partitionBy(*safe)
    local = {
        f"__local_{n}": spec.local(inside.orderBy(*map(quoted, spec.by or order))) for n, spec in outputs.items() if spec.local
    }
    if any(spec.previous for spec in outputs.values()):
        local["__first"] = F.row_number().over(inside.orderBy(*map(quoted, order))) == 1
    # The summaries are made of these same rows, so that both share one shuffle.
    rows = keyed.withColumns(local) if local else keyed
    joined = rows
    depths = {n: spec.depth or len(block) for n, spec in outputs.items()}
    values = {}
    for depth in sorted(set(depths.values()), reverse=True):
        some = {n: spec for n, spec in outputs.items() if depths[n] == depth}
        on = list(safe)[: 2 * (len(keys) + depth)]
        joined = joined.join(_carried(rows, len(keys), depth, order, some, overall), on, "left")
        overall, taken = {}, [*overall]
        values |= {n: F.col(f"__overall_{n}") for n in taken}
    for name, spec in outputs.items():
        carried = F.col(f"__carried_{name}")
        if spec.previous:
            values[name] = F.when(F.col("__first"), carried["v"]).otherwise(F.col(f"__local_{name}"))
        else:
            own = F.col(f"__local_{name}") if spec.local else F.lit(1)
            values[name] = own.cast("bigint") + F.coalesce(carried, F.lit(0).cast("bigint"))
    return joined.select(*[quoted(c) for c in df.columns], *[value.alias(name) for name, value in values.items()])


def _carried(
    keyed: DataFrame,
    keys: int,
    depth: int,
    order: Sequence[str],
    outputs: Mapping[str, Windowed],
    overall: Mapping[str, Overall],
) -> DataFrame:
    """For each block what the blocks before it give: sums of sizes, and the last row before it; and values of the key.

    From the finest level up, the blocks of each level are combined to one row, and what comes before it within the
    level above is added.
    """

    def names(n: int) -> list[str]:
        return [f"{kind}_{i}" for i in range(n) for kind in ("__value", "__null")]

    numbers = [n for n, spec in outputs.items() if not spec.previous]
    previous = {n: spec.previous for n, spec in outputs.items() if spec.previous}
    position = F.struct(*map(quoted, order))
    size = {n: F.max(f"__local_{n}") if outputs[n].size is None else outputs[n].size for n in numbers}
    sizes = [size[n].cast("bigint").alias(f"__size_{n}") for n in numbers]
    last = [F.max_by(F.struct(quoted(c).alias("v")), position).alias(f"__last_{n}") for n, c in previous.items()]
    whole = [spec.aggregate(position).alias(f"__overall_{n}") for n, spec in overall.items()]
    level = keyed.groupBy(*names(keys + depth)).agg(*sizes, *last, *whole)
    finest, found = level, None
    for k in range(depth, 0, -1):
        at = keys + k - 1
        # nulls come first, as in the order of the rows
        by = [F.col(f"__null_{at}").desc(), F.col(f"__value_{at}")]
        above = Window.partitionBy(*names(at)).orderBy(*by)
        before = above.rowsBetween(Window.unboundedPreceding, -1)
        now = {f"__carried_{n}": F.sum(f"__size_{n}").over(before) for n in numbers}
        now |= {f"__carried_{n}": F.lag(f"__last_{n}").over(above) for n in previous}
        carried = level.select(*names(at + 1), *[c.alias(n) for n, c in now.items()])
        if found is None:
            found = carried
        else:
            more = carried.withColumnsRenamed({n: f"{n}_above" for n in now})
            both = found.join(more, names(at + 1), "left")
            merged = {f"__carried_{n}": F.coalesce(f"__carried_{n}", F.lit(0)) + F.coalesce(f"__carried_{n}_above", F.lit(0)) for n in numbers}
            merged |= {f"__carried_{n}": F.coalesce(f"__carried_{n}", f"__carried_{n}_above") for n in previous}
            found = both.withColumns(merged).drop(*more.columns[len(names(at + 1)) :])
        if k > 1:
            latest = F.struct(*[x for i in range(at, keys + k) for x in (~F.col(f"__null_{i}"), F.col(f"__value_{i}"))])
            sums = [F.sum(f"__size_{n}").alias(f"__size_{n}") for n in numbers]
            ends = [F.max_by(f"__last_{n}", latest).alias(f"__last_{n}") for n in previous]
            level = level.groupBy(*names(at)).agg(*sums, *ends)
    if overall:
        place = F.struct(*[x for i in range(keys, keys + depth) for x in (~F.col(f"__null_{i}"), F.col(f"__value_{i}"))])
        values = [spec.combine(F.col(f"__overall_{n}"), place).alias(f"__overall_{n}") for n, spec in overall.items()]
        found = found.join(finest.groupBy(*names(keys)).agg(*values), names(keys), "left")
    return found


def phase_transitions(df: DataFrame, case: str, order: Sequence[str], phase: str, counted: DataFrame | None = None) -> DataFrame:
    """Add FASE_DO_MES_ANTERIOR, MUDOU_FASE (code 0 to 4) and DP_FASE_MES (`old - new`). For `counted` see `ordered`."""
    previous = ordered.ordered(df, [case], order, {"FASE_DO_MES_ANTERIOR": ordered.lag(phase)}, counted)
    now, before = F.col(phase), F.col("FASE_DO_MES_ANTERIOR")
    return previous.withColumns(
        {"MUDOU_FASE": transition_code(now, before), "DP_FASE_MES": transition_label(now, before)}
    )


def count_once(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "QTDE") -> DataFrame:
    """1 on the first row of each key, 0 on the others; of equal first rows one counts.

    The first place of a key is an aggregate that is looked up; only rows of one place are numbered together.
    """
    place = F.struct(*map(quoted, order))
    first_ = df.groupBy(*map(quoted, keys)).agg(F.min(place).alias("__first"))
    same = Window.partitionBy(*map(quoted, keys), *map(quoted, order)).orderBy(*map(quoted, order))
    found = lookup(df.withColumn("__rn", F.row_number().over(same)), first_, list(keys), ["__first"], null_safe=True, derived=True)
    counts = (F.col("__rn") == 1) & F.col("__first").eqNullSafe(place)
    return found.withColumn(name, counts.cast("int")).drop("__rn", "__first")
