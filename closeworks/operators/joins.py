"""Joins: lookups, outer joins, membership and the coalescing merge.

Dimensions are never hinted as broadcast unless their size was counted where they were
built (`sources.dims`). Everything else leaves the choice to Spark, which compares sizes with
`spark.sql.autoBroadcastJoinThreshold` and otherwise shuffles both sides, splitting a hot
key between tasks (see `session.SETTINGS`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.operators.schema import quoted


def _pairs(keys) -> list[tuple[str, str]]:
    if isinstance(keys, str):
        return [(keys, keys)]
    if isinstance(keys, Mapping):
        return list(keys.items())
    return [(key, key) for key in keys]


def lookup(
    df: DataFrame,
    dim: DataFrame,
    keys: str | Sequence[str] | Mapping[str, str],
    columns: Mapping[str, str] | Sequence[str],
    null_safe: bool = False,
    how: str = "left",
    derived: bool = False,
) -> DataFrame:
    """Add columns of `dim`, which holds each key once, without multiplying rows.

    `keys` names the key columns, or maps ours to those of `dim`; `columns` names the wanted
    columns, or maps those of `dim` to the names they get. With `null_safe` a missing
    key matches a missing key, as concatenated text keys would.

    `derived` says that `dim` was grouped or de-duplicated by these keys just before. Spark would
    reuse that partitioning, and adaptive execution splits a hot key only where both sides are
    shuffled for the join itself. A null-safe comparison makes it shuffle the small side again;
    null keys are taken out of it, so they still match nothing.
    """
    pairs = _pairs(keys)
    names = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    right = dim.select(
        *[quoted(theirs).alias(f"__key_{i}") for i, (_, theirs) in enumerate(pairs)],
        *[quoted(old).alias(f"__new_{i}") for i, old in enumerate(names)],
    )
    matches = []
    for i, (ours, _) in enumerate(pairs):
        left_key, right_key = quoted(ours), F.col(f"__key_{i}")
        if derived and not null_safe:
            right = right.filter(right_key.isNotNull())
        matches.append(left_key.eqNullSafe(right_key) if null_safe or derived else left_key == right_key)
    joined = df.join(right, reduce(Column.__and__, matches), how)
    kept = [quoted(c) for c in df.columns if c not in names.values()]
    added = [F.col(f"__new_{i}").alias(new) for i, new in enumerate(names.values())]
    return joined.select(*kept, *added)


def inner_lookup(df, dim, keys, columns=(), derived: bool = False) -> DataFrame:
    """As `lookup`, for rows with a match only."""
    return lookup(df, dim, keys, columns, how="inner", derived=derived)


def full_outer_coalesce(
    left: DataFrame, right: DataFrame, keys: Sequence[str], fill: float = 0.0
) -> DataFrame:
    """Full outer join on keys that are unique on both sides; missing numbers become `fill`."""
    joined = left.join(right, list(keys), "full")
    measures = [c for c in joined.columns if c not in keys]
    return joined.fillna(fill, subset=measures)


def flag_exists(
    df: DataFrame, history: DataFrame, keys, flag: str, null_safe: bool = False
) -> DataFrame:
    """Boolean column: does the key occur in the history?"""
    pairs = _pairs(keys)
    known = history.select(*[quoted(theirs) for _, theirs in pairs]).distinct()
    known = known.withColumn("__known", F.lit(True))
    # `known` has the names of the history.
    found = lookup(df, known, dict(pairs), {"__known": flag}, null_safe, derived=True)
    return found.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def _by_membership(df: DataFrame, history: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on equal keys, written so that a hot key can be split (see `lookup`)."""
    known = history.select(*[quoted(k).alias(f"__key_{i}") for i, k in enumerate(keys)]).dropna().distinct()
    same = [quoted(k).eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(keys)]
    return df.join(known, reduce(Column.__and__, same), how)


def known_only(df: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in the history."""
    return _by_membership(df, history, keys, "left_semi")


def unknown_only(df: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in the history, or is null."""
    return _by_membership(df, history, keys, "left_anti")


def merge_update(
    source: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    columns: Sequence[str] | None = None,
    null_overwrites: bool = False,
) -> DataFrame:
    """Update `source` from `new`, which holds each key once.

    A new value wins if it is not null; with `null_overwrites` it wins on every matched row.
    `columns` limits the update to some columns. With `how` right or outer the rows that only
    `new` has are added with their keys; they come from an anti join, because a full outer
    join cannot split a hot key between tasks. Null keys match nothing (see `lookup` for the
    null-safe comparison).
    """
    left = source.alias("a")
    right = new.dropna(subset=list(keys)).withColumn("__matched", F.lit(True)).alias("b")
    condition = reduce(Column.__and__, [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys])
    joined = left.join(right, condition, "left" if how in ("left", "outer") else "inner")
    updated = set(new.columns if columns is None else columns) & set(new.columns) - set(keys)

    def value(name: str) -> Column:
        old = F.col(f"a.`{name}`")
        if name not in updated:
            return old
        fresh = F.col(f"b.`{name}`")
        return F.when(F.col("b.__matched"), fresh).otherwise(old) if null_overwrites else F.coalesce(fresh, old)

    ordered = list(keys) + [c for c in source.columns if c not in keys]
    merged = joined.select(*[value(name).alias(name) for name in ordered])
    if how not in ("right", "outer"):
        return merged
    added = unknown_only(new, source, keys)
    filled = [
        quoted(n) if n in updated or n in keys else F.lit(None).cast(source.schema[n].dataType) for n in ordered
    ]
    return merged.unionAll(added.select(*[c.alias(n) for c, n in zip(filled, ordered)]))


def refresh_closed(
    book: DataFrame,
    totals: DataFrame,
    amounts: Sequence[str],
    case: str = "ID_PROCESSO",
    month: str = "MES_FECH",
    closed: str = "ENCERRADOS",
    last_payment: str = "DT_ULT_PGTO",
    total: str = "TOTAL_PAGAMENTOS",
) -> DataFrame:
    """Put current payment totals on the latest closed row of every case.

    `totals` holds one row per case; a closed case without one has paid nothing. The total
    is the sum of all amounts after the update, a known last payment date is never lost, and
    rows that are not refreshed keep what they had. The latest month comes from an
    aggregate that is combined before the shuffle, so one case with very many rows is no
    problem, and the book itself is joined on case and month.
    """
    latest = book.filter(F.col(closed) == 1).groupBy(case).agg(F.max(month).alias("__month"))
    fresh = latest.join(totals.withColumnsRenamed({n: f"__{n}" for n in [*amounts, last_payment]}), case, "left")
    fresh = fresh.select(
        F.col(case).alias("__case"),
        "__month",
        *[F.coalesce(F.col(f"__{n}"), F.lit(0.0)).alias(f"__{n}") for n in amounts],
        F.col(f"__{last_payment}"),
    )
    joined = book.join(
        fresh, (F.col(case) == F.col("__case")) & (F.col(month) == F.col("__month")), "left"
    )
    renewed = (F.col("__case").isNotNull()) & (F.col(closed) == 1)
    new_total = reduce(Column.__add__, [F.col(f"__{n}") for n in amounts])
    changes = {n: F.when(renewed, F.col(f"__{n}")).otherwise(F.col(n)) for n in amounts}
    changes[last_payment] = F.when(
        renewed, F.coalesce(F.col(f"__{last_payment}"), F.col(last_payment))
    ).otherwise(F.col(last_payment))
    changes[total] = F.when(renewed, new_total).otherwise(F.col(total))
    return joined.withColumns(changes).select(*book.columns)


def org_lookup(
    df: DataFrame,
    units: DataFrame,
    areas: DataFrame,
    centre: str,
    company: str,
    override: tuple[str, str, str] | None = None,
    area_name: str = "AREA_FUNCIONAL",
) -> DataFrame:
    """Business unit and functional area of a cost centre.

    `units` has CENTRO_DE_CUSTO, BU; `areas` has CENTRO, DESCRICAO, NOME2, NOME3,
    NOME_RESPONSAVEL, AREA_FUNCIONAL. `override` names a company that is its own unit, the
    label it gets everywhere and the short label of its functional area, which is called
    `area_name`.
    """
    found = lookup(df, units, {centre: "CENTRO_DE_CUSTO"}, {"BU": "BU"})
    found = lookup(
        found,
        areas,
        {centre: "CENTRO"},
        {
            "DESCRICAO": "DESCRICAO_CENTRO_CUSTO",
            "NOME2": "VP",
            "NOME3": "DIRETORIA",
            "NOME_RESPONSAVEL": "RESPONSAVEL_AREA",
            "AREA_FUNCIONAL": area_name,
        },
    )
    found = found.withColumn("RESPONSAVEL_AREA", F.upper("RESPONSAVEL_AREA"))
    if override is None:
        return found
    name, label, area_label = override
    special = F.col(company) == name
    labels = {c: label for c in ["BU", "VP", "DIRETORIA", "RESPONSAVEL_AREA"]}
    labels[area_name] = area_label
    return found.withColumns({c: F.when(special, v).otherwise(F.col(c)) for c, v in labels.items()})


def discount_for(
    df: DataFrame,
    discounts: DataFrame,
    task: str,
    office: str,
    tasks: Sequence[str],
    excluded_offices: Sequence[str],
) -> DataFrame:
    """Column DESCONTO: the discount of the task, for listed tasks and no excluded office."""
    found = lookup(df, discounts, {task: "QUESITO"}, {"VALOR": "DESCONTO"})
    # An office that is missing is none of the excluded ones.
    allowed = F.col(office).isNull() | ~F.col(office).isin(*excluded_offices)
    return found.withColumn(
        "DESCONTO", F.when(F.col(task).isin(*tasks) & allowed, F.col("DESCONTO"))
    )


def last_per_key(df: DataFrame, key: str, month: str) -> DataFrame:
    """Rows of the last month of each key (several if they share it)."""
    last = df.groupBy(key).agg(F.max(month).alias("__last"))
    joined = lookup(df, last, key, {"__last": "__last"}, derived=True)
    return joined.filter(F.col(month) == F.col("__last")).drop("__last")
