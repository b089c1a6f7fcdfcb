"""Normalised tables: managerial bases, consolidated billing bases and the cost driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from closeworks.operators import cleaning, schema
from closeworks.operators.unions import union_all


def managerial_base(
    sheet: DataFrame,
    date_word: str = "DATA ",
    more_dates: Sequence[str] = (),
    percent_word: str = "PERCENTUAL",
) -> DataFrame:
    """Managerial sheet with typed dates and percentages and canonical names."""
    dates = [*schema.find_columns(sheet, date_word), *schema.existing(sheet, more_dates)]
    typed = cleaning.parse_dates(sheet, list(dict.fromkeys(dates)))
    typed = cleaning.to_number(typed, schema.find_columns(typed, percent_word))
    return schema.strip_accents_columns(schema.adjust_column_names(typed))


def _named(sheet: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """A sheet with canonical names, whatever spelling it came with; repeated ones are numbered."""
    renamed = schema.rename(schema.dedupe_columns_suffix(sheet), renames)
    return schema.dedupe_columns_suffix(schema.snake_columns(renamed, upper=True))


def normalised_table(
    sheets: Sequence[DataFrame],
    renames: Mapping[str, str] | None = None,
    ids: Sequence[str] = (),
    money: Sequence[str] = (),
    dates: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    blanks: str = "null",
    as_text: bool = False,
) -> DataFrame:
    """Canonical table from one or more sheets of the same base.

    Names become UPPER_SNAKE in each sheet, with repeated ones numbered, before the sheets meet; ids bigint, money double, and dates
    (all columns with DATA in their name unless listed) dates. Textual nulls become real ones, or
    with `blanks="text"` nulls of text columns become empty text. `as_text` turns every other
    column into text.
    """
    table = union_all([_named(s.drop(*drop), renames or {}) for s in sheets])
    date_names = schema.find_columns(table, "DATA") if dates is None else schema.existing(table, dates)
    id_names, money_names = schema.existing(table, ids), schema.existing(table, money)
    typed = set(date_names) | set(id_names) | set(money_names)
    if as_text:
        others = {c: "string" for c in table.columns if c not in typed}
        table = cleaning.cast_columns(table, others)
    table = cleaning.coerce_ids(table, id_names)
    table = cleaning.parse_money(table, money_names)
    table = cleaning.coerce_dates(table, date_names)
    return cleaning.blank_nulls(table) if blanks == "text" else cleaning.null_text(table)


def cost_driver(sheet: DataFrame) -> DataFrame:
    """Judicial expenses with clean names, each once, and no nulls in text."""
    named = schema.dedupe_columns_first(schema.adjust_column_names(sheet))
    return cleaning.blank_nulls(named)


def payments_control(sheet: DataFrame, renames: Mapping[str, str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """Fee payments: plain upper-case names, textual nulls removed."""
    kept = sheet.drop(*drop)
    plain = kept.toDF(*[schema.without_marks(n).replace(" ", "_").upper() for n in kept.columns])
    return cleaning.null_text(schema.rename(plain, renames or {}))
