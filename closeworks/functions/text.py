"""String and number cleaning expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters of the Portuguese alphabet and their plain forms, position by position.
ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑáàâãäéèêëíìîïóòôõöúùûüçñ"
PLAIN = "AAAAAEEEEIIIIOOOOOUUUUCNaaaaaeeeeiiiiooooouuuucn"

TEXTUAL_NULLS = ("nan", "NaN", "None", "NAT", "NaT", "")


def strip_accents(col: Column) -> Column:
    return F.translate(col, ACCENTED, PLAIN)


def squeeze(col: Column) -> Column:
    """Trim and reduce every run of white space to one blank."""
    return F.regexp_replace(F.trim(col), r"\s+", " ")


def number(col: Column) -> Column:
    return col.try_cast("double")


def parse_brl(text: Column) -> Column:
    """Brazilian currency text to double, 0.0 where it is not a number.

    Dots are thousands separators only in text that has a decimal comma or is grouped
    in threes; `123.45` keeps its value and a leading minus its sign.
    """
    bare = F.regexp_replace(text, r"R\$|\s", "")
    grouped = F.contains(bare, F.lit(",")) | bare.rlike(r"^-?\d{1,3}(\.\d{3})+$")
    plain = F.when(grouped, F.translate(bare, ",.", ".")).otherwise(bare)
    value = plain.try_cast("double")
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def format_brl(col: Column) -> Column:
    """Number to text with dot grouping and two decimals after a comma."""
    return F.translate(F.format_number(col, 2), ",.", ".,")


def coerce_id(col: Column) -> Column:
    """Identifier text to bigint; workbook line-break residue and blanks are dropped.

    A fraction of zeros is dropped too, and so is an exponent that leaves a whole number; all else is null.
    """
    bare = F.trim(F.regexp_replace(col.cast("string"), "_x000D_", ""))
    whole = F.regexp_replace(bare, r"\.0*$", "")
    scientific = F.when(bare.rlike("[eE]"), bare.try_cast("decimal(38,10)"))
    exact = F.when(scientific == F.floor(scientific), scientific.try_cast("bigint"))
    return F.coalesce(F.when(whole.rlike(r"^[+-]?[0-9]+$"), whole).try_cast("bigint"), exact)


def null_tokens(col: Column, tokens: Iterable[str] = TEXTUAL_NULLS) -> Column:
    return F.when(col.isin(*tokens), F.lit(None)).otherwise(col)


def normalize_tax_id(col: Column) -> Column:
    """Digits only, left-padded to 11; longer ids are kept, blanks become null.

    A floating-point column must be cast to bigint first, or its digits would be read
    from scientific notation.
    """
    digits = F.regexp_replace(col.cast("string"), r"[^0-9]", "")
    padded = F.when(F.length(digits) < 11, F.lpad(digits, 11, "0")).otherwise(digits)
    return F.when(digits != "", padded)


def mask_tax_id(col: Column) -> Column:
    """`ddd.ddd.ddd-dd` for 11 digits, anything else unchanged."""
    masked = F.regexp_replace(col, r"^(\d{3})(\d{3})(\d{3})(\d{2})$", r"$1.$2.$3-$4")
    return F.when(F.length(col) == 11, masked).otherwise(col)


def tax_id_number(col: Column) -> Column:
    return F.regexp_replace(col, r"[.\-/]", "").try_cast("bigint")


def normalize_registration(col: Column, width: int = 8) -> Column:
    bare = F.regexp_replace(col.cast("string"), r"\s+", "")
    return F.when(F.length(bare) < width, F.lpad(bare, width, "0")).otherwise(bare)


def replace_values(col: Column, mapping: Mapping[str, str]) -> Column:
    """Upper-case, then exact value replacement."""
    upper = F.upper(col)
    result = upper
    for old, new in mapping.items():
        result = F.when(upper == old, F.lit(new)).otherwise(result)
    return result


def strip_suffix(col: Column, suffix: str) -> Column:
    return F.when(
        F.endswith(col, F.lit(suffix)), F.substr(col, F.lit(1), F.length(col) - len(suffix))
    ).otherwise(col)


def strip_prefix(col: Column, prefix: str) -> Column:
    """Remove a fixed phrase wherever it occurs in a free-text column."""
    return F.replace(col, F.lit(prefix), F.lit(""))


def branch_code(branch: Column, longer_code: Column) -> Column:
    """The branch, or characters 3 to 6 of a longer code where the branch is blank."""
    return F.when(is_blank(branch), F.substring(longer_code, 3, 4)).otherwise(branch)


def is_blank(col: Column) -> Column:
    return col.isNull() | (col == "")


def first_filled(*cols: Column) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.when(c != "", c) for c in cols])


def label_or(col: Column, default: str) -> Column:
    return F.coalesce(col, F.lit(default))


def contains_word(col: Column, word: str) -> Column:
    """Case-insensitive containment; false for null."""
    return F.coalesce(F.contains(F.upper(col), F.lit(word.upper())), F.lit(False))


def text_flag(col: Column) -> Column:
    """1 where there is text, else 0."""
    return (F.coalesce(col, F.lit("")) != "").cast("int")
