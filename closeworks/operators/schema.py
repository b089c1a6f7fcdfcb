"""Column names, column order and column types."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAME_SEPARATORS = "()-._/|;?"
LIST_SEPARATORS = "()-._/"


# Signs of sheet headers that have a plain spelling but do not decompose into one.
PLAIN_SIGNS = str.maketrans({"°": "deg", "–": "-", "—": "-", "’": "'", "‘": "'", "“": '"', "”": '"'})


def without_marks(text: str) -> str:
    """Text without accents, all other characters unchanged."""
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))


def plain_letters(text: str) -> str:
    """ASCII spelling of a text; characters without one are dropped."""
    decomposed = unicodedata.normalize("NFKD", text.translate(PLAIN_SIGNS))
    return decomposed.encode("ascii", "ignore").decode("ascii")


def quoted(name: str) -> Column:
    """Column whose name may hold dots, colons or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def find_columns(df: DataFrame, word: str) -> list[str]:
    return [name for name in df.columns if word in name]


def existing(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in wanted if name in present]


def adjust_names(names: Iterable[str], separators: str = LIST_SEPARATORS) -> list[str]:
    """Separators and white space to single underscores, upper case."""
    blanks = str.maketrans(separators, " " * len(separators))
    return ["_".join(name.translate(blanks).split()).upper() for name in names]


def adjust_column_names(df: DataFrame) -> DataFrame:
    """Clean all names at once. Names that become equal stay apart by position and are
    resolved with `dedupe_columns_first` or `dedupe_columns_suffix`."""
    return df.toDF(*adjust_names(df.columns, NAME_SEPARATORS))


def compress_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[" ".join(name.split()) for name in df.columns])


def strip_accents_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[plain_letters(name) for name in df.columns])


def snake_names(names: Iterable[str], upper: bool = False) -> list[str]:
    snake = [re.sub(r"[^a-z0-9]+", "_", plain_letters(str(n)).lower()).strip("_") for n in names]
    return [name.upper() for name in snake] if upper else snake


def snake_columns(df: DataFrame, upper: bool = False) -> DataFrame:
    """Plain letters and digits joined by single underscores."""
    return df.toDF(*snake_names(df.columns, upper))


def _numbered(df: DataFrame) -> tuple[DataFrame, list[str]]:
    numbered = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*numbered), numbered


def dedupe_columns_first(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name."""
    first: dict[str, int] = {}
    for position, name in enumerate(df.columns):
        first.setdefault(name, position)
    numbered, keys = _numbered(df)
    return numbered.select(*[F.col(keys[p]).alias(name) for name, p in first.items()])


def dedupe_columns_suffix(df: DataFrame) -> DataFrame:
    """Keep columns that share a name, later ones as `name_1`, `name_2`…

    A number that would hit an existing name is skipped.
    """
    taken, repeats, result = set(df.columns), {}, []
    for name in df.columns:
        if name not in repeats:
            repeats[name] = 0
            result.append(name)
            continue
        while True:
            repeats[name] += 1
            candidate = f"{name}_{repeats[name]}"
            if candidate not in taken:
                break
        taken.add(candidate)
        result.append(candidate)
    return df.toDF(*result)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def resolved(df: DataFrame) -> dict[str, T.StructField]:
    """The columns by their names in lower case. Letter case alone does not tell columns apart, as Spark could not read them."""
    found: dict[str, T.StructField] = {}
    for field in df.schema.fields:
        known = found.setdefault(field.name.lower(), field)
        if known is not field:
            raise ValueError(f"columns {known.name!r} and {field.name!r} differ in letter case only, or not at all")
    return found


def spellings(dfs: Sequence[DataFrame]) -> dict[str, list[str | None]]:
    """For each column, by its first spelling, how each of the frames spells it; None where it is missing."""
    names = [resolved(df) for df in dfs]
    first: dict[str, str] = {}
    for columns in names:
        for lower, field in columns.items():
            first.setdefault(lower, field.name)
    return {name: [c[lower].name if lower in c else None for c in names] for lower, name in first.items()}


def common_columns(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames cut to the columns they share, in the order and spelling of the left one."""
    shared = [(name, *own) for name, own in spellings([left, right]).items() if None not in own]
    return left.select(*[quoted(a) for _, a, _ in shared]), right.select(*[quoted(b).alias(name) for name, _, b in shared])


def _conformed(df: DataFrame, schema: T.StructType | str) -> list[tuple[str, Column | None, Column]]:
    """Name, own column (None if missing) and wanted column for each field of `schema`."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields, out = resolved(df), []
    for field in schema.fields:
        own = fields.get(field.name.lower())
        if own is None:
            out.append((field.name, None, F.lit(None).cast(field.dataType)))
            continue
        column = quoted(own.name)
        out.append((field.name, column, column if own.dataType == field.dataType else column.try_cast(field.dataType)))
    return out


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The columns of `schema` in its order, types and letter case; what is missing or unreadable is null."""
    return df.select(*[wanted.alias(name) for name, _, wanted in _conformed(df, schema)])


def _lost(df: DataFrame, schema: T.StructType | str) -> list[Column]:
    columns = [(name, own, wanted) for name, own, wanted in _conformed(df, schema) if own is not None]
    return [F.count_if(own.isNotNull() & wanted.isNull()).alias(name) for name, own, wanted in columns]


def conform_observed(df: DataFrame, schema: T.StructType | str, observation: Observation) -> DataFrame:
    """As `conform`; once the result has been computed, the observation has the number of values each cast made null.

    They are counted while the rows pass, so that no row is read twice.
    """
    lost = _lost(df, schema)
    return conform(df.observe(observation, *lost) if lost else df, schema)


def lost_values(dfs: Sequence[DataFrame], schema: T.StructType | str) -> DataFrame:
    """(ENTRADA, COLUNA, PERDIDOS): for each frame, by its place, and column that it has, the values that its cast makes null."""
    counted = []
    for place, df in enumerate(dfs):
        lost = _lost(df, schema)
        if lost:
            names = [name for name, own, _ in _conformed(df, schema) if own is not None]
            row = df.agg(*lost)
            cells = [F.struct(F.lit(name).alias("COLUNA"), quoted(name).alias("PERDIDOS")) for name in names]
            counted.append(row.select(F.lit(place).alias("ENTRADA"), F.explode(F.array(*cells)).alias("cell")).select("ENTRADA", "cell.*"))
    if not counted:
        raise ValueError("no frame has a column of the schema")
    return reduce(DataFrame.unionAll, counted)


def with_missing(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Add the columns that are not there as nulls of the given type."""
    return df.withColumns({n: F.lit(None).cast(kind) for n, kind in types.items() if n not in df.columns})


def insert_after(df: DataFrame, name: str, new: str, value: Column) -> DataFrame:
    position = df.columns.index(name) + 1
    columns = [quoted(c) for c in df.columns]
    return df.select(*columns[:position], value.alias(new), *columns[position:])


def empty_frame(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Template without rows, in the session of `df`."""
    return df.sparkSession.createDataFrame([], schema)


def with_columns_changed(df: DataFrame, columns: Sequence[str], change) -> DataFrame:
    """Apply a column function to some columns in one projection.

    A column that is not there is an error, not silently passed over.
    """
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.withColumns({name: change(quoted(name)) for name in columns})
