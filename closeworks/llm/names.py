"""Column names that don't clash with those a table already has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, name: str) -> str:
    """The name, with underscores added until no column has it (letter case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
