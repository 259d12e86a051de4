"""Column names that clash with nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, name: str) -> str:
    """`name`, with underscores added until no column of the table is called so (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
