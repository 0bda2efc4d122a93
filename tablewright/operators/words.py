"""Lines to words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.text import split_fields
from tablewright.operators.names import named


def words_of(
    lines: DataFrame, column: str = "value", output: str = "word", separator: str = " "
) -> DataFrame:
    """One row per piece between separators, empty pieces included."""
    return lines.select(F.explode(split_fields(named(column), separator)).alias(output))


def explode_array(df: DataFrame, column: str, output: str) -> DataFrame:
    """One row per element, next to the other columns."""
    others = (named(c) for c in df.columns if c != column)
    return df.select(*others, F.explode(named(column)).alias(output))
