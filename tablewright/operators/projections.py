"""Projections and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.arithmetic import multiply
from tablewright.functions.text import join_text, upper_equals
from tablewright.operators.names import named


def steps_report(
    df: DataFrame,
    steps_per_floor: int,
    *,
    id: str = "id",
    first: str = "first_name",
    second: str = "second_name",
    floor: str = "floor",
) -> DataFrame:
    """Full name and number of steps up to the desk, one row per person."""
    return df.select(
        named(id).alias("id"),
        join_text(named(first), named(second)).alias("name"),
        multiply(named(floor), steps_per_floor).alias("steps_to_desk"),
    )


def with_age(df: DataFrame, floor: str = "floor", years_per_floor: int = 10) -> DataFrame:
    """All columns, and an ``age`` worked out from the floor."""
    return df.withColumn("age", multiply(named(floor), years_per_floor))


def select_columns(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """Select a list of literal names and expressions."""
    return df.select(*(named(c) if isinstance(c, str) else c for c in cols))


def struct_field(struct: str, field: str) -> Column:
    """A field of a struct column, both names taken literally."""
    return named(struct).getField(field)


def where_at_least(df: DataFrame, column: str, threshold: int | float | str) -> DataFrame:
    return df.where(named(column) >= F.lit(threshold))


def where_upper_equals(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose text equals ``text`` in any mix of upper and lower case."""
    return df.where(upper_equals(named(column), text))


def where_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & named(c).isNotNull()
    return df.where(condition)


def sort_ascending(df: DataFrame, *columns: str) -> DataFrame:
    """A global ascending sort (range-partitioned, so no single task sorts it all)."""
    return df.orderBy(*(named(c).asc() for c in columns))
