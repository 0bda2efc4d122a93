"""Grouped aggregates.

All of them combine on the map side before the shuffle, so that a hot group arrives as one
partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.names import named, require_unique
from tablewright.sources.scratch import set_aside


def column_mean(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    return df.agg(F.mean(named(column)).alias(output or f"avg_{column}"))


def row_count(df: DataFrame, output: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(output))


def group_max(df: DataFrame, by: Sequence[str], column: str, output: str) -> DataFrame:
    return df.groupBy(*(named(c) for c in by)).agg(F.max(named(column)).alias(output))


def group_count(df: DataFrame, by: Sequence[str], output: str = "count") -> DataFrame:
    return df.groupBy(*(named(c) for c in by)).agg(F.count(F.lit(1)).alias(output))


def group_sum_count(
    df: DataFrame, by: Sequence[str], column: str, sum_output: str, count_output: str
) -> DataFrame:
    return df.groupBy(*(named(c) for c in by)).agg(
        F.sum(named(column)).alias(sum_output), F.count(F.lit(1)).alias(count_output)
    )


def all_met(df: DataFrame, entity: str, requirement: str, met: str) -> DataFrame:
    """Entities that have met each of their requirements at least once.

    First one flag per (entity, requirement), then one verdict per entity: meeting one
    requirement twice does not make up for another, nor does a flag that is always NULL.
    """
    best = df.groupBy(named(entity), named(requirement)).agg(
        (F.coalesce(F.max(named(met)), F.lit(0)) >= 1).alias("__met")
    )
    return (
        best.groupBy(named(entity))
        .agg(F.bool_and("__met").alias("__all"))
        .where("__all")
        .select(named(entity))
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*(named(c) for c in columns)).distinct()


def bounded_values(distinct: DataFrame, column: str, limit: int, name: str | None = None) -> list[Any]:
    """The values of a column of distinct values, sorted, NULL last; more than ``limit`` is an error."""
    values = [row[column] for row in distinct.limit(limit + 1).collect()]
    if len(values) > limit:
        raise ValueError(f"more than {limit} distinct values in {name or column!r}: use the long form")
    return [*sorted(v for v in values if v is not None), *(v for v in values if v is None)]


def text_of(value: Any) -> str:
    """A value as Spark writes it in a column name."""
    return "null" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def pivot_count_long(
    df: DataFrame, rows: Sequence[str], column: str, value: str = "value", output: str = "count"
) -> DataFrame:
    """Number of rows per group and value, one row each: any number of values, NULL included."""
    return df.groupBy(*(named(c) for c in rows), named(column).alias(value)).agg(
        F.count(F.lit(1)).alias(output)
    )


def pivot_count(
    df: DataFrame,
    rows: Sequence[str],
    column: str,
    values: Sequence[Any] | None = None,
    max_values: int | None = None,
) -> DataFrame:
    """Number of rows per group and value, one output column per value.

    The values are named, or found, of which the caller says how many columns there may be at
    most.  Counts are made first, in one pass that does not depend on the number of values, and
    spread after it; where values have to be found the counts are set aside, and values and
    cells both come from them.  A cell without rows is NULL; NULL is a value like others.
    """
    counted = pivot_count_long(df, rows, column, "__value", "__count")
    if values is None:
        if max_values is None:
            raise ValueError("name the values, say how many there may be, or use pivot_count_long")
        counted = set_aside(counted)
        values = bounded_values(distinct_values(counted, "__value"), "__value", max_values, column)
    names = [text_of(v) for v in values]
    require_unique(df.sparkSession, [*rows, *names])
    kind = df.schema[column].dataType
    cells = (
        F.max(F.when(F.col("__value").eqNullSafe(F.lit(v).cast(kind)), F.col("__count"))).alias(n)
        for v, n in zip(values, names)
    )
    return counted.groupBy(*(named(c) for c in rows)).agg(*cells)
