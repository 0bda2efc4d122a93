"""Maps to columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.maps import map_values_as
from tablewright.operators.aggregates import bounded_values
from tablewright.operators.names import named, require_unique


def map_distinct_keys(df: DataFrame, map_column: str, output: str = "key") -> DataFrame:
    """The distinct keys of a map column, one per row."""
    return df.select(F.explode(F.map_keys(named(map_column))).alias(output)).distinct()


def map_to_rows(
    df: DataFrame,
    map_column: str,
    keep: Sequence[str] | None = None,
    key: str = "key",
    value: str = "value",
) -> DataFrame:
    """One row per entry next to the kept columns: any number of keys."""
    if keep is None:
        keep = [c for c in df.columns if c != map_column]
    require_unique(df.sparkSession, [*keep, key, value])
    return df.select(*(named(c) for c in keep), F.explode(named(map_column)).alias(key, value))


def map_to_columns(
    df: DataFrame,
    map_column: str,
    keys: Sequence[str] | None = None,
    keep: Sequence[str] | None = None,
    max_keys: int | None = None,
) -> DataFrame:
    """Replace a map column by one column per key.

    The keys are named, or found by a job of its own, of which the caller says how many
    columns there may be at most; more are an error.
    """
    if keys is None:
        if max_keys is None:
            raise ValueError("name the keys, say how many there may be, or use map_to_rows")
        keys = bounded_values(map_distinct_keys(df, map_column), "key", max_keys)
    if keep is None:
        keep = [c for c in df.columns if c != map_column]
    require_unique(df.sparkSession, [*keep, *keys])
    return df.select(*(named(c) for c in keep), *map_values_as(named(map_column), keys))
