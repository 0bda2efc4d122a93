"""Renaming and reordering columns.

All renames are simultaneous: the new names are worked out from the old ones and applied
by one projection, so a name produced by the rename is never renamed again, and a swap of
two names is a swap.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How special characters are spelled in changed column names.
SPACE_SPELLING = "_&"
DOT_SPELLING = "_$"

SORT_ORDERS = ("asc", "desc")


def quote_name(name: str) -> str:
    """The name in back-quotes, so that dots in it do not read as struct access."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """The column with literally this name."""
    return F.col(quote_name(name))


def require_unique(spark: SparkSession, names: Sequence[str]) -> None:
    """Refuse names that could not be told apart afterwards."""
    sensitive = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    seen = Counter(n if sensitive else n.lower() for n in names)
    repeated = sorted({n for n in names if seen[n if sensitive else n.lower()] > 1})
    if repeated:
        raise ValueError(f"this would repeat column names: {repeated}")


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns but {len(names)} new names")
    require_unique(df.sparkSession, names)
    return df.toDF(*names)


def modify_column_names(df: DataFrame, fun: Callable[[str], str]) -> DataFrame:
    """Rename every column with a function of its name."""
    return rename_all(df, [fun(c) for c in df.columns])


def rename_where(
    df: DataFrame, fun: Callable[[str], str], predicate: Callable[[str], bool]
) -> DataFrame:
    """Rename only the columns whose name satisfies the predicate."""
    return modify_column_names(df, lambda c: fun(c) if predicate(c) else c)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by an ``{old: new}`` mapping; names that are not there are ignored."""
    return modify_column_names(df, lambda c: mapping.get(c, c))


def spell_special_characters(name: str) -> str:
    return name.translate({ord(" "): SPACE_SPELLING, ord("."): DOT_SPELLING})


def change_column_names(df: DataFrame) -> DataFrame:
    """Spell out the spaces and dots in all column names."""
    return modify_column_names(df, spell_special_characters)


def dots_to_underscores(name: str, count: int | None = 1) -> str:
    """Replace the first ``count`` dots, or all of them for ``None``."""
    return name.replace(".", "_", -1 if count is None else count)


def sort_columns(df: DataFrame, order: str = "asc") -> DataFrame:
    """Reorder the columns by name."""
    if order not in SORT_ORDERS:
        raise ValueError(f"sort order must be one of {list(SORT_ORDERS)}, not {order!r}")
    return df.select(*(named(c) for c in sorted(df.columns, reverse=order == "desc")))


def with_column_metadata(df: DataFrame, column: str, metadata: Mapping[str, Any]) -> DataFrame:
    """Attach metadata to one field; a Parquet round trip keeps it."""
    return df.select(
        *(named(c).alias(c, metadata=dict(metadata)) if c == column else named(c) for c in df.columns)
    )


def column_metadata(df: DataFrame, column: str) -> dict[str, Any]:
    return dict(df.schema[column].metadata)
