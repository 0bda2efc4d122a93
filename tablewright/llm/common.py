"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.sources.scratch import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and go on from the table.

    The lineage ends here: a lost executor costs the tasks that read the table, not those that made it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(identifier: Column, divisor: int) -> Column:
    """``crc32(identifier as text) mod divisor``; NULL counts as the empty text."""
    return F.crc32(F.coalesce(identifier.cast("string"), F.lit("")).cast("binary")) % divisor


def utf8(text: Column) -> Column:
    """The text's bytes; NULL is the empty text."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def rows(batches: Iterator[pa.RecordBatch], size: int = 512) -> Iterator[tuple]:
    """The rows of Arrow batches, few at a time as Python values."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            part = batch.slice(start, size)
            yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


def id_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
