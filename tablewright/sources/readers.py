"""Sources."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import split_fields
from tablewright.operators.names import named
from tablewright.sources.scratch import scratch_path

BAD_LINE_POLICIES = ("fail", "drop", "split")
BAD_RECORD = "__bad_record"


def extract(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet dataset."""
    return spark.read.parquet(path)


def read_partition(spark: SparkSession, root: str, **partition: Any) -> DataFrame:
    """Read some partitions of a partitioned Parquet dataset, partition columns included.

    The root is read and the partitions are pruned, rather than their folders named: a
    folder read on its own loses its partition columns.
    """
    df = spark.read.parquet(root)
    for column, value in partition.items():
        df = df.where(named(column).eqNullSafe(F.lit(value)))
    return df


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Read text, one line per row, in the column ``value``."""
    return spark.read.text(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    null_text: str = "",
    multi_line: bool = False,
    on_bad: str = "fail",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Read what :func:`tablewright.sources.writers.load_csv` wrote.

    The header has to agree with the schema.  A malformed row ends the job (``fail``), is left
    out (``drop``), or comes back as text next to the good rows (``split``).  ``multi_line``
    reads values with line breaks in them, at the price that a file is no longer split between
    tasks; ``load_csv`` bounds the rows of a file.
    """
    if on_bad not in BAD_LINE_POLICIES:
        raise ValueError(f"on_bad must be one of {list(BAD_LINE_POLICIES)}, not {on_bad!r}")
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    full = T.StructType([*wanted.fields, T.StructField(BAD_RECORD, T.StringType())])
    rows = (
        spark.read.schema(wanted if on_bad == "fail" else full)
        .option("mode", "FAILFAST" if on_bad == "fail" else "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_RECORD)
        .option("enforceSchema", on_bad != "fail")
        .option("header", True)
        .option("escape", '"')
        .option("nullValue", null_text)
        .option("emptyValue", "")
        .option("multiLine", multi_line)
        .csv(path)
    )
    # A condition on all columns that always holds: no pruning hides a malformed one.
    everything = F.xxhash64(*(named(f.name) for f in wanted.fields))
    rows = rows.where(everything >= F.lit(-(2**63)))
    if on_bad == "fail":
        return rows
    bad = F.col(BAD_RECORD).isNotNull()
    good = rows.where(~bad).select(*(named(f.name) for f in wanted.fields))
    if on_bad == "drop":
        return good
    # Spark reads no bad records alone: a text of no length of the other columns goes with them.
    text = F.concat(F.col(BAD_RECORD), F.substring(everything.cast("string"), 1, 0))
    return good, rows.where(bad).select(text.alias("value"))


def from_rows(
    spark: SparkSession, rows: Iterable[Any], schema: T.StructType | str
) -> DataFrame:
    """A small DataFrame from tuples, lists, ``Row`` or dicts; the schema is always given."""
    return spark.createDataFrame(list(rows), schema)


def sql_over(df: DataFrame, view: str, statement: str) -> DataFrame:
    """Run a statement that names the DataFrame as ``{view}``; no view of the caller's is touched."""
    return df.sparkSession.sql(statement, **{view: df})


def read_strict_delimited(
    lines: DataFrame,
    fields: Sequence[str],
    on_bad: str = "fail",
    separator: str = ",",
    column: str = "value",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Split lines into exactly the given fields.

    A line with another number of parts is bad: ``fail`` ends the job with the line in the
    message, ``drop`` leaves it out, ``split`` returns the good rows and the bad lines.
    """
    if on_bad not in BAD_LINE_POLICIES:
        raise ValueError(f"on_bad must be one of {list(BAD_LINE_POLICIES)}, not {on_bad!r}")
    line = named(column)
    good = F.size(split_fields(line, separator)) == len(fields)
    # A condition rather than a column: no projection can prune the check away.
    if on_bad == "fail":
        kept = lines.where(
            F.when(good, F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("Bad line: "), F.coalesce(line, F.lit("NULL"))))
            )
        )
    else:
        kept = lines.where(good)
    rows = kept.select(*_parts(line, fields, separator))
    if on_bad == "split":
        return rows, lines.where(~F.coalesce(good, F.lit(False)))
    return rows


def _parts(line: Column, fields: Sequence[str], separator: str) -> list[Column]:
    parts = split_fields(line, separator)
    return [parts.getItem(i).alias(f) for i, f in enumerate(fields)]


@dataclass(frozen=True)
class StrictLines:
    """What :func:`split_strict_delimited` made of some lines."""

    good: DataFrame
    bad: DataFrame
    good_lines: int
    bad_lines: int


def split_strict_delimited(
    lines: DataFrame, fields: Sequence[str], separator: str = ",", column: str = "value"
) -> StrictLines:
    """Good rows, bad lines, and the number of each, from one pass over the lines.

    The lines are split once and set aside with a mark, in files of their own for either kind;
    they are counted while they are written.
    """
    line = named(column)
    parts = split_fields(line, separator)
    bad = ~F.coalesce(F.size(parts) == len(fields), F.lit(False))
    counted = Observation()
    marked = lines.select(bad.alias("bad"), F.when(~bad, parts).alias("parts"), F.when(bad, line).alias("line")).observe(
        counted, F.count_if(~F.col("bad")).alias("good_lines"), F.count_if("bad").alias("bad_lines")
    )
    path = scratch_path(lines.sparkSession, "strict-lines")
    marked.write.partitionBy("bad").parquet(path)
    kept = lines.sparkSession.read.schema(marked.schema).parquet(path)
    good = kept.where(~F.col("bad")).select(*(F.col("parts")[i].alias(f) for i, f in enumerate(fields)))
    numbers = {"good_lines": 0, "bad_lines": 0} | counted.get
    return StrictLines(good, kept.where("bad").select(F.col("line").alias(column)), **numbers)
