"""Sinks.

Each writes a folder with one file per task.  ``rebalance`` adds a shuffle that evens out
the files: adaptive execution merges small ones and splits those of a hot partition.
Nothing is ever brought together in a single task.

``mode="overwrite"`` writes the new rows beside the old ones and exchanges the folders when
they are complete: a job that fails leaves the old rows, and may read what it replaces.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, DataFrameWriter

from tablewright.operators.names import named
from tablewright.sources.folders import Folders, replaced

# A file with line breaks in its values is read by one task.
MAX_ROWS_PER_FILE = 1_000_000


def _load(
    df: DataFrame,
    path: str,
    mode: str,
    rebalance: bool,
    write: Callable[[DataFrameWriter, str], None],
    columns: tuple[str, ...] = (),
    check: Callable[[str], None] | None = None,
) -> None:
    even = df.hint("rebalance", *columns) if rebalance else df
    if mode == "overwrite":
        replaced(df.sparkSession, path, lambda staged: write(even.write.mode("error"), staged), check)
    else:
        write(even.write.mode(mode), path)


def load_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    null_text: str = "",
    rebalance: bool = False,
    max_rows_per_file: int = MAX_ROWS_PER_FILE,
) -> None:
    """Write CSV files with a header, none with more than ``max_rows_per_file`` rows.

    With the default ``null_text`` a NULL and an empty string read back alike; give a text
    that does not occur to keep them apart.
    """

    def write(writer: DataFrameWriter, target: str) -> None:
        (
            writer.option("header", True)
            .option("escape", '"')
            .option("nullValue", null_text)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("maxRecordsPerFile", max_rows_per_file)
            .csv(target)
        )

    _load(df, path, mode, rebalance, write)


def load_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", rebalance: bool = False
) -> None:
    _load(df, path, mode, rebalance, lambda writer, target: writer.parquet(target))


PARTITION_MODES = ("error", "append", "ignore", "overwrite", "overwrite_all", "overwrite_partitions")


class PartitionsLost(ValueError):
    """Overwriting would erase partitions that the new rows do not have."""


def load_partitioned(
    df: DataFrame, path: str, *columns: str, mode: str = "error", rebalance: bool = True
) -> None:
    """Write Parquet in one folder per combination of values.

    Rebalanced by those columns, a folder gets a few files instead of one per task, and a
    hot one is written by several tasks.

    ``overwrite_partitions`` replaces the partitions that the new rows have and leaves all
    others.  ``overwrite`` replaces everything, but is refused (:class:`PartitionsLost`, the
    old rows stay) if a partition would be erased that the new rows do not have;
    ``overwrite_all`` erases such ones, too.  Either way the old rows stay until the new ones
    are complete.
    """
    if mode not in PARTITION_MODES:
        raise ValueError(f"mode must be one of {list(PARTITION_MODES)}, not {mode!r}")
    if not columns:
        raise ValueError("name the columns to partition by")
    spark = df.sparkSession

    def write(writer: DataFrameWriter, target: str) -> None:
        writer.partitionBy(*columns).parquet(target)

    def parts(folder: str) -> DataFrame:
        # Partition columns alone: folder names are read and no data.
        return spark.read.schema(df.schema).parquet(folder).select(*(named(c) for c in columns)).distinct()

    def nothing_lost(staged: str) -> None:
        if not Folders(spark, path).exists(path):
            return
        old, new = parts(path), parts(staged)
        same = reduce(lambda a, b: a & b, (old[f"`{c}`"].eqNullSafe(new[f"`{c}`"]) for c in columns))
        lost = old.join(new, same, "left_anti").limit(3).collect()
        if lost:
            raise PartitionsLost(
                f"{path} has partitions that the new rows do not have, such as {[r.asDict() for r in lost]}: "
                "mode 'overwrite_partitions' leaves them, 'overwrite_all' erases them"
            )

    if mode == "overwrite_partitions":
        even = df.hint("rebalance", *columns) if rebalance else df
        write(even.write.mode("overwrite").option("partitionOverwriteMode", "dynamic"), path)
    elif mode == "overwrite_all":
        _load(df, path, "overwrite", rebalance, write, columns)
    else:
        _load(df, path, mode, rebalance, write, columns, nothing_lost)


def load_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a single text column, one row per line."""
    _load(df, path, mode, False, lambda writer, target: writer.text(target))
