"""Columns to lists and dictionaries, in pieces of bounded size.

A list of a whole column, or of a hot group, fits neither a task nor the driver.  A list is
returned as rows of (group, ``start``, values): ``start`` is the exact position, from 0, of
the first value in the group's list, and no row holds more than ``chunk_size`` values.
Read by ``start``, the rows of a group are the whole list in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.chance import hash_number
from tablewright.operators.heavy import frequent_hashes, partition_share
from tablewright.operators.names import named
from tablewright.sources.scratch import set_aside

CHUNK_SIZE = 10_000
REPEATED_KEYS = ("max", "fail")


# Pieces of a run are told apart in two steps, so that no row holds the numbers of all of them.
PIECES_AT_ONCE = 4096


def _numbered(window_keys: Sequence[str], order: Sequence[str], df: DataFrame, size: int) -> DataFrame:
    window = Window.partitionBy(*window_keys).orderBy(*order)
    return df.withColumn("__at", F.row_number().over(window) - 1).withColumn(
        "__chunk", F.floor(F.col("__at") / F.lit(size))
    )


def _runs(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Rows with ``__copies``: rows that would fill a good part of a partition with their equals become one.

    They are found by a sketch of the rows' hashes and counted before any shuffle; all others stay rows of their own.
    The flag tells whether there are any.
    """
    often = frequent_hashes(rows, F.col("__tie"), partition_share(rows.sparkSession))
    if not often:
        return rows.withColumn("__copies", F.lit(1).cast("bigint")), False
    heavy = F.col("__tie").isin(often)
    counted = rows.where(heavy).groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__copies"))
    return rows.where(~heavy).withColumn("__copies", F.lit(1).cast("bigint")).unionByName(counted), True


def _pieces(runs: DataFrame, chunk_size: int) -> DataFrame:
    """Runs (a list of one value, ``__copies`` times) as lists of at most ``chunk_size``, dealt out to all tasks."""
    last = F.expr(f"(__copies - 1) div {chunk_size}")
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"__last div {PIECES_AT_ONCE}")))
    blocks = runs.withColumn("__last", last).withColumn("__block", block)
    first = F.col("__block") * PIECES_AT_ONCE
    until = F.least(first + (PIECES_AT_ONCE - 1), F.col("__last"))
    pieces = blocks.repartition("__part", "__start", "__block").withColumn("__piece", F.explode(F.sequence(first, until)))
    done = F.col("__piece") * chunk_size
    length = F.least(F.lit(chunk_size).cast("bigint"), F.col("__copies") - done).cast("int")
    return (
        # Only numbers and one value are dealt out; the list is made where it ends up.
        pieces.repartition("__part", "__start", "__piece")
        .withColumn("__list", F.array_repeat(F.get("__list", F.lit(0)), length))
        .withColumn("__start", F.col("__start") + done)
        .drop("__last", "__block", "__piece")
    )


def columns_to_lists(
    df: DataFrame,
    columns: Sequence[str],
    order: str,
    by: Sequence[str] = (),
    chunk_size: int = CHUNK_SIZE,
    greatest: str | None = None,
) -> DataFrame:
    """Aligned lists of several columns, NULLs included, in the order of ``order``.

    All rows are range-partitioned by (group, order, hash of the row), whose cut points Spark
    samples in one pass: they are compared and never computed with, so any orderable type,
    NaN, infinity and outliers are cut alike, and ties by their hash.  A group, however hot,
    spreads over as many partitions as it needs.  Rows that are equal in everything and so
    many that no cut could part them are counted before the shuffle and travel as one run of
    copies; running sums of copies give the positions, and a run is cut into pieces, dealt
    out to all tasks, when the lists are read.  The chunks are written once; where a
    partition starts within a group follows from their sizes, one row per group and
    partition.  Rows that tie in ``order`` follow each other by hash.  ``greatest`` adds
    ``max_<column>``, the maximum over the whole group.
    """
    keys = [f"__by_{i}" for i in range(len(by))]
    fields = [named(c).alias(f"__value_{i}") for i, c in enumerate(columns)]
    rows = df.select(
        *(named(c).alias(k) for c, k in zip(by, keys)),
        named(order).alias("__order"),
        F.struct(*fields).alias("__values"),
    ).withColumn("__tie", F.xxhash64(*keys, "__order", "__values"))
    rows, has_runs = _runs(rows)
    ranged = rows.repartitionByRange(*keys, "__order", "__tie").withColumn("__part", F.spark_partition_id())
    if has_runs:
        window = Window.partitionBy("__part", *keys).orderBy("__order", "__tie")
        window = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = (F.col("__copies") > 1).cast("int")
        # A run is a chunk of its own, and starts a new one after it.
        numbered = ranged.select(
            "*",
            (F.sum("__copies").over(window) - F.col("__copies")).alias("__at"),
            (2 * F.sum(run).over(window) - run).alias("__cut"),
        ).withColumn("__chunk", F.floor(F.col("__at") / F.lit(chunk_size)))
        by_chunk = ["__cut", "__chunk"]
    else:
        numbered = _numbered(["__part", *keys], ["__order", "__tie"], ranged, chunk_size)
        by_chunk = ["__chunk"]
    entries = F.sort_array(F.collect_list(F.struct("__at", "__values")))
    chunks = set_aside(
        numbered.groupBy("__part", *keys, *by_chunk)
        .agg(
            F.min("__at").cast("bigint").alias("__at"),
            F.max("__copies").alias("__copies"),
            entries.getField("__values").alias("__list"),
        )
        .drop(*by_chunk)
    )
    measured = [F.sum(F.size("__list") * F.col("__copies")).alias("__rows")]
    if greatest is not None:
        values = F.col("__list").getField(f"__value_{list(columns).index(greatest)}")
        measured.append(F.max(F.array_max(values)).alias("__greatest"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        chunks.groupBy("__part", *keys)
        .agg(*measured)
        .withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
    )
    if greatest is not None:
        parts = parts.withColumn("__greatest", F.max("__greatest").over(group))
    own = [k + "_own" for k in ("__part", *keys)]
    parts = parts.drop("__rows").withColumnsRenamed(dict(zip(("__part", *keys), own)))
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(("__part", *keys), own)]
    placed = chunks.join(parts, same).withColumn("__start", (F.col("__before") + F.col("__at")).cast("bigint"))
    if has_runs:
        placed = placed.where("__copies = 1").unionByName(_pieces(placed.where("__copies > 1"), chunk_size))
    return placed.select(
        *(F.col(k).alias(c) for c, k in zip(by, keys)),
        F.col("__start").alias("start"),
        # A field of an array of structs is the array of that field.
        *(F.col("__list").getField(f"__value_{i}").alias(c) for i, c in enumerate(columns)),
        *([F.col("__greatest").alias(f"max_{greatest}")] if greatest is not None else []),
    )


def column_to_list(
    df: DataFrame, column: str, order: str, by: Sequence[str] = (), chunk_size: int = CHUNK_SIZE
) -> DataFrame:
    return columns_to_lists(df, [column], order, by, chunk_size)


def two_columns_to_lists(
    df: DataFrame,
    first: str,
    second: str,
    order: str,
    by: Sequence[str] = (),
    chunk_size: int = CHUNK_SIZE,
) -> DataFrame:
    return columns_to_lists(df, [first, second], order, by, chunk_size)


def collect_groups(
    df: DataFrame, by: Sequence[str], column: str, order: str, chunk_size: int = CHUNK_SIZE
) -> DataFrame:
    """Group to the list of its non-NULL values, and their maximum over the whole group.

    A group of NULLs alone has one row with an empty list.
    """
    present = named(column).isNotNull()
    lists = columns_to_lists(df.where(present), [column], order, by, chunk_size, column)
    empty = (
        df.groupBy(*(named(c) for c in by))
        .agg(F.count(named(column)).alias("__present"))
        .where(F.col("__present") == 0)
        .select(
            *(named(c) for c in by),
            F.lit(0).cast("bigint").alias("start"),
            F.array().cast(lists.schema[column].dataType).alias(column),
            F.lit(None).cast(lists.schema[f"max_{column}"].dataType).alias(f"max_{column}"),
        )
    )
    return lists.unionByName(empty)


def two_columns_to_map(
    df: DataFrame,
    key: str,
    value: str,
    output: str = "entries",
    chunk_size: int = CHUNK_SIZE,
    on_repeated: str = "max",
) -> DataFrame:
    """A dictionary from two columns, as rows of (slice, chunk, map).

    Of several values for a key the greatest is kept, or (``on_repeated="fail"``) different
    ones are an error; a NULL key is an error.  The slice is a hash of the key, so one key is
    in one row only.  A dictionary of at most ``chunk_size`` keys is one row.
    """
    if on_repeated not in REPEATED_KEYS:
        raise ValueError(f"on_repeated must be one of {list(REPEATED_KEYS)}, not {on_repeated!r}")
    greatest: Column = F.max(named(value))
    if on_repeated == "fail":
        single = greatest.eqNullSafe(F.min(named(value)))
        greatest = F.when(single, greatest).otherwise(F.raise_error(F.lit("A key has several values")))
    unique = set_aside(df.groupBy(named(key).alias("__key")).agg(greatest.alias("__value")))
    keys = unique.count()
    slices = 1 if keys <= chunk_size else -(-2 * keys // chunk_size)
    sliced = unique.withColumn("slice", hash_number(0, [F.col("__key")]) % F.lit(slices))
    return (
        _numbered(["slice"], ["__key"], sliced, chunk_size)
        .groupBy("slice", F.col("__chunk").cast("int").alias("chunk"))
        .agg(F.map_from_entries(F.collect_list(F.struct("__key", "__value"))).alias(output))
    )
