"""Dictionary lookups and the join behind them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.maps import MAX_LITERAL_ENTRIES, translate_values, value_type_of
from tablewright.operators.heavy import frequent_hashes, partition_share
from tablewright.operators.names import named

BROADCAST_BYTES = 64 << 20
# Overhead per row in a broadcast hash table, on top of the text of its values.
ROW_OVERHEAD_BYTES = 64
# A key with more than this share of all rows is hot; there can be at most 1/share of them.
HOT_SHARE = 1 / 500
# Table rows of hot keys are broadcast up to this size.
HOT_BYTES = 64 << 20


def _width(df: DataFrame) -> Column:
    """An upper-end estimate of a row's size in memory."""
    texts = (F.coalesce(F.octet_length(named(c).cast("string")), F.lit(0)) for c in df.columns)
    fixed = F.lit(ROW_OVERHEAD_BYTES + 8 * len(df.columns)).cast("bigint")
    return reduce(lambda a, b: a + b, texts, fixed)


def measured_bytes(df: DataFrame) -> int:
    """A table's size in memory, estimated by one distributed aggregate."""
    return df.agg(F.sum(_width(df)).alias("bytes")).first()["bytes"] or 0


@dataclass(frozen=True)
class Profile:
    rows: int
    keys: int
    bytes: int


def profile(df: DataFrame, keys: Sequence[str]) -> Profile:
    """Number of rows, of different keys, and size, by one job."""
    per_key = df.groupBy(*(named(k) for k in keys)).agg(
        F.count(F.lit(1)).alias("__rows"), F.sum(_width(df)).alias("__bytes")
    )
    found = per_key.agg(F.sum("__rows"), F.count(F.lit(1)), F.sum("__bytes")).first()
    return Profile(*(n or 0 for n in found))


def _matches(
    left: DataFrame, right: DataFrame, on: Sequence[str], keys: Sequence[str], null_safe: bool
) -> Column:
    pairs = ((left[f"`{c}`"], right[k]) for c, k in zip(on, keys))
    return reduce(lambda a, b: a & b, (x.eqNullSafe(y) if null_safe else x == y for x, y in pairs))


def join_unique(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    table_bytes: int | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float | None = None,
) -> DataFrame:
    """Join ``df`` with a table that holds each key at most once.

    A table of at most ``max_broadcast_bytes`` (``table_bytes``, or measured) is broadcast.
    A larger one is shuffled, but not for the hot keys of ``df``: there are at most
    ``1 / hot_share`` keys with more than that share of its rows (by default half of what a
    shuffle partition has), and so their few table rows are broadcast if they, too, are
    measured to be small.  No row of a hot key is shuffled then, and none is dropped.
    ``null_safe`` lets NULL keys match NULL keys.

    Hot keys are found by their hashes, in one pass over the keys of ``df`` alone, and rows are
    told apart by these: a row that is taken for hot by its hash is joined all the same.  ``df``
    is read three times then, once without; ``checkpoint()`` it first if it is dear to compute.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    keys = [f"__key_{i}" for i in range(len(on))]
    table = table.select(
        *(named(c).alias(k) for c, k in zip(on, keys)),
        *(named(c) for c in table.columns if c not in on),
    )
    kept = [c for c in table.columns if c not in keys]

    def joined(rows: DataFrame, part: DataFrame) -> DataFrame:
        return rows.join(part, _matches(rows, part, on, keys, null_safe), how).select(
            *(named(c) for c in rows.columns), *(named(c) for c in kept)
        )

    if table_bytes is None:
        table_bytes = measured_bytes(table)
    if table_bytes <= max_broadcast_bytes:
        return joined(df, F.broadcast(table))

    by_merge = joined(df, table.hint("merge"))
    # Only values of one type have one hash.
    if any(df.schema[c].dataType != table.schema[k].dataType for c, k in zip(on, keys)):
        return by_merge
    hashed = F.xxhash64(*(named(c) for c in on))
    hot = frequent_hashes(df, hashed, hot_share or partition_share(df.sparkSession, HOT_SHARE))
    if not hot:
        return by_merge
    hot_entries = table.where(F.xxhash64(*keys).isin(hot))
    if measured_bytes(hot_entries) > max(max_broadcast_bytes, HOT_BYTES):
        return by_merge
    return joined(df.where(hashed.isin(hot)), F.broadcast(hot_entries)).unionByName(
        joined(df.where(~hashed.isin(hot)), table.hint("merge"))
    )


PLAIN_TYPES = (T.StringType, T.IntegralType, T.DoubleType, T.BooleanType)
MAX_LITERAL_ROWS = 50


def local_table(spark: SparkSession, rows: Sequence[Row], schema: T.StructType) -> DataFrame:
    """Rows of the driver as a table; a few plain ones as literals, without Python workers."""
    plain = all(isinstance(f.dataType, PLAIN_TYPES) for f in schema)
    if not plain or len(rows) > MAX_LITERAL_ROWS:
        return spark.createDataFrame(rows, schema).coalesce(1)
    structs = (
        F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema)))
        for row in rows
    )
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def unique_keys(mapping: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key; of several values the greatest is kept."""
    return mapping.groupBy(named(key).alias(key)).agg(F.max(named(value)).alias(value))


def map_values_from(
    df: DataFrame,
    column: str,
    mapping: DataFrame,
    key: str,
    value: str,
    output: str,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    on_repeated: str = "max",
) -> DataFrame:
    """Look ``column`` up in a mapping table; NULL where it is missing.

    The mapping may be as large as it likes: see :func:`join_unique`.  Of several values
    for a key the greatest is taken, or (``on_repeated="fail"``) a repeated key is an error.
    """
    if on_repeated not in ("max", "fail"):
        raise ValueError(f"on_repeated must be 'max' or 'fail', not {on_repeated!r}")
    entries = mapping.where(named(key).isNotNull()).select(
        named(key).alias(column), named(value).alias(output)
    )
    found = profile(entries, [column])
    if found.keys < found.rows and on_repeated == "fail":
        raise ValueError(f"{found.rows} entries for {found.keys} different keys")
    if found.keys < found.rows:
        entries = unique_keys(entries, column, output)
    return join_unique(
        df,
        entries,
        [column],
        "left",
        table_bytes=found.bytes,
        max_broadcast_bytes=max_broadcast_bytes,
    )


def map_values(
    df: DataFrame,
    column: str,
    dictionary: Mapping[object, object],
    output: str,
    value_type: T.DataType | None = None,
) -> DataFrame:
    """Look ``column`` up in a Python dictionary; NULL where it is missing.

    The values have one type (``value_type``, or inferred: whole numbers are ``bigint``),
    whatever the size.  A small dictionary becomes a literal map, a larger one a table, which
    is broadcast only if it is measured to be small.
    """
    value_type = value_type or value_type_of(dictionary.values())
    if len(dictionary) <= MAX_LITERAL_ENTRIES:
        found = translate_values(named(column), dictionary).cast(value_type)
        return df.withColumn(output, found)
    key_type = df.schema[column].dataType
    schema = T.StructType(
        [
            T.StructField(column, key_type, False),
            T.StructField(output, value_type, True),
        ]
    )
    as_type = float if isinstance(value_type, T.DoubleType) else lambda v: v
    entries = [(k, None if v is None else as_type(v)) for k, v in dictionary.items()]
    table = df.sparkSession.createDataFrame(entries, schema)
    return join_unique(df, table, [column])
