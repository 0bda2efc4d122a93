"""Top-k, ranks and samples of an exact size."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.chance import HASH_RANGE, hash_text
from tablewright.operators.lookups import BROADCAST_BYTES, join_unique
from tablewright.operators.names import named
from tablewright.sources.scratch import set_aside

# Up to this many rows a sample is one bounded sort per task and one merge.
MERGED_SAMPLE_ROWS = 10_000
# Into how many parts of about equal size a large sample is counted.
PREFIXES = 1 << 16
DIGEST = "__digest"


def rank_top_k(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    k: int,
    descending: bool = True,
    output: str = "rank",
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of rank 1 to ``k`` within their group, or of all rows (no ``by``), ties included.

    A tie may hold any number of rows, so ranked rows are never gathered by group.  Only
    ``k`` values per group are: each task keeps its ``k`` best, the ranks follow from the
    ``k`` best of all, and the rows are then found by joining their values with the ranks.
    """
    best = set_aside(best_ranks(df, by, order, k, descending, output))
    return join_unique(
        df, best, [*by, order], "inner", null_safe=True, max_broadcast_bytes=max_broadcast_bytes
    )


def best_ranks(
    df: DataFrame, by: Sequence[str], order: str, k: int, descending: bool, output: str
) -> DataFrame:
    """The different values of rank 1 to ``k`` in each group: at most ``k`` rows per group."""
    direction = named(order).desc() if descending else named(order).asc()
    window = Window.partitionBy(*(named(c) for c in by)).orderBy(direction)
    values = df.select(*(named(c) for c in by), named(order))
    if by:
        best = values.withColumn("__n", F.row_number().over(window)).where(F.col("__n") <= k)
    else:
        best = values.orderBy(direction).limit(k)
    return (
        best.withColumn(output, F.rank().over(window))
        .groupBy(*(named(c) for c in by), named(order))
        .agg(F.min(output).alias(output))
    )


def sample_top_k(
    df: DataFrame, k: int, keys: Sequence[str] = (), seed: int | None = None
) -> DataFrame:
    """``k`` random rows in no particular order; with a seed and a unique key always the same.

    Without a seed one is drawn, once; without keys rows are told apart by all their columns.
    """
    if seed is None:
        return sample_without_replacement(df, k, keys or df.columns, random.randrange(1 << 62))
    if not keys:
        raise ValueError("a seeded sample needs the columns of a unique key")
    return sample_without_replacement(df, k, keys, seed)


def _with_digest(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    # A column of its own: as a sort expression it would be worked out at every comparison.
    return df.withColumn(DIGEST, hash_text(seed, [named(c) for c in keys]))


def _least(hashed: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    return hashed.orderBy(DIGEST, *(named(c) for c in keys)).limit(k)


def sample_without_replacement(
    df: DataFrame, k: int, keys: Sequence[str], seed: int, merged_rows: int = MERGED_SAMPLE_ROWS
) -> DataFrame:
    """Exactly ``k`` different rows (all, if there are fewer) for any ``k``, in no particular order.

    The sample is the rows with the least hashes.  A small one is a top-k.  A large one
    would be merged in a single task by that; instead the rows below a hash that is just
    high enough are set aside in the shared folder, and cut down to ``k`` by
    :func:`_cut`.  Hashes of different keys being uniform, that hash follows from the number of
    rows: one pass, without hashing, counts them, and one more sets the rows aside.  If many
    copies of a key make them too few, it is repeated with a higher hash.
    """
    hashed = _with_digest(df, keys, seed)
    if k <= merged_rows:
        return _least(hashed, keys, k).drop(DIGEST)
    total = df.count()
    wanted = k + 6 * math.sqrt(k) + 100
    while wanted < total:
        below = f"{int(wanted / total * HASH_RANGE):08x}"
        candidates = set_aside(hashed.where(F.col(DIGEST) < F.lit(below)))
        if candidates.count() >= k:
            return _cut(candidates, k, keys, total).drop(DIGEST)
        wanted *= 4
    return _cut(set_aside(hashed), k, keys, total).drop(DIGEST) if k < total else df


def _cut(hashed: DataFrame, k: int, keys: Sequence[str], total: int) -> DataFrame:
    """The ``k`` rows with the least hashes, by counting rows per hash prefix.

    The prefix that reaches ``k`` is found, the rows below it are kept by a filter, and only
    the few rows of that one prefix are ordered.
    """
    digits = math.ceil(math.log(PREFIXES * max(total / k, 1), 16)) if k else 1
    prefix = F.substring(DIGEST, 1, digits)
    # About PREFIXES rows, whatever the size of the data: few enough for one task.
    running = F.sum("n").over(Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
    reached = (
        hashed.groupBy(prefix.alias("prefix"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("prefix", "n", running.alias("total"))
        .where(F.col("total") >= k)
        .orderBy("prefix")
        .first()
    )
    if reached is None:
        return hashed
    edge = hashed.where(prefix == reached["prefix"])
    missing = k - (reached["total"] - reached["n"])
    return hashed.where(prefix < reached["prefix"]).unionByName(_least(edge, keys, missing))
