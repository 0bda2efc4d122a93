"""Random numbers.

The seeded forms hash a row key, so that a row gets the same number however the data
is partitioned, on every retry of a task and in every run.  ``F.rand(seed)`` promises
none of these; the unseeded forms use it because they promise nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32


def hash_text(seed: int, keys: Sequence[Column]) -> Column:
    """md5 hex digest of ``seed-key1-key2...``; a NULL key counts as ``''``."""
    parts = [F.coalesce(k.cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *parts))


def hash_number(seed: int, keys: Sequence[Column]) -> Column:
    """A bigint in ``[0, 2**32)`` drawn from the row key."""
    return F.conv(F.substring(hash_text(seed, keys), 1, 8), 16, 10).cast("bigint")


def seeded_uniform(seed: int, *keys: Column) -> Column:
    """A double in ``[0, 1)`` drawn from the row key."""
    return hash_number(seed, keys) / F.lit(float(HASH_RANGE))


def random_uniform(seed: int | None = None) -> Column:
    """Spark's own generator; depends on the partitioning even when seeded."""
    return F.rand(seed)
