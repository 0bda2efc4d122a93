"""Map functions."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A literal map is searched entry by entry for every row; beyond this a join is cheaper.
MAX_LITERAL_ENTRIES = 64
PLAIN_TYPES = {
    str: T.StringType(),
    bytes: T.BinaryType(),
    datetime.date: T.DateType(),
    datetime.datetime: T.TimestampType(),
}


def map_value(map_col: Column, key: object) -> Column:
    """The entry's value; NULL where the key is missing."""
    return map_col.getItem(key)


def map_values_as(map_col: Column, keys: Sequence[str]) -> list[Column]:
    """One column per key, named after it."""
    return [map_value(map_col, k).alias(k) for k in keys]


def nested_value(col: Column, *path: str) -> Column:
    """Walk struct fields and map keys; NULL once a branch is absent."""
    for step in path:
        col = col.getItem(step)
    return col


def value_type_of(values: Iterable[object]) -> T.DataType:
    """One type for all values of a dictionary, whatever their number."""
    kinds = {type(v) for v in values if v is not None}
    if kinds <= {bool}:
        return T.BooleanType() if kinds else T.StringType()
    if kinds <= {int}:
        return T.LongType()
    if kinds <= {int, float}:
        return T.DoubleType()
    if len(kinds) == 1 and (plain := PLAIN_TYPES.get(kinds.pop())):
        return plain
    raise TypeError("the values have no single plain type: pass value_type")


def translate_values(col: Column, dictionary: Mapping[object, object]) -> Column:
    """Look each value up in a small dictionary; NULL where it is missing."""
    if len(dictionary) > MAX_LITERAL_ENTRIES:
        raise ValueError(
            f"{len(dictionary)} entries are too many for a literal map "
            f"(at most {MAX_LITERAL_ENTRIES}); use operators.lookups.map_values"
        )
    if not dictionary:
        return F.lit(None).cast("string")
    literals = F.create_map(*(F.lit(x) for x in chain.from_iterable(dictionary.items())))
    return literals[col]
