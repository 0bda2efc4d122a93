"""Comparing columns and DataFrames: the rows that differ, as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_FLOOR, Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.lookups import join_unique
from tablewright.operators.names import named
from tablewright.sources.scratch import set_aside


class SchemaMismatch(ValueError):
    """The two sides do not have the same columns; says which ones."""


def equal(a: Column, b: Column) -> Column:
    """Equality in which NULL equals NULL; never NULL itself."""
    return a.eqNullSafe(b)


EXACT_TYPES = (T.IntegralType, T.DecimalType)


def _scale(kind: T.DataType) -> int:
    return kind.scale if isinstance(kind, T.DecimalType) else 0


def about_equal(
    a: Column,
    b: Column,
    precision: float,
    kinds: tuple[T.DataType, T.DataType] | None = None,
    relative: float = 0.0,
) -> Column:
    """Numbers at most ``precision`` (or that share of the larger) apart; NULL only equals NULL.

    Whole numbers and decimals (``kinds``, the types of both sides) are compared exactly;
    otherwise as doubles, where NaN only equals NaN.  A difference too large for a decimal is
    a difference.
    """
    if kinds is not None and all(isinstance(k, EXACT_TYPES) for k in kinds):
        scale = max(map(_scale, kinds))
        x, y = (c.try_cast(T.DecimalType(38, scale)) for c in (a, b))
        apart = F.abs(F.try_subtract(x, y))
        # Differences have so many digits after the point and no more: neither needs the limit.
        limit = F.lit(Decimal(repr(float(precision))).quantize(Decimal(1).scaleb(-scale), ROUND_FLOOR))
    else:
        x, y = a.cast("double"), b.cast("double")
        apart, limit = F.abs(x - y), F.lit(float(precision))
    if relative:
        limit = F.greatest(limit.cast("double"), F.lit(relative) * F.greatest(F.abs(x), F.abs(y)).cast("double"))
    return equal(a, b) | F.coalesce(apart <= limit, F.lit(False))


def column_mismatches(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows in which two columns differ."""
    return df.where(~equal(named(a), named(b)))


def column_mismatches_approx(df: DataFrame, a: str, b: str, precision: float) -> DataFrame:
    """Rows in which two numeric columns are more than ``precision`` apart."""
    kinds = (df.schema[a].dataType, df.schema[b].dataType)
    return df.where(~about_equal(named(a), named(b), precision, kinds))


def schema_differences(left: DataFrame, right: DataFrame) -> list[str]:
    """One line per missing, additional or differently typed column; order is ignored."""
    mine = {f.name: f.dataType for f in left.schema}
    other = {f.name: f.dataType for f in right.schema}
    return [
        *(f"column {c!r} is only on the left" for c in mine if c not in other),
        *(f"column {c!r} is only on the right" for c in other if c not in mine),
        *(
            f"column {c!r} is {t.simpleString()} on the left, {other[c].simpleString()} on the right"
            for c, t in mine.items()
            if c in other and t != other[c]
        ),
    ]


def require_same_schema(left: DataFrame, right: DataFrame) -> None:
    differences = schema_differences(left, right)
    if differences:
        raise SchemaMismatch("; ".join(differences))


def dataframe_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Multiset difference: each surplus row once, with its side and number of copies.

    Both sides are counted in a single aggregate, so copies are added up before the one
    shuffle and a row with very many copies is no hot spot.
    """
    require_same_schema(left, right)
    columns = left.columns
    both = left.select(*(named(c) for c in columns), F.lit(1).alias("__copies")).unionByName(
        right.select(*(named(c) for c in columns), F.lit(-1).alias("__copies"))
    )
    surplus = both.groupBy(*(named(c) for c in columns)).agg(F.sum("__copies").alias("__surplus"))
    return surplus.where(F.col("__surplus") != 0).select(
        *(named(c) for c in columns),
        F.when(F.col("__surplus") > 0, "left").otherwise("right").alias("side"),
        F.abs("__surplus").alias("copies"),
    )


def dataframe_diff_approx(
    left: DataFrame, right: DataFrame, key: Sequence[str], precision: float
) -> DataFrame:
    """Keyed difference with a tolerance for numbers.

    One row per key that differs: ``kind`` is ``left_only``, ``right_only`` or ``changed``,
    ``columns`` the names of changed columns, ``left`` and ``right`` the values.  Rows of a key
    that is not unique on a side cannot be paired; they are compared as a multiset, and each
    row of which one side has more copies is a row of kind ``repeated_key``, under the side
    that has more, with the copies in ``left_rows`` and ``right_rows``.  NULL keys are equal.

    A first pass over fixed-width rows finds the keys with any difference, and only their rows
    are shuffled.  Per key it adds up, before the shuffle, counts, a 64-bit hash of what has to
    be the same, and the difference of every number that may be a little off: where each side
    has one row, that is their difference, and values that have moved
    by less than ``precision`` are done with.
    """
    require_same_schema(left, right)
    values = [f for f in left.schema if f.name not in key]
    keys = [f"__by_{i}" for i in range(len(key))]
    sides = (("left", left), ("right", right))

    def of(side: str) -> Column:
        return F.col("__side") == side

    def tagged(*more: Column) -> DataFrame:
        parts = [
            df.select(*(named(c).alias(k) for c, k in zip(key, keys)), F.lit(side).alias("__side"), *more)
            for side, df in sides
        ]
        return reduce(DataFrame.unionByName, parts)

    counts = [F.count_if(of(side)).alias(f"{side}_rows") for side, _ in sides]
    near = {f"__near_{i}": f for i, f in enumerate(values) if _may_be_off(f, precision)}
    exact = [named(f.name) for f in values if f not in near.values()]
    marks = [_mark(f) for f in near.values()]
    hashed = tagged(
        F.xxhash64(F.lit(0), *exact, *marks).alias("__hash"), *(_number(f).alias(n) for n, f in near.items())
    )

    def apart(name: str) -> Column:
        if isinstance(near[name].dataType, EXACT_TYPES):
            # The longest decimals have no negative of their length.
            left, right = (F.max(F.when(of(side), F.col(name))) for side, _ in sides)
            return F.abs(F.try_subtract(left, right))
        return F.abs(F.sum(F.when(of("left"), F.col(name)).otherwise(-F.col(name))))

    profiles = hashed.groupBy(*keys).agg(
        *counts,
        F.min("__hash").alias("__low"),
        F.max("__hash").alias("__high"),
        *(apart(n).alias(n) for n in near),
    )
    alike = reduce(
        lambda a, b: a & b,
        # A difference that cannot be told is one.
        (F.coalesce(F.col(n) <= _limit(f, precision), F.lit(False)) for n, f in near.items()),
        (F.col("left_rows") == 1) & (F.col("right_rows") == 1) & (F.col("__low") == F.col("__high")),
    )
    differing = set_aside(profiles.where(~alike).select(*keys, "left_rows", "right_rows"))
    single = (F.col("left_rows") <= 1) & (F.col("right_rows") <= 1)
    rows = tagged(F.struct(*(named(f.name) for f in values)).alias("__row"))
    rows = join_unique(rows, differing, keys, "inner", null_safe=True)

    pairs = (
        rows.where(single)
        .groupBy(*keys, "left_rows", "right_rows")
        .agg(
            F.max(F.when(of("left"), F.col("__row"))).alias("left"),
            F.max(F.when(of("right"), F.col("__row"))).alias("right"),
        )
    )
    changed = F.array_compact(
        F.array(*(F.when(~_field_equal(f, precision), F.lit(f.name)) for f in values)).cast("array<string>")
    )
    kind = (
        F.when(F.col("right_rows") == 0, "left_only")
        .when(F.col("left_rows") == 0, "right_only")
        .when(F.size(changed) > 0, "changed")
    )
    paired = pairs.withColumn("kind", kind).where(F.col("kind").isNotNull())

    copies = rows.where(~single).drop("left_rows", "right_rows").groupBy(*keys, "__row").agg(*counts)
    more = F.col("left_rows") > F.col("right_rows")
    repeated = copies.where(F.col("left_rows") != F.col("right_rows")).select(
        *keys,
        F.lit("repeated_key").alias("kind"),
        "left_rows",
        "right_rows",
        F.lit(None).cast("array<string>").alias("columns"),
        F.when(more, F.col("__row")).alias("left"),
        F.when(~more, F.col("__row")).alias("right"),
    )
    found = paired.select(
        *keys,
        "kind",
        "left_rows",
        "right_rows",
        F.when(F.col("kind") == "changed", changed).alias("columns"),
        "left",
        "right",
    ).unionByName(repeated)
    return found.withColumnsRenamed(dict(zip(keys, key)))


def _limit(field: T.StructField, precision: float) -> Column:
    """The greatest difference that is none, as :func:`about_equal` has it."""
    if isinstance(field.dataType, EXACT_TYPES):
        unit = Decimal(1).scaleb(-_scale(field.dataType))
        return F.lit(Decimal(repr(float(precision))).quantize(unit, ROUND_FLOOR))
    return F.lit(float(precision))


def _may_be_off(field: T.StructField, precision: float) -> bool:
    """Whether two different values of the field can be within the tolerance."""
    if isinstance(field.dataType, EXACT_TYPES):
        return Decimal(repr(float(precision))) >= Decimal(1).scaleb(-_scale(field.dataType))
    return isinstance(field.dataType, T.NumericType)


def _number(field: T.StructField) -> Column:
    """The value as a number to subtract; 0 for what :func:`_mark` tells apart."""
    if isinstance(field.dataType, EXACT_TYPES):
        kind = T.DecimalType(38, _scale(field.dataType))
        return F.coalesce(named(field.name).try_cast(kind), F.lit(0).cast(kind))
    number = named(field.name).cast("double")
    return F.when(F.abs(number) < float("inf"), number).otherwise(0.0)


def _mark(field: T.StructField) -> Column:
    """NULL, NaN and infinities, which are equal to themselves alone, and numbers too long for a decimal."""
    value = named(field.name)
    if isinstance(field.dataType, EXACT_TYPES):
        return F.when(value.try_cast(T.DecimalType(38, _scale(field.dataType))).isNull(), F.coalesce(value.cast("string"), F.lit("")))
    number = value.cast("double")
    return F.when(F.abs(number) < float("inf"), "number").otherwise(F.coalesce(number.cast("string"), F.lit("")))


def _field_equal(field: T.StructField, precision: float) -> Column:
    a, b = F.col("left").getField(field.name), F.col("right").getField(field.name)
    if isinstance(field.dataType, T.NumericType):
        return about_equal(a, b, precision, (field.dataType, field.dataType))
    return equal(a, b)


def reconcile(
    expected: DataFrame,
    actual: DataFrame,
    measure: str,
    precision: float = 1e-6,
    relative: float = 1e-9,
) -> DataFrame:
    """One row that compares column count, row count and mean of a measure.

    Whole numbers and decimals agree if their sums are the same.  Sums of doubles depend on
    how the rows are partitioned: their means agree if they are ``relative`` of the larger
    apart at most, or ``precision`` if that is more.
    """
    kinds = tuple(df.schema[measure].dataType for df in (expected, actual))
    exact = all(isinstance(k, EXACT_TYPES) for k in kinds)
    both = expected.select(F.lit(True).alias("__expected"), named(measure).alias("__x")).unionByName(
        actual.select(F.lit(False).alias("__expected"), named(measure).alias("__x"))
    )
    wanted = F.col("__expected")
    scale = max((k.scale for k in kinds if isinstance(k, T.DecimalType)), default=0)
    total = F.col("__x").cast(T.DecimalType(38, scale)) if exact else F.col("__x").cast("double")
    summary = both.agg(
        F.count_if(wanted).alias("expected_rows"),
        F.count_if(~wanted).alias("actual_rows"),
        F.avg(F.when(wanted, F.col("__x"))).alias("expected_mean"),
        F.avg(F.when(~wanted, F.col("__x"))).alias("actual_mean"),
        F.try_sum(F.when(wanted, total)).alias("__expected_sum"),
        F.try_sum(F.when(~wanted, total)).alias("__actual_sum"),
    )
    if exact:
        same = equal(F.col("__expected_sum"), F.col("__actual_sum"))
    else:
        same = about_equal(F.col("expected_mean"), F.col("actual_mean"), precision, relative=relative)
    return summary.select(
        F.lit(len(expected.columns)).alias("expected_columns"),
        F.lit(len(actual.columns)).alias("actual_columns"),
        "expected_rows",
        "actual_rows",
        "expected_mean",
        "actual_mean",
        (
            F.lit(len(expected.columns) == len(actual.columns))
            & (F.col("expected_rows") == F.col("actual_rows"))
            & same
        ).alias("agrees"),
    )
