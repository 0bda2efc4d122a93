"""NULL-safe arithmetic and element-wise casts under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER_TYPES = ("tinyint", "smallint", "int", "bigint")
WHOLE_NUMBER = r"^[\s\p{Cntrl}]*[+-]?\d+[\s\p{Cntrl}]*$"


def multiply(col: Column, factor: int | float) -> Column:
    return col * F.lit(factor)


def divide(col: Column, divisor: Column | int | float) -> Column:
    """Fractional division; NULL where either side is NULL or the divisor is zero."""
    by = divisor if isinstance(divisor, Column) else F.lit(divisor)
    return F.try_divide(col.cast("double"), by.cast("double"))


def divide_by_three(col: Column) -> Column:
    return divide(col, 3)


def divide_by_zero(col: Column) -> Column:
    """Always NULL: plain ``/`` would raise ``DIVIDE_BY_ZERO`` under ANSI mode."""
    return divide(col, 0)


def cast_array(col: Column, element_type: str = "int") -> Column:
    """Cast an array; an element that cannot be cast becomes NULL, a NULL array stays NULL."""
    if element_type in INTEGER_TYPES:
        # A cast that fails is many times as slow as one that succeeds, so text that cannot
        # be a whole number does not get that far.  Elements of other types are cast as they are.
        col = F.transform(
            col,
            lambda x: F.when((F.typeof(x) != "string") | x.cast("string").rlike(WHOLE_NUMBER), x),
        )
    return col.try_cast(f"array<{element_type}>")


def flag_at_least(col: Column, threshold: int | float = 1) -> Column:
    """1 where ``col >= threshold``, else 0 (also 0 for NULL)."""
    return F.when(col >= F.lit(threshold), 1).otherwise(0)
