"""String functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as removable punctuation, and the report's name separator.
NON_WORD_RUN = r"[^\w\s]+"
NAME_SEPARATOR = " "


def remove_non_word_characters(col: Column) -> Column:
    """Drop everything that is neither a word character nor white space.

    Word characters are ASCII letters, digits and ``_``; NULL stays NULL.
    """
    return F.regexp_replace(col, NON_WORD_RUN, "")


def join_text(*cols: Column, separator: str = NAME_SEPARATOR) -> Column:
    """Join the non-NULL parts; ``''`` if all of them are NULL."""
    return F.concat_ws(separator, *cols)


def upper_equals(col: Column, text: str) -> Column:
    """Case-insensitive equality: both sides are upper-cased."""
    return F.upper(col) == F.upper(F.lit(text))


def split_fields(col: Column, separator: str = ",") -> Column:
    """Split on a literal separator, keeping empty pieces at either end."""
    return F.split(col, literal_pattern(separator), -1)


def literal_pattern(separator: str) -> str:
    """A regular expression that matches ``separator`` literally."""
    return "".join(f"\\{c}" if c in r"\.[]{}()*+-?^$|#&~" else c for c in separator)


def title(col: Column, enabled: bool = True) -> Column:
    """Upper-case the first letter after each space and lower-case the rest.

    ``enabled=False`` returns the text as it is.  For words that also start after
    apostrophes, hyphens and digits use :func:`tablewright.udfs.title_udf`.
    """
    return F.initcap(col) if enabled else col
