"""The one Python function: title case by Python's rules, in Arrow batches."""

from __future__ import annotations

from typing import Any

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def title_udf() -> Any:
    """``title(text, enabled)``: words also start after apostrophes, hyphens and digits.

    NULL text stays NULL; where ``enabled`` is not true the text is returned as it is.
    """

    # Nested, so that it travels to the executors by value.
    def title(text: pd.Series, enabled: pd.Series) -> pd.Series:
        return text.mask(enabled.isin([True]), text.str.title())

    return F.pandas_udf(title, "string")


def register_title(spark: SparkSession, name: str = "title_text") -> Any:
    """Make the function available to SQL."""
    return spark.udf.register(name, title_udf())
