"""The report job: extract, transform, load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.operators.projections import steps_report
from tablewright.sources.published import publish
from tablewright.sources.readers import extract
from tablewright.sources.writers import load_csv, load_parquet

OUTPUT_FORMATS = ("csv", "parquet")


def run_report_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    steps_per_floor: int,
    output_format: str = "csv",
    versioned: bool = False,
    **columns: str,
) -> None:
    """Read people from Parquet and write the steps report; safe to repeat.

    The report replaces the one before when it is complete, and not at all if the job fails.
    ``versioned`` commits it as a new version for :func:`tablewright.sources.published.published`
    instead: readers are then never between two versions, on any store.  ``columns`` maps the report's inputs (``id``, ``first``, ``second``, ``floor``) to the
    columns that hold them.
    """
    if output_format not in OUTPUT_FORMATS:
        raise ValueError(f"output format must be one of {list(OUTPUT_FORMATS)}, not {output_format!r}")
    report = steps_report(extract(spark, input_path), steps_per_floor, **columns)
    if versioned:
        publish(report, output_path, output_format)
    elif output_format == "csv":
        load_csv(report, output_path)
    else:
        load_parquet(report, output_path)


def materialize_pair(
    df: DataFrame,
    input_path: str,
    report_path: str,
    steps_per_floor: int,
    **columns: str,
) -> None:
    """Write an input dataset and the report derived from it.

    The report is derived from the dataset as written, so that the pair agrees even where
    ``df`` itself would not come out the same twice, and is not computed twice.
    """
    load_parquet(df, input_path)
    written = extract(df.sparkSession, input_path)
    load_parquet(steps_report(written, steps_per_floor, **columns), report_path)
