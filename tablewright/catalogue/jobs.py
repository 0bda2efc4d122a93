"""Whole jobs, by what they leave in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.catalogue.projecting import CUSTOMER_COLUMNS, STEPS_PER_FLOOR
from tablewright.catalogue.registry import query, table, table_path
from tablewright.plans.report import materialize_pair, run_report_job
from tablewright.sources.published import published
from tablewright.sources.readers import extract
from tablewright.sources.scratch import scratch_path

REPORT_SQL = """
    SELECT c_custkey AS id, concat_ws(' ', c_name, c_mktsegment) AS name,
           c_nationkey * 21 AS steps_to_desk
    FROM customer
    """


@query("job_steps_report", REPORT_SQL)
def steps_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "steps-report")
    # Run again, as after a failure: readers get one report, the last that was committed.
    for _ in range(2):
        run_report_job(
            spark, table_path(sf_dir, "customer"), path, STEPS_PER_FLOOR, versioned=True, **CUSTOMER_COLUMNS
        )
    return published(spark, path)


@query("job_materialize_pair", REPORT_SQL)
def pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "pair")
    materialize_pair(
        table(spark, sf_dir, "customer"),
        f"{folder}/input",
        f"{folder}/report",
        STEPS_PER_FLOOR,
        **CUSTOMER_COLUMNS,
    )
    return extract(spark, f"{folder}/report")
