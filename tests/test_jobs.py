from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablewright.operators import compare as V
from tablewright.plans.report import materialize_pair, run_report_job
from tests.helpers import bag

@pytest.fixture
def staff(spark):
    n = F.col("id")
    return spark.range(1, 31).select(
        "id",
        F.concat(F.lit("F"), n).alias("first_name"),
        F.concat(F.lit("S"), n * 7).alias("second_name"),
        (n % 6).alias("floor"),
    )


REPORT = Counter((n, f"F{n} S{n * 7}", n % 6 * 21) for n in range(1, 31))


@pytest.mark.parametrize("output_format", ["csv", "parquet"])
def test_report_job_can_be_repeated(spark, staff, tmp_path, output_format):
    source, target = str(tmp_path / "staff"), str(tmp_path / "report")
    staff.write.parquet(source)
    for _ in range(2):
        run_report_job(spark, source, target, 21, output_format)
        reader = spark.read.schema("id bigint, name string, steps_to_desk bigint").option("header", True)
        assert bag(reader.format(output_format).load(target)) == REPORT


def test_report_job_rejects_another_format(spark):
    with pytest.raises(ValueError, match="csv.*parquet.*'xml'"):
        run_report_job(spark, "in", "out", 21, "xml")


def test_materialized_pair_reconciles(spark, staff, tmp_path):
    source, target = str(tmp_path / "staff"), str(tmp_path / "report")
    materialize_pair(staff, source, target, 21)
    report = spark.read.parquet(target)
    assert bag(spark.read.parquet(source)) == bag(staff)
    assert bag(report) == REPORT
    again = str(tmp_path / "again")
    run_report_job(spark, source, again, 21, "parquet")
    summary = V.reconcile(report, spark.read.parquet(again), "steps_to_desk").first()
    assert summary.agrees and summary.expected_mean == 52.5
    assert V.dataframe_diff(report, spark.read.parquet(again)).count() == 0
