"""Writes that fail half way, are repeated, or happen at once."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tablewright.plans.report import run_report_job
from tablewright.sources import folders as D
from tablewright.sources import published as P
from tablewright.sources import readers as R
from tablewright.sources import scratch
from tablewright.sources import writers as X
from tests.helpers import bag, plan, values


@pytest.fixture
def numbers(spark):
    return spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("part"), F.concat(F.lit("w,"), "id").alias("word"))


def failing(df):
    """Most tasks write their rows, the last one ends the job."""
    late = F.when(F.col("id") == 99, F.raise_error(F.lit("half way")).cast("string")).otherwise(F.col("word"))
    return df.repartition(8, "id").withColumn("word", late)


@pytest.mark.parametrize("write", [X.load_parquet, X.load_csv])
def test_a_failed_overwrite_leaves_the_old_rows(spark, numbers, tmp_path, write):
    path = str(tmp_path / "rows")

    def read():
        return bag(spark.read.schema(numbers.schema).option("header", True).format(write.__name__[5:]).load(path))

    write(numbers, path)
    with pytest.raises(Exception, match="half way"):
        write(failing(numbers), path)
    assert read() == bag(numbers)
    assert os.listdir(tmp_path) == ["rows"]
    write(numbers.where("id < 5"), path)
    assert read() == bag(numbers.where("id < 5"))
    assert os.listdir(tmp_path) == ["rows"]


@pytest.mark.parametrize("output_format", ["csv", "parquet"])
@pytest.mark.parametrize("versioned", [False, True])
def test_a_report_job_that_fails_half_way(spark, tmp_path, output_format, versioned):
    source, target = str(tmp_path / "staff"), str(tmp_path / "report")
    staff = spark.range(50).select("id", F.lit("A").alias("first_name"), F.lit("B").alias("second_name"), F.lit(2).alias("floor"))
    staff.write.parquet(source)

    def report():
        if versioned:
            return P.published(spark, target)
        schema = "id bigint, name string, steps_to_desk int"
        return spark.read.schema(schema).option("header", True).format(output_format).load(target)

    run_report_job(spark, source, target, 21, output_format, versioned)
    before = bag(report())
    # A floor so high that the steps do not fit: only in one of several files.
    broken = staff.withColumn("floor", F.when(F.col("id") == 49, 2_000_000_000).otherwise(2)).repartition(5, "id")
    broken.write.mode("overwrite").parquet(source)
    with pytest.raises(Exception, match="OVERFLOW"):
        run_report_job(spark, source, target, 21, output_format, versioned)
    assert bag(report()) == before and len(before) == 50
    staff.where("id < 3").write.mode("overwrite").parquet(source)
    run_report_job(spark, source, target, 21, output_format, versioned)
    assert report().count() == 3


def test_a_dataset_can_be_made_from_itself(spark, numbers, tmp_path):
    path = str(tmp_path / "rows")
    X.load_parquet(numbers, path)
    for left in (50, 25):
        X.load_parquet(R.extract(spark, path).where(f"id < {left}"), path)
        assert sorted(values(R.extract(spark, path), "id")) == list(range(left))


def test_what_died_between_the_renames_comes_back(spark, numbers, tmp_path):
    path = str(tmp_path / "rows")
    X.load_parquet(numbers, path)
    os.rename(path, tmp_path / ".rows.replaced-0123")
    (tmp_path / ".rows.staged-0123").mkdir()
    assert D.restore(spark, path) and not D.restore(spark, path)
    assert bag(R.extract(spark, path)) == bag(numbers)
    os.rename(path, tmp_path / ".rows.replaced-0123")
    with pytest.raises(Exception, match="half way"):
        X.load_parquet(failing(numbers), path)
    assert bag(R.extract(spark, path)) == bag(numbers)


def test_versions(spark, numbers, tmp_path):
    path = str(tmp_path / "rows")
    with pytest.raises(FileNotFoundError, match="no committed version"):
        P.published(spark, path)
    first = P.publish(numbers, path)
    assert (first.number, first.rows, first.format) == (1, 100, "parquet")
    held = P.published(spark, path)
    second = P.publish(held.where("id < 10"), path, "csv", rebalance=True)
    assert (second.number, second.rows) == (2, 10)
    third = P.publish(held, path, partition_by=["part"])
    assert P.versions(spark, path) == [first, second, third]
    # A reader keeps the version it took.
    assert bag(held) == bag(numbers) == bag(P.published(spark, path))
    assert P.published(spark, path).columns == numbers.columns
    assert bag(P.published(spark, path, 2)) == bag(numbers.where("id < 10"))
    assert "PartitionFilters: [isnotnull(part" in plan(P.published(spark, path).where("part = 1"))
    with pytest.raises(FileNotFoundError, match="version 7"):
        P.published(spark, path, 7)
    for bad in ({"format": "orc"}, {"format": "csv", "partition_by": ["part"]}):
        with pytest.raises(ValueError):
            P.publish(numbers, path, **bad)


def test_a_failed_version_is_not_seen_and_goes(spark, numbers, tmp_path):
    path = str(tmp_path / "rows")
    P.publish(numbers, path)
    with pytest.raises(Exception, match="half way"):
        P.publish(failing(numbers), path)
    assert [v.number for v in P.versions(spark, path)] == [1]
    assert bag(P.published(spark, path)) == bag(numbers)
    P.publish(numbers.limit(0), path)
    assert P.published(spark, path).count() == 0
    (tmp_path / "rows" / "_version-left").mkdir()
    assert P.forget(spark, path, keep=2) == []  # it may be someone's who is still writing
    gone = P.forget(spark, path, keep=1, abandoned_hours=-1)
    assert "_version-left" in gone and len(gone) in (2, 3)
    assert [v.number for v in P.versions(spark, path)] == [2]
    assert P.published(spark, path).count() == 0
    with pytest.raises(ValueError, match="last version"):
        P.forget(spark, path, keep=0)


def test_versions_committed_at_once(spark, numbers, tmp_path):
    path = str(tmp_path / "rows")
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda k: P.publish(numbers.where(f"part = {k}"), path), range(4)))
    assert sorted(v.number for v in made) == [1, 2, 3, 4]
    for k, version in enumerate(made):
        assert set(values(P.published(spark, path, version.number), "part")) == {k}


def test_null_and_awkward_text_in_versions(spark, tmp_path):
    rows = [(1, ""), (2, None), (3, 'a"b,c'), (4, "two\nlines")]
    path = str(tmp_path / "rows")
    P.publish(R.from_rows(spark, rows, "id bigint, `t x` string"), path, "csv", null_text=r"\N", multi_line=True)
    assert sorted(P.published(spark, path).collect()) == rows


def test_overwriting_single_partitions(spark, numbers, tmp_path):
    path = str(tmp_path / "rows")
    X.load_partitioned(numbers, path, "part")
    kept = {f for f in os.listdir(tmp_path / "rows" / "part=3")}
    new = numbers.where("part = 1 and id < 9").withColumn("word", F.lit("new"))
    with pytest.raises(X.PartitionsLost, match="part.*0"):
        X.load_partitioned(new, path, "part", mode="overwrite")
    assert bag(R.extract(spark, path).select(numbers.columns)) == bag(numbers)
    X.load_partitioned(new, path, "part", mode="overwrite_partitions")
    assert bag(R.extract(spark, path).select(numbers.columns)) == bag(numbers.where("part <> 1").unionByName(new))
    assert set(os.listdir(tmp_path / "rows" / "part=3")) == kept
    with pytest.raises(Exception, match="half way"):
        X.load_partitioned(failing(numbers.withColumn("part", F.lit(3))), path, "part", mode="overwrite_partitions")
    assert set(os.listdir(tmp_path / "rows" / "part=3")) == kept
    X.load_partitioned(numbers, path, "part", mode="overwrite")
    assert R.extract(spark, path).count() == 100
    X.load_partitioned(new, path, "part", mode="overwrite_all")
    assert bag(R.extract(spark, path).select(numbers.columns)) == bag(new)
    for bad in ({"mode": "merge"}, {}):
        with pytest.raises(ValueError):
            X.load_partitioned(numbers, path, *(["part"] if bad else []), **bad)


def test_null_partitions_are_told_apart(spark, tmp_path):
    path = str(tmp_path / "rows")
    both = R.from_rows(spark, [(1, "a"), (2, None)], "n int, p string")
    X.load_partitioned(both, path, "p")
    with pytest.raises(X.PartitionsLost, match="None"):
        X.load_partitioned(both.where("n = 1"), path, "p", mode="overwrite")
    X.load_partitioned(both, path, "p", mode="overwrite")
    X.load_partitioned(both.where("n = 2").withColumn("n", F.lit(5)), path, "p", mode="overwrite_partitions")
    assert sorted(values(R.extract(spark, path), "n")) == [1, 5]


def test_partitions_are_compared_by_their_names_alone(spark, numbers, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    X.load_partitioned(numbers, path, "part")
    shown = plan(spark.read.schema(numbers.schema).parquet(path).select("part").distinct())
    assert "ReadSchema: struct<>" in shown


def test_scratch_is_removed_at_the_end(spark, numbers, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_folder", lambda spark: str(tmp_path))
    aside = scratch.set_aside(numbers)
    assert aside.count() == 100 and os.listdir(tmp_path / "scratch") == [spark.sparkContext.applicationId]
    scratch.remove_scratch(spark)
    assert os.listdir(tmp_path / "scratch") == []
