import os
from collections import Counter

import pytest
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import functions as F

from tablewright.operators.words import words_of
from tablewright.sources import readers as R
from tablewright.sources import scratch
from tablewright.sources import writers as X
from tests.helpers import bag, plan, values

SCHEMA = "n bigint, word string, kind string, size int"


@pytest.fixture
def things(spark):
    """Sixty rows of three kinds and five sizes; every ninth word is missing."""
    n = F.col("id")
    return spark.range(60).select(
        n.alias("n"),
        F.when(n % 9 != 0, F.concat(F.lit("w"), n)).alias("word"),
        F.concat(F.lit("k"), n % 3).alias("kind"),
        (n % 5 * 100).cast("int").alias("size"),
    )


def chosen(condition):
    return [n for n in range(60) if condition(n)]


def files(path, suffix):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(suffix)]


def test_rows_of_every_kind(spark):
    wanted = [(n, None if n % 2 else str(n)) for n in range(5)]
    dicts = [{"id": n} if t is None else {"id": n, "t": t} for n, t in wanted]
    for rows in (wanted, [list(r) for r in wanted], dicts):
        assert R.from_rows(spark, rows, "id bigint, t string").collect() == wanted
    assert R.from_rows(spark, [], "id bigint, t string").columns == ["id", "t"]


def test_parquet_overwrites_or_refuses(things, spark, tmp_path):
    path = str(tmp_path / "things")
    X.load_parquet(things, path)
    X.load_parquet(things.where("size > 0"), path)
    assert R.extract(spark, path).count() == 48
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        X.load_parquet(things, path, mode="error")


def test_view_and_predicate_push_down(things, spark, tmp_path):
    path = str(tmp_path / "things")
    X.load_parquet(things, path)
    spark.range(1).createOrReplaceTempView("v")
    large = R.sql_over(R.extract(spark, path), "v", "SELECT * FROM {v} WHERE size >= 300")
    assert sorted(values(large, "n")) == chosen(lambda n: n % 5 >= 3)
    assert "GreaterThanOrEqual(size,300)" in plan(large)
    # A view of the caller's stays as it was.
    assert spark.table("v").columns == ["id"]
    spark.catalog.dropTempView("v")


def test_partitions_are_pruned_and_keep_their_columns(things, spark, tmp_path):
    path = str(tmp_path / "things")
    X.load_partitioned(things, path, "kind", "size")
    whole = R.extract(spark, path)
    assert dict(whole.dtypes) | {"size": "int", "kind": "string"} == dict(whole.dtypes)
    assert bag(whole.select(things.columns)) == bag(things)
    few = R.sql_over(whole, "parts", "SELECT n FROM {parts} WHERE kind = 'k1' AND size >= 300")
    assert sorted(values(few)) == chosen(lambda n: n % 3 == 1 and n % 5 >= 3)
    shown = plan(few)
    assert "(size" in shown.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<n:bigint>" in shown
    kind = R.read_partition(spark, path, kind="k2")
    assert sorted(values(kind, "n")) == chosen(lambda n: n % 3 == 2)
    assert sorted(values(R.read_partition(spark, path, kind="k0", size=400), "n")) == chosen(
        lambda n: n % 3 == 0 and n % 5 == 4
    )
    assert "kind" in plan(kind).split("PartitionFilters: [")[1].split("]")[0]


def test_null_partition(spark, tmp_path):
    path = str(tmp_path / "parts")
    X.load_partitioned(R.from_rows(spark, [(1, "a"), (2, None)], "n int, p string"), path, "p")
    assert values(R.read_partition(spark, path, p=None), "n") == [2]


def test_rebalancing_gives_few_files(spark, tmp_path):
    df = spark.range(0, 8000, 1, 16).withColumn("p", F.col("id") % 2)
    plain, even = str(tmp_path / "plain"), str(tmp_path / "even")
    X.load_partitioned(df, plain, "p", rebalance=False)
    X.load_partitioned(df, even, "p")
    assert len(files(plain, ".parquet")) == 32
    assert len(files(even, ".parquet")) <= 4
    assert bag(spark.read.parquet(even).select("id")) == bag(df.select("id"))


def test_csv_round_trip_keeps_awkward_text(spark, tmp_path):
    rows = [(1, ""), (2, None), (3, 'a"b,c'), (4, "x\\y"), (5, " padded "), (6, "two\nlines"), (7, '"')]
    df = R.from_rows(spark, rows, "id bigint, t string")
    path = str(tmp_path / "csv")
    X.load_csv(df, path, null_text=r"\N")
    read = R.read_csv(spark, path, "id bigint, t string", null_text=r"\N", multi_line=True)
    assert sorted(read.collect()) == sorted(rows)


def test_csv_has_a_header_and_is_overwritten(things, spark, tmp_path):
    path = tmp_path / "csv"
    for _ in range(2):
        X.load_csv(things, str(path), max_rows_per_file=7)
    parts = [(path / f).read_text().splitlines() for f in files(path, ".csv")]
    assert all(p[0] == "n,word,kind,size" and len(p) <= 8 for p in parts)
    assert bag(R.read_csv(spark, str(path), SCHEMA)) == bag(things)


def test_csv_with_another_header_is_refused(things, spark, tmp_path):
    path = str(tmp_path / "csv")
    X.load_csv(things.select("n", "size"), path)
    with pytest.raises(Exception, match="CSV header does not conform"):
        R.read_csv(spark, path, "size int, n bigint").collect()


def test_malformed_csv_rows_are_not_lost(spark, tmp_path):
    path = str(tmp_path / "csv")
    mixed = spark.range(20).select("id", F.when(F.col("id") % 4 == 0, "many").otherwise(F.col("id").cast("string")).alias("n"))
    X.load_csv(mixed, path)
    schema = "id bigint, n int"
    with pytest.raises(Exception, match="[Mm]alformed"):
        R.read_csv(spark, path, schema).select("id").collect()
    good, bad = R.read_csv(spark, path, schema, on_bad="split")
    assert sorted(values(good, "n")) == [n for n in range(20) if n % 4]
    assert sorted(values(bad)) == sorted(f"{n},many" for n in range(0, 20, 4))
    assert R.read_csv(spark, path, schema, on_bad="drop").count() == 15
    with pytest.raises(ValueError, match="on_bad"):
        R.read_csv(spark, path, schema, on_bad="ignore")


def test_text_lines_and_words(spark, tmp_path):
    path = tmp_path / "words.txt"
    written = [" ".join(f"w{k}" for k in range(n)) for n in range(1, 6)]
    path.write_text("\n".join(written) + "\n")
    lines = R.read_text_lines(spark, str(path))
    assert values(lines) == written
    assert words_of(lines).count() == 15


FIELDS = ["a", "b", "c"]
GOOD = [",".join(f"{x}{n}" if n % 2 else "" for x in FIELDS) for n in range(3)]
BAD = [",".join("x" * n) for n in (1, 2, 4, 5)] + [None]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([(x,) for x in GOOD + BAD], "value string")


def test_strict_lines_drop_and_split(lines):
    wanted = Counter(tuple(x.split(",")) for x in GOOD)
    assert bag(R.read_strict_delimited(lines, FIELDS, on_bad="drop")) == wanted
    good, bad = R.read_strict_delimited(lines, FIELDS, on_bad="split")
    assert bag(good) == wanted
    assert bag(bad) == Counter((x,) for x in BAD)


def test_strict_lines_are_split_and_counted_in_one_pass(lines, spark):
    found = R.split_strict_delimited(lines, FIELDS)
    assert bag(found.good) == Counter(tuple(x.split(",")) for x in GOOD) and found.good.columns == FIELDS
    assert bag(found.bad) == Counter((x,) for x in BAD) and found.bad.columns == ["value"]
    assert (found.good_lines, found.bad_lines) == (len(GOOD), len(BAD))
    assert "PartitionFilters: [isnotnull(bad" in plan(found.bad)
    none = R.split_strict_delimited(lines.limit(0), FIELDS)
    assert (none.good.count(), none.bad.count(), none.good_lines, none.bad_lines) == (0, 0, 0, 0)
    only = R.split_strict_delimited(lines.where("value is null"), FIELDS, column="value")
    assert (only.good.count(), only.bad_lines) == (0, 1)


def test_strict_lines_fail_even_if_no_field_is_used(lines):
    strict = R.read_strict_delimited(lines, FIELDS)
    with pytest.raises(SparkRuntimeException, match="Bad line: "):
        strict.collect()
    with pytest.raises(SparkRuntimeException, match="Bad line: "):
        strict.select(F.lit(1)).collect()
    with pytest.raises(SparkRuntimeException, match="Bad line: "):
        strict.count()
    assert R.read_strict_delimited(lines.limit(3), FIELDS).count() == 3
    with pytest.raises(ValueError, match="on_bad"):
        R.read_strict_delimited(lines, FIELDS, on_bad="ignore")


def test_scratch_is_in_the_configured_folder(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    path = scratch.scratch_path(spark, "x")
    if configured:
        assert path.startswith(configured.rstrip("/") + "/")
    assert path != scratch.scratch_path(spark, "x")


class Context:
    """Stands in for a Spark context."""

    applicationId = "app"

    def __init__(self, master, conf=None, current=None):
        self.master, self.conf, self.current = master, conf or {}, current

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, folder):
        self.current = folder


class Session:
    def __init__(self, context):
        self.sparkContext = context


def test_scratch_folder_choice(tmp_path):
    named = Session(Context("yarn", {"spark.checkpoint.dir": "/shared/ck/"}))
    assert scratch.shared_folder(named) == "/shared/ck"
    given = Session(Context("yarn", current="/given/uuid"))
    assert scratch.shared_folder(given) == "/given/uuid"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session(Context("yarn")))
    local = Session(Context("local[2]"))
    assert scratch.shared_folder(local) == scratch.shared_folder(local)
