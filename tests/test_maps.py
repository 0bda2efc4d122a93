import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import maps as M
from tablewright.operators import lookups as K
from tablewright.operators import maps as O
from tests.helpers import bag, plan, values


@pytest.fixture
def entries(spark):
    """Row n has the keys of its divisors among 2, 3 and 5; the last row has no map."""
    divisors = [F.when(F.col("n") % d == 0, F.struct(F.lit(f"d{d}").alias("k"), (F.col("n") / d).cast("int").cast("string").alias("v"))) for d in (5, 2, 3)]
    table = F.map_from_entries(F.array_compact(F.array(*divisors)))
    return spark.range(1, 13).toDF("n").withColumn("m", F.when(F.col("n") < 12, table))


def wanted(n, d):
    return str(n // d) if n % d == 0 and n < 12 else None


def test_map_value(entries):
    assert values(entries.select(M.map_value(F.col("m"), "d3").alias("x"))) == [wanted(n, 3) for n in range(1, 13)]


def test_distinct_keys(entries):
    assert sorted(values(O.map_distinct_keys(entries, "m"))) == ["d2", "d3", "d5"]


def test_map_to_columns_with_given_keys(entries):
    wide = O.map_to_columns(entries, "m", ["d5", "none", "d2"])
    assert wide.columns == ["n", "d5", "none", "d2"]
    assert wide.collect() == [(n, wanted(n, 5), None, wanted(n, 2)) for n in range(1, 13)]


def test_map_to_columns_discovers_keys_in_order(entries):
    wide = O.map_to_columns(entries, "m", max_keys=3)
    assert wide.columns == ["n", "d2", "d3", "d5"]
    assert wide.collect() == [(n, *(wanted(n, d) for d in (2, 3, 5))) for n in range(1, 13)]
    assert O.map_to_columns(entries, "m", keep=[], max_keys=3).columns == ["d2", "d3", "d5"]


def test_wide_maps_are_bounded_and_named_apart(entries):
    with pytest.raises(ValueError, match="more than 2 distinct values"):
        O.map_to_columns(entries, "m", max_keys=2)
    with pytest.raises(ValueError, match="map_to_rows"):
        O.map_to_columns(entries, "m")
    with pytest.raises(ValueError, match="repeat column names"):
        O.map_to_columns(entries.withColumnRenamed("n", "d2"), "m", ["d2"])


def test_map_to_rows(entries):
    long = O.map_to_rows(entries, "m")
    assert long.columns == ["n", "key", "value"]
    assert bag(long) == {(n, f"d{d}", wanted(n, d)): 1 for n in range(1, 12) for d in (2, 3, 5) if n % d == 0}


def test_nested_values(spark):
    inner = F.create_map(F.lit("x"), F.col("id").cast("string"))
    outer = F.struct(
        F.col("id").alias("n"), F.struct(F.when(F.col("id") != 2, inner).alias("deep")).alias("mid")
    )
    df = spark.range(5).select(F.when(F.col("id") != 3, outer).alias("o"))
    rows = df.select(
        M.nested_value(F.col("o"), "n"),
        M.nested_value(F.col("o"), "mid", "deep", "x"),
        M.nested_value(F.col("o"), "mid", "deep", "y"),
    ).collect()
    assert rows == [(n if n != 3 else None, str(n) if n not in (2, 3) else None, None) for n in range(5)]


def test_translate_values(spark):
    df = spark.range(4).select(F.nullif(F.col("id"), F.lit(3)).alias("n"))
    letters = {n: chr(97 + n) for n in range(2)}
    assert values(df.select(M.translate_values(F.col("n"), letters).alias("x"))) == ["a", "b", None, None]
    assert values(df.select(M.translate_values(F.col("n"), {}).alias("x"))) == [None] * 4
    with pytest.raises(ValueError, match="too many"):
        M.translate_values(F.col("n"), {i: "x" for i in range(100)})


@pytest.mark.parametrize("make", [lambda n: n * n, lambda n: n / 2, lambda n: n if n % 2 else n / 4, str, lambda n: n % 2 == 0])
def test_map_values_do_not_depend_on_the_size(spark, make):
    df = spark.range(100).toDF("n")
    found = {}
    for size in (K.MAX_LITERAL_ENTRIES, K.MAX_LITERAL_ENTRIES + 1):
        looked_up = K.map_values(df, "n", {n: make(n) for n in range(size)}, "x")
        found[size] = looked_up.dtypes
        assert bag(looked_up) == {(n, make(n) if n < size else None): 1 for n in range(100)}
    assert len({tuple(x) for x in found.values()}) == 1


def test_map_values_of_a_given_type(spark):
    df = spark.range(3).toDF("n")
    assert K.map_values(df, "n", {1: 10}, "x", T.ShortType()).dtypes[1] == ("x", "smallint")
    many = K.map_values(df, "n", {i: i for i in range(300)}, "x", T.ShortType())
    assert many.dtypes[1] == ("x", "smallint") and "BroadcastHashJoin" in plan(many)
    with pytest.raises(TypeError, match="value_type"):
        K.map_values(df, "n", {1: "a", 2: 3}, "x")


def test_large_dictionaries_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(K, "measured_bytes", lambda df: 1 << 40)
    shown = plan(K.map_values(spark.range(3).toDF("n"), "n", {i: i for i in range(100)}, "x"))
    assert "SortMergeJoin" in shown and "Broadcast" not in shown


def test_repeated_keys_can_be_an_error(spark):
    df, twice = spark.range(3).toDF("k"), spark.range(6).select((F.col("id") % 3).alias("k"), "id")
    assert bag(K.map_values_from(df, "k", twice, "k", "id", "x")) == {(n, n + 3): 1 for n in range(3)}
    with pytest.raises(ValueError, match="6 entries for 3 different keys"):
        K.map_values_from(df, "k", twice, "k", "id", "x", on_repeated="fail")


@pytest.fixture
def hot(spark):
    """A third of the rows has one key, a third none at all; many are copies."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7).cast("bigint"))
        .when(F.col("id") % 3 == 1, F.col("id") % 50)
    )
    return spark.range(6000).select((F.col("id") % 100).alias("payload"), key.alias("k"))


def expected_lookup(rows, dictionary):
    out = {}
    for (payload, k), n in rows.items():
        row = (payload, k, dictionary.get(k))
        out[row] = out.get(row, 0) + n
    return out


@pytest.mark.parametrize("bound", [K.BROADCAST_BYTES, 0])
def test_map_values_from_keeps_all_rows_of_hot_and_null_keys(spark, hot, bound):
    table = spark.range(40).select(
        F.col("id").alias("key"), F.concat(F.lit("v"), F.col("id")).alias("value")
    )
    # Repeated and NULL keys in the table do not multiply rows; the greatest value is kept.
    repeated = table.unionByName(
        spark.createDataFrame([(7, "w"), (7, "a"), (None, "n")], "key bigint, value string")
    )
    result = K.map_values_from(hot, "k", repeated, "key", "value", "x", max_broadcast_bytes=bound)
    dictionary = {i: f"v{i}" for i in range(40)} | {7: "w"}
    assert dict(bag(result)) == expected_lookup(bag(hot), dictionary)


@pytest.mark.parametrize("most", [0, 50])
def test_local_tables(spark, monkeypatch, most):
    monkeypatch.setattr(K, "MAX_LITERAL_ROWS", most)
    df = spark.createDataFrame(
        [("it's `x`", 1, -(2**62), 0.1, True), (None, None, None, float("inf"), None)],
        "`a.b` string, i int, l bigint, d double, t boolean",
    )
    local = K.local_table(spark, df.collect(), df.schema)
    assert bag(local) == bag(df) and local.dtypes == df.dtypes
    dates = spark.sql("SELECT date'2020-02-29' AS d, timestamp_ntz'2020-03-29 02:30:00' AS n")
    assert bag(K.local_table(spark, dates.collect(), dates.schema)) == bag(dates)


def test_hot_rows_are_not_shuffled(spark, hot, monkeypatch):
    table = spark.range(40).select(F.col("id").alias("k"), F.lit("x").alias("x"))
    shown = plan(K.join_unique(hot, table, ["k"], max_broadcast_bytes=0))
    # One branch for cold keys, shuffled; one for hot keys, broadcast.
    assert shown.count("SortMergeJoin") == 1 and shown.count("BroadcastHashJoin") == 1
    monkeypatch.setattr(K, "HOT_BYTES", 0)
    shown = plan(K.join_unique(hot, table, ["k"], max_broadcast_bytes=0))
    assert shown.count("SortMergeJoin") == 1 and "BroadcastHashJoin" not in shown


def test_keys_of_two_types_are_joined_by_merge(spark, hot):
    table = spark.range(40).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("v"), F.col("id")).alias("x"))
    result = K.join_unique(hot, table, ["k"], max_broadcast_bytes=0)
    assert "BroadcastHashJoin" not in plan(result)
    assert dict(bag(result)) == expected_lookup(bag(hot), {i: f"v{i}" for i in range(40)})


def test_join_unique_null_safe_and_several_keys(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (None, None, "c")], "x int, y int, v string")
    table = spark.createDataFrame([(1, None, 10), (None, None, 30)], "x int, y int, n int")
    for bound in (K.BROADCAST_BYTES, 0):
        inner = K.join_unique(df, table, ["x", "y"], "inner", null_safe=True, max_broadcast_bytes=bound)
        assert bag(inner) == {(1, None, "a", 10): 1, (None, None, "c", 30): 1}
        left = K.join_unique(df, table, ["x", "y"], "left", max_broadcast_bytes=bound)
        assert {r.n for r in left.collect()} == {None}
    with pytest.raises(ValueError, match="how"):
        K.join_unique(df, table, ["x"], "outer")
