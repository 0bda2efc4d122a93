from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.operators import compare as V
from tablewright.operators.projections import with_age
from tests.helpers import bag, plan, values


@pytest.fixture
def table(spark):
    """Keys, a text that is NULL for every seventh, and a number."""
    return spark.range(60).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("t"), F.col("id") % 5)).alias("t"),
        (F.col("id") / 4).alias("x"),
    )


def test_columns_exact(table):
    other = F.when(F.col("k") % 11 == 0, "else").when(F.col("k") % 13 == 0, F.lit(None)).otherwise(F.col("t"))
    found = V.column_mismatches(table.withColumn("u", other), "t", "u")
    rows = table.withColumn("u", other).collect()
    assert sorted(values(found, "k")) == [r.k for r in rows if r.t != r.u]


def test_columns_approx_around_the_tolerance(spark):
    df = spark.range(-8, 9).select("id", F.lit(3.0).alias("a"), (3 + F.col("id") / 8).alias("b"))
    found = V.column_mismatches_approx(df, "a", "b", 0.5)
    assert sorted(values(found, "id")) == [n for n in range(-8, 9) if abs(n) > 4]


def test_approx_knows_special_numbers(spark):
    special = [float("nan"), float("inf"), float("-inf"), 0.0, -0.0, None]
    pairs = [(i, j, a, b) for i, a in enumerate(special) for j, b in enumerate(special)]
    df = spark.createDataFrame(pairs, "i int, j int, a double, b double")
    differ = {(r.i, r.j) for r in V.column_mismatches_approx(df, "a", "b", 0.5).collect()}
    zero = {3, 4}
    assert differ == {(i, j) for i, j, *_ in pairs if i != j and not {i, j} <= zero}


def test_whole_numbers_and_decimals_are_compared_exactly(spark):
    big = 2**53
    df = spark.createDataFrame(
        [(n, big, big + n, Decimal(10) ** 20, Decimal(10) ** 20 + n) for n in range(3)],
        "n int, a bigint, b bigint, c decimal(38,2), d decimal(38,2)",
    )
    for x, y in (("a", "b"), ("c", "d")):
        assert values(V.column_mismatches_approx(df, x, y, 0.0), "n") == [1, 2]
        assert values(V.column_mismatches_approx(df, x, y, 1.5), "n") == [2]
    ends = spark.createDataFrame([(-(2**63), 2**63 - 1)], "a bigint, b bigint")
    assert V.column_mismatches_approx(ends, "a", "b", 1.0).count() == 1


def test_schema_differences_are_named(spark):
    left = spark.range(1).select("id", F.lit(1).alias("floor"))
    assert V.schema_differences(left, left.select("floor", "id")) == []
    assert V.schema_differences(left, with_age(left)) == ["column 'age' is only on the right"]
    other = spark.range(1).select(F.col("id").cast("int"), F.lit("x").alias("note"))
    assert V.schema_differences(left, other) == [
        "column 'floor' is only on the left",
        "column 'note' is only on the right",
        "column 'id' is bigint on the left, int on the right",
    ]
    for compare in (V.dataframe_diff, lambda a, b: V.dataframe_diff_approx(a, b, ["id"], 0.1)):
        with pytest.raises(V.SchemaMismatch, match="'age' is only on the right"):
            compare(left, with_age(left))


ROWS = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["p", "q", None])), max_size=20
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=ROWS, right=ROWS)
def test_multiset_difference_against_brute_force(spark, left, right):
    schema = "n int, s string"
    got = V.dataframe_diff(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema))
    wanted = Counter()
    for side, surplus in (("left", Counter(left) - Counter(right)), ("right", Counter(right) - Counter(left))):
        wanted.update({(*row, side, n): 1 for row, n in surplus.items()})
    assert bag(got) == wanted


def test_multiset_difference_is_one_shuffle_after_partial_counts(spark):
    df = spark.range(100)
    shown = plan(V.dataframe_diff(df, df.where("id < 50")))
    assert shown.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in shown and "Join" not in shown


def brute_keyed(left, right, precision):
    """What ``dataframe_diff_approx`` gives for rows (key, number, text)."""
    out = Counter()
    for key in {r[0] for r in left + right}:
        mine, other = ([r[1:] for r in rows if r[0] == key] for rows in (left, right))
        if len(mine) > 1 or len(other) > 1:
            a, b = Counter(mine), Counter(other)
            for row in set(a) | set(b):
                if a[row] != b[row]:
                    out[key, "repeated_key", a[row], b[row], ()] += 1
        elif not other:
            out[key, "left_only", 1, 0, ()] += 1
        elif not mine:
            out[key, "right_only", 0, 1, ()] += 1
        else:
            (x, s), (y, t) = mine[0], other[0]
            near = x == y or (None not in (x, y) and abs(x - y) <= precision)
            columns = tuple(n for n, same in (("n", near), ("s", s == t)) if not same)
            if columns:
                out[key, "changed", 1, 1, columns] += 1
    return out


KEYED = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 4)),
        st.one_of(st.none(), st.integers(0, 3)),
        st.sampled_from(["p", None]),
    ),
    max_size=12,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=KEYED, right=KEYED)
def test_keyed_difference_against_brute_force(spark, left, right):
    schema = "k int, n int, s string"
    got = V.dataframe_diff_approx(
        spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"], 1.0
    )
    found = Counter((r.k, r.kind, r.left_rows, r.right_rows, tuple(r.columns or ())) for r in got.collect())
    assert found == brute_keyed(left, right, 1.0)


def test_keyed_difference_shows_both_sides(table):
    moved = table.withColumn("x", F.col("x") + F.when(F.col("k") == 9, 5).otherwise(0.01))
    (row,) = V.dataframe_diff_approx(table, moved, ["k"], 0.1).collect()
    assert (row.k, row.kind, row.columns, row.right.x - row.left.x) == (9, "changed", ["x"], 5.0)


def test_equal_tables_with_a_hot_key_do_not_differ(spark):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    left = spark.range(3000).select(hot.alias("k"), F.lit(1).alias("v"))
    assert V.dataframe_diff_approx(left, left, ["k"], 0.0).count() == 0
    more = left.unionByName(left.where("k = 0"))
    (row,) = V.dataframe_diff_approx(left, more, ["k"], 0.0).collect()
    assert (row.k, row.kind, row.left_rows, row.right_rows, row.right.v) == (0, "repeated_key", 1000, 2000, 1)


def test_reconcile(spark):
    expected = spark.range(1, 41).select("id", (F.col("id") * 3).alias("n"))
    same = V.reconcile(expected, expected, "n").first()
    assert same.agrees and same.expected_mean == same.actual_mean == 61.5
    more = spark.range(1, 51).select("id", (F.col("id") * 3).alias("n"), F.lit(1).alias("z"))
    other = V.reconcile(expected, more, "n").first()
    assert not other.agrees
    assert (other.expected_columns, other.actual_columns) == (2, 3)
    assert (other.expected_rows, other.actual_rows, other.actual_mean) == (40, 50, 76.5)
    empty = V.reconcile(expected.limit(0), expected.limit(0), "n").first()
    assert empty.agrees and empty.expected_mean is None
    assert not {"Cartesian", "NestedLoop"} & set(plan(V.reconcile(expected, more, "n")).split())


def test_reconcile_is_exact_for_whole_numbers_and_relative_for_doubles(spark):
    n = spark.range(100).select((F.col("id") + 2**53).alias("n"))
    moved = n.withColumn("n", F.col("n") + F.when(F.col("n") == 2**53, 1).otherwise(0))
    assert not V.reconcile(n, moved, "n").first().agrees
    x = spark.range(100).select((F.col("id") + 1e12).alias("x"))
    assert V.reconcile(x, x.withColumn("x", F.col("x") + 1e-3), "x").first().agrees
    assert not V.reconcile(x, x.withColumn("x", F.col("x") * (1 + 1e-6)), "x").first().agrees


def first_pass(monkeypatch):
    """Catches the keys that the first pass hands on."""
    seen = []

    def kept(df):
        seen.append(df.count())
        return df

    monkeypatch.setattr(V, "set_aside", kept)
    return seen


def test_noise_within_the_tolerance_joins_no_row(spark, monkeypatch):
    seen = first_pass(monkeypatch)
    n = F.col("id")
    left = spark.range(500).select(
        "id", (n / 7).alias("d"), (n / 3).cast("float").alias("f"), n.cast("decimal(12,3)").alias("m"), (n * 5).alias("i"), F.concat(F.lit("t"), n).alias("t")
    )
    noise = (n % 200 - 100) / 1001
    right = left.select(
        "id", (F.col("d") + noise).alias("d"), (F.col("f") + noise).cast("float").alias("f"), (F.col("m") + F.lit(0.099)).cast("decimal(12,3)").alias("m"), "i", "t"
    )
    assert V.dataframe_diff_approx(left, right, ["id"], 0.1).count() == 0
    assert seen == [0]
    # Whole numbers move only where the tolerance allows it.
    later = right.withColumn("i", F.col("i") + F.when(n % 100 == 0, 2).otherwise(1))
    assert V.dataframe_diff_approx(left, later, ["id"], 1.0).count() == 5
    assert V.dataframe_diff_approx(left, later, ["id"], 0.1).count() == 500
    assert seen == [0, 5, 500]


NUMBERS = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1.0, 1.05, 1.2, 1e308, -1e308, 5e-324]


def test_first_pass_agrees_with_plain_comparison(spark):
    pairs = [(i * 100 + j, a, b) for i, a in enumerate(NUMBERS) for j, b in enumerate(NUMBERS)]
    both = spark.createDataFrame(pairs, "k int, a double, b double")
    for precision in (0.0, 0.1, 1e308):
        got = V.dataframe_diff_approx(
            both.select("k", F.col("a").alias("x")), both.select("k", F.col("b").alias("x")), ["k"], precision
        )
        plain = V.column_mismatches_approx(both, "a", "b", precision)
        assert sorted(values(got, "k")) == sorted(values(plain, "k"))


def test_decimals_too_long_to_add_up(spark):
    rows = spark.sql(
        "SELECT 1 AS k, 99999999999999999999999999999999999999BD AS a, -99999999999999999999999999999999999999BD AS b "
        "UNION ALL SELECT 2, 99999999999999999999999999999999999999BD, 99999999999999999999999999999999999998BD "
        "UNION ALL SELECT 3, NULL, NULL UNION ALL SELECT 4, NULL, 0BD"
    )
    got = V.dataframe_diff_approx(
        rows.select("k", F.col("a").alias("x")), rows.select("k", F.col("b").alias("x")), ["k"], 1.0
    )
    assert sorted(values(got, "k")) == [1, 4]
