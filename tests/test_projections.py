import pytest
from pyspark.sql import functions as F

from tablewright.operators import projections as P
from tablewright.operators.names import named, rename_all
from tablewright.operators.words import explode_array, words_of
from tests.helpers import values

@pytest.fixture
def staff(spark):
    """Twelve rows on floors 1 to 4; the second name is missing for every fifth."""
    n = F.col("id")
    return spark.range(1, 13).select(
        n.alias("id"),
        F.concat(F.lit("First"), n).alias("first_name"),
        F.when(n % 5 != 0, F.concat(F.lit("Second"), 20 - n)).alias("second_name"),
        (n % 4 + 1).alias("floor"),
    )


def full_name(n):
    return f"First{n} Second{20 - n}" if n % 5 else f"First{n}"


def test_steps_report(staff):
    report = P.steps_report(staff, 21)
    assert report.columns == ["id", "name", "steps_to_desk"]
    assert report.collect() == [(n, full_name(n), (n % 4 + 1) * 21) for n in range(1, 13)]


def test_steps_report_with_other_columns(staff):
    renamed = rename_all(staff, ["key", "a.b", "second", "level"])
    report = P.steps_report(renamed, 2, id="key", first="a.b", second="second", floor="level")
    assert report.collect() == [(n, full_name(n), (n % 4 + 1) * 2) for n in range(1, 13)]


def test_with_age(staff):
    assert P.with_age(staff).columns == [*staff.columns, "age"]
    assert values(P.with_age(staff), "age") == [(n % 4 + 1) * 10 for n in range(1, 13)]


def test_dotted_names_and_struct_fields_are_kept_apart(spark):
    inside = F.struct((-F.col("id")).alias("k"), (F.col("id") * 100).alias("m"))
    df = spark.range(4).select(F.col("id").alias("s.k"), inside.alias("s"))
    chosen = P.select_columns(df, ["s.k", P.struct_field("s", "m").alias("m")])
    assert chosen.collect() == [(n, n * 100) for n in range(4)]
    assert values(df.select(P.struct_field("s", "k").alias("n"))) == [0, -1, -2, -3]
    assert values(df.select(named("s.k").alias("n"))) == [0, 1, 2, 3]


def test_filters(staff):
    assert values(P.where_at_least(staff, "floor", 3)) == [n for n in range(1, 13) if n % 4 >= 2]
    assert values(P.where_upper_equals(staff, "first_name", "fiRST7")) == [7]
    assert values(P.where_present(staff, ["first_name", "second_name"])) == [n for n in range(1, 13) if n % 5]
    assert values(P.where_present(staff, [])) == list(range(1, 13))


def test_sort_ascending(staff):
    shuffled = staff.repartition(3, "first_name")
    assert values(P.sort_ascending(shuffled, "floor", "id")) == sorted(range(1, 13), key=lambda n: (n % 4, n))
    names = values(P.sort_ascending(shuffled, "second_name"), "second_name")
    assert names == [None, None, *sorted(f"Second{20 - n}" for n in range(1, 13) if n % 5)]


def test_words_of(spark):
    texts = [" ".join("ab" * k for k in range(n)) for n in range(5)]
    lines = spark.createDataFrame([(t,) for t in [*texts, None]], "value string")
    assert values(words_of(lines)) == [w for t in texts for w in t.split(" ")]


def test_explode_array(spark):
    df = spark.createDataFrame([(1, ["a", None]), (2, [])], "id int, xs array<string>")
    assert explode_array(df, "xs", "x").collect() == [(1, "a"), (1, None)]
    assert df.select(F.explode("xs")).count() == 2
