import pytest
from pyspark.sql import functions as F

from tablewright.functions import arithmetic as M
from tablewright.functions import arrays as A
from tablewright.functions import chance as C
from tablewright.functions import text as S
from tests.helpers import values


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_remove_non_word_characters(spark):
    kept = "azAZ09_ \t"
    dirty = ["".join(f"{c}{chr(p)}" for c in kept) for p in (33, 38, 42, 58, 64, 91, 126)] + [None]
    df = spark.createDataFrame([(x,) for x in dirty], "x string")
    assert one(df, S.remove_non_word_characters(F.col("x"))) == [kept] * 7 + [None]


def test_join_text_skips_nulls(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, None)], "x string, y string")
    assert one(df, S.join_text(F.col("x"), F.col("y"))) == ["a b", "a", ""]
    assert one(df, S.join_text(F.col("x"), F.col("y"), separator="-")) == ["a-b", "a", ""]


def test_upper_equals_in_any_case(spark):
    df = spark.createDataFrame([("ab",), ("Ab",), ("abc",), (None,)], "x string")
    assert one(df, S.upper_equals(F.col("x"), "aB")) == [True, True, False, None]


@pytest.mark.parametrize("separator", [",", "|", ".", "\\", "--", "^"])
def test_split_fields_is_literal_and_keeps_empty_pieces(spark, separator):
    lines = [separator.join(["a", "", "c", ""]), "", "abc"]
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    assert one(df, S.split_fields(F.col("x"), separator)) == [x.split(separator) for x in lines]


def test_title(spark):
    df = spark.createDataFrame([("they're foo-bar",), (None,)], "x string")
    assert one(df, S.title(F.col("x"))) == ["They're Foo-bar", None]
    assert one(df, S.title(F.col("x"), enabled=False)) == ["they're foo-bar", None]


def test_divide(spark):
    df = spark.createDataFrame([(1,), (3,), (None,)], "n bigint")
    thirds = one(df, M.divide_by_three(F.col("n")))
    assert thirds[0] == pytest.approx(1 / 3)
    assert thirds[1:] == [1.0, None]
    assert one(df, M.divide_by_zero(F.col("n"))) == [None, None, None]
    assert one(df, M.divide(F.col("n"), F.col("n") - 1)) == [None, 1.5, None]
    assert one(df, M.multiply(F.col("n"), 21)) == [21, 63, None]


def test_cast_array(spark):
    numbers = [str(n) for n in range(-3, 4)]
    odd = ["x", "2.5", None, "", str(2**40)]
    df = spark.createDataFrame([(numbers,), (odd,), ([],), (None,)], "xs array<string>")
    assert one(df, M.cast_array(F.col("xs"))) == [list(range(-3, 4)), [None] * 5, [], None]
    assert one(df, M.cast_array(F.col("xs"), "bigint"))[1] == [None, None, None, None, 2**40]
    assert one(df, M.cast_array(F.col("xs"), "double"))[1] == [None, 2.5, None, None, float(2**40)]


@pytest.mark.parametrize("kind", ["double", "float", "int", "bigint", "decimal(6,2)", "boolean"])
def test_cast_array_of_other_elements(spark, kind):
    df = spark.createDataFrame([([1.0, 0.0, None],)], "xs array<double>").select(F.col("xs").cast(f"array<{kind}>").alias("xs"))
    assert one(df, M.cast_array(F.col("xs"))) == [[1, 0, None]]
    fractions = spark.createDataFrame([([1.0, 2.5, -2.5, 1e20],)], "xs array<double>")
    assert one(fractions, M.cast_array(F.col("xs"))) == [[1, 2, -2, None]]


def test_cast_array_agrees_with_an_unguarded_cast(spark):
    texts = ["1", "+1", "-1", "1.", ".1", "1e3", "0x1", "١", "\t7\n", " 7", "- 1", "--1", "00012", "1_0", "2147483648"]
    df = spark.createDataFrame([(texts,)], "xs array<string>")
    assert one(df, M.cast_array(F.col("xs"))) == one(df, F.col("xs").try_cast("array<int>"))


def test_flag_at_least(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "n int")
    assert one(df, M.flag_at_least(F.col("n"))) == [0, 1, 1, 0]


ARRAYS = [(1, ["a", "b", "c"]), (2, ["a", "b", "c", "d"]), (3, ["x"]), (4, [None]), (5, []), (6, None)]


@pytest.mark.parametrize("seed", [None, 42])
def test_array_choice_draws_a_member(spark, seed):
    df = spark.createDataFrame(ARRAYS, "id int, xs array<string>")
    picked = df.select("xs", A.array_choice(F.col("xs"), F.col("id"), seed=seed).alias("x")).collect()
    assert all(row.x in row.xs if row.xs else row.x is None for row in picked)


def test_seeded_choice_repeats_and_is_about_uniform(spark):
    df = spark.range(4000).select("id", F.array(*(F.lit(x) for x in "abcd")).alias("xs"))
    choice = A.array_choice(F.col("xs"), F.col("id"), seed=7).alias("x")
    first = dict(df.repartition(3).select("id", choice).collect())
    assert first == dict(df.repartition(7, "id").select("id", choice).collect())
    counts = [list(first.values()).count(x) for x in "abcd"]
    assert min(counts) > 850
    other = dict(df.select("id", A.array_choice(F.col("xs"), F.col("id"), seed=8)).collect())
    assert other != first


def test_seeded_choice_needs_a_key():
    with pytest.raises(ValueError, match="key"):
        A.array_choice(F.lit(None), seed=1)


def test_choice_of_columns_and_values(spark):
    df = spark.createDataFrame([(10, None, None), (None, None, None), (1, 2, 3)], "a int, b int, c int")
    cols = [F.col(c) for c in "abc"]
    for row in df.select("*", A.choice_of_columns(cols, F.col("a"), seed=1).alias("x")).collect():
        assert row.x in (row.a, row.b, row.c)
    many = spark.range(200)
    assert set(one(many, A.choice_of_values([3, 5, 7], F.col("id"), seed=1))) == {3, 5, 7}


def test_array_mean(spark):
    df = spark.createDataFrame([([1, 2, 6],), ([],), ([1, None],), (None,)], "xs array<int>")
    assert one(df, A.array_mean(F.col("xs"))) == [3.0, None, None, None]


def test_array_all(spark):
    df = spark.createDataFrame([([1, 2],), ([0, 1],), ([],), (None,)], "xs array<int>")
    assert one(df, A.array_all_at_least(F.col("xs"))) == [True, False, True, None]


def test_keyword_hits(spark):
    topics = [[f"t{k}" for k in range(n)] for n in (1, 2, 4)]
    lines = [" ".join(f"t{k}" for k in range(n, 5)) for n in range(6)] + ["t1 t1 t11", None]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    hits = one(df, A.keyword_hits(S.split_fields(F.col("line"), " "), topics))
    assert hits == [[None] * 3 if x is None else [sum(w in t for w in x.split(" ")) for t in topics] for x in lines]


@pytest.mark.parametrize("count", [0, 1, 7, 1000])
def test_keyword_hits_of_any_number_of_topics(spark, count):
    topics = [[f"w{n % 13}", f"w{n * 5 % 13}", "ünï'\"\\"][: 1 + n % 3] for n in range(count)]
    lines = ["w1 w1 w5 x", "", "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12", "ünï'\"\\ w3 w3", "x y", None]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = one(df, A.keyword_hits(S.split_fields(F.col("line"), " "), topics))
    assert got == [[None] * count if x is None else [sum(w in set(t) for w in x.split(" ")) for t in topics] for x in lines]
    tokens = spark.createDataFrame([([None, "w1", None],)], "tokens array<string>")
    assert one(tokens, A.keyword_hits(F.col("tokens"), [["w1"], ["w2"]])) == [[1, 0]]


def test_seeded_uniform(spark):
    df = spark.range(2000)
    draws = one(df, C.seeded_uniform(3, F.col("id")))
    assert draws == one(df.repartition(5).orderBy("id"), C.seeded_uniform(3, F.col("id")))
    assert all(0 <= x < 1 for x in draws) and len(set(draws)) == 2000
    assert sum(draws) / 2000 == pytest.approx(0.5, abs=0.03)
    assert all(0 <= x < 1 for x in values(df.select(C.random_uniform(1).alias("x"))))
