import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import names as N


@pytest.fixture
def wide(spark):
    """Column i holds i; names with a dot, a space, a back-quote and capitals."""
    names = ["q.r.s", "plain", "two words", "t.u", "od`d", "Zed"]
    return spark.range(3).select(*(F.lit(i).alias(n) for i, n in enumerate(names)))


def positions(df):
    """What each column of the first row holds: where it was before."""
    return list(df.first())


def test_rename_all_keeps_position_rows_and_nullability(spark):
    schema = T.StructType([T.StructField(f"c.{i}", T.LongType(), i % 2 == 0) for i in range(6)])
    df = spark.createDataFrame([tuple(range(k, k + 6)) for k in range(4)], schema)
    renamed = N.rename_all(df, [f"n{i}" for i in range(6)])
    assert [f.nullable for f in renamed.schema] == [i % 2 == 0 for i in range(6)]
    assert renamed.columns == [f"n{i}" for i in range(6)] and renamed.collect() == df.collect()


def test_rename_all_wants_one_name_per_column(wide):
    with pytest.raises(ValueError, match="6 columns but 1 new names"):
        N.rename_all(wide, ["a"])


@pytest.mark.parametrize("twin", ["n0", "N0"])
def test_renaming_to_the_same_name_twice_is_an_error(wide, twin):
    with pytest.raises(ValueError, match="repeat column names"):
        N.rename_all(wide, ["n0", twin, "n2", "n3", "n4", "n5"])


def test_modify_column_names_first_dot_or_all(wide):
    assert N.modify_column_names(wide, N.dots_to_underscores).columns[0] == "q_r.s"
    every = N.modify_column_names(wide, lambda c: N.dots_to_underscores(c, count=None))
    assert every.columns == [c.replace(".", "_") for c in wide.columns]
    assert positions(every) == list(range(6))


def test_rename_where_touches_no_other_column(wide):
    renamed = N.rename_where(wide, str.upper, lambda c: "." in c)
    assert renamed.columns == [c.upper() if "." in c else c for c in wide.columns]
    assert positions(renamed) == list(range(6))


def test_rename_columns_is_simultaneous(spark):
    df = spark.range(1).select(*(F.lit(i).alias(f"v{i}") for i in range(4)))
    ring = {f"v{i}": f"v{(i + 1) % 4}" for i in range(4)}
    turned = N.rename_columns(df, ring)
    assert turned.columns == ["v1", "v2", "v3", "v0"] and positions(turned) == [0, 1, 2, 3]
    chain = N.rename_columns(df, {"v0": "w", "w": "x", "nowhere": "y"})
    assert chain.columns == ["w", "v1", "v2", "v3"]


def test_change_column_names_spells_spaces_and_dots(wide):
    spelled = [c.replace(" ", N.SPACE_SPELLING).replace(".", N.DOT_SPELLING) for c in wide.columns]
    changed = N.change_column_names(wide)
    assert changed.columns == spelled and positions(changed) == list(range(6))


@pytest.mark.parametrize("order", ["asc", "desc"])
def test_sort_columns(wide, order):
    ordered = N.sort_columns(wide, order)
    assert ordered.columns == sorted(wide.columns, reverse=order == "desc")
    assert positions(ordered) == [wide.columns.index(c) for c in ordered.columns]


def test_sort_columns_rejects_another_order(wide):
    with pytest.raises(ValueError, match="asc.*desc.*'up'"):
        N.sort_columns(wide, "up")


def test_quote_name_doubles_back_quotes(wide):
    assert wide.select(*map(N.named, wide.columns)).first() == wide.first()


def test_metadata_survives_parquet_and_renames(spark, tmp_path):
    path = str(tmp_path / "marked")
    N.with_column_metadata(spark.range(2).toDF("k").withColumn("m", F.lit(1)), "m", {"unit": "kg"}).write.parquet(path)
    read = spark.read.parquet(path)
    assert (N.column_metadata(read, "m"), N.column_metadata(read, "k")) == ({"unit": "kg"}, {})
    assert N.column_metadata(N.rename_columns(read, {"m": "mass"}), "mass") == {"unit": "kg"}


def test_transform_chain(wide):
    chained = wide.transform(lambda d: N.modify_column_names(d, lambda c: c[::-1])).transform(N.sort_columns)
    assert chained.columns == sorted(c[::-1] for c in wide.columns)
