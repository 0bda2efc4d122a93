from pyspark.sql import functions as F

from tablewright.sources.readers import sql_over
from tablewright.udfs import register_title, title_udf
from tests.helpers import plan, values

TEXTS = ["aaa", "they're foo-bar", "x1y ÉCOLE", "", None]


def test_title_is_pythons(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    titled = df.select(title_udf()("text", F.lit(True)).alias("t"))
    assert values(titled) == [None if t is None else t.title() for t in TEXTS]
    assert "ArrowEvalPython" in plan(titled)


def test_flag(spark):
    df = spark.createDataFrame([("ab", True), ("ab", False), ("ab", None)], "t string, on boolean")
    assert values(df.select(title_udf()("t", "on").alias("t"))) == ["Ab", "ab", "ab"]
    assert values(df.coalesce(1).select(title_udf()("t", "on").alias("t"))) == ["Ab", "ab", "ab"]


def test_title_in_sql(spark):
    register_title(spark, "title_in_test")
    df = spark.createDataFrame([("bbb",), (None,)], "t string")
    assert values(sql_over(df, "titles", "SELECT title_in_test(t, true) AS t FROM {titles}")) == ["Bbb", None]
