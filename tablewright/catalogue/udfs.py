"""The Python function, called from the DataFrame API and from SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.catalogue.registry import query, table
from tablewright.sources.readers import sql_over
from tablewright.udfs import register_title, title_udf

TITLE_SQL = """
    SELECT p_partkey,
           list_aggregate(list_transform(string_split(p_name, ' '),
                          lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS title
    FROM part
    """


@query("udf_title", TITLE_SQL)
def title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", title_udf()("p_name", F.lit(True)).alias("title")
    )


@query("udf_title_sql", TITLE_SQL)
def title_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_title(spark, "title_text")
    return sql_over(
        table(spark, sf_dir, "part"),
        "parts_to_title",
        "SELECT p_partkey, title_text(p_name, true) AS title FROM {parts_to_title}",
    )
