"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.catalogue.registry import query, table
from tablewright.functions.arithmetic import flag_at_least
from tablewright.operators import projections as P
from tablewright.operators.names import named, rename_columns

# Who the customers are in the report's terms.
CUSTOMER_COLUMNS = {
    "id": "c_custkey",
    "first": "c_name",
    "second": "c_mktsegment",
    "floor": "c_nationkey",
}
STEPS_PER_FLOOR = 21


@query(
    "proj_steps_report",
    """
    SELECT c_custkey AS id,
           concat_ws(' ', c_name, c_mktsegment) AS name,
           c_nationkey * 21 AS steps_to_desk
    FROM customer
    """,
)
def steps_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.steps_report(table(spark, sf_dir, "customer"), STEPS_PER_FLOOR, **CUSTOMER_COLUMNS)


@query("proj_derived_age", "SELECT *, c_nationkey * 10 AS age FROM customer")
def derived_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.with_age(table(spark, sf_dir, "customer"), floor="c_nationkey")


@query(
    "proj_select_list",
    "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem",
)
def select_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return P.select_columns(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", revenue.alias("revenue")]
    )


@query(
    "proj_dotted_name",
    "SELECT c_custkey, c_name AS dotted_name FROM customer",
)
def dotted_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    dotted = rename_columns(table(spark, sf_dir, "customer"), {"c_name": "customer.name"})
    return dotted.select("c_custkey", named("customer.name").alias("dotted_name"))


@query(
    "proj_struct_field",
    """
    SELECT c_name AS field_name, c_nationkey AS field_age, upper(c_mktsegment) AS column_name
    FROM customer
    """,
)
def struct_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A struct field and a column with a dot in its name, spelled alike.
    people = table(spark, sf_dir, "customer").select(
        F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("age")).alias("person"),
        F.upper("c_mktsegment").alias("person.name"),
    )
    return people.select(
        P.struct_field("person", "name").alias("field_name"),
        P.struct_field("person", "age").alias("field_age"),
        named("person.name").alias("column_name"),
    )


@query("proj_with_column", "SELECT *, o_totalprice * 2 AS doubled FROM orders")
def with_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("doubled", F.col("o_totalprice") * 2)


@query(
    "proj_literal_alias",
    "SELECT p_partkey AS part, 'stock' AS origin, CAST(7 AS INTEGER) AS lot FROM part",
)
def literal_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part"), F.lit("stock").alias("origin"), F.lit(7).alias("lot")
    )


@query(
    "filter_compare",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 400000",
)
def compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.where_at_least(table(spark, sf_dir, "orders"), "o_totalprice", 400000).select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "filter_upper_equals",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE upper(c_mktsegment) = 'BUILDING'",
)
def upper_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.where_upper_equals(
        table(spark, sf_dir, "customer"), "c_mktsegment", "building"
    ).select("c_custkey", "c_mktsegment")


@query(
    "filter_not_null",
    """
    SELECT d.doc_id, d.lang, nullif(l.quality, 0) AS quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE d.lang IS NOT NULL AND nullif(l.quality, 0) IS NOT NULL
    """,
)
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = (
        table(spark, sf_dir, "documents")
        .select("doc_id", "lang")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select("doc_id", "lang", F.nullif("quality", F.lit(0)).alias("quality"))
    )
    return P.where_present(labelled, ["lang", "quality"])


@query(
    "expr_case_when",
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS INTEGER) AS large
    FROM lineitem
    """,
)
def case_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", flag_at_least(F.col("l_quantity"), 25).alias("large")
    )
