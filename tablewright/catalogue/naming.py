"""Column names and layout."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.catalogue.registry import query, table
from tablewright.operators import names as N
from tablewright.sources.readers import extract
from tablewright.sources.scratch import scratch_path
from tablewright.sources.writers import load_parquet


@query(
    "rename_positional",
    """
    SELECT c_custkey AS a, c_name AS b, c_nationkey AS c, c_acctbal AS d, c_mktsegment AS e
    FROM customer
    """,
)
def positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.rename_all(table(spark, sf_dir, "customer"), list("abcde"))


@query(
    "rename_with_function",
    """
    SELECT o_orderkey AS ORDERKEY, o_custkey AS CUSTKEY, o_orderstatus AS ORDERSTATUS,
           o_totalprice AS TOTALPRICE, o_orderdate AS ORDERDATE, o_orderpriority AS ORDERPRIORITY
    FROM orders
    """,
)
def with_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.modify_column_names(table(spark, sf_dir, "orders"), lambda c: c[2:].upper())


@query(
    "rename_special_chars",
    """
    SELECT c_custkey AS "the_&key", c_name AS "full_$name", c_nationkey AS "a_&nation_$key",
           c_acctbal, c_mktsegment
    FROM customer
    """,
)
def special_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    spaced = N.rename_columns(
        table(spark, sf_dir, "customer"),
        {"c_custkey": "the key", "c_name": "full.name", "c_nationkey": "a nation.key"},
    )
    return N.change_column_names(spaced)


@query(
    "rename_first_dot",
    """
    SELECT c_custkey AS customer_key, c_name AS customer_full_name, c_nationkey, c_acctbal,
           c_mktsegment
    FROM customer
    """,
)
def first_dot(spark: SparkSession, sf_dir: str) -> DataFrame:
    dotted = N.rename_columns(
        table(spark, sf_dir, "customer"),
        {"c_custkey": "customer.key", "c_name": "customer.full.name"},
    )
    # The first pass leaves "customer_full.name", the second the rest.
    once = N.modify_column_names(dotted, N.dots_to_underscores)
    return N.modify_column_names(once, N.dots_to_underscores)


@query(
    "rename_where",
    """
    SELECT c_custkey AS key, c_nationkey AS nation, c_name, c_acctbal, c_mktsegment FROM customer
    """,
)
def where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.rename_where(
        table(spark, sf_dir, "customer"),
        {"c_custkey": "key", "c_nationkey": "nation"}.__getitem__,
        lambda c: c.endswith("key"),
    )


@query(
    "rename_mapping",
    """
    SELECT c_custkey, c_mktsegment AS c_name, c_name AS c_mktsegment, c_nationkey, c_acctbal
    FROM customer
    """,
)
def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A swap: the renames have to happen at once.
    return N.rename_columns(
        table(spark, sf_dir, "customer"), {"c_name": "c_mktsegment", "c_mktsegment": "c_name"}
    )


@query(
    "columns_sorted_asc",
    "SELECT c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey FROM customer",
)
def sorted_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.sort_columns(table(spark, sf_dir, "customer"), "asc")


@query(
    "columns_sorted_desc",
    "SELECT c_nationkey, c_name, c_mktsegment, c_custkey, c_acctbal FROM customer",
)
def sorted_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.sort_columns(table(spark, sf_dir, "customer"), "desc")


@query(
    "column_metadata_roundtrip",
    "SELECT c_custkey, c_mktsegment, CAST(3 AS INTEGER) AS model_version FROM customer",
)
def metadata_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "column-metadata")
    marked = N.with_column_metadata(
        table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"),
        "c_mktsegment",
        {"model_version": 3},
    )
    load_parquet(marked, path)
    read = extract(spark, path)
    version = N.column_metadata(read, "c_mktsegment")["model_version"]
    return read.withColumn("model_version", F.lit(version))


@query(
    "transform_chain",
    """
    SELECT c_custkey AS CUSTKEY, c_mktsegment AS MKTSEGMENT, c_name AS NAME,
           c_acctbal AS ACCTBAL, c_nationkey AS nation
    FROM customer
    """,
)
def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .transform(partial(N.rename_columns, mapping={"c_nationkey": "nation"}))
        .transform(
            partial(
                N.rename_where, fun=lambda c: c[2:].upper(), predicate=lambda c: c.startswith("c_")
            )
        )
        .transform(N.sort_columns)
    )
