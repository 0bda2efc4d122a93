"""Comparisons: tables against copies that differ by known rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.catalogue.registry import query, table
from tablewright.operators import compare as V


def in_progress() -> Column:
    return F.col("o_orderstatus") == "P"


def urgent() -> Column:
    return F.col("o_orderpriority") == "1-URGENT"


def orders_at(spark: SparkSession, sf_dir: str, in_progress_surcharge: float) -> DataFrame:
    """Orders, those in progress at a higher price."""
    price = F.col("o_totalprice") + F.when(in_progress(), in_progress_surcharge).otherwise(0.0)
    return table(spark, sf_dir, "orders").withColumn("o_totalprice", price)


@query(
    "diff_columns_exact",
    """
    SELECT o_orderkey, o_orderpriority, CAST(NULL AS VARCHAR) AS copy
    FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT'
    """,
)
def columns_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    # NULL in the copy where in progress, on both sides where urgent as well.
    both = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(~(in_progress() & urgent()), F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(~in_progress(), F.col("o_orderpriority")).alias("copy"),
    )
    return V.column_mismatches(both, "o_orderpriority", "copy")


@query(
    "diff_columns_approx",
    "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'",
)
def columns_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 5 apart where in progress, a quarter apart elsewhere, with a tolerance of a half.
    both = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        (F.col("o_totalprice") + F.when(in_progress(), 5.0).otherwise(0.25)).alias("copy"),
    )
    return V.column_mismatches_approx(both, "o_totalprice", "copy", 0.5).select("o_orderkey")


@query(
    "diff_rows_multiset",
    """
    SELECT o_orderstatus, o_orderpriority, side, copies
    FROM (SELECT o_orderstatus, o_orderpriority, 'left' AS side, count(*) AS copies
          FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' GROUP BY ALL
          UNION ALL
          SELECT 'P', 'none', 'right', count(*)
          FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
    """,
)
def rows_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two columns of few values: nearly every row has many copies.
    left = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority")
    right = left.withColumn(
        "o_orderpriority",
        F.when(in_progress() & urgent(), "none").otherwise(F.col("o_orderpriority")),
    )
    return V.dataframe_diff(left, right)


@query(
    "diff_rows_multiset_unique",
    """
    SELECT *, 'left' AS side, CAST(1 AS BIGINT) AS copies FROM orders WHERE o_orderstatus = 'P'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 5, o_orderdate, o_orderpriority,
           'right', 1
    FROM orders WHERE o_orderstatus = 'P'
    """,
)
def rows_multiset_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.dataframe_diff(table(spark, sf_dir, "orders"), orders_at(spark, sf_dir, 5.0))


@query(
    "diff_rows_keyed",
    """
    SELECT o_orderkey, kind, columns, left_price, right_price
    FROM (SELECT o_orderkey,
                 CASE WHEN o_orderpriority = '1-URGENT' THEN 'left_only'
                      WHEN o_orderpriority = '5-LOW' THEN 'right_only'
                      WHEN o_orderstatus = 'P' THEN 'changed' END AS kind,
                 CASE WHEN kind = 'changed' THEN 'o_totalprice' END AS columns,
                 CASE WHEN kind <> 'right_only' THEN o_totalprice END AS left_price,
                 CASE WHEN kind <> 'left_only'
                      THEN o_totalprice + CASE o_orderstatus WHEN 'P' THEN 5.0::DOUBLE ELSE 0 END END
                     AS right_price
          FROM orders)
    WHERE kind IS NOT NULL
    """,
)
def rows_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") != "5-LOW")
    right = orders_at(spark, sf_dir, 5.0).where(~urgent())
    return V.dataframe_diff_approx(left, right, ["o_orderkey"], 0.5).select(
        "o_orderkey",
        "kind",
        F.array_join("columns", ",").alias("columns"),
        F.col("left.o_totalprice").alias("left_price"),
        F.col("right.o_totalprice").alias("right_price"),
    )


@query(
    "diff_columns_beyond_doubles",
    "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'",
)
def columns_beyond_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Whole numbers one apart that are the same double.
    large = F.lit(9007199254740992).cast("bigint") + 2 * F.col("o_orderkey")
    both = table(spark, sf_dir, "orders").select(
        "o_orderkey", large.alias("a"), (large + F.when(in_progress(), 1).otherwise(0)).alias("b")
    )
    return V.column_mismatches_approx(both, "a", "b", 0.0).select("o_orderkey")


@query(
    "diff_rows_repeated_keys",
    """
    SELECT o_custkey, o_orderkey, 'repeated_key' AS kind, 1::BIGINT AS left_rows, 0::BIGINT AS right_rows
    FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
    WHERE o_orderstatus = 'P' AND n > 1
    UNION ALL
    SELECT o_custkey, o_orderkey, 'left_only', 1, 0
    FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
    WHERE o_orderstatus = 'P' AND n = 1
    """,
)
def rows_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Customers have several orders; the right side lacks those in progress.
    left = table(spark, sf_dir, "orders")
    return V.dataframe_diff_approx(left, left.where(~in_progress()), ["o_custkey"], 0.5).select(
        "o_custkey", F.col("left.o_orderkey").alias("o_orderkey"), "kind", "left_rows", "right_rows"
    )


@query(
    "diff_rows_repeated_keys_equal",
    "SELECT o_custkey, '' AS kind FROM orders WHERE false",
)
def rows_repeated_keys_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "orders")
    return V.dataframe_diff_approx(left, left, ["o_custkey"], 0.0).select("o_custkey", "kind")


@query(
    "reconcile_summary",
    """
    SELECT CAST(6 AS INTEGER) AS expected_columns, CAST(6 AS INTEGER) AS actual_columns,
           count(*) AS expected_rows,
           count(*) FILTER (o_orderpriority <> '1-URGENT') AS actual_rows,
           round(avg(o_totalprice), 4) AS expected_mean,
           round(avg(o_totalprice + CASE o_orderstatus WHEN 'P' THEN 5.0::DOUBLE ELSE 0 END)
                 FILTER (o_orderpriority <> '1-URGENT'), 4) AS actual_mean,
           false AS agrees
    FROM orders
    """,
)
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    actual = orders_at(spark, sf_dir, 5.0).where(~urgent())
    summary = V.reconcile(table(spark, sf_dir, "orders"), actual, "o_totalprice")
    return summary.withColumns(
        {c: F.round(c, 4) for c in ("expected_mean", "actual_mean")}
    )


@query(
    "diff_rows_noise",
    """
    SELECT o_orderkey, 'half,o_totalprice' AS columns FROM orders WHERE o_orderkey % 500 = 0
    """,
)
def rows_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    # All doubles move, nearly all by less than the precision: those keys are done with in the first pass.
    left = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", (F.col("o_totalprice") / 2).alias("half"), F.lit(0.01).alias("rate")
    )
    moved = F.when(F.col("o_orderkey") % 500 == 0, 0.25).otherwise((F.col("o_orderkey") % 19 - 9) / 100)
    right = left.select(
        "o_orderkey",
        *((F.col(c) + moved).alias(c) for c in ("o_totalprice", "half")),
        (F.col("rate") + 0.09).alias("rate"),
    )
    return V.dataframe_diff_approx(left, right, ["o_orderkey"], 0.11).select(
        "o_orderkey", F.array_join(F.array_sort("columns"), ",").alias("columns")
    )
