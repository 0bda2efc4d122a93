"""Sources and sinks, by round trips through the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.catalogue.registry import query, table, table_path
from tablewright.operators.aggregates import group_count
from tablewright.operators.words import words_of
from tablewright.sources import published as P
from tablewright.sources import readers as R
from tablewright.sources import writers as X
from tablewright.sources.scratch import scratch_path

CUSTOMER_SCHEMA = (
    "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)
PARTITIONED_BY = ("o_orderstatus", "o_orderpriority")


def partitioned_orders(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "orders-partitioned")
    X.load_partitioned(table(spark, sf_dir, "orders"), path, *PARTITIONED_BY)
    return path


@query("src_parquet", "SELECT * FROM lineitem")
def parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.extract(spark, table_path(sf_dir, "lineitem"))


@query(
    "src_parquet_partition",
    """
    SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority
    FROM orders WHERE o_orderstatus = 'F'
    """,
)
def parquet_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = partitioned_orders(spark, sf_dir)
    return R.read_partition(spark, root, o_orderstatus="F").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )


@query(
    "src_text_lines",
    r"""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split(regexp_replace(text, '[\n\r]', ' ', 'g'), ' ')) AS word
          FROM documents)
    WHERE word <> '' GROUP BY word
    """,
)
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "documents-text")
    X.load_text(table(spark, sf_dir, "documents").select("text"), path)
    words = words_of(R.read_text_lines(spark, path)).where(F.col("word") != "")
    return group_count(words, ["word"], "n")


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as delimited lines; those in debt lack their last field."""
    path = scratch_path(spark, "customer-lines")
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    lines = table(spark, sf_dir, "customer").select(
        F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", segment).alias("value")
    )
    X.load_text(lines, path)
    return R.read_text_lines(spark, path)


FIELDS = ("custkey", "name", "segment")


@query(
    "src_strict_delimited",
    """
    SELECT c_custkey::VARCHAR AS custkey, c_name AS name, c_mktsegment AS segment
    FROM customer WHERE c_acctbal >= 0
    """,
)
def strict_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.read_strict_delimited(customer_lines(spark, sf_dir), FIELDS, on_bad="drop")


@query(
    "src_strict_delimited_bad",
    "SELECT c_custkey::VARCHAR || ',' || c_name AS value FROM customer WHERE c_acctbal < 0",
)
def strict_delimited_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = R.read_strict_delimited(customer_lines(spark, sf_dir), FIELDS, on_bad="split")
    return bad


@query(
    "src_strict_delimited_counted",
    """
    SELECT c_custkey::VARCHAR || ',' || c_name AS value, count(*) OVER () AS bad_lines,
           (SELECT count(*) FROM customer WHERE c_acctbal >= 0) AS good_lines
    FROM customer WHERE c_acctbal < 0
    """,
)
def strict_delimited_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The bad lines, and how many there are of either kind; the lines are read once.
    found = R.split_strict_delimited(customer_lines(spark, sf_dir), FIELDS)
    return found.bad.select(
        "value",
        F.lit(found.bad_lines).cast("bigint").alias("bad_lines"),
        F.lit(found.good_lines).cast("bigint").alias("good_lines"),
    )


@query("sink_csv_roundtrip", "SELECT * FROM customer")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customer-csv")
    X.load_csv(table(spark, sf_dir, "customer"), path)
    return R.read_csv(spark, path, CUSTOMER_SCHEMA)


@query(
    "sink_csv_text_roundtrip",
    """
    SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS length,
           CASE WHEN lang = 'en' THEN NULL WHEN lang = 'fr' THEN '' ELSE lang END AS lang
    FROM documents
    """,
)
def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Line breaks, quotes, NULL and the empty string all survive.
    path = scratch_path(spark, "documents-csv")
    lang = F.when(F.col("lang") == "fr", "").when(F.col("lang") != "en", F.col("lang"))
    X.load_csv(
        table(spark, sf_dir, "documents").select("doc_id", "text", lang.alias("lang")),
        path,
        null_text=r"\N",
    )
    read = R.read_csv(
        spark, path, "doc_id bigint, text string, lang string", null_text=r"\N", multi_line=True
    )
    return read.select(
        "doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("length"), "lang"
    )


@query("sink_parquet_roundtrip", "SELECT * FROM orders")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-parquet")
    X.load_parquet(table(spark, sf_dir, "orders"), path)
    return R.extract(spark, path)


@query("sink_replaced_by_itself", "SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def replaced_by_itself(spark: SparkSession, sf_dir: str) -> DataFrame:
    # What is overwritten is read to make the new rows.
    path = scratch_path(spark, "orders-replaced")
    X.load_parquet(table(spark, sf_dir, "orders"), path)
    X.load_parquet(R.extract(spark, path).where(F.col("o_orderstatus") != "P"), path)
    return R.extract(spark, path)


@query(
    "sink_versions",
    """
    SELECT 1 AS version, count(*) AS orders, CAST(sum(o_custkey) AS BIGINT) AS customers FROM orders
    UNION ALL
    SELECT 2, count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders WHERE o_orderstatus = 'F'
    """,
)
def committed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-versions")
    P.publish(table(spark, sf_dir, "orders"), path)
    P.publish(P.published(spark, path).where(F.col("o_orderstatus") == "F"), path, "csv")

    def summary(number: int | None) -> DataFrame:
        return P.published(spark, path, number).agg(
            F.lit(number or 2).alias("version"),
            F.count(F.lit(1)).alias("orders"),
            F.sum("o_custkey").alias("customers"),
        )

    return summary(1).unionByName(summary(None))


@query(
    "sink_partition_overwrite",
    """
    SELECT o_orderkey, o_orderpriority, o_orderstatus,
           CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE o_orderstatus <> 'F' OR o_orderpriority < '3'
    """,
)
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One partition is written anew, with fewer rows and other prices; the others stay.
    path = scratch_path(spark, "orders-by-status")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    X.load_partitioned(orders, path, "o_orderstatus")
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") < "3")
    X.load_partitioned(
        orders.where(urgent).withColumn("o_totalprice", F.lit(0.0)), path, "o_orderstatus", mode="overwrite_partitions"
    )
    return R.extract(spark, path)


@query("sink_parquet_partitioned", "SELECT * FROM orders")
def parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.extract(spark, partitioned_orders(spark, sf_dir))


@query(
    "filter_partition_conj",
    """
    SELECT o_orderkey, o_custkey, o_orderpriority
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority >= '3'
    """,
)
def partition_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.sql_over(
        R.extract(spark, partitioned_orders(spark, sf_dir)),
        "partitioned_orders",
        """
        SELECT o_orderkey, o_custkey, o_orderpriority FROM {partitioned_orders}
        WHERE o_orderstatus = 'F' AND o_orderpriority >= '3'
        """,
    )


@query(
    "src_inline_rows",
    """
    SELECT o_orderkey, days FROM orders
    LEFT JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 3), ('3-MEDIUM', 7), ('5-LOW', NULL)) v(priority, days)
    ON o_orderpriority = priority
    """,
)
def inline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = R.from_rows(
        spark,
        [("1-URGENT", 1), ("2-HIGH", 3), ("3-MEDIUM", 7), ("5-LOW", None)],
        "priority string, days int",
    )
    # Four rows of the program text; only what they are joined with grows.
    orders = table(spark, sf_dir, "orders")
    matches = orders["o_orderpriority"] == limits["priority"]
    return orders.join(F.broadcast(limits), matches, "left").select("o_orderkey", "days")


@query(
    "sql_view_filter",
    "SELECT * FROM lineitem WHERE l_extendedprice >= 60000",
)
def view_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.sql_over(
        table(spark, sf_dir, "lineitem"),
        "lineitem_view",
        "SELECT * FROM {lineitem_view} WHERE l_extendedprice >= 60000",
    )


@query(
    "sink_csv_bad_rows",
    """
    SELECT o_orderkey || ',' || CASE WHEN o_orderstatus = 'P' THEN 'many' ELSE o_custkey::VARCHAR END AS value
    FROM orders WHERE o_orderstatus = 'P'
    """,
)
def csv_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Orders in progress have a customer that is no number: their rows come back as text.
    path = scratch_path(spark, "orders-csv")
    customer = F.when(F.col("o_orderstatus") == "P", "many").otherwise(F.col("o_custkey").cast("string"))
    orders = table(spark, sf_dir, "orders")
    X.load_csv(orders.select("o_orderkey", customer.alias("o_custkey")), path)
    _, bad = R.read_csv(spark, path, "o_orderkey bigint, o_custkey bigint", on_bad="split")
    return bad


@query(
    "src_strict_delimited_fail",
    "SELECT c_custkey::VARCHAR AS custkey, c_name AS name FROM customer",
)
def strict_delimited_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "customer").select(F.concat_ws(",", "c_custkey", "c_name").alias("value"))
    return R.read_strict_delimited(lines, ["custkey", "name"], on_bad="fail")
