"""Aggregates, pivots and lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.catalogue.registry import query, table
from tablewright.functions.arithmetic import flag_at_least
from tablewright.operators import aggregates as G
from tablewright.operators import lists as L

LIST_CHUNK = 1000


@query("agg_mean", "SELECT round(avg(c_acctbal), 4) AS avg_c_acctbal FROM customer")
def mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = G.column_mean(table(spark, sf_dir, "customer"), "c_acctbal")
    return result.select(F.round("avg_c_acctbal", 4).alias("avg_c_acctbal"))


@query("agg_count", 'SELECT count(*) AS "rows" FROM lineitem')
def count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.row_count(table(spark, sf_dir, "lineitem"))


@query(
    "agg_group_max",
    """
    SELECT o_custkey, o_orderpriority, max(o_totalprice) AS max_price
    FROM orders GROUP BY o_custkey, o_orderpriority
    """,
)
def group_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.group_max(
        table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], "o_totalprice", "max_price"
    )


@query(
    "agg_group_sum_count",
    """
    SELECT l_returnflag, l_linestatus, sum(l_linenumber)::BIGINT AS sum_number, count(*) AS n
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
)
def group_sum_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.group_sum_count(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        "l_linenumber",
        "sum_number",
        "n",
    )


@query("agg_group_count", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.group_count(table(spark, sf_dir, "documents"), ["source"], "n")


@query(
    "agg_all_requirements_met",
    """
    SELECT o_custkey
    FROM (SELECT o_custkey, o_orderpriority,
                 max(CASE WHEN o_totalprice >= 250000 THEN 1 ELSE 0 END) AS met
          FROM orders GROUP BY o_custkey, o_orderpriority)
    GROUP BY o_custkey HAVING min(met) >= 1
    """,
)
def all_requirements_met(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Customers with a large order of every priority they have ordered with.
    flagged = table(spark, sf_dir, "orders").withColumn(
        "met", flag_at_least(F.col("o_totalprice"), 250000)
    )
    return G.all_met(flagged, "o_custkey", "o_orderpriority", "met")


@query("agg_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.distinct_values(table(spark, sf_dir, "events"), "user_id", "event_type")


@query(
    "agg_pivot_count",
    """
    SELECT o_custkey,
           nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS F,
           nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS O,
           nullif(count(*) FILTER (o_orderstatus = 'P'), 0) AS P
    FROM orders GROUP BY o_custkey
    """,
)
def pivot_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return G.pivot_count(orders, ["o_custkey"], "o_orderstatus", max_values=10)


@query(
    "agg_pivot_count_transposed",
    """
    SELECT o_orderpriority,
           nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS O,
           nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS F,
           nullif(count(*) FILTER (o_orderstatus = 'X'), 0) AS X
    FROM orders GROUP BY o_orderpriority
    """,
)
def pivot_count_transposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Values known beforehand: no job to find them; one that does not occur is all NULL.
    return G.pivot_count(
        table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus", ["O", "F", "X"]
    )


@query(
    "agg_pivot_count_null",
    """
    SELECT o_orderpriority,
           nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS F,
           nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS O,
           nullif(count(*) FILTER (o_orderstatus = 'P'), 0) AS "null"
    FROM orders GROUP BY o_orderpriority
    """,
)
def pivot_count_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("P"))
    )
    return G.pivot_count(orders, ["o_orderpriority"], "o_orderstatus", max_values=10)


@query(
    "agg_pivot_count_long",
    "SELECT l_suppkey, l_partkey AS part, count(*) AS lines FROM lineitem GROUP BY ALL",
)
def pivot_count_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As many values as there are parts: no bound on them, as they are rows.
    lines = table(spark, sf_dir, "lineitem")
    return G.pivot_count_long(lines, ["l_suppkey"], "l_partkey", "part", "lines")


@query(
    "agg_collect_list",
    """
    SELECT o_orderpriority, date, max(date) OVER (PARTITION BY o_orderpriority) AS max_date,
           row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS position
    FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS date
          FROM orders)
    WHERE date IS NOT NULL
    """,
)
def collect_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
    )
    groups = L.collect_groups(dated, ["o_orderpriority"], "date", "o_orderkey", LIST_CHUNK)
    return groups.select(
        "o_orderpriority", "start", "max_date", F.posexplode("date").alias("at", "date")
    ).select("o_orderpriority", "date", "max_date", (F.col("start") + F.col("at")).alias("position"))


@query(
    "agg_column_to_list",
    """
    SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, o_orderpriority AS priority
    FROM orders
    """,
)
def column_to_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lists = L.column_to_list(orders, "o_orderpriority", "o_orderkey", chunk_size=LIST_CHUNK)
    return lists.select("start", F.posexplode("o_orderpriority").alias("at", "priority")).select(
        (F.col("start") + F.col("at")).alias("position"), "priority"
    )


@query(
    "agg_two_columns_to_lists",
    """
    SELECT o_orderstatus, o_orderkey AS key, o_custkey AS customer,
           row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS position
    FROM orders
    """,
)
def two_columns_to_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = L.two_columns_to_lists(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        "o_custkey",
        "o_orderkey",
        ["o_orderstatus"],
        chunk_size=LIST_CHUNK,
    )
    pairs = F.posexplode(F.arrays_zip("o_orderkey", "o_custkey")).alias("at", "pair")
    return lists.select("o_orderstatus", "start", pairs).select(
        "o_orderstatus",
        F.col("pair.o_orderkey").alias("key"),
        F.col("pair.o_custkey").alias("customer"),
        (F.col("start") + F.col("at")).alias("position"),
    )


@query(
    "agg_list_by_text",
    """
    SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5(text), doc_id) - 1 AS position
    FROM documents
    """,
)
def list_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Ordered by a text, made unique by the id.
    keyed = table(spark, sf_dir, "documents").select(
        "lang", "doc_id", F.concat_ws("-", F.md5("text"), F.lpad(F.col("doc_id").cast("string"), 20, "0")).alias("k")
    )
    lists = L.column_to_list(keyed, "doc_id", "k", ["lang"], 100)
    return lists.select("lang", "start", F.posexplode("doc_id").alias("at", "doc_id")).select(
        "lang", "doc_id", (F.col("start") + F.col("at")).alias("position")
    )


@query(
    "agg_list_tied_order",
    """
    SELECT l_returnflag, l_quantity,
           row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) - 1 AS position
    FROM lineitem
    """,
)
def list_tied_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Fifty different quantities order all lines: the list of them is the same however ties fall.
    lines = table(spark, sf_dir, "lineitem")
    lists = L.columns_to_lists(
        lines, ["l_quantity", "l_orderkey", "l_linenumber"], "l_quantity", ["l_returnflag"], LIST_CHUNK
    )
    return lists.select(
        "l_returnflag", "start", F.posexplode("l_quantity").alias("at", "l_quantity")
    ).select("l_returnflag", "l_quantity", (F.col("start") + F.col("at")).alias("position"))


@query(
    "agg_list_one_value",
    """
    SELECT value, row_number() OVER (ORDER BY value) - 1 AS position
    FROM (SELECT CASE WHEN l_orderkey % 10 = 0 THEN l_returnflag || l_linenumber ELSE 'usual' END AS value FROM lineitem)
    """,
)
def list_one_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Nine rows in ten are equal in everything: they are counted, not shuffled, and listed by all tasks.
    value = F.when(F.col("l_orderkey") % 10 == 0, F.concat("l_returnflag", "l_linenumber")).otherwise("usual")
    lists = L.column_to_list(table(spark, sf_dir, "lineitem").select(value.alias("value")), "value", "value", chunk_size=LIST_CHUNK)
    return lists.select("start", F.posexplode("value").alias("at", "value")).select(
        "value", (F.col("start") + F.col("at")).alias("position")
    )
