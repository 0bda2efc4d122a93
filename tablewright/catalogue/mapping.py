"""Maps, dictionaries and nested values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.catalogue.registry import query, table
from tablewright.functions import maps as M
from tablewright.operators import lookups, maps
from tablewright.operators.lists import collect_groups, two_columns_to_map

PROPS_TYPE = "map<string,string>"
EVENT_NAMES = {"view": "Viewed", "click": "Clicked", "purchase": "Bought", "signup": "Joined"}


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their properties, and the value under the name of the event's type."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.map_concat(
            F.from_json("props", PROPS_TYPE), F.create_map("event_type", F.lit("yes"))
        ).alias("props"),
    )


@query(
    "map_get",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS missing FROM events",
)
def get(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", PROPS_TYPE)
    return table(spark, sf_dir, "events").select(
        "event_id",
        M.map_value(props, "k").alias("k"),
        M.map_value(props, "no such key").alias("missing"),
    )


@query(
    "map_distinct_keys",
    """
    SELECT DISTINCT key
    FROM (SELECT unnest(json_keys(props)) AS key FROM events
          UNION ALL SELECT event_type FROM events)
    """,
)
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maps.map_distinct_keys(properties(spark, sf_dir), "props")


@query(
    "map_to_columns_fixed",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS k,
           CASE WHEN event_type = 'click' THEN 'yes' END AS click,
           CAST(NULL AS VARCHAR) AS absent
    FROM events
    """,
)
def columns_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maps.map_to_columns(properties(spark, sf_dir), "props", ["k", "click", "absent"])


@query(
    "map_to_columns_discovered",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS k,
           CASE WHEN event_type = 'click' THEN 'yes' END AS click,
           CASE WHEN event_type = 'error' THEN 'yes' END AS error,
           CASE WHEN event_type = 'purchase' THEN 'yes' END AS purchase,
           CASE WHEN event_type = 'signup' THEN 'yes' END AS signup,
           CASE WHEN event_type = 'view' THEN 'yes' END AS view
    FROM events
    """,
)
def columns_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maps.map_to_columns(properties(spark, sf_dir), "props", max_keys=20)


@query(
    "map_nested_get",
    """
    SELECT o_orderkey, o_orderstatus AS status,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority,
           CAST(NULL AS VARCHAR) AS missing
    FROM orders
    """,
)
def nested_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Orders as nested text; those in progress lack the inner dictionary altogether.
    fields = F.when(
        F.col("o_orderstatus") != "P", F.create_map(F.lit("priority"), F.col("o_orderpriority"))
    )
    nested = F.to_json(F.struct(F.col("o_orderstatus").alias("status"), fields.alias("fields")))
    parsed = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.from_json(nested, "status string, fields map<string,string>").alias("order"),
    )
    order = F.col("order")
    return parsed.select(
        "o_orderkey",
        M.nested_value(order, "status").alias("status"),
        M.nested_value(order, "fields", "priority").alias("priority"),
        M.nested_value(order, "fields", "no such key").alias("missing"),
    )


@query(
    "map_lookup_literal",
    """
    SELECT event_id,
           CASE event_type WHEN 'view' THEN 'Viewed' WHEN 'click' THEN 'Clicked'
                           WHEN 'purchase' THEN 'Bought' WHEN 'signup' THEN 'Joined' END AS name
    FROM events
    """,
)
def lookup_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", M.translate_values(F.col("event_type"), EVENT_NAMES).alias("name")
    )


@query(
    "map_lookup_broadcast",
    """
    SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment AS segment
    FROM orders o
    LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON o.o_custkey = c.c_custkey
    """,
)
def lookup_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The dictionary is a table that grows with the data; it is broadcast only if it is small.
    dictionary = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lookups.map_values_from(
        orders, "o_custkey", dictionary, "c_custkey", "c_mktsegment", "segment"
    )


@query(
    "map_lookup_shuffled",
    """
    SELECT l.l_orderkey, l.l_linenumber, o.o_orderpriority AS priority
    FROM lineitem l
    LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l.l_orderkey = o.o_orderkey
    """,
)
def lookup_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As above with a bound of nothing: the way taken when the dictionary is too large.
    dictionary = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return lookups.map_values_from(
        lines,
        "l_orderkey",
        dictionary,
        "o_orderkey",
        "o_orderpriority",
        "priority",
        max_broadcast_bytes=0,
    )


@query(
    "map_from_two_columns",
    "SELECT o_custkey AS customer, max(o_totalprice) AS price FROM orders GROUP BY o_custkey",
)
def from_two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionaries = two_columns_to_map(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice")
    return dictionaries.select(F.explode("entries").alias("customer", "price"))


@query(
    "map_to_rows",
    """
    SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events
    WHERE json_exists(props, '$.k')
    UNION ALL SELECT event_id, event_type, 'yes' FROM events
    """,
)
def to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maps.map_to_rows(properties(spark, sf_dir), "props")


def squares(entries: int) -> dict[int, int]:
    return {n: n * n for n in range(entries)}


SQUARES_SQL = """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_partkey % 100 < {entries} THEN (l_partkey % 100) * (l_partkey % 100) END AS square
    FROM lineitem
    """


def squared(spark: SparkSession, sf_dir: str, entries: int) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") % 100).alias("rest")
    )
    return lookups.map_values(lines, "rest", squares(entries), "square").drop("rest")


@query("map_values_64_entries", SQUARES_SQL.format(entries=64))
def values_64(spark: SparkSession, sf_dir: str) -> DataFrame:
    return squared(spark, sf_dir, 64)


@query("map_values_65_entries", SQUARES_SQL.format(entries=65))
def values_65(spark: SparkSession, sf_dir: str) -> DataFrame:
    return squared(spark, sf_dir, 65)


@query(
    "map_lookup_hot_keys",
    """
    SELECT l_orderkey, l_linenumber, l_linenumber * 10 AS tens FROM lineitem
    """,
)
def lookup_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every key has a seventh of the rows or so; with a bound of nothing all but these would be shuffled.
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    numbers = lines.select("l_linenumber", (F.col("l_linenumber") * 10).alias("tens")).distinct()
    return lookups.map_values_from(
        lines, "l_linenumber", numbers, "l_linenumber", "tens", "tens", max_broadcast_bytes=0
    )


@query(
    "map_from_grouped_lists",
    """
    SELECT o_custkey AS customer, o_orderkey AS key,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS position
    FROM orders
    """,
)
def from_grouped_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A dictionary of lists: group to list, then (group, start) to that piece of it.
    lists = collect_groups(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "o_orderkey")
    pieces = lists.select(F.struct("o_custkey", "start").alias("piece"), F.col("o_orderkey").alias("keys"))
    entries = two_columns_to_map(pieces, "piece", "keys", on_repeated="fail").select(
        F.explode("entries").alias("piece", "keys")
    )
    return entries.select("piece", F.posexplode("keys").alias("at", "key")).select(
        F.col("piece.o_custkey").alias("customer"),
        "key",
        (F.col("piece.start") + F.col("at")).alias("position"),
    )
