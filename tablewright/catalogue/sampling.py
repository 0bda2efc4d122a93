"""Ranks, samples and sorting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.catalogue.registry import query, table
from tablewright.operators import sampling as W
from tablewright.operators.projections import sort_ascending

SEED = 42
SAMPLE_ROWS = 30


@query(
    "win_rank_top_k",
    """
    SELECT o_orderkey, o_orderpriority, o_totalprice, rank::INTEGER AS rank
    FROM (SELECT *, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS rank
          FROM orders)
    WHERE rank <= 3
    """,
)
def rank_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return W.rank_top_k(orders, ["o_orderpriority"], "o_totalprice", 3)


@query(
    "win_rank_top_k_ties",
    """
    SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, rank::INTEGER AS rank
    FROM (SELECT *, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS rank
          FROM lineitem)
    WHERE rank <= 3
    """,
)
def rank_top_k_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rank 1 is shared by a fiftieth of all rows.
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"
    )
    return W.rank_top_k(lines, ["l_returnflag"], "l_quantity", 3, descending=False)


@query(
    "win_rank_top_k_global",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, rank::INTEGER AS rank
    FROM (SELECT *, rank() OVER (ORDER BY l_quantity DESC) AS rank FROM lineitem)
    WHERE rank <= 5
    """,
)
def rank_top_k_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Without groups; rank 1 is shared by a fiftieth of all rows.
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return W.rank_top_k(lines, [], "l_quantity", 5)


@query(
    "sample_top_k_large",
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    ORDER BY md5('7-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey),
             l_orderkey, l_linenumber, l_partkey
    LIMIT 15000
    """,
)
def sample_top_k_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return W.sample_top_k(lines, 15_000, ["l_orderkey", "l_linenumber", "l_partkey"], 7)


@query(
    "sample_top_k_seeded",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY md5('42-' || o_orderkey), o_orderkey LIMIT 30
    """,
)
def sample_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return W.sample_top_k(orders, SAMPLE_ROWS, ["o_orderkey"], SEED)


@query(
    "sample_without_replacement",
    """
    SELECT event_id, user_id FROM events
    ORDER BY md5('42-' || event_id), event_id LIMIT 30
    """,
)
def sample_without_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return W.sample_without_replacement(events, SAMPLE_ROWS, ["event_id"], SEED)


@query(
    "sample_large_without_replacement",
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    ORDER BY md5('42-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey),
             l_orderkey, l_linenumber, l_partkey
    LIMIT 20000
    """,
)
def sample_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Too many rows to merge in one task.
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return W.sample_without_replacement(
        lines, 20_000, ["l_orderkey", "l_linenumber", "l_partkey"], SEED
    )


@query("sort_ascending", "SELECT o_orderdate, o_orderkey FROM orders ORDER BY 1, 2")
def ascending(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return sort_ascending(orders, "o_orderdate", "o_orderkey")
