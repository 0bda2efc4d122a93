import re

import pytest

import __spark_entry__ as entry_points
from tablewright.catalogue import REGISTRY
from tests import oracle
from tests.helpers import plan

PYTHON_QUERIES = {"udf_title", "udf_title_sql"}


@pytest.fixture(scope="session")
def connection(sf_dir):
    return oracle.connect(sf_dir)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["id", "name", "steps_to_desk"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry_points.queries()) and set(REGISTRY) <= set(entry_points.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_gives_what_its_sql_gives(spark, connection, sf_dir, name):
    query = REGISTRY[name]
    df = query.run(spark, sf_dir)
    assert oracle.spark_types(df) == oracle.sql_types(connection, query.sql)
    assert oracle.spark_result(df) == oracle.sql_result(connection, query.sql)
    shown = plan(df)
    assert not re.search("CartesianProduct|NestedLoop|BatchEvalPython", shown)
    assert ("ArrowEvalPython" in shown) == (name in PYTHON_QUERIES)


@pytest.mark.parametrize(
    "name", [n for n in sorted(REGISTRY) if re.search("seeded|sample|choice|job|lists?$|rank", n)]
)
def test_repeated_runs_agree(spark, sf_dir, name):
    first, second = (oracle.spark_result(REGISTRY[name].run(spark, sf_dir)) for _ in range(2))
    assert first == second


def test_sorted_output_is_in_order(spark, sf_dir):
    rows = [tuple(r) for r in REGISTRY["sort_ascending"].run(spark, sf_dir).collect()]
    assert rows == sorted(rows)
    names = REGISTRY["columns_sorted_desc"].run(spark, sf_dir).columns
    assert names == sorted(names, reverse=True)


# What the physical plan of a query has to show, and how many shuffles it may take.
PLANS = {
    "filter_compare": ("PushedFilters: [IsNotNull(o_totalprice), GreaterThanOrEqual(o_totalprice,400000.0)]", 0),
    "sql_view_filter": ("GreaterThanOrEqual(l_extendedprice,60000.0)", 0),
    "proj_select_list": ("ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,", 0),
    "filter_partition_conj": ("PartitionFilters: [isnotnull(o_orderstatus", 0),
    "src_parquet_partition": ("PartitionFilters: [(o_orderstatus", 0),
    "agg_group_sum_count": ("partial_sum(l_linenumber", 1),
    # The counts, from which values and cells both come, are made in a job of their own.
    "agg_pivot_count": ("partial_max", 1),
    "agg_all_requirements_met": ("partial_min", 2),
    "agg_distinct": ("HashAggregate", 1),
    # What is set aside is planned in jobs of their own.
    "agg_column_to_list": ("Generate posexplode", 2),
    "agg_two_columns_to_lists": ("Generate posexplode", 3),
    "agg_collect_list": ("Generate posexplode", 4),
    "map_from_two_columns": ("Window", 1),
    "map_lookup_broadcast": ("BroadcastHashJoin", 1),
    "map_lookup_shuffled": ("SortMergeJoin", 3),
    "map_lookup_hot_keys": ("BroadcastHashJoin", 6),
    "map_values_65_entries": ("BroadcastHashJoin", 0),
    "map_lookup_literal": ("Project", 0),
    "win_rank_top_k": ("BroadcastHashJoin", 0),
    "sample_top_k_seeded": ("TakeOrderedAndProject", 0),
    "sample_without_replacement": ("TakeOrderedAndProject", 0),
    "diff_rows_multiset": ("partial_sum", 1),
    "diff_rows_keyed": ("BroadcastHashJoin", 3),
    "reconcile_summary": ("partial_avg", 1),
    "text_flatmap_words": ("partial_count", 1),
    "rename_mapping": ("Project", 0),
    "str_remove_non_word": ("regexp_replace", 0),
}


@pytest.mark.parametrize("name", sorted(PLANS))
def test_plan(spark, sf_dir, name):
    fragment, shuffles = PLANS[name]
    shown = plan(REGISTRY[name].run(spark, sf_dir))
    assert fragment in shown
    assert len(re.findall(r"Exchange (?:hash|range|Single)", shown)) <= shuffles
