import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.operators import sampling as W
from tests.helpers import bag, plan, values


def brute_ranks(rows, k, descending):
    """Rows (g, x) with their rank; NULLs last when descending, first when ascending."""
    out = []
    for g, x in rows:
        peers = [y for h, y in rows if h == g]

        def before(y):
            if y is None or x is None:
                return (x is None and y is not None) if descending else (y is None and x is not None)
            return y > x if descending else y < x

        rank = 1 + sum(before(y) for y in peers)
        if rank <= k:
            out.append((g, x, rank))
    return Counter(out)


@pytest.mark.parametrize("bound", [64 << 20, 0])
@pytest.mark.parametrize("descending", [True, False])
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 4))),
        min_size=1,
        max_size=30,
    )
)
def test_rank_top_k_against_brute_force(spark, bound, descending, rows):
    df = spark.createDataFrame(rows, "g string, x int")
    got = W.rank_top_k(df, ["g"], "x", 3, descending, max_broadcast_bytes=bound)
    assert bag(got) == brute_ranks(rows, 3, descending)


def test_rank_top_k_with_a_tie_of_a_third_of_all_rows(spark):
    x = F.when(F.col("id") % 3 == 0, 1000).otherwise(F.col("id") % 1000)
    df = spark.range(9000).select("id", F.lit("g").alias("g"), x.alias("x"))
    for bound in (64 << 20, 0):
        got = bag(W.rank_top_k(df, ["g"], "x", 3, max_broadcast_bytes=bound).groupBy("x", "rank").count())
        assert got == {(1000, 1, 3000): 1}


def test_ranks_are_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    shown = plan(W.best_ranks(df, ["g"], "id", 3, True, "rank"))
    assert shown.count("WindowGroupLimit") == 2
    assert shown.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("descending", [True, False])
def test_rank_of_all_rows(spark, descending):
    df = spark.range(90).select("id", F.nullif(F.col("id") % 9, F.lit(4)).alias("x"))
    rows = [("all", r.x) for r in df.collect()]
    wanted = Counter({(x, rank): n for (_, x, rank), n in brute_ranks(rows, 15, descending).items()})
    for bound in (64 << 20, 0):
        ranked = W.rank_top_k(df, [], "x", 15, descending, max_broadcast_bytes=bound)
        assert bag(ranked.select("x", "rank")) == wanted
    shown = plan(W.best_ranks(df, [], "x", 15, descending, "rank"))
    assert "TakeOrderedAndProject" in shown


def test_unseeded_sample_has_its_size(spark):
    df = spark.range(40)
    ids = values(W.sample_top_k(df, 13))
    assert len(ids) == len(set(ids)) == 13
    copies = df.select(F.lit(1).alias("x"))
    assert W.sample_top_k(copies, 7).count() == 7 and W.sample_top_k(copies, 100).count() == 40


def test_seeded_sample_does_not_depend_on_partitions(spark):
    df = spark.range(2000)
    first = bag(W.sample_top_k(df, 50, ["id"], 42))
    assert first == bag(W.sample_top_k(df.repartition(7, "id"), 50, ["id"], 42))
    assert first != bag(W.sample_top_k(df, 50, ["id"], 43))
    assert "TakeOrderedAndProject" in plan(W.sample_top_k(df, 50, ["id"], 42))


def test_a_large_sample_is_not_merged_in_one_task(spark):
    df = spark.range(30_000)
    for seed in (1, None):
        sample = W.sample_top_k(df, 20_000, ["id"], seed)
        large = [int(n) for n in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", plan(sample))]
        assert sample.count() == 20_000 and all(n < 1000 for n in large)


@pytest.mark.parametrize("k", [0, 1, 200, 999, 1999, 2000, 5000])
@pytest.mark.parametrize("prefixes", [1, 1 << 16])
def test_large_samples_are_the_same_rows(spark, monkeypatch, k, prefixes):
    monkeypatch.setattr(W, "PREFIXES", prefixes)
    df = spark.range(2000)
    small = bag(W.sample_without_replacement(df, k, ["id"], 42, merged_rows=10_000))
    large = bag(W.sample_without_replacement(df, k, ["id"], 42, merged_rows=-1))
    assert small == large and sum(large.values()) == min(k, 2000)


@pytest.mark.parametrize("seed", range(4))
def test_large_sample_with_many_copies_of_a_key(spark, seed):
    # The first guess goes wrong if a third of the rows have one hash.
    df = spark.range(6000).select(F.when(F.col("id") < 2000, 5).otherwise(F.col("id")).alias("id"))
    for k in (300, 1500, 5999):
        got = W.sample_without_replacement(df, k, ["id"], seed, merged_rows=-1)
        assert bag(got) == bag(W.sample_top_k(df, k, ["id"], seed))


def test_a_large_sample_sets_its_rows_aside_once(spark, monkeypatch):
    written = []
    aside = W.set_aside

    def kept(df):
        written.append(aside(df))
        return written[-1]

    monkeypatch.setattr(W, "set_aside", kept)
    assert W.sample_without_replacement(spark.range(40_000), 10_000, ["id"], 3, merged_rows=-1).count() == 10_000
    assert len(written) == 1 and written[0].count() < 10_800


def test_a_sample_needs_a_key(spark):
    with pytest.raises(ValueError, match="unique key"):
        W.sample_top_k(spark.range(3), 1, [], 1)
