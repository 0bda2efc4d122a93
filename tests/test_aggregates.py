from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablewright.operators import aggregates as G
from tests.helpers import bag, plan, values

N = 120


@pytest.fixture
def marks(spark):
    """Entity e, requirement r, and a flag that is NULL for some."""
    n = F.col("id")
    return spark.range(N).select(
        (n % 7).alias("e"), (n % 4).alias("r"), F.when(n % 5 != 0, F.when(n % 11 < 3, 1).otherwise(0)).alias("met")
    )


def rows_of(marks):
    return [tuple(r) for r in marks.collect()]


def test_mean_and_count(marks):
    flags = [m for _, _, m in rows_of(marks) if m is not None]
    assert G.column_mean(marks, "met").collect() == [(pytest.approx(sum(flags) / len(flags)),)]
    assert G.column_mean(marks, "met", "m").columns == ["m"]
    assert G.row_count(marks).collect() == [(N,)]


def test_group_max_sum_and_counts(marks):
    groups = {}
    for e, r, m in rows_of(marks):
        groups.setdefault((e, r), []).append(m)
    known = {k: [m for m in v if m is not None] for k, v in groups.items()}
    assert bag(G.group_max(marks, ["e", "r"], "met", "best")) == Counter(
        (*k, max(v, default=None)) for k, v in known.items()
    )
    assert bag(G.group_sum_count(marks, ["e", "r"], "met", "total", "n")) == Counter(
        (*k, sum(known[k]) if known[k] else None, len(v)) for k, v in groups.items()
    )
    assert bag(G.group_count(marks, ["e"])) == Counter(
        (e, n) for e, n in Counter(e for e, _, _ in rows_of(marks)).items()
    )


def test_all_met_counts_each_requirement_once(marks):
    some = marks.where("e < 3 or met = 1").where("e <> 2 or r = 1")
    rows = rows_of(some)
    wanted = [
        e
        for e in sorted({e for e, _, _ in rows})
        if all(any(m == 1 for f, q, m in rows if (f, q) == (e, r)) for r in {q for f, q, _ in rows if f == e})
    ]
    assert sorted(values(G.all_met(some, "e", "r", "met"))) == wanted
    assert 0 < len(wanted)


def test_distinct_values(marks):
    assert bag(G.distinct_values(marks, "met")) == {(0,): 1, (1,): 1, (None,): 1}


def test_pivot_count_agrees_with_pivot_null_included(marks):
    ours = G.pivot_count(marks, ["e"], "met", max_values=5)
    assert ours.columns == ["e", "0", "1", "null"]
    assert bag(ours) == bag(marks.groupBy("e").pivot("met", [0, 1, None]).count())
    turned = G.pivot_count(marks, ["met"], "e", [6, 0, 99])
    assert turned.columns == ["met", "6", "0", "99"]
    assert bag(turned) == bag(marks.groupBy("met").pivot("e", [6, 0, 99]).count())


def test_pivot_counts_first(marks):
    shown = plan(G.pivot_count(marks, ["e"], "r", list(range(200))))
    assert shown.count("Exchange hashpartitioning") == 2 and "partial_count" in shown


def test_long_pivot_has_no_bound(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), F.nullif(F.col("id"), F.lit(0)).alias("v"))
    long = G.pivot_count_long(df, ["g"], "v")
    assert long.columns == ["g", "value", "count"] and long.count() == 3000
    assert long.where("value is null").collect() == [(0, None, 1)]


def test_wide_pivots_are_bounded_and_named_apart(marks):
    with pytest.raises(ValueError, match="more than 2 distinct"):
        G.pivot_count(marks, ["e"], "met", max_values=2)
    with pytest.raises(ValueError, match="pivot_count_long"):
        G.pivot_count(marks, ["e"], "met")
    named_alike = marks.select(F.col("e").alias("1"), "met")
    with pytest.raises(ValueError, match="repeat column names"):
        G.pivot_count(named_alike, ["1"], "met", [0, 1])
    flags = marks.select("e", (F.col("met") == 1).alias("f"))
    assert G.pivot_count(flags, ["e"], "f", max_values=3).columns == ["e", "false", "true", "null"]


def test_dotted_names(spark):
    df = spark.range(6).select((F.col("id") % 2).alias("g.x"), F.col("id").alias("v.y"))
    assert bag(G.group_max(df, ["g.x"], "v.y", "m")) == {(0, 4): 1, (1, 5): 1}
    assert G.pivot_count(df, ["g.x"], "v.y", max_values=6).columns == ["g.x", *map(str, range(6))]


def test_values_and_cells_of_a_pivot_come_from_one_scan(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(60).select((F.col("id") % 3).alias("g"), (F.col("id") % 4).alias("v")).write.parquet(path)
    rows = G.pivot_count(spark.read.parquet(path), ["g"], "v", max_values=4)
    assert path not in plan(rows) and "FileScan parquet" in plan(rows)
    assert path in plan(G.pivot_count(spark.read.parquet(path), ["g"], "v", [0, 1, 2, 3]))
    assert bag(rows) == {(g, 5, 5, 5, 5): 1 for g in range(3)}
