"""Connected components of a graph whose edges stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """One row per node of ``edges`` (columns ``a``, ``b``): ``node`` and ``label``, the smallest node reachable.

    Alternates large-star and small-star steps until nothing changes; each step hangs nodes under the smallest
    neighbour they have, so chains shorten by a factor and hubs are never gathered. Loops and repeated edges do
    not matter; edges with a NULL end are left out. No edges give no rows.
    """
    pairs = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct(),
        "edges",
    )
    before = None
    while (now := _state(pairs)) != before:
        before = now
        pairs = written(_small_star(_large_star(pairs)), "stars")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)


def _state(pairs: DataFrame) -> tuple:
    """What two sets of pairs that differ do not share."""
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20)"))).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node under the smallest of the node and its neighbours."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # The minima are written, so that the join has a plain shuffle on both sides and a hub's rows can be split.
    smallest = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "minima")
    hung = both.join(smallest, "a").where(F.col("b") > F.col("a"))
    return written(hung.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")


def _small_star(pairs: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours under the smallest of these."""
    smallest = written(pairs.groupBy("a").agg(F.min("b").alias("m")), "minima")
    hung = pairs.join(smallest, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct()
