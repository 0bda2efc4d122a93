"""Values that make up a large share of a column, by one pass and sketches that can be merged."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Items that a sketch tracks for each one that may be that frequent: its error is then half the share at most.
TRACKED_PER_ITEM = 8
# Sketches of tasks are merged in so many groups first, so that no task gets all of them.
MERGE_GROUPS = 64
# The most items that a sketch of Spark's tracks.
MAX_TRACKED = 1_000_000


def partition_share(spark: SparkSession, most: float = 1.0) -> float:
    """Half of what a shuffle partition has of all rows; ``most`` if that is less."""
    return min(most, 1 / (2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def frequent_hashes(df: DataFrame, hashed: Column, share: float) -> list[int]:
    """Every value of the long ``hashed`` that at least ``share`` of all rows have, and none with less than half of it.

    One pass: each task keeps a frequent-items sketch of bounded size, and sketches are merged. At most ``2 / share``
    numbers reach the driver.
    """
    wanted = math.ceil(1 / share)
    tracked = min(MAX_TRACKED, 1 << (TRACKED_PER_ITEM * wanted - 1).bit_length())
    sketches = (
        df.select(hashed.alias("h"), F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("g"))
        .groupBy("g")
        .agg(F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("rows"))
    )
    # By a constant: a task without sketches then has none to hand on.
    merged = sketches.withColumn("all", F.lit(0)).groupBy("all").agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {min(2 * wanted, tracked)})").alias("items"),
        F.sum("rows").alias("rows"),
    ).first()
    if merged is None:
        return []
    return [i["item"] for i in merged["items"] if i["count"] >= share * merged["rows"] / 2]
