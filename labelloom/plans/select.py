"""Exact quotas per group without a task per group, and positions without a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import saved, small

#: Hex digits of the hash that name a bucket.
DIGITS = 3


def within_quota(df: DataFrame, group: str, quotas: DataFrame, h: Column, *ties: str, flag: str = "selected") -> DataFrame:
    """df with a boolean column: the row is among the first `quota` of its group by (h, ties).

    quotas(group, quota); groups without one select nothing. h is a hex string, evenly spread.
    Counts per (group, bucket of h) find the bucket in which a group's quota ends; whole
    buckets before it are in, and only that bucket's rows are ranked.
    """
    df = df.withColumn("_h", h).withColumn("_bucket", F.conv(F.substring("_h", 1, DIGITS), 16, 10).cast("int"))
    up_to = W.partitionBy(group).orderBy("_bucket")
    counts = df.groupBy(group, "_bucket").agg(F.count("*").alias("_n")).withColumn("_sum", F.sum("_n").over(up_to))
    ends = counts.join(quotas.select(group, F.col("quota").alias("_quota")), group).where("_sum > _quota")
    # the bucket in which the quota ends, and what is left of it there; groups that fit whole have none
    ends = ends.groupBy(group).agg(F.min(F.struct("_bucket", (F.col("_quota") - F.col("_sum") + F.col("_n")).alias("_left"))).alias("_end"))
    limits = small(quotas.select(group).distinct().join(ends, group, "left").select(group, F.coalesce("_end._bucket", F.lit(16**DIGITS)).alias("_at"), F.coalesce("_end._left", F.lit(0)).alias("_left")))
    at = df.join(limits, group, "left").withColumn("_at", F.coalesce("_at", F.lit(-1)))
    sure = at.where("_bucket <> _at").withColumn(flag, F.col("_bucket") < F.col("_at"))
    edge = at.where("_bucket = _at").withColumn(flag, F.row_number().over(W.partitionBy(group, "_bucket").orderBy("_h", *ties)) <= F.col("_left"))
    return sure.unionByName(edge).drop("_h", "_bucket", "_at", "_left")


def numbered(df: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """df with its place (from 0) in the given order: a range-partitioned sort and the partitions' offsets.

    The sorted table is written, as range boundaries are sampled and must not be found twice;
    what is returned reads that table, so it need not be saved again.
    """
    cols = [F.col(c) for c in order]
    kept = saved(df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_id", F.monotonically_increasing_id()))
    kept = kept.withColumn("_part", F.shiftright("_id", 33))
    sizes = kept.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = saved(sizes.select("_part", (F.sum("_n").over(W.partitionBy(F.lit(1)).orderBy("_part")) - F.col("_n")).alias("_before")).coalesce(1))  # a row a partition
    return kept.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id", "_part", "_before")


def top_per_group(df: DataFrame, group: str, k: int, *order: Column, key: str = "key", salts: int = 64) -> DataFrame:
    """The first k rows of each group in the given order, with their rank: k are kept of each salted part first, so that no task ranks a whole group."""
    part = W.partitionBy(group, "_salt").orderBy(*order)
    trimmed = df.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts))).withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= k)
    return trimmed.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(*order)).cast("bigint")).where(F.col("rank") <= k).drop("_salt", "_r")
