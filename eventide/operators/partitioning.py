"""Explicit partitioning: custom partitioner, replication, parallelism."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_by_expr(df: DataFrame, num_partitions: int, partition_id: Column) -> DataFrame:
    """Custom partitioner: each row goes to partition ``partition_id`` (mod n)."""
    return df.repartitionById(num_partitions, partition_id.cast("int"))


def partition_summary(df: DataFrame, num_partitions: int, partition_id: Column, value_col: str,
                      out_part: str = "part") -> DataFrame:
    """Rows and sum of ``value_col`` per partition of the custom partitioner.

    Rows are pre-aggregated where they are read — one partial per (input
    partition, target partition) — and only those partials are routed by
    the custom partitioner, so the data itself never funnels into the
    ``num_partitions`` target tasks.  ``spark_partition_id`` is read right
    after the routing exchange.
    """
    partial = (df.select(F.spark_partition_id().alias("_src"), partition_id.cast("int").alias("_target"),
                         F.col(value_col))
               .groupBy("_src", "_target")
               .agg(F.count(F.lit(1)).alias("_n"), F.sum(value_col).alias("_s")))
    routed = partition_by_expr(partial, num_partitions, F.col("_target"))
    tagged = routed.select(F.spark_partition_id().alias(out_part), "_n", "_s")
    return (tagged.groupBy(out_part)
            .agg(F.sum("_n").alias("n_rows"), F.sum("_s").alias("sum_value")))


def replicate(df: DataFrame, copies: int, out: str = "replica") -> DataFrame:
    """Broadcast partitioning: every row is sent to each of ``copies`` consumers.

    Implemented as a generator (no join): each row yields ``copies`` rows
    tagged ``0..copies-1``.
    """
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def with_parallelism(df: DataFrame, n: int, keys: list[str] | None = None) -> DataFrame:
    """Set the parallelism of the next stage (hash on ``keys`` or round-robin)."""
    return df.repartition(n, *keys) if keys else df.repartition(n)
