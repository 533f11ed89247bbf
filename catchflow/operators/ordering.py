"""Positions and running totals in a total order without a single-task window.

The rows are range-partitioned on the order columns and the partition id is materialised (a
checkpoint in the shared folder, so every later use sees the same layout). Each partition numbers
(or sums) its own rows with a window partitioned by that id; the per-partition totals (one row per
partition) give each partition's offset. No task ever holds more than one range partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)


def _offsets(s: DataFrame, amount) -> DataFrame:
    per = s.groupBy("_pid").agg(F.sum(amount).alias("_tot"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    return per.select("_pid", F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off"))


def ordered_index(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """0-based position of every row in the order of ``order`` (rows should be distinct on it)."""
    s = _ranged(df, order)
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) - 1
    s = s.withColumn("_local", local)
    offs = _offsets(s, F.lit(1))
    return (s.join(F.broadcast(offs), "_pid")
             .select(*df.columns, (F.col("_off") + F.col("_local")).cast("long").alias(name)))


def running_sum(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Inclusive running total of ``value`` in the order of ``order``."""
    s = _ranged(df, order)
    local = F.sum(value).over(Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    s = s.withColumn("_local", local)
    offs = _offsets(s, F.col(value))
    return s.join(F.broadcast(offs), "_pid").select(*df.columns, (F.col("_off") + F.col("_local")).alias(name))
