"""Global row numbers and fixed-size batches without gathering all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written


def numbered(df: DataFrame, order: list[str], name: str = "n") -> DataFrame:
    """df with its place in the order, from 1: range partitions are numbered by themselves and shifted by those before."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    parts = written(placed, "numbered").withColumn("_part", F.shiftright("_at", 33)).withColumn("_i", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at")
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_c"))
    shift = counts.withColumn("_shift", F.sum("_c").over(Window.orderBy("_part")) - F.col("_c")).drop("_c")  # a row for each partition
    return parts.join(F.broadcast(shift), "_part").withColumn(name, (F.col("_i") + F.col("_shift")).cast("long")).drop("_part", "_i", "_shift")


def batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """df with ``batch`` (from 0; all of ``size`` rows but the last), ``idx`` (from 1) and ``total``."""
    if size < 1:
        raise ValueError("a batch has at least one row")
    d = numbered(df, order, "idx")
    return d.withColumn("batch", F.floor((F.col("idx") - 1) / size)).withColumn("total", F.lit(df.count()).cast("long"))
