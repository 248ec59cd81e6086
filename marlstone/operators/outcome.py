"""Counts, thresholds and progress over outcomes; metrics over an events table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stored(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def ready(df: DataFrame, at: int) -> DataFrame:
    """``n`` and whether it reaches the threshold."""
    return df.agg(F.count(F.lit(1)).alias("n")).withColumn("ready", F.col("n") >= at)


def saved(df: DataFrame, status: str = "status") -> DataFrame:
    return df.agg(F.count_if(F.col(status) == "saved").alias("saved"))


def by_status(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def reduction(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: how many rows a step was given and how many it left."""
    both = before.select(F.lit(True).alias("given")).unionByName(after.select(F.lit(False).alias("given")))
    return both.agg(F.count_if("given").alias("n_in"), F.count_if(~F.col("given")).alias("n_out"))


def progress(done: DataFrame, totals: DataFrame, source: str = "source_file") -> DataFrame:
    """Remaining pages of each source; a source without pages is done at once."""
    d = done.groupBy(F.col(source).alias("d_source")).agg(F.count(F.lit(1)).alias("dispatched"))
    j = totals.join(d, F.col(source) == F.col("d_source"), "left").withColumn("remaining", F.col("total") - F.coalesce("dispatched", F.lit(0)))
    return j.select(source, "total", "remaining", F.when(F.col("remaining") <= 0, "done").otherwise("queued").alias("state"))


def histogram(df: DataFrame, value: str, edges: Sequence[float], *keys: str) -> DataFrame:
    """Cumulative buckets, sum and count of a latency column."""
    v = F.col(value)
    cols = [F.count_if(v <= e).alias(f"le_{str(e).replace('.', '_')}") for e in edges]
    return df.groupBy(*keys).agg(*cols, F.sum(v).alias("total"), F.count(v).alias("n"))


def gauge(df: DataFrame, value: str, at: Column, *keys: str) -> DataFrame:
    """Last value of each key."""
    return df.groupBy(*keys).agg(F.max_by(F.col(value), at).alias("last"))
