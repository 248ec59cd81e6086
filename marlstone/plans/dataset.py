"""Manifests to a deduplicated, split dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import neardup, split
from ..options import HAMMING_BELOW
from ..sources import files, sinks


def build(samples: DataFrame, signatures: DataFrame, index: DataFrame | None = None, below: int = HAMMING_BELOW) -> DataFrame:
    """Samples that the greedy choice keeps.

    ``signatures``: image_path, sig; a sample without one is kept.  ``index``:
    key, sig; a sample's own key does not count against it.
    """
    if samples.isEmpty():
        raise RuntimeError("No manifest files found in the dataset.")
    s = signatures.select(F.col("image_path").alias("s_path"), "sig")
    # of samples with one path the least counts, whatever the tasks' order
    rest = [F.col(c) for c in samples.columns if c != "image_path"]
    d = samples.groupBy("image_path").agg(F.min(F.struct(*rest)).alias("s")).select("image_path", "s.*").join(s, F.col("image_path") == F.col("s_path"), "left").drop("s_path")
    if index is not None:
        index = index.join(d.select(F.col("image_path").alias("o_path")), F.col("key") == F.col("o_path"), "left_anti")
    out = neardup.greedy(d, "image_path", index, below).drop("sig")
    if out.isEmpty():
        raise RuntimeError("No unique samples after deduplication.")
    return out


def build_from(spark: SparkSession, root: str, signatures: DataFrame, index: DataFrame | None = None) -> DataFrame:
    return build(files.manifests(spark, root), signatures, index)


def split_and_publish(df: DataFrame, path: str, key: str = "image_path") -> DataFrame:
    """Write train, val and test; returns the rows of each."""
    sinks.publish_splits(split.assign(df, key), path)
    return df.sparkSession.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n"))
