"""Exact 80/10/10 split in hash order."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..options import SPLIT_SEED
from .numbering import numbered


def sizes(n: int) -> tuple[int, int, int]:
    """Rows of train, val and test; an empty part raises."""
    rest = math.ceil(0.2 * n)
    test = math.ceil(0.5 * rest)
    out = n - rest, rest - test, test
    if min(out) < 1:
        raise ValueError(f"{n} rows are too few to split")
    return out


def assign(df: DataFrame, key: str, seed: int = SPLIT_SEED) -> DataFrame:
    """df with ``split``: exact sizes, the same whatever the partitions.  Keys must be unique."""
    ranked = numbered(df.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))), ["_hash", key], "_rank")
    train, val, _ = sizes(ranked.count())
    part = F.when(F.col("_rank") <= train, "train").when(F.col("_rank") <= train + val, "val").otherwise("test")
    return ranked.withColumn("split", part).drop("_hash", "_rank")
