"""Thresholds of the engine; a job passes its own Options, or sets spark.marlstone.* keys."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

#: Fixed values that results depend on.
SUPPORTED = (".pdf", ".png", ".jpg", ".jpeg", ".tiff", ".bmp")
SOURCE_NAME = "colab-ingest"
LOC_SCALE = 500
HAMMING_BELOW = 8
SPLIT_SEED = 42


@dataclass(frozen=True)
class Options:
    batch_size: int = 100
    commit_every: int = 1000
    ready_at: int = 5000
    hamming_below: int = HAMMING_BELOW
    dpi: int = 150
    poll_seconds: int = 5
    prefetch: int = 300
    max_tokens: int = 1024

    def __post_init__(self) -> None:
        if self.batch_size < 1:
            raise ValueError("batch_size must be at least 1")

    @classmethod
    def from_conf(cls, spark: SparkSession) -> Options:
        found = {f.name: spark.conf.get(f"spark.marlstone.{f.name}", None) for f in fields(cls)}
        return cls(**{k: int(v) for k, v in found.items() if v is not None})
