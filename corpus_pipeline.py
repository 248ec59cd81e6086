"""A training-data pipeline over ``documents``: filter, deduplicate, decontaminate, mask, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet and reads it again for the next.  All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import common, decontaminate, jaccard, packing, pii, quality, tokens


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_SPENT = threading.local()  # scratch folders of the thread's stages: their number -> folders


def _stage(number: int) -> Callable[[Stage], Stage]:
    """A stage whose intermediate tables go when a later one begins: by then its result has been written."""

    def add(stage: Stage) -> Stage:
        @wraps(stage)
        def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            spent = _SPENT.__dict__.setdefault("by_stage", {})
            for earlier in range(1, number):
                common.sweep(spark, spent.get(earlier, []), docs)
            with common.noted(spent.setdefault(number, [])):
                return stage(spark, docs, sf_dir)

        return run

    return add


@_stage(1)
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.filter_quality(docs)


@_stage(2)
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-copies connect (five-word shingles, 80 percent) the one with the smallest id stays."""
    return jaccard.keep_one(docs, k=5, percent=80)


@_stage(3)
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage(4)
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@_stage(5)
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their place in a sequence of at most 1024 tokens."""
    return packing.pack_documents(docs, tokens.public_vocabulary(), capacity=1024, end_id=2)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: No SQL: near-duplicate components, substitution-tolerant overlaps, checksums and byte-level BPE are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = common.Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        scratch.drop(before)
        scratch.release()
        before = docs
    return docs
