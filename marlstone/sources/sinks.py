"""Tables out: staged batches, manifests, count file, the hash index, splits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import StorageError
from .scratch import exists, filesystem, listing, work_dir


def delete(spark: SparkSession, path: str) -> None:
    fs, of = filesystem(spark, path)
    fs.delete(of(path), True)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """A batch is a folder of its own: writing it again replaces it, so a replay adds nothing."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, batch_id bigint" if "batch_id" not in schema else schema).parquet(path)


def write_manifests(samples: DataFrame, root: str) -> None:
    """True JSON lines in manifests/*.jsonl: written aside, then moved in under names of their own."""
    spark = samples.sparkSession
    cols = ["image_path", "output_text", "chandra_raw", "source", "img_w", "img_h"]
    aside = work_dir(spark, "manifests")
    samples.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value")).write.option("compression", "none").text(aside)
    fs, path = filesystem(spark, root)
    fs.mkdirs(path(f"{root}/manifests"))
    name = uuid.uuid4().hex
    for i, part in enumerate(sorted(x for x in listing(spark, aside) if x.startswith("part-"))):
        move(spark, f"{aside}/{part}", f"{root}/manifests/{name}-{i:05d}.jsonl")
    delete(spark, aside)


def move(spark: SparkSession, source: str, target: str) -> None:
    """One file or folder, by rename; across file systems by copy."""
    fs, path = filesystem(spark, source)
    to, to_path = filesystem(spark, target)
    if fs.getUri().equals(to.getUri()):
        if not fs.rename(path(source), to_path(target)):
            raise StorageError(f"can't move {source} to {target}")
    else:
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, path(source), to, to_path(target), True, spark.sparkContext._jsc.hadoopConfiguration())


def publish(spark: SparkSession, staged: str, published: str, at: int) -> int:
    """Publish the batches of ``staged`` that are not published yet, once they have ``at`` rows; returns how many.

    They are written aside and moved to ``published/upto=<last batch>`` in one
    rename, and what is published is told by that name: a run that dies in
    between leaves nothing half published, and a replay adds nothing.
    """
    if not exists(spark, staged):
        return 0
    done = max((int(x.split("=")[1]) for x in (listing(spark, published) if exists(spark, published) else []) if x.startswith("upto=")), default=-1)
    rows = spark.read.parquet(staged).filter(F.col("batch_id") > done)
    n, last = rows.agg(F.count(F.lit(1)), F.max("batch_id")).first()
    if n < max(1, at):
        return 0
    aside = f"{published}/_{uuid.uuid4().hex}"
    rows.write.parquet(aside)
    move(spark, aside, f"{published}/upto={last}")
    return n


def publish_splits(df: DataFrame, path: str) -> None:
    """All splits in one job."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
