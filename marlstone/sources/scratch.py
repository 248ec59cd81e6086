"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..errors import StorageError


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``.  A local session where it is unset gets a temporary folder; on a cluster that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise StorageError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="marlstone-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once: its lineage ends here, and an executor lost later costs nothing before it."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filesystem(spark: SparkSession, path: str):
    """The file system of a path, and the class of its paths."""
    of = spark._jvm.org.apache.hadoop.fs.Path
    return of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), of


def exists(spark: SparkSession, path: str) -> bool:
    fs, of = filesystem(spark, path)
    return fs.exists(of(path))


def listing(spark: SparkSession, path: str) -> list[str]:
    fs, of = filesystem(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(of(path))]
