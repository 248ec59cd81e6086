"""Streaming ingestion: new files in, batches of fixed size out, count-triggered commits.

Offsets live in the checkpoint; a trigger that runs again writes the same
batch folders again.  Rows short of a full batch wait in a pending table until
later files fill it, or the stream is drained.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..errors import GateError
from ..functions import text
from ..operators import outcome
from ..operators.numbering import numbered
from ..options import Options
from ..plans import ingest
from ..schemas import OUTCOME
from ..sources import files, sinks
from ..sources.scratch import exists, filesystem, listing, written

log = logging.getLogger(__name__)
Batch = Callable[[DataFrame, int], None]


def tumbling(root: str, order: list[str], size: int, fire: Batch) -> Batch:
    """A foreachBatch function that fires exact batches of ``size`` rows in order.

    State is versioned by trigger: trigger n reads what trigger n - 1 left, so
    a replay starts from the same rows.
    """

    def run(rows: DataFrame, trigger: int) -> None:
        spark = rows.sparkSession
        before = f"{root}/pending/{trigger - 1}"
        first = 0
        if trigger and exists(spark, before):
            held = spark.read.parquet(before)
            first = spark.read.parquet(f"{root}/next/{trigger - 1}").first()["next"]
            rows = rows.unionByName(held)
        d = written(numbered(rows, order, "_n"), "pending")
        full = d.count() // size
        if full:
            fire(d.filter(F.col("_n") <= full * size).withColumn("batch", F.lit(first) + F.floor((F.col("_n") - 1) / size)).drop("_n"), trigger)
        d.filter(F.col("_n") > full * size).drop("_n").write.mode("overwrite").parquet(f"{root}/pending/{trigger}")
        spark.createDataFrame([(first + full,)], "next bigint").write.mode("overwrite").parquet(f"{root}/next/{trigger}")

    return run


def fire_rest(spark: SparkSession, root: str, fire: Batch) -> None:
    """Fire what is pending as a last, short batch; under a negative number, so no trigger's batch is replaced."""
    if not exists(spark, f"{root}/next"):
        return
    last = max(int(x) for x in listing(spark, f"{root}/next"))
    held = written(spark.read.parquet(f"{root}/pending/{last}"), "rest")
    if held.isEmpty():
        return
    first = spark.read.parquet(f"{root}/next/{last}").first()["next"]
    fire(held.withColumn("batch", F.lit(first).cast("long")), -last - 1)
    held.limit(0).write.mode("overwrite").parquet(f"{root}/pending/{last}")
    spark.createDataFrame([(first + 1,)], "next bigint").write.mode("overwrite").parquet(f"{root}/next/{last}")


def start(stream: DataFrame, fire: Batch, checkpoint: str, options: Options = Options(), available_now: bool = False) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(fire).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{options.poll_seconds} seconds")).start()


def drain(query: StreamingQuery, root: str | None = None, fire: Batch | None = None) -> None:
    """Finish what has arrived, then stop; with ``root`` and ``fire`` of a ``tumbling`` also what is pending."""
    if query.isActive:
        query.processAllAvailable()
        query.stop()
    query.awaitTermination()
    if root and fire:
        fire_rest(SparkSession.active(), root, fire)


def ingest_batch(root: str, make, hashes, options: Options = Options(), render: files.Renderer = files._render_with_library, archive_to: str | None = None) -> Batch:
    """A foreachBatch function: files to pages, without near duplicates, recognised, committed under the trigger's number.

    A file that can't be rendered and a page that fails have an outcome with
    their error, and files a row in ``failed``; the rest of the batch goes on.
    Once ``commit_every`` saved pages wait, they are published.  With
    ``archive_to``, the input files of the trigger before, which can't run
    again any more, move there.
    """

    def run(found: DataFrame, trigger: int) -> None:
        spark = found.sparkSession
        if archive_to and trigger:
            archive(spark, root, archive_to, trigger - 1)
        pages = written(files.pages(found, options.dpi, render), "pages")
        lost = pages.filter("error is not null").select("source_file", "error")
        totals = pages.groupBy("source_file").agg(F.count(F.lit(1)).alias("total"))
        done = written(ingest.outcomes(hashes(pages), ingest.index_before(spark, root, trigger), make, options), "outcomes")
        saved = ingest.commit(done, root, trigger)
        sinks.write_batch(lost, f"{root}/failed", trigger)
        sinks.write_batch(totals, f"{root}/totals", trigger)
        published = sinks.publish(spark, f"{root}/samples", f"{root}/published", options.commit_every)
        log.info("batch %d: %d saved, %d published", trigger, saved, published)

    return run


def archive(spark: SparkSession, root: str, target: str, trigger: int) -> int:
    """Move a trigger's input files to ``target``/failed if they could not be rendered, else to ``target``/done; returns how many.

    Only names come to the driver, ``prefetch`` of them at most.  A name that
    is taken gets the time in it; a file that is gone was moved before.
    """
    batch = F.col("batch_id") == trigger
    lost = sinks.read_batches(spark, f"{root}/failed", "source_file string, error string").filter(batch).select("source_file").distinct().withColumn("lost", F.lit(True))
    of = sinks.read_batches(spark, f"{root}/totals", "source_file string, total bigint").filter(batch).select("source_file").distinct()
    names = of.join(lost, "source_file", "left").select("source_file", F.coalesce("lost", F.lit(False)).alias("lost"), text.basename(F.col("source_file")).alias("name"), text.renamed(F.col("source_file"), F.lit(int(time.time()))).alias("other"))
    moved = 0
    for r in names.collect():
        folder = f"{target}/{'failed' if r['lost'] else 'done'}"
        if exists(spark, r["source_file"]):
            fs, path = filesystem(spark, folder)
            fs.mkdirs(path(folder))
            name = r["other"] if exists(spark, f"{folder}/{r['name']}") else r["name"]
            sinks.move(spark, r["source_file"], f"{folder}/{name}")
            moved += 1
    return moved


def watch(spark: SparkSession, folder: str, root: str, make, hashes, options: Options = Options(), render: files.Renderer = files._render_with_library, available_now: bool = False, archive_to: str | None = None) -> StreamingQuery:
    """Ingest the files of a folder as they come, at most ``prefetch`` of them a trigger.

    ``archive_to`` (outside the folder): where files go one trigger after they were ingested; the last trigger's wait for the next.
    """
    if exists(spark, f"{root}/index") and not exists(spark, f"{root}/checkpoint"):
        raise GateError("watch", f"{root} holds batches of single files")
    found = files.scan_stream(spark, folder, options.prefetch)
    return start(found, ingest_batch(root, make, hashes, options, render, archive_to), f"{root}/checkpoint", options, available_now)


def progress(spark: SparkSession, root: str) -> DataFrame:
    """Pages of each source file, how many are left, and its state."""
    done = sinks.read_batches(spark, f"{root}/outcomes", OUTCOME)
    totals = sinks.read_batches(spark, f"{root}/totals", "source_file string, total bigint").drop("batch_id")
    return outcome.progress(done, totals)
