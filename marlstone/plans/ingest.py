"""Batch ingestion: pages, signatures, dedup, recognition, markup, samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import GateError, StorageError
from ..functions import signature, text
from ..operators import doctag, neardup
from ..options import SOURCE_NAME, Options
from ..schemas import HASH_INDEX
from ..sources import files, sinks
from ..sources.scratch import exists, listing, written

Recogniser = Callable[[bytes], str]


def recognise(pages: DataFrame, make: Callable[[], Recogniser], at_once: int = 100) -> DataFrame:
    """pages with ``html`` and ``ocr_error``.  One client a task, ``at_once`` requests in flight; a failed one fails alone.

    Only the content goes to Python.
    """

    @F.arrow_udf("struct<html:string,ocr_error:string>")
    def ask(contents: Iterator[pa.Array]) -> Iterator[pa.Array]:
        client = None

        def one(content: bytes) -> dict[str, str | None]:
            try:
                return {"html": client(content), "ocr_error": None}
            except Exception as e:
                return {"html": None, "ocr_error": str(e) or type(e).__name__}

        kind = pa.struct([("html", pa.string()), ("ocr_error", pa.string())])
        for part in contents:
            client = client or make()
            with ThreadPoolExecutor(max(1, min(at_once, len(part)))) as pool:
                yield pa.array(list(pool.map(one, part.to_pylist())), kind)

    d = pages.withColumn("answer", ask.asNondeterministic()(F.col("content")))
    return d.withColumns({"html": F.col("answer.html"), "ocr_error": F.col("answer.ocr_error")}).drop("answer")


def outcomes(pages: DataFrame, index: DataFrame, make: Callable[[], Recogniser], options: Options = Options()) -> DataFrame:
    """Every page with ``status``: saved, duplicate or failed.

    ``pages``: page_uri, source_file, page_no, content, sig, img_w, img_h.
    Duplicates go before recognition.  A page that fails is no representative,
    so the choice is made again without the failed ones until none fails.  A
    page that comes with an ``error`` (its file could not be rendered) has failed.
    """
    spark: SparkSession = pages.sparkSession
    if "error" in pages.columns:
        lost = pages.filter("error is not null").withColumns({"sample_id": text.sample_id(F.col("source_file"), F.col("page_no")), "html": F.lit(None).cast("string"), "doctags": F.lit(None).cast("string"), "status": F.lit("failed")})
        return outcomes(pages.filter("error is null").drop("error"), index, make, options).unionByName(lost)
    d = written(pages.withColumn("sample_id", text.sample_id(F.col("source_file"), F.col("page_no"))), "pages")
    failed = spark.createDataFrame([], "f_id string, f_error string")
    tried = None
    while True:
        left = d.join(failed.select("f_id"), F.col("sample_id") == F.col("f_id"), "left_anti")
        keep = neardup.greedy(left.select("sample_id", "sig"), "sample_id", index, options.hamming_below).select(F.col("sample_id").alias("k_id"))
        todo = left.join(keep, F.col("sample_id") == F.col("k_id"), "left_semi")
        if tried is not None:
            todo = todo.join(tried.select(F.col("sample_id").alias("t_id")), F.col("sample_id") == F.col("t_id"), "left_anti")
        got = written(doctag.convert(recognise(todo, make, options.batch_size)).withColumn("error", F.coalesce("ocr_error", "error")), "recognised")
        tried = got if tried is None else tried.unionByName(got)
        bad = got.filter("error is not null").select(F.col("sample_id").alias("f_id"), F.col("error").alias("f_error"))
        if bad.isEmpty():
            break
        failed = written(failed.unionByName(bad), "failed")
    done = tried.select(F.col("sample_id").alias("d_id"), "html", "doctags", "error")
    status = F.when(F.col("d_id").isNull(), "duplicate").when(F.col("error").isNotNull(), "failed").otherwise("saved")
    return d.join(done, F.col("sample_id") == F.col("d_id"), "left").withColumn("status", status).drop("d_id")


def samples(done: DataFrame) -> DataFrame:
    """Manifest rows of the saved pages."""
    i = F.col("sample_id")
    return done.filter("status = 'saved'").select("sample_id", text.image_path(i).alias("image_path"), F.col("doctags").alias("output_text"), text.raw_path(i).alias("chandra_raw"), F.lit(SOURCE_NAME).alias("source"), "img_w", "img_h", F.lit(None).cast("timestamp_ntz").alias("created_at"))


def index_rows(done: DataFrame) -> DataFrame:
    """What is registered: saved pages only, after they are written."""
    return done.filter("status = 'saved' and sig is not null").select(F.col("sample_id").alias("key"), "sig", signature.to_hex(F.col("sig")).alias("sig_hex"))


def commit(done: DataFrame, root: str, batch_id: int) -> int:
    """Write a batch's samples, outcomes and index rows, in this order; returns the number saved."""
    sinks.write_batch(samples(done).join(done.select(F.col("sample_id").alias("c_id"), "content", F.col("html").alias("raw_html")), F.col("sample_id") == F.col("c_id")).drop("c_id"), f"{root}/samples", batch_id)
    sinks.write_batch(done.select("page_uri", "source_file", "status", "error"), f"{root}/outcomes", batch_id)
    sinks.write_batch(index_rows(done), f"{root}/index", batch_id)
    return done.filter("status = 'saved'").count()


def ingest_file(spark: SparkSession, path: str, root: str, make: Callable[[], Recogniser], hashes: Callable[[DataFrame], DataFrame], options: Options = Options(), render: files.Renderer = files._render_with_library, batch_id: int | None = None) -> int:
    """Ingest one file and return the number of saved pages; a file that can't be rendered raises.

    Without a ``batch_id`` it takes the next free one; the number of a batch before runs that batch again.

    ``hashes`` adds ``sig``, ``img_w`` and ``img_h`` to pages with ``content``.
    """
    source = files.one_file(spark, path)
    if batch_id is None:
        batch_id = next_batch(spark, root)
    pages = written(files.pages(source, options.dpi, render), "pages")
    if bad := pages.filter("error is not null").select("error").first():
        raise StorageError(f"{path}: {bad['error']}")
    done = written(outcomes(hashes(pages.drop("error")), index_before(spark, root, batch_id), make, options), "outcomes")
    return commit(done, root, batch_id)


def next_batch(spark: SparkSession, root: str) -> int:
    """One more than the last batch that was committed whole; a stream numbers its batches itself, so its folder is refused."""
    if exists(spark, f"{root}/checkpoint"):
        raise GateError("ingest", f"{root} belongs to a stream")
    done = listing(spark, f"{root}/index") if exists(spark, f"{root}/index") else []
    return 1 + max((int(x.split("=")[1]) for x in done if x.startswith("batch_id=")), default=-1)


def index_before(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """What other batches have registered before; a batch that runs again does not see itself."""
    return sinks.read_batches(spark, f"{root}/index", HASH_INDEX).filter(F.col("batch_id") < batch_id)
