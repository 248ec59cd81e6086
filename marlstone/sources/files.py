"""Files in: directory scans, single files, images, PDF pages, manifests, JSON, blobs."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..errors import StorageError
from ..functions import text
from ..options import SUPPORTED
from ..schemas import MANIFEST
from .scratch import exists, filesystem, listing

BINARY = "path string, modificationTime timestamp, length bigint, content binary"
WHOLE_BYTES = 1 << 20  # a file that holds one pretty-printed object has a sample, and is no longer
Renderer = Callable[[bytes, int], Iterator[bytes]]


def supported(path) -> object:
    return text.suffix(path).isin(*SUPPORTED)


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """Regular files of one folder (not below) with a supported suffix."""
    return spark.read.format("binaryFile").load(folder).filter(supported(F.col("path")))


def scan_stream(spark: SparkSession, folder: str, max_files: int) -> DataFrame:
    return spark.readStream.format("binaryFile").schema(BINARY).option("maxFilesPerTrigger", max_files).load(folder).filter(supported(F.col("path")))


def one_file(spark: SparkSession, path: str) -> DataFrame:
    """One file to ingest; what is missing or of another type is refused before any work."""
    if not exists(spark, path):
        raise FileNotFoundError(f"File not found: {path}")
    ext = PurePosixPath(path).suffix.lower()
    if ext not in SUPPORTED:
        raise ValueError(f"Unsupported file type: {ext}")
    return spark.read.format("binaryFile").load(path)


def new_files(found: DataFrame, known: DataFrame, path: str = "path") -> DataFrame:
    """Files whose path is not known yet, each once."""
    return found.dropDuplicates([path]).join(known.select(F.col(path).alias("_known")).distinct(), F.col(path) == F.col("_known"), "left_anti")


def _render_with_library(content: bytes, dpi: int) -> Iterator[bytes]:
    try:
        import fitz
    except ImportError as e:
        raise StorageError("no PDF renderer is installed; pass one as render=") from e
    with fitz.open(stream=content, filetype="pdf") as doc:
        for page in doc:
            yield page.get_pixmap(matrix=fitz.Matrix(dpi / 72, dpi / 72)).tobytes("png")


def pages(files: DataFrame, dpi: int = 150, render: Renderer = _render_with_library) -> DataFrame:
    """One row a page, in page order; an image is its own only page.  A file that can't be rendered has one row with ``error``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                try:
                    parts, error = list(render(content, dpi)) if path.lower().endswith(".pdf") else [content], None
                except Exception as e:  # one bad file fails alone
                    parts, error = [None], str(e) or type(e).__name__
                n = len(parts)
                yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(range(n), pa.int32()), pa.array([n] * n, pa.int32()), pa.array(parts, pa.binary()), pa.array([error] * n, pa.string())], names=["source_file", "page_no", "n_pages", "content", "error"])

    d = files.select("path", "content").mapInArrow(run, "source_file string, page_no int, n_pages int, content binary, error string")
    tag = F.substring(F.md5("source_file"), 1, 6)
    return d.withColumn("page_uri", F.when(F.lower("source_file").endswith(".pdf"), text.page_name(F.col("page_no"), tag)).otherwise(F.col("source_file")))


def images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images; one that can't be decoded has -1 as its sizes."""
    return spark.read.format("image").load(path)


def manifests(spark: SparkSession, root: str, schema: str = MANIFEST) -> DataFrame:
    """Samples of all manifests/**/*.jsonl: a file is one JSON object, or one object a line; a bad line fails the job.

    Only files up to ``WHOLE_BYTES`` are read whole; a larger one has an object a line and is split among tasks.
    """
    folder = f"{root.rstrip('/')}/manifests"
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    reader = spark.read.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", True)
    size = F.col("_metadata.file_size")
    whole = reader.text(folder, wholetext=True).filter(size <= WHOLE_BYTES).select("value")
    lines = reader.text(folder).filter(size > WHOLE_BYTES).select("value")
    return from_manifest_text(whole, schema).unionByName(from_lines(lines.filter(text.trim_u(F.col("value")) != ""), schema))


def from_lines(lines: DataFrame, schema: str = MANIFEST) -> DataFrame:
    """One JSON object a ``value``; anything else, also after the object, fails the job."""
    whole = F.when(_one_object(F.col("value")), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("not one JSON object: "), F.substring("value", 1, 200))))
    return lines.select(F.from_json(whole.cast("string"), schema, {"mode": "FAILFAST"}).alias("s")).select("s.*")


@F.arrow_udf(BooleanType())
def _one_object(values: pa.Array) -> pa.Array:
    def ok(v: str | None) -> bool:
        try:
            return isinstance(json.loads(v or ""), dict)
        except ValueError:
            return False

    return pa.array([ok(v) for v in values.to_pylist()], pa.bool_())


def from_manifest_text(files: DataFrame, schema: str = MANIFEST) -> DataFrame:
    """``value`` holds whole files."""
    body = text.trim_u(F.col("value"))
    single = body.startswith("{") & F.from_json(body, schema, {"mode": "PERMISSIVE"}).isNotNull() & ~F.coalesce(F.get(F.filter(F.split(body, "\n"), lambda x: text.trim_u(x) != ""), F.lit(1)), F.lit("")).rlike(r"^\s*\{")
    rows = F.when(single, F.array(body)).otherwise(F.filter(F.transform(F.split(body, "\n"), text.trim_u), lambda x: x != ""))
    return from_lines(files.select(F.explode(rows).alias("value")), schema)


def json_object(spark: SparkSession, path: str) -> DataFrame:
    """A whole-file JSON object; anything wrong is a StorageError."""
    try:
        return spark.read.option("multiLine", True).option("mode", "FAILFAST").json(path)
    except Exception as e:
        raise StorageError(f"can't read {path}") from e


def hash_index(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The index table; empty if it is missing, an error if it is there and can't be read."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def blobs(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """Paths and lengths of files below root whose relative path starts with the prefix; contents are not read."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    at = F.regexp_replace("path", r"^[a-z]+:/+", "/")
    return d.filter(at.startswith(f"{root.split('://')[-1].rstrip('/')}/{prefix}"))


def ensure_warehouse(spark: SparkSession, path: str, marker: str = "_marlstone") -> None:
    """Create the folder if absent; refuse one that holds something else."""
    if exists(spark, path):
        names = listing(spark, path)
        if marker in names:
            return
        if names:
            raise StorageError(f"{path} holds other files")
    fs, of = filesystem(spark, path)
    fs.mkdirs(of(f"{path}/{marker}"))
