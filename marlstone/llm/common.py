"""Shared plumbing of the training-data operators.

Three things live here: writing intermediate tables into the folder that the
cluster shares (``spark.checkpoint.dir``), moving Arrow text columns into flat
numpy byte arrays, and a connected-components routine that never gathers links
in one place.
"""

from __future__ import annotations

import ctypes
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import shared_dir
from ..sources.sinks import delete

#: Bytes of text that a numpy kernel holds at once; a longer single text goes alone.
CHUNK_BYTES = 1 << 20


# --------------------------------------------------------------------------- shared folder


class Scratch:
    """Intermediate tables of one operator run, each written once and reread.

    A written table cuts lineage: an executor lost later costs only the stage
    that was running.  ``drop`` deletes a table as soon as nothing reads it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._tables: list[DataFrame] = []
        self._n = 0
        if (noted := getattr(_NOTED, "roots", None)) is not None:
            noted.append(self.root)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        self._tables.append(out)
        return out

    def drop(self, *dfs: DataFrame | None) -> None:
        for df in dfs:
            if path := getattr(df, "_scratch_path", None):
                delete(self.spark, path)
                self._tables = [t for t in self._tables if t is not df]

    def drop_all_but(self, *dfs: DataFrame) -> None:
        self.drop(*[t for t in self._tables if not any(t is d for d in dfs)])
        self.release()

    def release(self) -> None:
        """Let Spark's cleaner delete the shuffle files of finished phases now, not at some later collection."""
        import gc

        gc.collect()
        self.spark._jvm.System.gc()


_NOTED = threading.local()


@contextmanager
def noted(roots: list[str]) -> Iterator[None]:
    """Folders of all scratch tables that this thread makes inside are added to ``roots``."""
    before, _NOTED.roots = getattr(_NOTED, "roots", None), roots
    try:
        yield
    finally:
        _NOTED.roots = before


def sweep(spark: SparkSession, roots: list[str], docs: DataFrame) -> None:
    """Delete the folders, but for those that ``docs`` still reads from."""
    bare = lambda path: "/" + path.split(":", 1)[-1].lstrip("/")
    used = [bare(f) for f in docs.inputFiles()] if roots else []
    for root in list(roots):
        if not any(f.startswith(bare(root) + "/") for f in used):
            delete(spark, root)
            roots.remove(root)


# --------------------------------------------------------------------------- arrow helpers


def trims(task):
    """A function for mapInArrow that gives what its task has freed back to the system: idle workers would hold it."""

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return run


def text_slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``limit`` bytes of text each.

    Yields the slice, its UTF-8 bytes and the byte offsets of its rows (one
    more than rows).  A null text is an empty one.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        if col.null_count:
            col = pc.fill_null(col, "")
        col = col.cast(pa.large_string())
        _, off_buf, data_buf = col.buffers()
        offs = np.frombuffer(off_buf, dtype=np.int64)[col.offset : col.offset + len(col) + 1]
        data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
        i = 0
        while i < len(col):
            j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
            j = min(max(j, i + 1), len(col))
            yield batch.slice(i, j - i), data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            i = j


def int_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.int64())


def pick(docs: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the columns that an operator reads, cast; whatever else the table has cannot clash with its own."""
    return docs.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()])


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until df has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


# --------------------------------------------------------------------------- hashing kernels

_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
_P = 0x9E3779B97F4A7C17  # odd, 3 mod 4
_P_INV = pow(_P, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTERS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, 0 to n - 1."""
    if len(_POWERS.get("p", ())) < n:
        size = max(n, 1 << 16)
        for key, base in (("p", _P), ("i", _P_INV)):
            a = np.full(size, np.uint64(base), dtype=np.uint64)
            a[0] = 1
            _POWERS[key] = np.multiply.accumulate(a)
    out = _POWERS["p"][:n], _POWERS["i"][:n]
    if n > 4 * CHUNK_BYTES:
        _POWERS.clear()
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes; a run ends with its text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    w = is_word[data]
    before = np.empty_like(w)
    before[0] = False
    before[1:] = w[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    before[inner] = False
    starts = np.flatnonzero(w & ~before)
    after = np.empty_like(w)
    after[-1] = False
    after[:-1] = w[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    return starts, np.flatnonzero(w & ~after) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span: a polynomial over random letters, mixed; equal spans have equal hashes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    p, inv = powers(len(data) + 1)
    letters = _LETTERS if fold is None else _LETTERS[fold]
    with np.errstate(over="ignore"):
        total = np.empty(len(data) + 1, np.uint64)
        total[0] = 0
        np.cumsum(letters[data] * p[: len(data)], dtype=np.uint64, out=total[1:])
        h = (total[ends] - total[starts]) * inv[starts]
        return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(seed))


#: Bytes that the contracts count as space between words: U+0020 and U+0009 to U+000D.
SPACE_BYTES = (32, 9, 10, 11, 12, 13)
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[list(SPACE_BYTES)] = False
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words inside the texts, and each run's first word.

    ``first``: for each text the index of its first word, then the total.  A
    text with 1 to k - 1 words gives one shingle of all its words.
    """
    n = len(words)
    mult = mix64(np.arange(1, k + 2, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)
    count = np.diff(first)
    with np.errstate(over="ignore"):
        if n >= k:
            m = n - k + 1
            h = np.zeros(m, np.uint64)
            for j in range(k):
                h += mix64(words[j : j + m] ^ mult[j]) * mult[j]
            ok = np.ones(m, bool)
            for j in range(1, k):  # a run that begins j words before a text's start crosses it
                bad = first[1:-1] - j
                bad = bad[(bad >= 0) & (bad < m)]
                ok[bad] = False
            at = np.flatnonzero(ok)
            h = mix64(h[at])
        else:
            h, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero((count > 0) & (count < k))
        if len(short):
            extra = np.zeros(len(short), np.uint64)
            for j in range(k - 1):
                has = count[short] > j
                extra[has] += mix64(words[first[short[has]] + j] ^ mult[j]) * mult[j]
            extra = mix64(extra + count[short].astype(np.uint64) * mult[k])
            # a run of a longer text can't begin at a short text's first word: it would cross
            keep = ~np.isin(at, first[short])
            h, at = np.concatenate([h[keep], extra]), np.concatenate([at[keep], first[short]])
            order = np.argsort(at, kind="stable")
            h, at = h[order], at[order]
    return h, at


def words_by_text(offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each text the index of its first word, then the number of words."""
    return np.searchsorted(starts, offsets).astype(np.int64)


# --------------------------------------------------------------------------- connected components


def connected_components(scratch: Scratch, edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node that has an edge: columns ``node`` and ``root``.

    Alternating large-star and small-star contraction: every round is two
    grouped minima and two equi-joins, written to the shared folder; neither a
    node's neighbours nor a component is ever gathered in one row.  A hub's
    minimum is taken with partial aggregation; the join that hands it back to
    the hub's edges is a plain inner join, which adaptive execution splits.
    Self-loops and repeated edges are allowed; null nodes are ignored.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.select(F.col("u"), F.col("v")).unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            j = both.filter(F.col("v") > F.col("u")).join(low, "u")
            return j.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        j = e.join(low, "u")
        near = j.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return near.unionByName(low.select("u", F.col("m").alias("v"))).distinct()

    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    current = scratch.save(e, "edges")
    mark = None
    for _ in range(max_rounds):
        nxt = scratch.save(star(star(current, True), False), "edges")
        seen = nxt.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        scratch.drop(current)
        current = nxt
        if seen["n"] == 0 or (seen["n"], seen["h"]) == mark:
            break
        mark = (seen["n"], seen["h"])
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def bounded_broadcast(spark: SparkSession, value: np.ndarray, limit_bytes: int):
    """Broadcast an array whose size is checked against a stated bound."""
    if value.nbytes > limit_bytes:
        raise ValueError(f"{value.nbytes} bytes to broadcast; the bound is {limit_bytes}")
    return spark.sparkContext.broadcast(value)


# --------------------------------------------------------------------------- Bloom filters

BLOOM_BITS, _BLOOM_RANGES = (16, 26), 64


def bloom(hashes: DataFrame, per: int = 16) -> np.ndarray:
    """A Bloom filter of two places for each number in the only column of a written table: ``per`` bits a number or more, 8 MB at most.

    Every task fills one of its own; ranges of them are joined in tasks.
    """
    least, most = BLOOM_BITS
    bits = min(most, max(least, (per * hashes.count()).bit_length()))
    column = hashes.columns[0]

    @trims
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << (bits - 3), np.uint8)
        for b in batches:
            for at in _bloom_places(b.column(0).to_numpy().view(np.uint64), bits):
                np.bitwise_or.at(table, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        if table.any():
            parts = [x.tobytes() if x.any() else b"" for x in np.split(table, _BLOOM_RANGES)]
            rows = [i for i, x in enumerate(parts) if x]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array([parts[i] for i in rows], pa.binary())], names=["part", "bits"])

    @trims
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            for p, x in zip(b.column(0).to_pylist(), b.column(1)):
                found[p] = found.get(p, 0) | np.frombuffer(x.as_buffer(), np.uint8)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())], names=["part", "bits"])

    size = (1 << bits) // _BLOOM_RANGES // 8
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in hashes.select(F.col(column).cast("long")).mapInArrow(fill, "part int, bits binary").repartition("part").mapInArrow(join, "part int, bits binary").collect():
        out[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def _bloom_places(h: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    mixed, mask = mix64(h), np.uint64((1 << bits) - 1)
    yield (mixed & mask).astype(np.int64)
    yield (mixed >> np.uint64(32) & mask).astype(np.int64)


def in_bloom(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the numbers may be in the filter."""
    ok = np.ones(len(h), bool)
    for at in _bloom_places(h, (8 * len(table)).bit_length() - 1):
        ok &= (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return ok
