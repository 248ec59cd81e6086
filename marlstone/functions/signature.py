"""64-bit signatures: perceptual image hashes, median bits, text simhash, and their distance."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]+")


def to_hex(sig: Column) -> Column:
    return F.lower(F.lpad(F.hex(sig), 16, "0"))


def from_hex(text: Column) -> Column:
    return F.conv(text, 16, -10).cast("bigint")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def median_bits(values: Column) -> Column:
    """Bit i (most significant first) is whether coefficient i of 64 exceeds the median of all."""
    ordered = F.array_sort(values)
    n = F.size(values)
    middle = (F.get(ordered, F.floor((n - 1) / 2).cast("int")).cast("double") + F.get(ordered, F.floor(n / 2).cast("int")).cast("double")) / 2
    bits = F.transform(values, lambda v: F.when(v.cast("double") > middle, "1").otherwise("0"))
    return F.when(n == 64, F.conv(F.array_join(bits, ""), 2, -10).cast("bigint"))


def simhash(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``sig``: signs of the summed md5 bits of the distinct tokens; null without tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [{w for w in _SPACE.split(t or "") if w} for t in b.column(1).to_pylist()]
            number = {w: i for i, w in enumerate({w for words in texts for w in words})}  # of each distinct word of the batch
            raw = np.frombuffer(b"".join(hashlib.md5(w.encode()).digest()[:8] for w in number), np.uint8).reshape(-1, 8)
            bits, out = np.unpackbits(raw, axis=1), []
            for words in texts:
                up = bits[[number[w] for w in words]].sum(axis=0, dtype=np.int64) * 2 > len(words) if words else None
                out.append(None if up is None else int(np.packbits(up).view(">i8")[0]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.int64())], names=["key", "sig"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, sig bigint").withColumnRenamed("key", key)


def _dct(n: int) -> np.ndarray:
    i = np.arange(n)
    return 2 * np.cos(np.pi * np.outer(i, 2 * i + 1) / (2 * n))


def _shrink(grey: np.ndarray, size: int) -> np.ndarray:
    """Area average to size x size; small images are repeated first."""
    for axis in (0, 1):
        n = grey.shape[axis]
        edges = np.linspace(0, n, size + 1)
        grid = np.minimum(np.arange(n * size) // size, n - 1)
        wide = np.take(grey, grid, axis=axis)
        grey = np.add.reduceat(wide, (edges[:-1] * size).astype(int), axis=axis) / n
    return grey


def phash_pixels(bgr: np.ndarray) -> int:
    """Perceptual hash of height x width x channels: grey, 32 x 32, DCT-II, low 8 x 8 against their median."""
    a = bgr.astype(np.float64)
    grey = a[..., 0] if a.shape[2] == 1 else a[..., 0] * 0.114 + a[..., 1] * 0.587 + a[..., 2] * 0.299
    d = _dct(32)
    low = (d @ _shrink(grey, 32) @ d.T)[:8, :8].ravel()
    return int(np.packbits(low > np.median(low)).view(">i8")[0])


def phash(images: DataFrame) -> DataFrame:
    """``origin``, ``img_w``, ``img_h``, ``sig`` of rows of the ``image`` source; undecodable ones have a null signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for o, w, h, c, raw in zip(*(col.to_pylist() for col in b.columns)):
                good = w is not None and w > 0 and h > 0 and raw
                out.append((o, w, h, phash_pixels(np.frombuffer(raw, np.uint8).reshape(h, w, c)) if good else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (pa.string(), pa.int32(), pa.int32(), pa.int64()))], names=["origin", "img_w", "img_h", "sig"])

    return images.select("image.origin", "image.width", "image.height", "image.nChannels", "image.data").mapInArrow(run, "origin string, img_w int, img_h int, sig bigint")
