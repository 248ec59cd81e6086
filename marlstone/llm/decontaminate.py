"""Benchmark decontamination by spaced-seed hashing.

A spaced seed hashes the tokens under a fixed mask and ignores those between,
so a passage with substituted tokens still shares seeds with its source.  The
masks follow from the verdict: a window is cut into blocks, its allowed
substitutions leave some blocks whole, and there is a mask for each placement
of whole blocks to each other, so every window that agrees enough is hit.  The
test side's seed hashes are a table; the training side is scanned once, and
only places whose hash is in a Bloom filter of bounded size (built from the test
hashes) are joined with that table.  Each hit gives a diagonal (document place
minus item place); along it the tokens around the hit are compared, and a
window of ``MIN_TOKENS`` tokens (or of the whole shorter item) of which
``MIN_SHARE`` agree is an overlap.

Tokens are runs of ASCII letters, digits and non-ASCII bytes; A-Z are lowered.

Defined results: a null or empty text has no tokens and no overlaps.  An item
of one to four tokens overlaps where all of them stand in a row; ``remove``
leaves items with fewer than ``least_item`` tokens out, as they say nothing of
where a text comes from.
Repeated rows of documents or items count once in the result.  Empty tables
give no rows.  Extra columns are ignored; the columns of a document are kept
by ``remove``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MIN_TOKENS, MIN_SHARE = 20, 0.8
LEAST_TO_REMOVE = 5  # an item of fewer tokens may stand in any clean text
SEED_TOKENS = 6  # hashed by a mask, where the window has room for so many
MARGIN = 64  # tokens around the hits of a region that are compared as well

TOKEN_BYTES = np.zeros(256, bool)
TOKEN_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True



@cache
def masks(window: int) -> tuple[str, ...]:
    """Masks (1 is hashed, 0 is ignored) of which one at least hits any ``window`` tokens that agree enough.

    Blocks of equal length: ``wrong`` substitutions touch as many blocks at
    most, so among ``wrong + whole`` blocks ``whole`` are untouched.
    """
    wrong = max(k for k in range(window) if window - k >= MIN_SHARE * window)
    length = next((n for n in (3, 2) if n * (window // n - wrong) >= SEED_TOKENS), 1)
    whole = min(SEED_TOKENS // length, window // length - wrong)
    apart = [(0, *later) for later in combinations(range(1, wrong + whole), whole - 1)]
    return tuple("".join("01"[i in blocks] * length for i in range(blocks[-1] + 1)) for blocks in apart)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = common.word_spans(data, offsets, TOKEN_BYTES)
    return common.span_hashes(data, starts, ends, common.ASCII_LOWER), common.words_by_text(offsets, starts)


def _seeds(tokens: np.ndarray, mask: str) -> np.ndarray:
    """A hash for each place where the whole mask fits."""
    m = len(tokens) - len(mask) + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(m, np.uint64(int(mask, 2) * 2 + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j, c in enumerate(mask):
            if c == "1":
                h = common.mix64(h ^ tokens[j : j + m]) + np.uint64(j + 1)
    return common.mix64(h)


def _item_seeds(tokens: np.ndarray, least_item: int) -> list[np.ndarray]:
    """Hashes for every mask of the item's window."""
    return [_seeds(tokens, m) for m in masks(min(MIN_TOKENS, len(tokens)))] if len(tokens) >= max(1, least_item) else []


def _test_side(benchmark: DataFrame, least_item: int) -> DataFrame:
    """One row an item: its tokens, and its seeds as (hash, place)."""

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in common.text_slices(batches):
            tok, first = _tokens(data, offsets)
            ids, all_tokens, all_seeds = part.column("item_id").to_pylist(), [], []
            for i in range(len(ids)):
                t = tok[first[i] : first[i + 1]]
                all_tokens.append(t.view(np.int64))
                all_seeds.append([{"h": h, "pos": p} for hs in _item_seeds(t, least_item) for p, h in enumerate(hs.view(np.int64).tolist())])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(all_tokens, pa.list_(pa.int64())), pa.array(all_seeds, pa.list_(pa.struct([("h", pa.int64()), ("pos", pa.int32())])))], names=["item_id", "item", "seeds"])

    return common.pick(benchmark, {"item_id": "long", "text": "string"}).mapInArrow(run, "item_id long, item array<long>, seeds array<struct<h:long,pos:int>>")


def _regions(rows: DataFrame, bits, used: list[str]) -> DataFrame:
    """Stretches of documents with hits close to each other: their tokens with a margin, and the hits."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    hit = pa.struct([("h", pa.int64()), ("pos", pa.int32())])

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        for part, data, offsets in common.text_slices(batches):
            tok, first = _tokens(data, offsets)
            found = []
            for m in used:
                h = _seeds(tok, m)  # over the whole slice; places that cross texts go below
                at = np.flatnonzero(common.in_bloom(table, h))
                found.append((at, h[at], np.full(len(at), len(m))))
            if not found:
                continue
            at, h, span = (np.concatenate(x) for x in zip(*found))
            doc = np.searchsorted(first, at, side="right") - 1
            ok = at + span <= first[doc + 1]
            at, h, doc = at[ok], h[ok], doc[ok]
            if not len(at):
                continue
            order = np.lexsort((at, doc))
            at, h, doc = at[order], h[order], doc[order]
            new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (np.diff(at) > MARGIN)]))
            ids, out = part.column("doc_id"), []
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(at)]):
                d = doc[a]
                lo, hi = max(int(first[d]), int(at[a]) - MARGIN), min(int(first[d + 1]), int(at[b - 1]) + MIN_TOKENS + MARGIN)
                out.append((ids[int(d)].as_py(), tok[lo:hi].view(np.int64), [{"h": x, "pos": y} for x, y in zip(h[a:b].view(np.int64).tolist(), (at[a:b] - lo).tolist())]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], ids.type), pa.array([r[1] for r in out], pa.list_(pa.int64())), pa.array([r[2] for r in out], pa.list_(hit))], names=["doc_id", "tokens", "hits"])

    return rows.mapInArrow(run, f"doc_id {kind}, tokens array<long>, hits array<struct<h:long,pos:int>>")


def _agree(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int]:
    """Most agreeing tokens in a window along the diagonal, and the window's length."""
    a, b = max(0, diagonal), min(len(doc), diagonal + len(item))
    want = min(MIN_TOKENS, len(item))
    if b - a < want:
        return 0, want
    same = np.concatenate([[0], np.cumsum(doc[a:b] == item[a - diagonal : b - diagonal])])
    return int((same[want:] - same[:-want]).max()), want


def overlaps(docs: DataFrame, benchmark: DataFrame, least_item: int = 1) -> DataFrame:
    """Pairs (doc_id, item_id) that overlap, with the best window: ``n_same`` of ``n_window`` tokens agree."""
    return _overlaps(common.pick(docs, {"doc_id": "long", "text": "string"}), benchmark, least_item)


def _overlaps(docs: DataFrame, benchmark: DataFrame, least_item: int) -> DataFrame:
    """``overlaps`` of documents whose doc_id is a number or a string."""
    spark = docs.sparkSession
    scratch = common.Scratch(spark, "decontaminate")
    test = scratch.save(_test_side(benchmark, least_item), "test")
    seeds = test.select("item_id", F.explode("seeds").alias("s")).select("item_id", F.col("s.h").alias("h"), F.col("s.pos").alias("item_pos"))
    bits = common.bounded_broadcast(spark, common.bloom(scratch.save(seeds.select("h"), "hashes"), per=256), 1 << (common.BLOOM_BITS[1] - 3))
    windows = [r[0] for r in test.filter(F.size("item") >= max(1, least_item)).select(F.least(F.size("item"), F.lit(MIN_TOKENS))).distinct().collect()]
    used = sorted({m for w in windows for m in masks(w)})
    # a region is known by its content: equal ones of a document are one, and a hash shared by two only adds pairs to verify
    regions = scratch.save(_regions(docs, bits, used).withColumn("region", F.xxhash64("doc_id", "tokens")), "regions")
    hits = regions.select("region", F.explode("hits").alias("x")).select("region", F.col("x.h").alias("d_h"), F.col("x.pos").alias("pos"))
    diagonals = hits.join(seeds, F.col("d_h") == F.col("h")).select("region", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct()
    pairs = diagonals.join(regions.select(F.col("region").alias("r_region"), "doc_id", "tokens"), F.col("region") == F.col("r_region")).join(test.select(F.col("item_id").alias("t_item"), "item").distinct(), F.col("item_id").eqNullSafe(F.col("t_item")))

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            docs_, items = batch.column("tokens"), batch.column("item")
            for i, (d, it, g) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("item_id").to_pylist(), batch.column("diagonal").to_pylist())):
                same, want = _agree(np.asarray(docs_[i].values), np.asarray(items[i].values), g)
                if same >= MIN_SHARE * want:
                    out.append((d, it, same, want))
            if out:
                kinds = (batch.schema.field("doc_id").type, *[pa.int64()] * 3)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "item_id", "n_same", "n_window"])

    found = pairs.select("doc_id", "item_id", "diagonal", "tokens", "item").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id long, n_same long, n_window long")
    return found.groupBy("doc_id", "item_id").agg(F.max("n_same").alias("n_same"), F.max("n_window").alias("n_window"))


def remove(docs: DataFrame, benchmark: DataFrame, least_item: int = LEAST_TO_REMOVE) -> DataFrame:
    """docs without the rows whose text overlaps an item of ``least_item`` tokens or more.

    Rows are known by doc_id and text: another text with the same or no doc_id stays.
    """
    row = F.concat_ws(":", F.col("doc_id").cast("long"), F.md5(F.col("text").cast("string")))
    (other,) = common.free(docs, "bad_row")
    bad = _overlaps(docs.select(row.alias("doc_id"), F.col("text").cast("string").alias("text")), benchmark, least_item).select(F.col("doc_id").alias(other)).distinct()
    return docs.join(bad, row == F.col(other), "left_anti")
