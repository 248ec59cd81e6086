"""Best-fit packing by minimum bin slack over the histogram of lengths.

Documents are tokenized and those longer than a sequence are cut; what is
packed then are pieces of 1 to ``capacity`` tokens.  Which bins to fill depends
on the lengths alone, so the packer runs on the histogram (at most
``capacity`` numbers, whatever the data's size): the longest length left opens
a bin, a bitset subset-sum program over the lengths available finds the
fullest combination for the rest, and that combination is taken as often as
the counts allow.  Every step uses up a length, so the list of patterns is
short as well.  Pieces then find their place by arithmetic on their rank among
the pieces of their length: no piece is ever moved to a bin.

Defined results: a null or empty text is the end token alone.  Repeated rows
are documents of their own.  An empty table gives no rows.  Extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all full, but the first may be shorter."""
    head = n % capacity or min(n, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to ``room``: bitset subset sums, then the way back."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left > 0:
            part = min(part, left)
            steps.append((length, part, reach))
            reach |= (reach << (length * part)) & mask
            left -= part
            part *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    out: dict[int, int] = {}
    for length, part, before in reversed(steps):
        if not before >> at & 1:
            at -= length * part
            out[length] = out.get(length, 0) + part
    return out


def min_bin_slack(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, lengths in each of them), until nothing is left."""
    left = {k: v for k, v in histogram.items() if v > 0}
    if any(not 0 < k <= capacity for k in left):
        raise ValueError("lengths must be from 1 to the capacity")
    plan = []
    while left:
        longest = max(left)
        left[longest] -= 1
        pattern = fullest({k: v for k, v in left.items() if v}, capacity - longest)
        left[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[k] // v for k, v in pattern.items())
        plan.append((times, pattern))
        for k, v in pattern.items():
            left[k] -= times * v
            if not left[k]:
                del left[k]
    return plan


def placements(plan: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length of each pattern: (length, first rank, pieces a bin, first bin, offset, pieces in all)."""
    taken: dict[int, int] = {}
    out, first_bin = [], 0
    for times, pattern in plan:
        offset = 0
        for length in sorted(pattern, reverse=True):
            per = pattern[length]
            out.append((length, taken.get(length, 0), per, first_bin, offset, per * times))
            taken[length] = taken.get(length, 0) + per * times
            offset += per * length
        first_bin += times
    return out


def tokenize_pieces(docs: DataFrame, capacity: int, end_id: int, vocabulary: dict[str, str], keep_ids: bool = False) -> DataFrame:
    """The pieces of every document, with a checksum of their ids (and the ids themselves, if asked for)."""
    rows = common.pick(docs, {"doc_id": "long", "text": "string"})
    schema = PIECES + (", ids array<int>" if keep_ids else "")

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(**vocabulary)
        for part, _, _ in common.text_slices(batches):
            doc, cols, kept = part.column("doc_id").to_pylist(), [], []
            for d, ids in zip(doc, enc.encode(part.column("text").to_pylist())):
                ids = np.append(ids, end_id).astype("<u4")
                for k, (s, n) in enumerate(cut(len(ids), capacity)):
                    cols.append((d, k, s, n, zlib.crc32(ids[s : s + n].tobytes())))
                    if keep_ids:
                        kept.append(ids[s : s + n].astype(np.int32))
            a = [pa.array(c, t) for c, t in zip(zip(*cols), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = [x.split()[0] for x in PIECES.split(", ")]
            if keep_ids:
                a.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, kept)]), pa.int32()), pa.array(np.concatenate(kept))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(a, names=names)

    return rows.mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int, scratch: common.Scratch, salt_rows: int = 200_000) -> DataFrame:
    """``sequence_id`` and ``offset`` for every row of a written table with a ``length`` column.

    Ranks among pieces of one length are counted inside (length, salt) groups
    of about ``salt_rows`` rows and shifted by the groups before, so a length
    that many pieces share is spread over many tasks.
    """
    spark: SparkSession = pieces.sparkSession
    hist = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    plan = placements(min_bin_slack(hist, capacity))
    schema = "p_length long, p_rank long, p_per long, p_bin long, p_offset long, p_n long"
    table = spark.createDataFrame(plan or [], schema)
    salts = max(1, -(-max(hist.values(), default=1) // salt_rows))
    # a row's salt must not change if its task runs again: it comes from the row
    salt = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(salts)).cast("int")
    d = pieces.withColumn("salt", salt)
    sizes = d.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window as W

    before = sizes.withColumn("shift", F.sum("n").over(W.partitionBy("length").orderBy("salt")) - F.col("n")).select(F.col("length").alias("b_length"), F.col("salt").alias("b_salt"), "shift")
    inner = W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    d = d.withColumn("rank", F.row_number().over(inner) - F.lit(1))
    # a pattern row covers a range of ranks: give each length its ranges as one sorted array (a few thousand in all) and search it
    ranges = table.groupBy("p_length").agg(F.array_sort(F.collect_list(F.struct("p_rank", "p_n", "p_per", "p_bin", "p_offset"))).alias("ranges"))
    d = d.join(F.broadcast(before) if salts <= 64 else before, (F.col("length") == F.col("b_length")) & (F.col("salt") == F.col("b_salt"))).withColumn("rank", F.col("rank") + F.col("shift"))
    d = d.join(F.broadcast(ranges), F.col("length") == F.col("p_length"))
    hit = F.get(F.filter("ranges", lambda r: (F.col("rank") >= r["p_rank"]) & (F.col("rank") < r["p_rank"] + r["p_n"])), F.lit(0))
    d = d.withColumn("hit", hit).withColumn("at", F.col("rank") - F.col("hit.p_rank"))
    return d.withColumn("sequence_id", F.col("hit.p_bin") + F.floor(F.col("at") / F.col("hit.p_per"))).withColumn("offset", F.col("hit.p_offset") + F.pmod(F.col("at"), F.col("hit.p_per")) * F.col("length")).select(*[c for c in pieces.columns], "sequence_id", "offset")


def pack_documents(docs: DataFrame, vocabulary: dict[str, str], capacity: int = 1024, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place in a sequence of at most ``capacity`` tokens.

    ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, with
    ``keep_ids`` also ``ids``, then ``sequence_id`` and ``offset``.
    """
    scratch = common.Scratch(docs.sparkSession, "packing")
    pieces = scratch.save(tokenize_pieces(docs, capacity, end_id, vocabulary, keep_ids), "pieces")
    return pack(pieces, capacity, scratch)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of every sequence, from ``pack_documents(..., keep_ids=True)``; a sequence has at most its capacity of them."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
