"""Removal of repeated byte strings by sorted suffixes (deep-shallow sorting).

Every byte covered by a ``width``-byte string that also starts anywhere else is
removed; strings do not cross texts.  Sorting all suffixes of a corpus would
move many times its size, so only those are sorted that can repeat:

1. Every ``width``-byte window has an anchor: its ``ANCHOR``-byte part with the
   least hash (the leftmost of equals).  Equal windows have equal anchors at
   the same place in them.  Consecutive windows with one anchor are a segment;
   segments are known by a hash of their bytes and the anchor's place.
2. A segment seen twice is a repeat throughout; one whose anchor is seen in no
   other segment is none.  What remains are the distinct segments that share
   an anchor, and only their bytes are fetched.
3. The suffixes that start at these anchors are sorted, and so are the reversed
   prefixes that end there: ternary multikey quicksort over eight bytes at a
   time to a shallow depth, then a blind trie for each group that still ties.
   A window that starts r bytes before its anchor repeats if another segment
   shares r bytes to the left and width - r to the right; the two sorted orders
   with their common-prefix lengths tell that for all rows of a group at once.

An anchor's group is one task's work if it has at most ``GROUP_ROWS`` distinct
segments.  A larger one (a passage between ever different neighbours) is dealt
anew by longer context: its windows are halved by where the anchor stands in
them, the windows of a half share more bytes around the anchor, and those
bytes are the new key.  Parts that are equal to their last byte collapse to
one; what is left is sorted like any group, or halved again.  A half of one
place has the whole window as its key, so this ends after as many steps as the
places have bits.

Defined results: a null or empty text has no bytes.  Repeated rows are texts
of their own (and repeat each other).  A null doc_id is kept.  An empty table
gives no rows.  Extra columns are ignored.  Segments are told apart by a
112-bit hash of their bytes.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WIDTH, ANCHOR, SHALLOW, GROUP_ROWS = 200, 32, 32, 4096


# --------------------------------------------------------------------------- deep-shallow sorting


def _words(rows: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes of each row from ``depth`` on, as a number that sorts like them; rows are padded with zeros."""
    part = rows[:, depth : depth + 8]
    if part.shape[1] < 8:
        part = np.pad(part, ((0, 0), (0, 8 - part.shape[1])))
    return np.ascontiguousarray(part).view(">u8").ravel()


def multikey_quicksort(rows: np.ndarray, group: np.ndarray, depth: int, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows inside their groups by bytes ``depth`` to ``shallow``, and which still tie there.

    All parts are partitioned at once: around a pivot word into less, equal and
    greater; the equal part goes on with the next eight bytes.  Returns the
    order and, along it, the number of the tied group.
    """
    n = len(rows)
    order = np.argsort(group, kind="stable")
    # parts: [begin, end) runs of `order`, each with its depth; finished ones are those of one row or of full depth
    part = np.concatenate([[0], np.cumsum(group[order][1:] != group[order][:-1])]) if n else np.zeros(0, np.int64)
    at = np.full(n, depth)
    while n:
        begin = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        size = np.diff(np.append(begin, n))
        live = np.repeat((size > 1) & (at[begin] < shallow), size)
        if not live.any():
            break
        where = np.flatnonzero(live)
        key = np.zeros(len(where), np.uint64)
        for d in np.unique(at[where]):
            m = at[where] == d
            key[m] = _words(rows[order[where[m]]], int(d))
        full = np.zeros(n, np.uint64)
        full[where] = key
        mid = np.repeat(begin + size // 2, size)
        pivot = full[mid[where]]
        side = np.where(key < pivot, 0, np.where(key == pivot, 1, 2))
        move = np.lexsort((np.arange(len(where)), side, part[where]))
        order[where] = order[where][move]
        new_at = at[where] + np.where(side == 1, 8, 0)
        at[where] = new_at[move]
        sub = np.zeros(n, np.int64)
        sub[where] = side[move]
        cut = np.concatenate([[0], (part[1:] != part[:-1]) | (sub[1:] != sub[:-1])])
        part = np.cumsum(cut)
    return order, part


class BlindTrie:
    """A compacted trie of equally long strings; an insertion compares with one string, found by branching bytes alone.

    A leaf is the number of a distinct string, a node ``[position, {byte: child}]``.
    """

    def __init__(self, rows: list[bytes]):
        self.same: dict[bytes, list[int]] = {}
        for i, s in enumerate(rows):
            self.same.setdefault(s, []).append(i)
        self.strings = list(self.same)
        self.root: list | int = 0
        for i in range(1, len(self.strings)):
            self._add(i)

    def _add(self, i: int) -> None:
        s = self.strings[i]
        node, path = self.root, []
        while isinstance(node, list):
            path.append(node)
            node = node[1].get(s[node[0]], next(iter(node[1].values())))
        shared = _lcp(s, other := self.strings[node])
        above = [x for x in path if x[0] < shared]
        if len(above) < len(path) and path[len(above)][0] == shared:  # one more branch of a node
            path[len(above)][1][s[shared]] = i
            return
        below = path[len(above)] if len(above) < len(path) else node
        branch = [shared, {other[shared]: below, s[shared]: i}]
        if above:
            above[-1][1][s[above[-1][0]]] = branch
        else:
            self.root = branch

    def ordered(self) -> tuple[list[int], list[int]]:
        """Row numbers in order, and each one's common prefix with the one before (0 for the first)."""
        out, lcp, stack = [], [], [(self.root, 0)]
        while stack:
            node, shared = stack.pop()
            if isinstance(node, list):
                keys = sorted(node[1])
                stack += [(node[1][k], node[0]) for k in keys[:0:-1]]
                stack.append((node[1][keys[0]], shared))
            else:
                s = self.strings[node]
                for k, i in enumerate(self.same[s]):
                    out.append(i)
                    lcp.append(len(s) if k else shared)
        return out, lcp


def _lcp(a: bytes, b: bytes) -> int:
    if a == b:
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


def deep_shallow_sort(rows: np.ndarray, group: np.ndarray, known: int = 0, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of equally long byte rows inside their groups, and common-prefix lengths along it.

    ``known``: bytes that all rows of a group share.  The length before the
    first row of a group is -1.
    """
    n = len(rows)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = known - known % 8
    deep_from = min(rows.shape[1], start + -(-shallow // 8) * 8)
    order, tied = multikey_quicksort(rows, group, start, deep_from)
    lcp = np.full(n, -1)
    # lengths between neighbours that differ in the shallow part
    a, b = rows[order[:-1]], rows[order[1:]]
    same_group = group[order[1:]] == group[order[:-1]]
    differ = np.flatnonzero(same_group & (tied[1:] != tied[:-1]))
    for lo in range(0, len(differ), 1 << 16):
        d = differ[lo : lo + (1 << 16)]
        unequal = a[d, :deep_from] != b[d, :deep_from]
        lcp[d + 1] = unequal.argmax(axis=1)
    begin = np.flatnonzero(np.concatenate([[True], tied[1:] != tied[:-1]]))
    size = np.diff(np.append(begin, n))
    for s, m in zip(begin[size > 1].tolist(), size[size > 1].tolist()):
        ids = order[s : s + m]
        found, shared = BlindTrie([r.tobytes() for r in rows[ids]]).ordered()
        order[s : s + m] = ids[found]
        lcp[s + 1 : s + m] = shared[1:]
    return order, lcp


# --------------------------------------------------------------------------- anchors and segments


def _window_min(h: np.ndarray, w: int) -> np.ndarray:
    """Place of the least value of each run of w values, by the upper half of the hash; of equals the leftmost.

    The place is the lower half of what is compared, so the least value tells it.  A text has less than 4 GiB.
    """
    n = len(h) - w + 1
    pad = -len(h) % w
    key = np.full(len(h) + pad, np.uint64(0xFFFFFFFFFFFFFFFF))
    key[: len(h)] = h & np.uint64(0xFFFFFFFF00000000) | np.arange(len(h), dtype=np.uint64)
    x = key.reshape(-1, w)
    left = np.minimum.accumulate(x, axis=1).ravel()  # from a block's start
    right = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()  # to a block's end
    return (np.minimum(right[:n], left[w - 1 : w - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _segments(data: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one text: first window, number of windows, anchor place and anchor hash of each segment."""
    n = len(data) - width + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    starts = np.arange(len(data) - anchor + 1)
    h = common.span_hashes(data, starts, starts + anchor)
    at = _window_min(h, width - anchor + 1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return first, np.diff(np.append(first, n)), at[first], h[at[first]]


_SEG = "row long, at int, n int, r int, anchor long, seg binary"


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key that a task run again would not change: a hash of the row.  Equal rows share it, and their result."""
    d = common.pick(docs, {"doc_id": "long", "text": "string"})
    return d.withColumn("row", F.xxhash64("doc_id", "text", F.length("text")))


def _scan(rows: DataFrame, width: int, anchor: int) -> DataFrame:
    """All segments: the text's row number, first window, number of windows, r of the first window, anchor, content hash."""

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in common.text_slices(batches):
            row = part.column("row").to_numpy()
            cols: list[list] = [[] for _ in range(6)]
            for i in range(part.num_rows):
                d = data[offsets[i] : offsets[i + 1]]
                first, n, at, h = _segments(d, width, anchor)
                if not len(first):
                    continue
                raw = d.tobytes()
                segs = [hashlib.blake2b(raw[a : a + m + width - 1], digest_size=14, salt=int(r).to_bytes(4, "little")).digest() for a, m, r in zip(first.tolist(), n.tolist(), (at - first).tolist())]
                for c, x in zip(cols, (np.full(len(first), row[i]), first, n, at - first, h.view(np.int64), segs)):
                    c.append(x)
            if cols[0]:
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
                a = [pa.array(np.concatenate(c), k) for c, k in zip(cols, kinds)]
                yield pa.RecordBatch.from_arrays([*a, pa.array([s for c in cols[5] for s in c], pa.binary())], names=[x.split()[0] for x in _SEG.split(", ")])

    return rows.select("row", "text").mapInArrow(run, _SEG)


# --------------------------------------------------------------------------- windows that repeat


def _contexts(texts: list[bytes], r0: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes from each anchor on, and reversed before it, padded to equal lengths (the padding is not compared: r's range is)."""
    right = np.zeros((len(texts), width), np.uint8)
    left = np.zeros((len(texts), -(-(width - anchor) // 8) * 8), np.uint8)
    for i, (t, r) in enumerate(zip(texts, r0.tolist())):
        a = np.frombuffer(t, np.uint8)
        after = a[r : r + width]
        right[i, : len(after)] = after
        before = a[max(0, r - left.shape[1]) : r][::-1]
        left[i, : len(before)] = before
    return right, left


def repeats(texts: list[bytes], r0: np.ndarray, n: np.ndarray, group: np.ndarray, width: int = WIDTH, anchor: int = ANCHOR) -> list[np.ndarray]:
    """For each segment, which of its windows repeat in another segment of its group.

    Window j of a segment starts r0 - j bytes before its anchor.
    """
    right, left = _contexts(texts, r0, width, anchor)
    r_order, r_lcp = deep_shallow_sort(right, group, known=anchor)
    l_order, l_lcp = deep_shallow_sort(left, group)
    out = [np.zeros(m, bool) for m in n.tolist()]
    low = r0 - n + 1
    m = len(texts)
    for r in range(int(low.min()), int(r0.max()) + 1) if m else ():
        valid = (low <= r) & (r <= r0)
        if valid.sum() < 2:
            continue
        rc, lc = np.empty(m, np.int64), np.empty(m, np.int64)
        rc[r_order] = np.cumsum(r_lcp < width - r)
        lc[l_order] = np.cumsum(l_lcp < r)
        rows = np.flatnonzero(valid)
        _, inverse, count = np.unique(rc[rows] * (m + 1) + lc[rows], return_inverse=True, return_counts=True)
        for i in rows[count[inverse] > 1].tolist():
            out[i][r0[i] - r] = True
    return out


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


_FOUND = "seg binary, at array<struct<a:int,b:int>>"
_RUNS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _sorted_repeats(rows: DataFrame, width: int, anchor: int) -> DataFrame:
    """Runs of repeated windows of each part of a segment seen once, by ``key``; ``off`` is the part's first window."""
    from .jaccard import _groups

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, new in _groups(batches, ["key"]):
            group = np.repeat(np.arange(len(new) - 1), np.diff(new))
            found = repeats([x.as_py() for x in t.column("bytes")], t.column("r").to_numpy().astype(np.int64), t.column("n").to_numpy().astype(np.int64), group, width, anchor)
            runs = [_runs(x) for x in found]
            once = t.column("m").to_numpy() == 1
            keep = [i for i, x in enumerate(runs) if x and once[i]]
            if keep:
                segs, off = t.column("seg").to_pylist(), t.column("off").to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([segs[i] for i in keep], pa.binary()), pa.array([[{"a": off[i] + a, "b": off[i] + b} for a, b in runs[i]] for i in keep], _RUNS)], names=["seg", "at"])

    return rows.repartition("key").sortWithinPartitions("key", "seg", "off").select("key", "seg", "off", "r", "n", "m", "bytes").mapInArrow(run, _FOUND)


_PART = "key long, sub binary, seg binary, off int, r int, n int, m long, lo int, hi int, bytes binary"


def _halved(rows: DataFrame, width: int) -> DataFrame:
    """Each part cut at the middle of its group's places ``lo`` to ``hi`` of the anchor, and keyed by the bytes that all windows of a half share."""

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        for batch in batches:
            out = []
            for seg, off, r, n, m, lo, hi, raw in zip(*(batch.column(c).to_pylist() for c in ("seg", "off", "r", "n", "m", "lo", "hi", "bytes"))):
                mid = (lo + hi + 1) // 2
                for a, b in ((lo, mid - 1), (mid, hi)):
                    low, top = max(r - n + 1, a), min(r, b)
                    if low > top:
                        continue
                    place = struct.pack("<4H", a, b, low, top)
                    key = hashlib.blake2b(raw[r - a : r + width - b], digest_size=8, salt=place[:4]).digest()
                    part = raw[r - top : r - low + width]
                    sub = hashlib.blake2b(part, digest_size=14, salt=place).digest()
                    out.append((int.from_bytes(key, "little", signed=True), sub, seg, off + r - top, top, top - low + 1, m, a, b, part))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[x.split()[0] for x in _PART.split(", ")])

    return rows.select("seg", "off", "r", "n", "m", "lo", "hi", "bytes").mapInArrow(run, _PART)


def _all_repeats(scratch: common.Scratch, fetched: DataFrame, width: int, anchor: int, group_rows: int) -> DataFrame:
    """Runs of repeated windows of all segments that were seen once."""
    part = fetched.select(F.col("anchor").alias("key"), "seg", F.lit(0).alias("off"), "r", "n", "m", F.lit(0).alias("lo"), F.lit(width - anchor).alias("hi"), "bytes", "k")
    cold, hot = part.filter(F.col("k") <= group_rows), part.filter(F.col("k") > group_rows).filter("lo < hi")
    found = []
    while True:
        found.append(scratch.save(_sorted_repeats(cold, width, anchor), "repeats"))
        if hot.isEmpty():
            return reduce(DataFrame.unionByName, found)
        part = scratch.save(_halved(hot, width), "halves")
        of_sub = part.groupBy("sub").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("seg", "off")).alias("one")).select(F.col("sub").alias("c_sub"), "c", "one")
        part = scratch.save(part.join(of_sub, F.col("sub") == F.col("c_sub")), "parts")
        found.append(part.filter("c > 1 and m = 1").select("seg", F.array(F.struct(F.col("off").alias("a"), (F.col("off") + F.col("n")).alias("b"))).alias("at")))
        part = part.filter(F.struct("seg", "off") == F.col("one")).withColumn("m", F.when(F.col("c") > 1, F.lit(2).cast("long")).otherwise(F.col("m")))
        many = scratch.save(part.groupBy(F.col("key").alias("h_key")).agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > group_rows).select("h_key"), "hot")
        same = F.col("key") == F.col("h_key")
        cold, hot = part.join(many, same, "left_anti"), part.join(many, same, "left_semi").filter("lo < hi")


def remove_repeats(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, group_rows: int = GROUP_ROWS, keep_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans`` (start, end) of every row.

    With ``keep_text`` also ``kept``: the bytes that remain.
    """
    if not 8 <= anchor <= width:
        raise ValueError("an anchor has 8 bytes or more and fits the width")
    scratch = common.Scratch(docs.sparkSession, "suffix")
    rows = _keyed(docs)
    segs = scratch.save(_scan(rows, width, anchor), "segments")
    # distinct segments first: copies end here, before anything is grouped by anchor
    distinct = segs.groupBy("seg", "anchor", "n", "r").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("row", "at")).alias("one"))
    distinct = scratch.save(distinct, "distinct")
    scratch.release()
    # an anchor matters if two distinct segments or more share it and one of them was seen once
    of_anchor = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"), F.min("m").alias("least"))
    shared = of_anchor.filter("k > 1 and least = 1").select(F.col("anchor").alias("s_anchor"), "k")
    rest = scratch.save(distinct.join(shared, F.col("anchor") == F.col("s_anchor")).select("seg", "anchor", "n", "r", "m", "one", "k"), "shared")
    twice = scratch.save(distinct.filter("m > 1").select("seg", "n"), "twice")
    scratch.drop(distinct)
    scratch.release()
    wanted = rest.select("one.row", F.struct(F.col("one.at").alias("at"), "n", "r", "anchor", "k", "m", "seg").alias("w")).groupBy("row").agg(F.collect_list("w").alias("want"))

    @common.trims
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, want in zip(batch.column("text").to_pylist(), batch.column("want").to_pylist()):
                raw = text.encode()
                out += [(x["anchor"], x["k"], x["m"], x["seg"], x["r"], x["n"], raw[x["at"] : x["at"] + x["n"] + width - 1]) for x in want]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["anchor", "k", "m", "seg", "r", "n", "bytes"])

    texts = rows.select(F.col("row").alias("t_row"), "text")
    one_each = wanted.join(texts, F.col("row") == F.col("t_row")).dropDuplicates(["row"])  # of repeated rows
    fetched = one_each.select("text", "want").mapInArrow(fetch, "anchor long, k long, m long, seg binary, r int, n int, bytes binary")
    fetched = scratch.save(fetched, "bytes")
    scratch.release()
    found = _all_repeats(scratch, fetched, width, anchor, group_rows)
    # per text: window runs of its segments; a segment seen twice repeats as a whole
    whole = twice.select("seg", F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"))).alias("at"))
    runs = whole.unionByName(found).select(F.col("seg").alias("f_seg"), F.col("at").alias("runs"))
    hits = segs.join(runs, F.col("seg") == F.col("f_seg")).select("row", F.transform("runs", lambda x: F.struct((F.col("at") + x["a"]).alias("a"), (F.col("at") + x["b"] + F.lit(width - 1)).alias("b"))).alias("runs"))
    per_row = hits.groupBy(F.col("row").alias("p_row")).agg(F.flatten(F.collect_set("runs")).alias("runs"))
    out_schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<a:int,b:int>>" + (", kept binary" if keep_text else "")

    @common.trims
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in common.text_slices(batches):
            out, kept = [], []
            for i, (doc, own) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("runs").to_pylist())):
                d = data[offsets[i] : offsets[i + 1]]
                gone = np.zeros(len(d) + 1, np.int32)
                for x in own or ():
                    gone[x["a"]] += 1
                    gone[x["b"]] -= 1
                mask = np.cumsum(gone[:-1]) > 0
                spans = _runs(mask)
                left = d[~mask].tobytes()
                out.append((doc, len(d), int(mask.sum()), len(spans), hashlib.sha256(left).hexdigest(), [{"a": a, "b": b} for a, b in spans]))
                kept.append(left)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), _RUNS)
            a = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            yield pa.RecordBatch.from_arrays(a + [pa.array(kept, pa.binary())] * keep_text, names=names + ["kept"] * keep_text)

    done = rows.join(per_row, F.col("row") == F.col("p_row"), "left").select("doc_id", "text", "runs")
    return done.mapInArrow(finish, out_schema)
