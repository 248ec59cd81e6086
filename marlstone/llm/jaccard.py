"""N-gram Jaccard join: rare-first prefixes with length, positional and suffix filters.

The set of a text is its distinct k-word shingles (hashed).  Texts with equal
sets are one class.  Shingles are ordered rare first, by a count table over
all texts, then by hash; two sets that are similar enough share one of their
first ``n - ceil(t * n) + 1`` shingles, so classes meet on those.  A meeting
is a candidate only if the length and positional filters allow it, and the
suffix filter does so too: the hash range is cut into partitions, and the
parities of the counts in them, a bit each, bound the difference of two sets
from below.  With four partitions a shingle that bound is nearly the
difference itself.  Each candidate pair that is left is verified once, on the
whole sets.

For components not every pair is needed.  Each class is first verified with
one partner, the leader it meets most often; leaders are the classes that
others share most with.  What is connected by that is contracted.  Then come
rounds in which every component but a block's largest proposes its best
partners in other components; those are verified and contracted too.  A
round's proposals are bounded by components, not by pairs; the bound rises
from round to round and the last has none; a later round looks only at
shingles where a component had more partners than it proposed, so in the end
none is left that was not verified.  So a large group of near copies
costs a pair a member, and no link that matters is lost.  ``links`` verifies
all candidates instead.

A shingle's postings are cut into blocks of bounded size, and pairs are made
per pair of blocks.  Copies of a text make postings once a task.

Defined results: without words or text a set is empty and linked with nothing.
With fewer than k words the whole sequence is the one shingle.  Repeated rows
are documents of one class.  A null doc_id is kept and never a component's id,
which is null if no member has one.  An empty table gives no rows.  Extra
columns are ignored.  A set is known by its size and a 64-bit hash of all its
shingle hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

COUNT_BITS, COUNT_RANGES = (18, 22), 64
SKETCH_BITS = 2048  # of a posting's parities at most; a set's own may be longer
BLOCK_ROWS = 8192
SEEN_SETS = 200_000  # sets a task remembers, so that copies it meets make postings once
ROUNDS = (8, 256, None)  # pairs that a component may propose in a block; the last round has no bound
PAIRS_AT_ONCE = 1 << 18
NO_ID = -(1 << 63)


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def needed(na, nb, percent: int):
    """The least intersection of sets of these sizes that are similar enough."""
    return -(-percent * (na + nb) // (100 + percent))


def _sets(batches: Iterator[pa.RecordBatch], k: int, text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """The sorted distinct shingle hashes of each text."""
    for part, data, offsets in common.text_slices(batches, text):
        starts, ends = common.word_spans(data, offsets, common.WORD_BYTES)
        words = common.span_hashes(data, starts, ends, common.ASCII_LOWER)
        first = common.words_by_text(offsets, starts)
        h, at = common.shingle_hashes(words, first, k)
        cut = np.searchsorted(at, first)
        yield part, [np.unique(h[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


def _sig(u: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(u.tobytes(), digest_size=8).digest(), "little", signed=True)


def _parities(u: np.ndarray) -> np.ndarray:
    """Bits of a power of two of partitions, four times the set's size or more: is the number of its hashes there odd?"""
    m = max(64, 1 << (4 * len(u) - 1).bit_length()) if len(u) else 64
    return np.packbits(np.bincount((u & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1)


def _folded(x: np.ndarray, size: int) -> np.ndarray:
    """Parities of fewer partitions: two halves together, until the last axis has ``size`` entries."""
    while x.shape[-1] > size:
        half = x.shape[-1] // 2
        x = x[..., :half] ^ x[..., half:]
    return x


def _least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of two sets' symmetric difference: each hash in it flips one parity."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    return int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())


def _count_bits(docs: DataFrame) -> int:
    """Of the count table: it grows with the input (as far as the plan knows its size), between two fixed bounds."""
    known = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()).bit_length()
    least, most = COUNT_BITS
    return least if known > 60 else min(most, max(least, known - 12))


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text, and a key of the text that tells rows of one doc_id apart."""
    return common.pick(docs, {"doc_id": "long", "text": "string"}).withColumn("key", F.xxhash64("text"))


_SCAN = "kind int, doc_id long, key long, n long, sig long, sketch binary, odd binary, part int, counts binary"


def _scan(docs: DataFrame, k: int, bits: int) -> DataFrame:
    """For each text its set's size, hash and parities (kind 0; ``odd`` only where it exceeds a sketch); for each task its shingle counts (kind 1)."""

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _SCAN.split(", ")]
        counts = np.zeros(1 << bits, np.uint32)
        for part, sets in _sets(batches, k):
            every = np.concatenate(sets)
            counts += np.bincount((every & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits).astype(np.uint32)
            n, odd = part.num_rows, [_parities(u) for u in sets]
            sketch = [_folded(x, SKETCH_BITS // 8).tobytes() for x in odd]
            whole = [x.tobytes() if len(x) > SKETCH_BITS // 8 else None for x in odd]
            cols = [pa.array(np.zeros(n), pa.int32()), *(common.int_column(part, c) for c in ("doc_id", "key")), pa.array([len(u) for u in sets], pa.int64()), pa.array([_sig(u) for u in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sketch, pa.binary()), pa.array(whole, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        if counts.any():
            m = COUNT_RANGES
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(m), pa.int32()), *[pa.nulls(m, pa.int64())] * 4, *[pa.nulls(m, pa.binary())] * 2, pa.array(range(m), pa.int32()), pa.array([c.tobytes() for c in np.split(counts, m)], pa.binary())], names=names)

    return _texts(docs).mapInArrow(run, _SCAN)


def _count_table(scan: DataFrame, bits: int) -> np.ndarray:
    """The tasks' counts summed, a range of them at a time in a task; 2 ** bits numbers."""

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for p, c in zip(b.column(0).to_pylist(), b.column(1)):
                total[p] = total.get(p, 0) + np.frombuffer(c.as_buffer(), np.uint32).astype(np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["part", "counts"])

    out = np.zeros(1 << bits, np.int64)
    size = (1 << bits) // COUNT_RANGES
    for r in scan.filter("kind = 1").select("part", "counts").repartition("part").mapInArrow(run, "part int, counts binary").collect():
        out[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["counts"], np.int64)
    return out


def _postings(docs: DataFrame, k: int, percent: int, counts, block: int) -> DataFrame:
    """The rare-first prefix of every set, once a task; ``salt`` is -1 unless the shingle is hot."""

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        mask = np.uint64(len(table) - 1)
        full = max(block, 8 * int(table.mean()))
        seen: set[tuple[int, int]] = set()
        for _, sets in _sets(batches, k):
            tok, salt, sig, place = [], [], [], []
            for u in sets:
                if not (n := len(u)) or (n, s := _sig(u)) in seen:
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add((n, s))
                c = table[(u & mask).astype(np.int64)]
                order = np.lexsort((u, c))[: prefix_length(n, percent)]
                tok.append(u[order])
                salts = -(-c[order] // full)
                with np.errstate(over="ignore"):
                    mixed = common.mix64(u[order] ^ np.uint64(s & 0xFFFFFFFFFFFFFFFF))
                salt.append(np.where(salts > 1, (mixed % np.maximum(salts, 1).astype(np.uint64)).astype(np.int64), -1))
                sig.append(np.full(len(order), s))
                place.append((n << 32) + np.arange(len(order)))
            if tok:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tok).view(np.int64)), pa.array(np.concatenate(salt), pa.int32()), pa.array(np.concatenate(sig), pa.int64()), pa.array(np.concatenate(place), pa.int64())], names=["token", "salt", "sig", "place"])

    return common.pick(docs, {"doc_id": "long", "text": "string"}).mapInArrow(run, "token long, salt int, sig long, place long")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Sorted batches again, cut so that no group of equal keys is split; with the groups' starts and the end."""
    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]) if held is not None else t
        if not t.num_rows:
            continue
        same = np.ones(t.num_rows - 1, bool)
        for key in keys:
            a = t.column(key).to_numpy()
            same &= a[1:] == a[:-1]
        new = np.concatenate([[0], np.flatnonzero(~same) + 1])
        held = t.slice(new[-1])
        if len(new) > 1:
            yield t.slice(0, new[-1]), new
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


_MEET = "token long, block long, sig long, n long, pos long"


def _meetings(postings: DataFrame, block: int) -> DataFrame:
    """Postings of shingles that two classes or more share, in blocks of at most ``block`` rows.

    A shingle's rows stream past; of those that a batch does not end, only the first is held.
    """

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count, last, held = None, 0, None, None  # of the group that the batch before ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy().astype(np.int64) for c in ("token", "salt", "sig", "place")]
            if key == (cols[0][0], cols[1][0]):
                copies = int(np.argmax(np.append((cols[0] != key[0]) | (cols[1] != key[1]) | (cols[2] != last[0]) | (cols[3] != last[1]), True)))
                cols = [c[copies:] for c in cols]
                if not len(cols[0]):
                    continue
            if key is None or not len(cols[0]) or key != (cols[0][0], cols[1][0]):
                count = 0
                held = None
            elif held is not None:
                cols = [np.concatenate([[h], c]) for h, c in zip(held, cols)]
                count, held = 0, None
            token, salt, sig, place = cols
            new_group = np.concatenate([[True], (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])])
            fresh = new_group | np.concatenate([[True], (sig[1:] != sig[:-1]) | (place[1:] != place[:-1])])
            token, salt, sig, place, new_group = (c[fresh] for c in (token, salt, sig, place, new_group))
            starts = np.flatnonzero(new_group)
            size = np.diff(np.append(starts, len(token)))
            size[0] += count
            group = np.cumsum(new_group) - 1
            at = np.arange(len(token)) - starts[group]
            at[group == 0] += count
            keep = (size[group] > 1) | (salt >= 0)
            key, last, count = (token[-1], salt[-1]), (sig[-1], place[-1]), int(size[-1])
            if not keep[-1]:
                held, count = (token[-1], salt[-1], sig[-1], place[-1]), 0
            if keep.any():
                out = [token, (salt + 1) * (1 << 32) + at // block, sig, place >> 32, place & 0xFFFFFFFF]
                yield pa.RecordBatch.from_arrays([pa.array(c[keep], pa.int64()) for c in out], names=[x.split()[0] for x in _MEET.split(", ")])

    return postings.repartition("token", "salt").sortWithinPartitions("token", "salt", "place", "sig").mapInArrow(run, _MEET)


def _allowed(percent: int, na: Column, pa_: Column, nb: Column, pb: Column) -> Column:
    """Length and positional filter."""
    least = F.ceil((percent * (na + nb)) / F.lit(float(100 + percent)) - F.lit(1e-9))
    most = F.least(pa_, pb) + 1 + F.least(na - pa_, nb - pb) - 1
    return (percent * F.greatest(na, nb) <= 100 * F.least(na, nb)) & (most >= least)


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def _class_sets(docs: DataFrame, scratch: common.Scratch, pairs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """The whole sets of the classes in ``pairs`` (a, b), each read from one of its texts.

    Texts are not shuffled: a Bloom filter of the chosen rows goes to them.  A
    set that comes by its error or twice does no harm.
    """
    chosen = lambda i, key: F.xxhash64(i, key).alias("h")
    reps = members.select(F.struct("n", "sig").alias("m_node"), chosen("rep.id", "rep.key"))
    wanted = scratch.save(reps.join(_nodes(pairs), F.col("m_node") == F.col("node"), "left_semi").select("h"), "wanted")
    bits = common.bounded_broadcast(docs.sparkSession, common.bloom(wanted), 1 << (common.BLOOM_BITS[1] - 3))

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # of repeated rows; so a set need not come twice from a task
        some = (b.filter(pa.array(common.in_bloom(bits.value, b.column(0).to_numpy().view(np.uint64)))) for b in batches)
        for _, sets in _sets(some, k):
            out = []
            for u in sets:
                node = (len(u), _sig(u))
                if node not in seen:
                    if len(seen) >= SEEN_SETS:
                        seen.clear()
                    seen.add(node)
                    out.append((*node, u.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))], names=["n", "sig", "shingles"])

    texts = _texts(docs).select(chosen(F.coalesce("doc_id", F.lit(NO_ID)), "key"), "text")
    return texts.mapInArrow(run, "n long, sig long, shingles binary")


def _near_enough(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Suffix filter: pairs (a, b, times) of a written table whose parities don't rule them out."""
    odd = members.select(F.struct("n", "sig").alias("m_node"), F.coalesce("odd", "sketch").alias("odd"))
    odd = odd.join(_nodes(pairs), F.col("m_node") == F.col("node"), "left_semi")
    j = pairs.join(odd.select(F.col("m_node").alias("a"), F.col("odd").alias("odd_a")), "a")
    j = j.join(odd.select(F.col("m_node").alias("b"), F.col("odd").alias("odd_b")), "b")

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = pc.struct_field(batch.column(0), "n").to_numpy() + pc.struct_field(batch.column(1), "n").to_numpy()
            least = np.array([_least_difference(x, y) for x, y in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())], np.int64)
            yield batch.select([0, 1, 2]).filter(pa.array(least <= both - 2 * needed(both, 0, percent)))

    node = "struct<n:bigint,sig:bigint>"
    return j.select("a", "b", "times", "odd_a", "odd_b").mapInArrow(run, f"a {node}, b {node}, times long")


def _similar(a: np.ndarray, b: np.ndarray, percent: int, depth: int = 4) -> bool:
    """Suffix filter by splitting both sets at pivots, then the intersection itself."""
    least = int(needed(len(a), len(b), percent))
    pivots = a[np.linspace(0, len(a) - 1, min(len(a), 1 << depth)).astype(np.int64)]
    ca, cb = np.searchsorted(a, pivots), np.searchsorted(b, pivots)
    differ = np.abs(np.diff(ca, prepend=0, append=len(a)) - np.diff(cb, prepend=0, append=len(b))).sum()
    if differ > len(a) + len(b) - 2 * least:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common_n = int((both[1:] == both[:-1]).sum())
    return 100 * common_n >= percent * (len(a) + len(b) - common_n)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b: struct n, sig) whose sets are similar enough."""
    j = pairs.join(sets.select(F.struct("n", "sig").alias("a"), F.col("shingles").alias("s_a")), "a")
    j = j.join(sets.select(F.struct("n", "sig").alias("b"), F.col("shingles").alias("s_b")), "b")

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            ok = [_similar(np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64), percent) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], names=["a", "b"])

    node = "struct<n:bigint,sig:bigint>"
    return j.select("a", "b", "s_a", "s_b").mapInArrow(run, f"a {node}, b {node}")


def _sketches(column: pa.ChunkedArray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Words of each row's sketch, and for each number of words that occurs the sketches of all rows with as many or more, folded to it."""
    raw = column.to_pylist()
    words = np.array([len(x) // 8 for x in raw])
    own = {s: np.frombuffer(b"".join(raw[i] for i in np.flatnonzero(words == s)), np.uint64).reshape(-1, s) for s in np.unique(words).tolist()}
    out = {}
    for s in own:
        out[s] = np.zeros((len(raw), s), np.uint64)
        for t, rows in own.items():
            if t >= s:
                out[s][words == t] = _folded(rows, s)
    return words, out


def _codes(*columns: np.ndarray) -> np.ndarray:
    """A number for each distinct combination."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _block_pairs(t: pa.Table, new: np.ndarray, percent: int, most: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidate pairs (rows x, y) between components, group by group; the best ``most`` that each component but the largest has, and whether it has more.

    Every pair between two components has a row outside the group's largest, so only those look for partners.
    """
    block, n, sig, pos, c_n, c_sig, i_, j_ = (t.column(c).to_numpy() for c in ("block", "n", "sig", "pos", "c_n", "c_sig", "i", "j"))
    size = np.diff(new)
    group = np.repeat(np.arange(len(size)), size)
    of = _codes(c_n, c_sig, group)
    first_of, rows_of = np.unique(of, return_index=True, return_counts=True)[1:]
    by_size = np.lexsort((rows_of, group[first_of]))
    largest = np.zeros(len(size), np.int64)
    largest[group[first_of[by_size]]] = by_size  # the last of a group stays
    left = np.flatnonzero(of != largest[group])
    words, folded = _sketches(t.column("sketch"))
    until = np.cumsum(size[group[left]])
    at = 0
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
        some = left[at:to]
        many = size[group[some]]
        x = np.repeat(some, many)
        y = np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(new[:-1][group[some]], many)
        ok = (of[x] != of[y]) & ((i_[x] == j_[x]) | (block[x] != block[y]))
        ok &= percent * np.maximum(n[x], n[y]) <= 100 * np.minimum(n[x], n[y])
        x, y = x[ok], y[ok]
        least = needed(n[x], n[y], percent)
        ok = np.minimum(pos[x], pos[y]) + np.minimum(n[x] - pos[x], n[y] - pos[y]) >= least
        x, y, least = x[ok], y[ok], least[ok]
        differ = np.zeros(len(x), np.int64)
        short = np.minimum(words[x], words[y])
        for s, rows in folded.items():
            which = np.flatnonzero(short == s)
            for lo in range(0, len(which), 1 << 16):
                w = which[lo : lo + (1 << 16)]
                differ[w] = np.bitwise_count(rows[x[w]] ^ rows[y[w]]).sum(axis=1)
        ok = differ <= n[x] + n[y] - 2 * least
        x, y, near = x[ok], y[ok], differ[ok] / (n[x[ok]] + n[y[ok]])
        order = np.lexsort((near, of[x]))
        x, y = x[order], y[order]
        if len(x):
            begin = np.flatnonzero(np.concatenate([[True], of[x][1:] != of[x][:-1]]))
            have = np.diff(np.append(begin, len(x)))
            rank = np.arange(len(x)) - np.repeat(begin, have)
            more = np.repeat(have, have) > (most or len(x))
            take = rank < (most or len(x))
            yield x[take], y[take], more[take]
        at = to


def _cross_pairs(meet: DataFrame, percent: int, most: int | None) -> DataFrame:
    """Candidate pairs (a, b) between components, and the ``token`` where a component had more of them.

    ``meet``: token, block, b0, b1 (the token's first and last block), n, sig,
    pos, c_n, c_sig (component), sketch.  A token's blocks are paired with each other.
    """
    plain = meet.filter("b0 = b1").withColumns({"i": F.col("block"), "j": F.col("block")})
    hot = meet.filter("b0 <> b1")
    blocks = hot.select(F.col("token").alias("o_token"), F.col("block").alias("o")).distinct()
    hot = hot.join(blocks, F.col("token") == F.col("o_token")).withColumns({"i": F.least("block", "o"), "j": F.greatest("block", "o")})
    columns = ["token", "i", "j", "block", "n", "sig", "pos", "c_n", "c_sig", "sketch"]
    rows = plain.select(*columns).unionByName(hot.select(*columns)).repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    node = pa.struct([("n", pa.int64()), ("sig", pa.int64())])

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, new in _groups(batches, ["token", "i", "j"]):
            n, sig = t.column("n").to_numpy(), t.column("sig").to_numpy()
            token = t.column("token").to_numpy()
            for x, y, more in _block_pairs(t, new, percent, most):
                where = pa.array(token[x], mask=~more)
                swap = (n[x] > n[y]) | (n[x] == n[y]) & (sig[x] > sig[y])
                x, y = np.where(swap, y, x), np.where(swap, x, y)
                yield pa.RecordBatch.from_arrays([*(pa.StructArray.from_arrays([pa.array(n[r]), pa.array(sig[r])], fields=list(node)) for r in (x, y)), where], names=["a", "b", "token"])

    kind = "struct<n:bigint,sig:bigint>"
    return rows.mapInArrow(run, f"a {kind}, b {kind}, token long")


def _prepare(docs: DataFrame, scratch: common.Scratch, k: int, percent: int, block: int):
    bits = _count_bits(docs)
    scan = scratch.save(_scan(docs, k, bits), "scan")
    counts = common.bounded_broadcast(docs.sparkSession, _count_table(scan, bits), 8 << COUNT_BITS[1])
    rows = scan.filter("kind = 0").select("doc_id", "key", "n", "sig", "sketch", "odd")
    rep = F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "key")).alias("rep")
    classes = rows.filter("n > 0").groupBy("sig", "n").agg(rep, F.min("doc_id").alias("least_id"), F.first("sketch").alias("sketch"), F.first("odd").alias("odd"))
    meet = scratch.save(_meetings(_postings(docs, k, percent, counts, block), block), "meetings")
    scratch.release()
    members = scratch.save(meet.select("sig", "n").distinct().join(classes, ["sig", "n"]), "members")
    return scan, rows, classes, meet, members


def _checked(docs: DataFrame, scratch: common.Scratch, pairs: DataFrame, members: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs of a written table that are links, written."""
    sets = scratch.save(_class_sets(docs, scratch, pairs, members, k), "sets")
    found = scratch.save(_verify(pairs, sets, percent), "links")
    scratch.drop(sets)
    scratch.release()
    return found


def _with_leaders(scratch: common.Scratch, meet: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Each posting with the leader of its block, the class whose prefix is shared most; and the table that it reads.

    A copy's edits make rare shingles that nobody shares, and they fill its
    prefix; the text that was copied has none of them.  So the most shared
    class is the one that most others are near to.
    """
    size = F.col("n") - F.floor((percent * F.col("n") + 99) / 100).cast("long") + 1
    share = meet.groupBy("sig", "n").agg(F.count(F.lit(1)).alias("met")).select("sig", "n", (F.col("met") / size).alias("share"))
    m = scratch.save(meet.join(share, ["sig", "n"]), "shares")
    lead = m.groupBy(F.col("token").alias("l_token"), F.col("block").alias("l_block")).agg(F.max(F.struct("share", F.negate("n").alias("small"), "sig", "n", "pos")).alias("l"))
    lead = lead.select("l_token", "l_block", F.col("l.sig").alias("l_sig"), F.col("l.n").alias("l_n"), F.col("l.pos").alias("l_pos"))
    return m.join(lead, (F.col("token") == F.col("l_token")) & (F.col("block") == F.col("l_block"))).select("sig", "n", "pos", "l_sig", "l_n", "l_pos"), m


def _first_pairs(scratch: common.Scratch, meet: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Of each class the leader that it meets most often and may be similar to."""
    met, shares = _with_leaders(scratch, meet, percent)
    met = met.filter((F.col("sig") != F.col("l_sig")) | (F.col("n") != F.col("l_n"))).filter(_allowed(percent, F.col("n"), F.col("pos"), F.col("l_n"), F.col("l_pos")))
    a, b = F.struct("n", "sig"), F.struct(F.col("l_n").alias("n"), F.col("l_sig").alias("sig"))
    pairs = scratch.save(met.groupBy(a.alias("a"), b.alias("b")).agg(F.count(F.lit(1)).alias("times")), "candidates")
    scratch.drop(shares)
    scratch.release()
    return _near_enough(pairs, members, percent).groupBy("a").agg(F.max(F.struct("times", "b")).alias("m")).select("a", F.col("m.b").alias("b"))


def _open(scratch: common.Scratch, meet: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Postings (with their component c, and their token's first and last block) of tokens that two components or more share, written."""
    own = F.struct("n", "sig")
    m = meet.select("token", "block", "n", "sig", "pos")
    if roots is None:
        m = m.withColumn("c", own)
    else:
        m = m.join(roots, own == F.col("node"), "left").withColumn("c", F.coalesce("root", own)).drop("node", "root")
    m = scratch.save(m, "components")
    several = m.groupBy(F.col("token").alias("o_token")).agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("block").alias("b0"), F.max("block").alias("b1")).filter("lo <> hi").select("o_token", "b0", "b1")
    out = scratch.save(m.join(several, F.col("token") == F.col("o_token")).drop("o_token"), "open")
    scratch.drop(m)
    return out


def _open_pairs(scratch: common.Scratch, open_: DataFrame, members: DataFrame, percent: int, most: int | None) -> DataFrame:
    """Candidate pairs (a, b) between components, and tokens where some have more of them, written."""
    m = open_.join(members.select("sig", "n", "sketch"), ["sig", "n"]).select("token", "block", "b0", "b1", "n", "sig", "pos", F.col("c.n").alias("c_n"), F.col("c.sig").alias("c_sig"), "sketch")
    return scratch.save(_cross_pairs(m, percent, most), "met")


def components(docs: DataFrame, k: int = 5, percent: int = 80, block: int = BLOCK_ROWS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``set_id`` of every row of docs.

    ``component_id``: the smallest doc_id reachable by links, the row's own
    included; two rows are linked if the Jaccard similarity of their sets is
    ``percent`` percent or more.
    """
    out = _components(docs, k, percent, block)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.col("sig").alias("set_id"))


def _components(docs: DataFrame, k: int, percent: int, block: int = BLOCK_ROWS, rounds: Sequence[int | None] = ROUNDS) -> DataFrame:
    """``doc_id``, set (``n``, ``sig``), ``root`` and ``component_id`` of every row; the root tells components without ids apart."""
    scratch = common.Scratch(docs.sparkSession, "jaccard")
    scan, rows, classes, meet, members = _prepare(docs, scratch, k, percent, block)
    tried = scratch.save(_first_pairs(scratch, meet, members, percent), "pairs")
    links = _checked(docs, scratch, tried, members, k, percent)
    for most in rounds:
        roots = scratch.save(common.connected_components(scratch, links), "roots")
        before, meet = meet, _open(scratch, meet, roots)
        scratch.drop(before)
        met = _open_pairs(scratch, meet, members, percent, most)
        if met.isEmpty():
            break
        done = tried.select(F.least("a", "b").alias("t_a"), F.greatest("a", "b").alias("t_b"))
        new = met.select("a", "b").distinct().join(done, (F.col("a") == F.col("t_a")) & (F.col("b") == F.col("t_b")), "left_anti").select("a", "b", F.lit(1).cast("long").alias("times"))
        new = scratch.save(_near_enough(scratch.save(new, "candidates"), members, percent).select("a", "b"), "pairs")
        found = _checked(docs, scratch, new, members, k, percent)
        # where nothing was left out all candidates are verified now, and merging components makes no new ones
        left = scratch.save(met.filter("token is not null").select(F.col("token").alias("l_token")).distinct(), "left")
        whole = left.isEmpty()
        if not found.isEmpty():
            links = scratch.save(links.unionByName(found), "links")
            if whole:
                roots = scratch.save(common.connected_components(scratch, links), "roots")
        if whole:
            break
        tried = scratch.save(tried.unionByName(new), "tried")
        meet = scratch.save(meet.join(left, F.col("token") == F.col("l_token"), "left_semi"), "again")
        scratch.release()
    scratch.drop_all_but(scan, roots)
    known = classes.select("sig", "n", "least_id").join(roots, F.struct("n", "sig") == F.col("node"), "left")
    known = known.withColumn("root", F.coalesce("root", F.struct("n", "sig")))
    least = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_class = known.select(F.col("sig").alias("c_sig"), F.col("n").alias("c_n"), "root").join(least, "root")
    out = rows.select("doc_id", "n", "sig").join(by_class, (F.col("sig") == F.col("c_sig")) & (F.col("n") == F.col("c_n")), "left")
    return out.select("doc_id", "n", "sig", "root", "component_id")


def links(docs: DataFrame, k: int = 5, percent: int = 80, block: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """All links between classes (a_id, b_id: their smallest doc_ids), and membership (doc_id, class_id)."""
    scratch = common.Scratch(docs.sparkSession, "jaccard")
    scan, rows, classes, meet, members = _prepare(docs, scratch, k, percent, block)
    met = _open_pairs(scratch, _open(scratch, meet, None), members, percent, None).select("a", "b").distinct().withColumn("times", F.lit(1).cast("long"))
    pairs = scratch.save(_near_enough(scratch.save(met, "candidates"), members, percent).select("a", "b"), "pairs")
    found = _checked(docs, scratch, pairs, members, k, percent)
    scratch.drop_all_but(scan, found)
    found = found.distinct()
    ids = classes.select(F.struct("n", "sig").alias("node"), F.col("least_id"))
    out = found.join(ids.withColumnsRenamed({"node": "a", "least_id": "a_id"}), "a").join(ids.withColumnsRenamed({"node": "b", "least_id": "b_id"}), "b").select("a_id", "b_id")
    member = rows.join(classes.select("sig", "n", F.col("least_id").alias("class_id")), ["sig", "n"]).select("doc_id", "class_id")
    return out, member


def _with_sets(docs: DataFrame, k: int, own_n: str, own_sig: str) -> DataFrame:
    """docs with each row's set as its last columns, named so."""
    n, (whole,) = len(docs.columns), common.free(docs, "text_")
    schema = docs.select("*", F.lit(0).cast("long").alias(own_n), F.lit(0).cast("long").alias(own_sig)).schema

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, k, whole):
            names = [*part.schema.names[:n], own_n, own_sig]
            yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array([len(u) for u in sets], pa.int64()), pa.array([_sig(u) for u in sets], pa.int64())], names=names)

    return docs.select("*", F.col("text").cast("string").alias(whole)).mapInArrow(run, schema)


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Of each component one row: the smallest doc_id's, or any where all ids are null.  Texts without words stay.

    Rows are decided one by one, by their doc_id and their set: a null or
    repeated doc_id says nothing of the other rows that have it.  Repeated rows
    (equal id and text) without words count once, those with a null id all stay.
    """
    spark: SparkSession = docs.sparkSession
    scratch = common.Scratch(spark, "keep-one")
    parts: list[str] = []
    with common.noted(parts):
        found = _components(docs, k, percent)
    found = scratch.save(found, "components")
    for part in parts:
        common.delete(spark, part)
    other, own_n, own_sig = common.free(docs, "g_id", "own_n", "own_sig")
    b_id, b_n, b_sig = common.free(docs, "b_id", "b_n", "b_sig")
    key = F.col("doc_id").cast("long")
    best = found.filter("n > 0").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "n", "sig")).alias("b"))
    best = scratch.save(best.select("b.doc_id", "b.n", "b.sig"), "best")
    again = scratch.save(found.filter("doc_id is not null").groupBy(F.col("doc_id").alias(other)).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(other), "again")
    gone = found.filter("n > 0 and doc_id is not null").select("doc_id").join(best.select("doc_id"), "doc_id", "left_anti").select(F.col("doc_id").alias(other))
    single = docs.filter(key.isNotNull()).join(gone.unionByName(again).distinct(), key == F.col(other), "left_anti")
    unsure = docs.filter(key.isNotNull()).join(again, key == F.col(other), "left_semi").unionByName(docs.filter(key.isNull()))
    rows = _with_sets(unsure, k, own_n, own_sig)
    blank = rows.filter(F.col(own_n) == 0)
    blank = blank.filter(key.isNull()).unionByName(blank.filter(key.isNotNull()).dropDuplicates(["doc_id", "text"]))
    b = best.select(F.col("doc_id").alias(b_id), F.col("n").alias(b_n), F.col("sig").alias(b_sig))
    kept = rows.filter(F.col(own_n) > 0).join(b, (F.col(own_sig) == F.col(b_sig)) & (F.col(own_n) == F.col(b_n)) & key.eqNullSafe(F.col(b_id)), "left_semi").dropDuplicates(["doc_id", own_n, own_sig])
    return single.unionByName(kept.unionByName(blank).drop(own_n, own_sig))
