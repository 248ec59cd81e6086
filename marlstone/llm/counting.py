"""Edit-aware token counts.

A document is kept as a tree over its pre-tokens: leaves are short stretches
of text that begin where a pre-token surely begins, inner nodes hold sums of
token counts.  An edit replaces a range of characters.  Only the leaves it
touches are encoded again, with as many leaves beside them as it takes until
both ends are sure boundaries again, and the sums above them are updated.

``build`` makes the trees once; as a table, a tree is its document's text with
the lengths and counts of its leaves.  ``apply_edits`` takes the trees with the
edits of a run and gives the trees after them, to be written for the next run;
a document without edits is not encoded again.

A sure boundary is a single U+0020 between two characters that are not white
space: no pre-token of a byte-level vocabulary crosses from a character that
is not a space into one.

Defined results: a null or empty text has no tokens and takes edits at 0.
Edits are applied in order of their start, in the coordinates of the text
before; an edit that overlaps one before it, or has nulls, or reaches outside
the text is clipped to what is left of its range.  Repeated rows are counted
one by one.  Documents without edits keep their count.  Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

LEAF_CHARS = 256

Edit = tuple[int, int, str]


def sure(text: str, i: int) -> bool:
    """A pre-token begins at i whatever else stands in the text."""
    return 0 < i < len(text) - 1 and text[i] == " " and not text[i - 1].isspace() and not text[i + 1].isspace()


def leaves(text: str, size: int = LEAF_CHARS) -> list[str]:
    """Cuts at sure boundaries, ``size`` characters apart or more."""
    out, at = [], 0
    while at < len(text):
        i = text.find(" ", at + size)
        while i != -1 and not sure(text, i):
            i = text.find(" ", i + 1)
        end = len(text) if i == -1 else i
        out.append(text[at:end])
        at = end
    return out


class CountTree:
    """Token counts of a text's leaves, with sums of subtrees."""

    def __init__(self, parts: Sequence[str], counts: Sequence[int]):
        self.parts = list(parts) or [""]
        counts = list(counts) or [0]
        self.size = 1 << (len(self.parts) - 1).bit_length()
        pad = self.size - len(self.parts)
        self.parts += [""] * pad
        self.tokens = [0] * self.size + counts + [0] * pad
        self.chars = [0] * self.size + [len(p) for p in self.parts]
        for i in range(self.size - 1, 0, -1):
            self._sum(i)
        self.encoded_chars = 0

    def _sum(self, i: int) -> None:
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.parts)

    def leaves(self) -> tuple[list[int], list[int]]:
        """Lengths and counts of the leaves that hold text."""
        at = [i for i, p in enumerate(self.parts) if p]
        return [self.chars[self.size + i] for i in at], [self.tokens[self.size + i] for i in at]

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (at the end: the last leaf with text) and where it begins."""
        if at >= self.length:
            at = max(0, self.length - 1)
        i, begun = 1, 0
        while i < self.size:
            i *= 2
            if at - begun >= self.chars[i]:
                begun += self.chars[i]
                i += 1
        return i - self.size, begun

    def _beside(self, leaf: int, step: int) -> int:
        leaf += step
        while 0 <= leaf < self.size and not self.parts[leaf]:
            leaf += step
        return leaf

    def edit(self, start: int, end: int, new: str, count) -> None:
        """Replace characters start to end; ``count`` gives the number of tokens of a text."""
        first, begun = self._find(start)
        last, last_begun = self._find(max(start, end - 1))
        region = "".join(self.parts[first : last + 1])
        region = region[: start - begun] + new + region[end - begun :]
        while (left := self._beside(first, -1)) >= 0 and not sure(self.parts[left][-1:] + region, 1):
            first, region = left, self.parts[left] + region
        while (right := self._beside(last, 1)) < self.size and not sure(region[-1:] + self.parts[right], 1):
            last, region = right, region + self.parts[right]
        self.encoded_chars += len(region)
        touched = range(first, last + 1)
        for i in touched:
            self.parts[i] = region if i == first else ""
            self.tokens[self.size + i] = count(region) if i == first and region else 0
            self.chars[self.size + i] = len(self.parts[i])
        for i in sorted({(self.size + k) >> d for k in touched for d in range(1, self.size.bit_length())}, reverse=True):
            self._sum(i)


def in_order(edits: Sequence[dict] | None, length: int) -> list[Edit]:
    """Edits by start, clipped to the text and to what the ones before have left."""
    out, at = [], 0
    for e in sorted((e for e in edits or [] if e and e["start"] is not None and e["end"] is not None), key=lambda e: (e["start"], e["end"])):
        a, b = min(max(e["start"], at), length), min(max(e["end"], at), length)
        out.append((a, max(a, b), e["text"] or ""))
        at = max(a, b)
    return out


TREES = "doc_id long, text string, leaf_chars array<int>, leaf_tokens array<int>"
EDITS = "array<struct<start:int,end:int,text:string>>"
COUNTS = "n_tokens long, n_edits int, n_tokens_after long, n_chars_after long, encoded_chars long"
_INTS = pa.list_(pa.int32())


def build(docs: DataFrame, vocabulary: dict[str, str]) -> DataFrame:
    """The trees of ``docs`` (doc_id, text), all leaves encoded."""

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(**vocabulary)
        for part, _, _ in common.text_slices(batches):
            split = [leaves(t or "") for t in part.column("text").to_pylist()]
            counts = np.array([len(x) for x in enc.encode([p for s in split for p in s])], np.int32)
            cuts = np.concatenate([[0], np.cumsum([len(s) for s in split])])
            chars = pa.array([[len(p) for p in s] for s in split], _INTS)
            found = pa.array([counts[a:b] for a, b in zip(cuts[:-1], cuts[1:])], _INTS)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), chars, found], names=["doc_id", "text", "leaf_chars", "leaf_tokens"])

    return common.pick(docs, {"doc_id": "long", "text": "string"}).mapInArrow(run, TREES)


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Trees with the edits of a table (doc_id, start, end, text) as an array ``edits``; a document's edits go to all its rows, those of no document to none."""
    e = edits.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("e_id"), F.struct(F.col("start").cast("int"), F.col("end").cast("int"), F.col("text").cast("string")).alias("e"))
    e = e.groupBy("e_id").agg(F.collect_list("e").alias("edits"))
    return trees.join(e, F.col("doc_id") == F.col("e_id"), "left").drop("e_id")


def apply_edits(trees: DataFrame, vocabulary: dict[str, str], keep_trees: bool = True) -> DataFrame:
    """Trees (with ``edits``: an array of struct(start, end, text), or null) after their edits, and token counts before and after.

    ``encoded_chars`` tells how much text the edits made the tokenizer see.
    Without ``keep_trees`` only doc_id and the counts are returned.
    """
    rows = trees.select("doc_id", "text", "leaf_chars", "leaf_tokens", F.col("edits").cast(EDITS).alias("edits"))
    schema = (TREES if keep_trees else "doc_id long") + ", " + COUNTS

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(**vocabulary)
        one = lambda t: len(enc.encode([t])[0])
        names = [x.split()[0] for x in schema.split(", ")]
        for part, _, _ in common.text_slices(batches):
            out = []
            for doc, text, chars, own, todo in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "leaf_chars", "leaf_tokens", "edits"))):
                chars, own, length = chars or [], own or [], len(text or "")
                before = sum(own)
                if not todo:
                    row = (doc, text, chars, own, before, 0, before, length, 0)
                else:
                    ends = np.cumsum([0, *chars]).tolist()
                    tree, shift = CountTree([(text or "")[a:b] for a, b in zip(ends[:-1], ends[1:])], own), 0
                    todo = in_order(todo, length)
                    for a, b, new in todo:
                        tree.edit(a + shift, b + shift, new, one)
                        shift += len(new) - (b - a)
                    row = (doc, tree.text() if keep_trees else None, *tree.leaves(), before, len(todo), tree.total, tree.length, tree.encoded_chars)
                out.append(row if keep_trees else (doc, *row[4:]))
            kinds = (pa.int64(), *((pa.string(), _INTS, _INTS) if keep_trees else ()), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return rows.mapInArrow(run, schema)


def with_redactions(trees: DataFrame) -> DataFrame:
    """Trees with the edits that replace personal data by its kind's name."""
    from . import pii

    kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())])

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _ in common.text_slices(batches):
            edits = [[{"start": a, "end": b, "text": f"<{k.upper()}>"} for k, a, b, _ in sorted(pii.spans(t or ""), key=lambda s: (s[1], -s[2]))] for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(edits, pa.list_(kind))], names=[*part.schema.names, "edits"])

    return trees.select("doc_id", "text", "leaf_chars", "leaf_tokens").mapInArrow(run, f"{TREES}, edits {EDITS}")
