"""Toxicity severity by cumulative-link ordinal regression on sparse word features.

P(grade <= k) = sigmoid(theta_k - w . x): one weight vector for all ordered
thresholds.  Features are the hashed distinct words of the whole text.
The model is fitted on the driver on at most ``max_train``
labelled texts (those with the least hashed id), and only words that occur in
``MIN_DOCS`` of them have a weight; the weight vector has a fixed size and is
broadcast.

Labels that only say toxic or not give the grades in two steps: a first fit
with one threshold scores the toxic training texts, and their score per word
splits them at the median into grades 1 and 2; the second fit is the ordinal
one.

Defined results: a null or empty text has no features; it gets the severity of
the thresholds alone.  Unlabelled or null labels are not trained on; of
repeated labels of a document the largest counts, of several texts of a
doc_id the least.  Without any labelled text
every severity is 0.  Repeated rows are scored one by one.  Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BITS = 18
MAX_TRAIN, MIN_DOCS, L1, STEPS = 20_000, 3, 3e-4, 150
TOXIC_AT = 0.2  # the penalty draws all probabilities towards the common grade, so the cut is below a half
TOKEN_BYTES = np.zeros(256, bool)
TOKEN_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    weights: np.ndarray  # 2 ** BITS
    thresholds: np.ndarray  # ascending, one fewer than grades

    def severity(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected grade, most likely grade, and P(grade >= 1)."""
        if not len(self.thresholds):
            z = np.zeros(len(score))
            return z, z.astype(np.int32), z
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - score[:, None], -30, 30)))
        p = np.diff(np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1), axis=1)
        return (1 - below).sum(axis=1), p.argmax(axis=1).astype(np.int32), 1 - below[:, 0]


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, feature, weight of all non-zero features, and the number of words of each text."""
    starts, ends = common.word_spans(data, offsets, TOKEN_BYTES)
    h = common.span_hashes(data, starts, ends, common.ASCII_LOWER) >> np.uint64(64 - BITS)
    first = common.words_by_text(offsets, starts)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first)).astype(np.uint64)
    keys = np.unique(text << np.uint64(BITS) | h)
    return (keys >> np.uint64(BITS)).astype(np.int64), (keys & np.uint64((1 << BITS) - 1)).astype(np.int64), np.ones(len(keys)), np.diff(first)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, grade: np.ndarray, n_grades: int, n_cols: int = 1 << BITS) -> Model:
    """Accelerated proximal gradient on the likelihood with an L1 penalty on scaled columns: few words keep a weight.

    The thresholds stay ordered as a first one and positive steps.
    """
    n = len(grade)
    used, where = np.unique(cols, return_inverse=True)
    # columns of equal length: else the commonest words set the step, and rare ones hardly move
    scale = np.sqrt(n / 100 / np.maximum(np.bincount(where, vals * vals, minlength=len(used)), 1e-9))
    vals = vals * scale[where]
    dot = lambda w: np.bincount(rows, vals * w[where], minlength=n)
    back = lambda g: np.bincount(where, vals * g[rows], minlength=len(used))
    v = np.ones(len(used))
    for _ in range(12):  # the largest curvature, by power iteration
        v = back(dot(v))
        size = np.linalg.norm(v) or 1.0
        v /= size
    rate = 4 * n / max(size, 1e-9) / 2
    cum = np.array([(grade <= k).mean() for k in range(n_grades - 1)]).clip(1e-3, 1 - 1e-3)
    theta = np.log(cum / (1 - cum))
    raw = np.concatenate([theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))])
    hi, lo = np.minimum(grade, n_grades - 2), np.maximum(grade - 1, 0)
    w = ahead = np.zeros(len(used))
    t = 1.0
    for _ in range(STEPS):
        theta = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
        s = dot(ahead)
        up = np.where(grade == n_grades - 1, 1.0, _sigmoid(theta[hi] - s))
        dn = np.where(grade == 0, 0.0, _sigmoid(theta[lo] - s))
        p = np.maximum(up - dn, 1e-9)
        g_up, g_dn = up * (1 - up) / p / n, dn * (1 - dn) / p / n
        step = ahead - rate * back(g_up - g_dn)
        new = np.sign(step) * np.maximum(np.abs(step) - rate * L1, 0)
        g_theta = np.bincount(hi, np.where(grade == n_grades - 1, 0, -g_up), minlength=n_grades - 1) + np.bincount(lo, np.where(grade == 0, 0, g_dn), minlength=n_grades - 1)
        tail = np.cumsum(g_theta[::-1])[::-1]
        raw = raw - np.concatenate([tail[:1], tail[1:] * np.exp(raw[1:])])
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (before - 1) / t * (new - w), new
    full = np.zeros(n_cols, np.float32)
    full[used] = w * scale
    return Model(full, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])])))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled texts: those whose id has the least hash."""
    lab = common.pick(labels, {"doc_id": "long", label: "int"}).filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    chosen = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    texts = common.pick(docs, {"doc_id": "long", "text": "string"}).join(F.broadcast(chosen), "doc_id")  # at most max_train rows
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))  # of an id with several texts the least, in every run

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in common.text_slices(batches):
            t, f, x, n = _features(data, offsets)
            cut = np.searchsorted(t, np.arange(len(offsets)))
            lists = [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(a)) for a in (f.astype(np.int32), x.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), *lists, pa.array(n, pa.int64())], names=["doc_id", "y", "f", "x", "n"])

    found = texts.mapInArrow(run, "doc_id long, y int, f array<int>, x array<float>, n long").limit(max_train).toArrow().sort_by("doc_id")
    y = (found.column("y").to_numpy() > 0).astype(int)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(1 << BITS, np.float32), np.zeros(0))
    r = np.repeat(np.arange(len(y)), pc.list_value_length(found.column("f")).to_numpy())
    c = pc.list_flatten(found.column("f")).to_numpy().astype(np.int64)
    v = pc.list_flatten(found.column("x")).to_numpy()
    enough = (np.bincount(c, minlength=1 << BITS) >= min(MIN_DOCS, max(1, len(y) // 20)))[c]
    r, c, v = r[enough], c[enough], v[enough]
    first = fit_ordinal(r, c, v, y, 2)
    density = np.bincount(r, v * np.maximum(first.weights[c], 0), minlength=len(y)) / np.log1p(found.column("n").to_numpy()).clip(1)
    grade = y + ((y == 1) & (density > np.median(density[y == 1]))).astype(int)
    return fit_ordinal(r, c, v, grade, 3) if grade.max() == 2 else first


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``expected_severity``, ``grade`` and ``toxic`` of every row."""
    weights = common.bounded_broadcast(docs.sparkSession, model.weights, 4 << BITS)
    thresholds = model.thresholds

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(weights.value, thresholds)
        for part, data, offsets in common.text_slices(batches):
            t, f, x, _ = _features(data, offsets)
            s = np.bincount(t, x * m.weights[f], minlength=part.num_rows)
            expected, grade, p = m.severity(s)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(expected, pa.float64()), pa.array(grade, pa.int32()), pa.array(p >= TOXIC_AT, pa.bool_())], names=["doc_id", "expected_severity", "grade", "toxic"])

    return common.pick(docs, {"doc_id": "long", "text": "string"}).mapInArrow(run, "doc_id long, expected_severity double, grade int, toxic boolean")
