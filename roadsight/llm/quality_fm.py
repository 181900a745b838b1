"""Quality classifier: a factorisation machine over hashed words and text statistics.

score(x) = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

The pair term over all features costs one pass over the features for each factor (sum of squares
identity).  Features of a text: presence-weighted counts of hashed words, and statistics of its
structure (case, symbols, digits, word lengths, repetition, lines, length).  Nothing else of a row
is looked at.  A null text counts as empty; an empty text has no feature and gets the score of the
bias alone, as learnt from all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from roadsight.llm.common import binary_parts, space_words

BUCKETS = 1024
#: Most labelled rows that a fit uses; the rows with the smallest hash of their id are taken.
MAX_FIT_ROWS = 8192
THRESHOLD = 0.7
_STATS = 13
WIDTH = BUCKETS + 2 * _STATS


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        mixed = x @ self.factors
        pairs = 0.5 * ((mixed ** 2).sum(1) - (x ** 2) @ (self.factors ** 2).sum(1))
        z = self.bias + x @ self.linear + pairs
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


_CLASS = np.zeros(256, np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 blank, 5 line end, 6 symbol, 7 above ASCII
_CLASS[33:48] = _CLASS[58:65] = _CLASS[91:97] = _CLASS[123:127] = 6
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 7
_CLASS[[32, 9, 11, 12]] = 4
_CLASS[[10, 13]] = 5
_PLAIN = np.isin(np.arange(256), [ord(c) for c in ".,;:?'\"-"])


def features(data: np.ndarray, offsets: np.ndarray, hasher) -> np.ndarray:
    """Feature rows of the texts in a byte buffer (float32, ``WIDTH`` columns)."""
    n = len(offsets) - 1
    x = np.zeros((n, WIDTH), np.float32)
    hashes, counts = hasher.texts(data, offsets)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    for i in range(n):
        raw = data[offsets[i]:offsets[i + 1]]
        words = hashes[bounds[i]:bounds[i + 1]]
        if not len(words):
            continue
        size, m = len(raw), len(words)
        kinds = np.bincount(_CLASS[raw], minlength=8) / size
        odd = np.count_nonzero(~_PLAIN[raw] & (_CLASS[raw] == 6)) / m
        unique, times = np.unique(words, return_counts=True)
        letters = max(kinds[1] + kinds[2] + kinds[7], 1e-9)
        stats = np.array([
            kinds[2] / letters, kinds[3], kinds[6], kinds[7], min(1.0, odd),
            min(1.0, size / m / 20), 1 - len(unique) / m, times.max() / m,
            np.count_nonzero(words[1:] == words[:-1]) / m, min(1.0, kinds[5] * size / m),
            min(1.0, np.log1p(m) / 12), min(1.0, (kinds[4] + kinds[5]) * 2), 1.0 if m < 12 else 0.0])
        x[i, :BUCKETS] = np.log1p(np.bincount((unique % np.uint64(BUCKETS)).astype(np.int64), times, BUCKETS))
        x[i, :BUCKETS] /= np.linalg.norm(x[i, :BUCKETS])
        x[i, BUCKETS:BUCKETS + _STATS] = stats
        x[i, BUCKETS + _STATS:] = np.sqrt(stats)
    return x


def _batched(columns, row):
    """Arrow map over texts in runs of bounded size; ``row`` gets a record batch and its feature rows."""
    def apply(batches):
        hasher = space_words()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                data, offsets = binary_parts(part.column(columns - 1))
                yield row(part, features(data, offsets, hasher))
    return apply


def labelled_features(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``max_rows`` labelled rows (a documented bound).

    One label an id: ids with contradicting or null labels are left out.  Rows with
    crc32(doc_id) mod 4 = 2 are held out.
    """
    import pyarrow as pa

    one = (labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
           .agg(F.min("quality").alias("y"), F.max("quality").alias("y1")).where("y = y1")
           .where(~held_out(F.col("doc_id")))
           .orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(max_rows).select("doc_id", "y"))
    texts = docs.select(F.col("doc_id"), F.col("text").cast("binary").alias("text"))
    joined = (texts.join(F.broadcast(one), "doc_id")  # at most max_rows rows
              .dropDuplicates(["doc_id"]).select("doc_id", "y", "text"))

    def row(part, x):
        packed = [v.astype(np.float16).tobytes() for v in x]
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1).cast(pa.int64()), pa.array(packed, pa.binary())], ["doc_id", "y", "x"])

    rows = joined.mapInArrow(_batched(3, row), "doc_id long, y long, x binary").toArrow().sort_by("doc_id")
    y = rows["y"].to_numpy().astype(np.float32)
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float16).reshape(len(y), WIDTH).astype(np.float32)
    return x, y


def fit(x: np.ndarray, y: np.ndarray, factors: int = 8, epochs: int = 40, step: float = 0.05,
        decay: float = 1e-5, seed: int = 7) -> Model:
    """AdaGrad on the log loss; the same rows give the same model.  Without rows every score is 0.5."""
    rng = np.random.default_rng(seed)
    width = x.shape[1] if x.ndim == 2 else WIDTH
    linear, v = np.zeros(width, np.float32), (0.02 * rng.standard_normal((width, factors))).astype(np.float32)
    if not len(y):
        return Model(0.0, linear, v * 0)
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    bias, gb, gl, gv = np.log(mean / (1 - mean)), 1e-6, np.full(width, 1e-6, np.float32), np.full(v.shape, 1e-6, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 256):
            xs, ys = x[order[at:at + 256]], y[order[at:at + 256]]
            miss = ((Model(bias, linear, v).scores(xs) - ys) / len(ys)).astype(np.float32)
            db, dl = float(miss.sum()), miss @ xs + decay * linear
            dv = xs.T @ (miss[:, None] * (xs @ v)) - v * (miss @ xs ** 2)[:, None] + decay * v
            gb, gl, gv = gb + db * db, gl + dl * dl, gv + dv * dv
            bias -= step * db / np.sqrt(gb)
            linear -= step * dl / np.sqrt(gl)
            v -= step * dv / np.sqrt(gv)
    return Model(float(bias), linear, v)


def held_out(doc_id):
    return (F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2) & doc_id.isNotNull()


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> Model:
    return fit(*labelled_features(docs, labels, max_rows))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted.  A row without id is not held out."""
    import pyarrow as pa

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                        F.col("text").cast("binary").alias("text"))

    def row(part, x):
        s = model.scores(x)
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"])

    return texts.mapInArrow(_batched(3, row), "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the model accepts, all columns as they were."""
    import pyarrow as pa

    at = docs.columns.index("text")

    def apply(batches):
        hasher = space_words()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                data, offsets = binary_parts(part.column(at).cast(pa.binary()))
                good = model.scores(features(data, offsets, hasher)) >= THRESHOLD
                yield part.filter(pa.array(good))

    return docs.mapInArrow(apply, docs.schema)
